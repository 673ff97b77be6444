import json

from pyspark.sql import functions as F

from tracequarry.sources import specs, stores, trajectories, transcripts


def write(path, lines):
    path.write_text("\n".join(x if isinstance(x, str) else json.dumps(x, ensure_ascii=False) for x in lines), encoding="utf-8")
    return str(path)


def test_lenient_lines(spark, tmp_path):
    good = {"id": "t1", "messages": [{"role": "user", "content": "hi"}]}
    path = write(tmp_path / "a.jsonl", ["", "{broken", "null", "42", "[1]", '"s"', {"id": "x", "messages": "no"}, {"id": "y"}, good, {"messages": []}, {"id": None, "messages": []}])
    ids = [r.trajectory_id for r in trajectories.scan_jsonl(spark, path).orderBy("line").collect()]
    assert ids[0] == "t1" and ids[1].startswith("traj_") and len(ids[1]) == 21 and ids[2] is None


def test_steps(spark, tmp_path):
    call = lambda name, args: {"id": "c", "type": "function", "function": {"name": name, "arguments": args}}
    messages = [
        {"role": "system", "content": "sys"},
        "nonsense",
        {"role": "alien", "content": "x"},
        {"role": "user", "content": None},
        {"role": "assistant", "content": "doing", "tool_calls": [call("Read", "{}"), {"name": "Bash", "arguments": "ls"}, 7]},
        {"role": "assistant", "content": "plain", "tool_calls": []},
        {"role": "tool", "content": "out", "tool_call_id": "c"},
    ]
    path = write(tmp_path / "a.jsonl", [{"id": "t", "messages": messages}])
    got = trajectories.steps(trajectories.scan_jsonl(spark, path)).orderBy("step_index").collect()
    assert [(r.step_index, r.role, r.content, r.tool_call_name, r.tool_call_args, r.tool_result) for r in got] == [
        (0, "system", "sys", None, None, None),
        (1, "user", "", None, None, None),
        (2, "assistant", "doing", "Read", "{}", None),
        (3, "assistant", "doing", "Bash", "ls", None),
        (4, "assistant", "doing", None, None, None),
        (5, "assistant", "plain", None, None, None),
        (6, "tool", "out", None, None, "out"),
    ]


def test_transcripts(spark, tmp_path):
    events = [
        {"type": "system", "content": " s "},
        {"message": {"role": "user", "content": [{"type": "text", "text": "a"}, {"type": "tool_result", "tool_use_id": 5, "content": [{"text": "r1"}, {"content": "r2"}]}, {"type": "text", "text": "b"}]}},
        {"message": {"role": "assistant", "content": [{"type": "thinking", "thinking": "t"}, {"type": "tool_use", "id": "i", "name": "Bash", "input": {"k": [1, "é"]}}]}},
        "not json",
        {"message": {"role": "assistant", "content": "  "}},
    ]
    (tmp_path / "in").mkdir()
    write(tmp_path / "in" / "sess.x.jsonl", events)
    write(tmp_path / "in" / "half.jsonl", events[:2])
    got = transcripts.scan_transcripts(spark, str(tmp_path / "in")).collect()
    assert [r.trajectory_id for r in got] == ["sess.x"]
    assert [(m.role, m.content) for m in got[0].messages] == [("system", "s"), ("user", "a\n\nb"), ("tool", "r1\nr2"), ("assistant", "")]
    assert got[0].messages[3].reasoning == "t"
    assert json.loads(got[0].messages[3].tool_calls[0])["function"] == {"name": "Bash", "arguments": '{"k":[1,"é"]}'}
    assert transcripts.convert_folder(spark, str(tmp_path / "in"), str(tmp_path / "out")) == {"converted": 1, "skipped": 1}
    steps = trajectories.steps(trajectories.scan_jsonl(spark, str(tmp_path / "out"))).where("tool_call_name is not null").collect()
    assert [(r.tool_call_name, r.content) for r in steps] == [("Bash", "")]


def test_manifest(spark):
    lines = ["  plain  ", "", '{"question": "q", "failure_trajectory": "p.jsonl"}', '{"question": 5}', '{"question": "", "a": 1}', "[1]", "{bad", '{"question": "z", "failure_trajectory": null}']
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, value string")
    got = [tuple(r)[1:] for r in specs.manifest_lines(df).orderBy("i").collect()]
    assert got == [("plain", None), ("q", "p.jsonl"), ('{"question": 5}', None), ('{"question": "", "a": 1}', None), ("[1]", None), ("{bad", None), ("z", None)]


def test_specs_and_taxonomy(spark, tmp_path):
    item = {
        "id": "1", "origin": "original", "parent_id": None, "raw_text": "r", "failure_summary": "f", "target_capability": ["a"], "trajectory_signal": "s",
        "hyde_positive": ["x", "y"], "keywords": ["k"], "structured_filters": {"languages": ["python"], "tools_used": None, "has_verification_step": None},
        "confidence": 0.9, "route": "pass",
    }
    assert specs.check_sub_problem(item) is item
    for change in ({"route": "drop"}, {"hyde_positive": ["x"]}, {"confidence": 2}, {"structured_filters": {"languages": ["cobol"]}}, {"origin": "clarified"}, {"rubric": {"capability_kind": "z"}}):
        try:
            specs.check_sub_problem({**item, **change})
        except ValueError:
            continue
        raise AssertionError(change)
    path = tmp_path / "spec.json"
    path.write_text(json.dumps({"raw_input": "q", "domain": "d", "sub_problems": [item]}, indent=1))
    assert [r.id for r in specs.scan_specs(spark, str(path)).collect()] == ["1"]
    labels = [{"label": "root", "parent": None}, {"label": "leaf", "parent": "root", "keywords": ["k"], "description_embedding": [0.5, 1.0]}]
    path.write_text(json.dumps({"version": "1.2.3", "labels": labels}, indent=1))
    found = specs.scan_taxonomy(spark, str(path))
    specs.write_taxonomy(found, "1.2.4", "now", str(tmp_path / "out"))
    back = specs.scan_taxonomy(spark, str(tmp_path / "out"))
    assert [(r.version, r.label, r.parent, r.keywords) for r in back.orderBy("ord").collect()] == [("1.2.4", "root", None, []), ("1.2.4", "leaf", "root", ["k"])]


def test_keyed_table(spark, tmp_path):
    table = stores.KeyedTable(spark, str(tmp_path / "t"), ["k"], "k string, v int")
    assert table.count() == 0 and table.read().count() == 0
    table.append(spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int"))
    table.append(spark.createDataFrame([("a", 3, "new")], "k string, v int, extra string"))
    assert [(r.k, r.v, r.extra) for r in table.read().orderBy("ingest_seq").collect()] == [("b", 2, None), ("a", 3, "new")]
    assert table.get(k="a").first().v == 3 and table.count() == 2
    table.clear()
    assert table.count() == 0
    assert set(stores.stats(stores.open_stores(spark, str(tmp_path / "root"))).values()) == {0}


def test_failure_evidence(spark):
    steps = F.expr("array(named_struct('step_index', 0, 'role', 'user', 'content', repeat('x\n', 200), 'tool_call_name', '', 'tool_call_args', '', 'tool_result', ''))")
    rows = spark.range(5).select(F.col("id"), F.concat(F.lit("t"), F.col("id")).alias("trajectory_id"), F.when(F.col("id") != 1, steps).otherwise(F.slice(steps, 1, 0)).alias("steps"))
    text = specs.failure_evidence(rows, ["id"]).first().evidence
    assert text.count("[trajectory_id: ") == 3 and "t1]" not in text and "t4]" not in text and "\\n" in text


def test_fence_and_home(monkeypatch):
    assert specs.strip_fence("```json\n{}\n```") == "{}" and specs.strip_fence("{}") == "{}"
    monkeypatch.setenv("TRACEQUARRY_HOME", "/x")
    assert specs.home() == "/x" and specs.home("/y") == "/y"


def test_log_source_by_ranges(spark, tmp_path):
    from tracequarry.sources import log_source

    folder = tmp_path / "log"
    folder.mkdir()
    files = {"a.jsonl": "one\r\n\n\nlonger line é\n" + "x" * 50 + "\nlast", "b.jsonl": "", "c.jsonl": "\n", "_skip": "no\n", "d.jsonl": "z\n" * 40}
    for name, text in files.items():
        (folder / name).write_bytes(text.encode())
    (folder / "e.jsonl").write_bytes(b"\xff\n")
    want = []
    for name in ("a.jsonl", "b.jsonl", "c.jsonl", "d.jsonl", "e.jsonl"):
        at = 0
        for line in (folder / name).read_bytes().split(b"\n"):
            want.append((name, at, line.removesuffix(b"\r").decode("utf-8", "replace")))
            at += len(line) + 1
        if want[-1][2] == "":
            want.pop()  # nothing stands behind the last line end
    show = lambda df: [(r.file.split("/")[-1], r.offset, r.value) for r in df.orderBy("file", "offset").collect()]
    for size in (1, 2, 3, 7, 64, 1 << 20):
        got = [
            (r.file.split("/")[-1], o.as_py(), v.as_py())
            for r in log_source.ranges({}, log_source.list_files(str(folder)), size)
            for b in log_source.read_range(r)
            for v, o in zip(b.column("value"), b.column("offset"))
        ]
        assert got == want, size
    assert show(log_source.read_lines(spark, str(folder), 7)) == want == show(log_source.read_lines(spark, f"file:{folder}", 1000))
    lines, one = log_source.read_lines(spark, str(folder), 16), log_source.read_lines(spark, str(folder), 16, names="a.*")
    some = log_source.read_lines(spark, str(folder), 16, names="a.*", from_offset=5, to_offset=30)
    assert show(some) == [w for w in want if w[0] == "a.jsonl" and 5 <= w[1] < 30]
    assert some.rdd.getNumPartitions() < one.rdd.getNumPartitions() < lines.rdd.getNumPartitions()
    for name in ("a.jsonl", "d.jsonl"):  # a frame is used again, with other conditions
        assert show(lines.where(F.col("file").endswith(name))) == [w for w in want if w[0] == name]
    assert show(lines.where("offset > 5")) == [w for w in want if w[1] > 5] and show(lines) == want


def test_log_source_as_a_stream(spark, tmp_path):
    from tracequarry.sources import log_source

    folder = tmp_path / "log"
    folder.mkdir()
    spark.dataSource.register(log_source.LogSource)

    def run():
        stream = spark.readStream.format("agent_log").option("range_bytes", 5).load(str(folder)).writeStream.format("parquet")
        stream.option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start(str(tmp_path / "out")).awaitTermination()
        return sorted((r.file.split("/")[-1], r.offset, r.value) for r in spark.read.parquet(str(tmp_path / "out")).collect())

    (folder / "a").write_text("one\ntwo\nthr")
    assert run() == [("a", 0, "one"), ("a", 4, "two")]
    with open(folder / "a", "a") as more:
        more.write("ee\n")
    (folder / "b").write_text("new\n")
    assert run() == [("a", 0, "one"), ("a", 4, "two"), ("a", 8, "three"), ("b", 0, "new")]
    assert len(run()) == 4


def test_conversion_reads_once(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "blank.jsonl").write_text(" \n\n")
    (tmp_path / "in" / "empty.jsonl").write_text("")
    assert transcripts.convert_folder(spark, str(tmp_path / "in"), str(tmp_path / "out")) == {"converted": 0, "skipped": 1}
