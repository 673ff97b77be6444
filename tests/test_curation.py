import json
import random

import numpy as np
import pytest

from tracequarry.operators.selection import SelectionConfig
from tracequarry.operators.signatures import hash_embedder
from tracequarry.plans import curation
from tracequarry.sources import stores
from tracequarry.streaming.ingest import stream_ingest

TOPICS = ["async race condition", "memory leak profile", "regex parser failure"]


def log(ident, topic, extra=""):
    call = lambda name, args: [{"id": "c", "type": "function", "function": {"name": name, "arguments": args}}]
    return {
        "id": ident,
        "messages": [
            {"role": "user", "content": f"please fix {topic}"},
            {"role": "assistant", "content": f"reading {topic} {extra}", "tool_calls": call("Read", "src/app.py")},
            {"role": "tool", "content": "def handler(self): pass"},
            {"role": "assistant", "content": "fixing", "tool_calls": call("Edit", f"{topic} {extra}")},
            {"role": "assistant", "content": "checking", "tool_calls": call("Bash", "pytest tests")},
            {"role": "tool", "content": "3 passed"},
        ],
    }


def embed(texts):
    own = hash_embedder(6)(texts)
    return [[1.0 + t.count(w.split()[0]) * 3 for w in TOPICS] + [3 * x for x in v] for t, v in zip(texts, own)]


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("logs")
    rows = [log(f"t{i}", TOPICS[i % 3], f"variant{'abcdefghijkl'[i]} unique{i}word other{i}") for i in range(9)]
    rows.append({**rows[0], "id": "copy0"})
    (folder / "a.jsonl").write_text("\n".join([*map(json.dumps, rows[:6]), "junk"]))
    (folder / "b.jsonl").write_text("\n".join(map(json.dumps, rows[6:])))
    out = str(tmp_path_factory.mktemp("store"))
    assert curation.ingest(spark, str(folder), out, embed) == 10
    return out, str(folder)


def problems(spark):
    rows = [
        (f"p{k}", k, TOPICS[k].split(), [[1.0 + 3.0 * (j == k) for j in range(3)] + [0.0] * 6], (["python"], None, True), f"fails at {TOPICS[k]}", [f"cap{k}"])
        for k in range(3)
    ]
    kind = "sub_problem_id string, ord long, keywords array<string>, query_vectors array<array<double>>, filters struct<languages:array<string>,tools_used:array<string>,has_verification_step:boolean>, failure_summary string, capability array<string>"
    return spark.createDataFrame(rows, kind)


def test_ingest_and_stream_agree(spark, root, tmp_path):
    out, folder = root
    slices = stores.open_stores(spark, out)["slices"]
    assert slices.count() == 10 and stores.stats(stores.open_stores(spark, out))["trajectories"] == 10
    for _ in range(2):
        stream_ingest(spark, folder, str(tmp_path / "s"), str(tmp_path / "c"), embed).awaitTermination(120)
    streamed = stores.open_stores(spark, str(tmp_path / "s"))["slices"].read()
    pick = ["trajectory_id", "slice_index", "bm25_tokens", "embedding", "turn_count"]
    assert sorted(map(repr, streamed.select(pick).collect())) == sorted(map(repr, slices.read().select(pick).collect()))


def test_search_judges_once_and_merges(spark, root):
    out, _ = root
    calls = []
    path = f"{out}/calls"

    def judge(problem, summaries):
        with open(path, "a") as f:
            f.write(f"{len(summaries)}\n")
        topic = problem["failure_summary"].removeprefix("fails at ")
        return json.dumps([{"match": topic in s, "confidence": 0.9, "spans": [{"start_step": 0, "end_step": 2}], "reasoning": ""} for s in summaries])

    got = curation.search(spark, out, problems(spark), judge, SelectionConfig(n=5, min_per_problem=1), top_n=10)
    chosen = {r.trajectory_id: r for r in got["selected"].collect()}
    assert len(chosen) == 5 and got["manifest"].first().targeted_count == 5
    assert {i for r in chosen.values() for i in r.sub_problem_ids} == {"p0", "p1", "p2"}
    assert not {"t0", "copy0"} <= set(chosen)
    assert got["scored"].count() == 30 and got["scored"].where("match").count() == 10
    calls = sum(map(int, open(path).read().split()))
    assert calls == 30
    again = curation.search(spark, out, problems(spark), judge, SelectionConfig(n=5, min_per_problem=1), top_n=10)
    assert {r.trajectory_id for r in again["selected"].collect()} == set(chosen)
    assert sum(map(int, open(path).read().split())) == 30


def test_evolve_backfills_once(spark, root):
    out, _ = root
    proposals = [
        {"label": "race", "vector": [4.0, 1.0, 1.0] + [0.0] * 6, "keywords": ["race"], "description": "race", "source_sub_problem_id": "p0"},
        {"label": "race2", "vector": [4.0, 1.0, 1.1] + [0.0] * 6, "keywords": [], "description": "", "source_sub_problem_id": "p1"},
    ]
    found = curation.evolve(spark, out, proposals, [], "now")
    assert [r["kind"] for r in found["resolved"]] == ["new_root", "duplicate"] and found["jobs"] == {"done": 1}
    labelled = stores.open_stores(spark, out)["slices"].read().where("array_contains(capability_labels, 'race')").count()
    assert labelled == 10
    assert curation.backfill(spark, out, proposals[0]) == 0


def test_equal_slices_cost_a_row_each(spark):
    from tracequarry.operators import dedup

    rows = [(i, 1.0 - i / 1000, [float(i % 3), 1.0, 0.5], [f"w{i % 2}", "x"]) for i in range(600)]
    merged = spark.createDataFrame(rows, "seq long, relevance double, embedding array<double>, bm25_tokens array<string>")
    got = {r.seq: r.survivor for r in curation.near_duplicates(merged).collect()}
    kept = []
    for i, _, v, t in rows:
        near = lambda k: rows[k][3] == t or np.dot(rows[k][2], v) / np.linalg.norm(rows[k][2]) / np.linalg.norm(v) > 0.95
        hit = next((k for k in kept if near(k)), None)
        assert got[i] == (i if hit is None else hit)
        kept += [i] if hit is None else []
    for pairs, sets in (dedup.token_pairs(merged), dedup.vector_pairs(merged)):
        assert pairs.count() <= 3 and sets.count() == 600


def test_nearest_in_groups(spark, monkeypatch):
    from tracequarry.operators import taxonomy

    monkeypatch.setattr(taxonomy, "GROUP", 16)
    rng = np.random.default_rng(1)
    known = [(f"k{j}", j, [float(x) for x in rng.normal(size=4)]) for j in range(60)]
    known += [("twin", 70, known[5][2]), ("short", 71, [1.0]), ("none", 72, None), ("zero", 73, [0.0] * 4)]
    items = [(i, [float(x) for x in rng.normal(size=4)]) for i in range(50)] + [(50, known[5][2]), (51, None), (52, [2.0]), (53, [0.0] * 4), (54, [-x for x in known[5][2]])]
    schema = "vector array<double>"
    found = taxonomy.nearest(spark.createDataFrame(items, f"id long, {schema}"), spark.createDataFrame(known, f"name string, ord int, {schema}"), "id", "name", "ord")
    for r in found.collect():
        cos = [taxonomy._cosine(dict(items)[r.id], v) for _, _, v in known]
        assert abs(r.cosine - max(cos)) < 1e-12 and r["name"] == known[int(np.argmax(cos))][0]
    assert found.count() == 55
    assert taxonomy.nearest(spark.createDataFrame(items, f"id long, {schema}").limit(0), spark.createDataFrame(known, f"name string, ord int, {schema}"), "id", "name", "ord").count() == 0


def test_nearest_in_groups_and_partitions(spark, monkeypatch):
    """Groups of both sides meet wherever they are dealt to."""
    from tracequarry.operators import taxonomy

    monkeypatch.setattr(taxonomy, "GROUP", 8)
    rng = np.random.default_rng(2)
    items, known = ([(i, [float(x) for x in rng.normal(size=4)]) for i in range(n)] for n in (40, 30))
    asked, stored = spark.createDataFrame(items, "id long, vector array<double>"), spark.createDataFrame([(f"k{i}", i, v) for i, v in known], "name string, ord int, vector array<double>")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r.id: r["name"] for r in taxonomy.nearest(asked, stored, "id", "name", "ord").collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert got == {i: f"k{int(np.argmax([taxonomy._cosine(v, w) for _, w in known]))}" for i, v in items}


def test_steps_in_spans_by_bins(spark):
    from tracequarry.operators import view

    pick = random.Random(2)
    spans = [(pick.randrange(3), a, a + pick.choice([0, 1, 2, 3, 7, 8, 40])) for a in [pick.randrange(200) for _ in range(60)]] + [(0, 5, 4), (1, None, 3)]
    steps = [(k, i) for k in range(4) for i in range(220)] + [(None, 1), (1, None)]
    got = view.steps_in_spans(spark.createDataFrame(steps, "k int, step_index int"), spark.createDataFrame(spans, "k int, start_step int, end_step int"), "k")
    want = sorted((k, i, a, b) for k, i in steps for q, a, b in spans if k == q and None not in (i, a, b) and a <= i <= b)
    assert sorted(map(tuple, got.select("k", "step_index", "start_step", "end_step").collect())) == want
    # 100,000 steps and 10,000 spans of a trajectory: rows that meet are near those that count
    steps = spark.range(100_000).selectExpr("1 as k", "id as step_index")
    spans = spark.range(10_000).selectExpr("1 as k", "id * 10 as start_step", "id * 10 + id % 16 as end_step")
    assert view.steps_in_spans(steps, spans, "k").count() == sum(min(99_999, s * 10 + s % 16) - s * 10 + 1 for s in range(10_000))
