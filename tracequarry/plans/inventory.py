"""Queries of sources, sinks, stores, judging, compiling and evolution over stand-ins, each with its SQL.

Logs, transcripts, specs and stores are written to the shared folder from the
contract tables and read back by the library; the SQL says what must come out of
the tables themselves.
"""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracequarry.functions import text as tx
from tracequarry.functions import vectors
from tracequarry.lineage import scratch
from tracequarry.operators import health, judging, merging, ranking, selection, taxonomy, view
from tracequarry.operators.signatures import signatures, with_embeddings, with_query_vectors
from tracequarry.plans import catalogue, compiling, curation, prompts
from tracequarry.plans.catalogue import long, read
from tracequarry.plans.oracles import SQL as _SQL
from tracequarry.plans.oracles import _CENTROIDS, _PLACES, _SCORED, _identifiers, _short
from tracequarry.sources import specs, stores, trajectories, transcripts
from tracequarry.sources.runs import RunLog
from tracequarry.streaming import health as stream_health
from tracequarry.streaming.ingest import stream_ingest

_REGISTERED: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        _REGISTERED[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


def queries() -> dict:
    return dict(_REGISTERED)


# ---- logs ------------------------------------------------------------------------------

_CALLS = '[{"function":{"name":"Read","arguments":"src/a.py ValueError def load_it"}},{"name":"Bash","arguments":"pytest -q"},7]'


def log_lines(spark, sf_dir) -> DataFrame:
    """JSON lines of the conversations: assistants call tools at turn 1 of 4, turn 2 of 4 is a tool's, and there is noise.

    Every fifth conversation has no id; one message each has an unknown role and one is no object."""
    role = F.when(F.col("turn") % 4 == 2, "tool").otherwise(F.col("role"))
    said = F.coalesce("text", F.lit(""))
    plain = F.to_json(F.struct(role.alias("role"), said.alias("content")))
    called = F.concat(F.expr("substring(plain, 1, length(plain) - 1)"), F.lit(f',"tool_calls":{_CALLS}}}'))
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", role.alias("role"), plain.alias("plain"))
    rows = rows.withColumn("message", F.when((F.col("role") == "assistant") & (F.col("turn") % 4 == 1), called).otherwise(F.col("plain")))
    talks = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "message"))).alias("m"))
    parts = F.concat(tx.strings('{"role":"critic","content":"no"}', '"noise"'), F.transform("m", lambda x: x["message"]))
    ident = F.when(F.col("conv_id") % 5 == 0, "").otherwise(F.concat(F.lit('"id":"c'), F.col("conv_id").cast("string"), F.lit('",')))
    good = talks.select(F.concat(F.lit(" {"), ident, F.lit('"messages":['), F.array_join(parts, ","), F.lit("]} ")).alias("value"))
    bad = spark.createDataFrame([("",), ("  ",), ("no json",), ("[1]",), ('{"id":"x","messages":5}',), ('{"id":',), ('{"id":"y"}',)], "value string")
    return good.unionByName(bad)


def logs(spark, sf_dir) -> str:
    path = scratch(spark, "logs")
    log_lines(spark, sf_dir).write.text(path)
    return path


def _whole(steps: DataFrame) -> DataFrame:
    """Trajectories as one slice each."""
    step = F.struct("step_index", "role", "content", "tool_call_name", "tool_call_args", "tool_result")
    return steps.groupBy("trajectory_id").agg(F.sort_array(F.collect_list(step)).alias("steps"))


def log_slices(spark, sf_dir) -> DataFrame:
    found = trajectories.scan_jsonl(spark, logs(spark, sf_dir))
    return _whole(trajectories.steps(found.select("trajectory_id", "messages")))


_LOGGED = """
msg AS (SELECT conv_id, turn, CASE WHEN turn % 4 = 2 THEN 'tool' ELSE role END AS role, coalesce(text, '') AS content FROM conversations),
st AS (
  SELECT conv_id, role, content, name AS tool, args, CASE WHEN role = 'tool' THEN content END AS result,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn, k) - 1 AS step_index
  FROM (
    SELECT msg.*, k, CASE k WHEN 1 THEN 'Read' WHEN 2 THEN 'Bash' END AS name, CASE k WHEN 1 THEN 'src/a.py ValueError def load_it' WHEN 2 THEN 'pytest -q' END AS args
    FROM msg, range(0, 4) r(k) WHERE CASE WHEN role = 'assistant' AND turn % 4 = 1 THEN k > 0 ELSE k = 0 END)),
named AS (SELECT conv_id, CASE WHEN conv_id % 5 = 0 THEN 'traj_' ELSE 'c' || conv_id END AS tid FROM (SELECT DISTINCT conv_id FROM conversations))
"""


def _named(rows: DataFrame) -> DataFrame:
    """Surrogate ids are hashes: shown by their head."""
    return rows.withColumn("trajectory_id", F.when(F.col("trajectory_id").rlike("^traj_[0-9a-f]{16}$"), "traj_").otherwise(F.col("trajectory_id")))


def _shown_steps(found: DataFrame) -> DataFrame:
    rows = trajectories.steps(found.select("trajectory_id", "messages"))
    return _named(rows).select(
        "trajectory_id", *long("step_index"), "role", F.md5("content").alias("content_md5"), F.col("tool_call_name").alias("tool"),
        F.col("tool_call_args").alias("args"), F.md5("tool_result").alias("result_md5"),
    )


_STEPS = f"WITH {_LOGGED} SELECT tid AS trajectory_id, step_index, role, md5(content) AS content_md5, tool, args, md5(result) AS result_md5 FROM st JOIN named USING (conv_id)"


@query(_STEPS)
def log_steps(spark, sf_dir):
    """Steps of JSON lines: lenient scan, surrogate ids, calls of both shapes."""
    return _shown_steps(trajectories.scan_jsonl(spark, logs(spark, sf_dir)))


@query(_STEPS)
def source_steps(spark, sf_dir):
    """The same through the data source, by ranges of bytes."""
    return _shown_steps(trajectories.scan_log(spark, logs(spark, sf_dir)))


@query("""
SELECT count(DISTINCT CASE WHEN conv_id % 5 = 0 THEN conv_id END) AS without_id, count(DISTINCT conv_id) AS lines, count(DISTINCT conv_id) AS with_path
FROM conversations""")
def log_ids(spark, sf_dir):
    """Surrogate ids and paths of scanned lines."""
    rows = trajectories.scan_jsonl(spark, logs(spark, sf_dir))
    surrogate = F.countDistinct(F.when(F.col("trajectory_id").startswith("traj_"), F.col("trajectory_id")))
    return rows.agg(surrogate.alias("without_id"), F.count("*").alias("lines"), F.count_if(F.length("trajectory_path") > 0).alias("with_path"))


_ALL = "string_agg(concat_ws(' ', coalesce(args, ''), coalesce(result, ''), content), ' ' ORDER BY step_index)"
_FOUND = """list_distinct(list_concat(list_transform(tools, lambda x: lower(x)),
    regexp_extract_all(said, '(SyntaxError|TypeError|ValueError|KeyError|ImportError|AttributeError|RuntimeError|FileNotFoundError|Traceback|Exception|FAILED|Error|panic)', 1),
    regexp_extract_all(said, '([\\p{L}\\p{N}_./-]+\\.(?:py|js|ts|json|yaml|yml|md))\\b', 1), regexp_extract_all(said, '\\bdef\\s+([A-Za-z_][A-Za-z0-9_]*)', 1)""".replace("\\\\", "\\")


@query(f"""
WITH {_LOGGED},
t AS (
  SELECT conv_id, count(*) AS step_count, count(*) FILTER (role = 'user') AS turn_count, list(DISTINCT tool) FILTER (tool IS NOT NULL) AS tools0, {_ALL} AS said,
    coalesce(bool_or(role = 'tool' AND regexp_matches(content, '(?i)(Traceback \\(most recent call last\\)|SyntaxError:|Error:|Exception:|FAILED|panic:)')), false) AS has_error,
    coalesce(bool_or(tool = 'Bash'), false) AS verifies
  FROM st GROUP BY conv_id),
u AS (SELECT *, coalesce(list_sort(tools0), []) AS tools FROM t)
SELECT tid AS trajectory_id, step_count, turn_count, array_to_string(tools, ',') AS tools_used, has_error, verifies,
  md5(array_to_string(list_sort({_FOUND}, {_identifiers('said')}))), ' ')) AS tokens_md5
FROM u JOIN named USING (conv_id)""")
def log_signatures(spark, sf_dir):
    """Signatures with search tokens: tools, error names, paths, definitions, identifiers."""
    rows = signatures(log_slices(spark, sf_dir))
    return _named(rows).select(
        "trajectory_id", *long("step_count", "turn_count"), F.array_join("tools_used", ",").alias("tools_used"), F.col("has_error_pattern").alias("has_error"),
        F.col("has_verification_step").alias("verifies"), F.md5(F.array_join("bm25_tokens", " ")).alias("tokens_md5"),
    )


@query(f"""
WITH {_LOGGED}, p AS (
  SELECT conv_id, left(string_agg(concat_ws(' ', left(args, 160), CASE WHEN role = 'assistant' AND content <> '' THEN left(content, 100) END,
      CASE WHEN role = 'assistant' AND content <> '' THEN tool END, CASE WHEN result <> '' THEN left(result, 50) END), ' ' ORDER BY step_index)
    FILTER (args IS NOT NULL OR (role = 'assistant' AND content <> '') OR result <> ''), 1000) AS t
  FROM st GROUP BY conv_id)
SELECT tid AS trajectory_id, md5(coalesce(t, '')) AS text_md5 FROM p JOIN named USING (conv_id)""")
def log_embedding_texts(spark, sf_dir):
    return _named(log_slices(spark, sf_dir)).select("trajectory_id", F.md5(tx.embedding_text(F.col("steps"))).alias("text_md5"))


@query(f"""
WITH {_LOGGED}, p AS (
  SELECT conv_id, length(string_agg(concat_ws(' ', left(args, 160), CASE WHEN role = 'assistant' AND content <> '' THEN left(content, 100) END,
      CASE WHEN role = 'assistant' AND content <> '' THEN tool END, CASE WHEN result <> '' THEN left(result, 50) END), ' ' ORDER BY step_index)
    FILTER (args IS NOT NULL OR (role = 'assistant' AND content <> '') OR result <> '')) AS n FROM st GROUP BY conv_id)
SELECT tid AS trajectory_id, least(coalesce(n, 0), 1000)::DOUBLE AS first FROM p JOIN named USING (conv_id)""")
def log_embeddings(spark, sf_dir):
    """Slices embedded by an injected embedder, here the text's length."""
    rows = with_embeddings(log_slices(spark, sf_dir), lambda texts: [[float(len(t)), 1.0] for t in texts])
    return _named(rows).select("trajectory_id", F.col("embedding")[0].cast("double").alias("first"))


_LINE = f"""CASE role WHEN 'assistant' THEN 'Step ' || step_index || ': [assistant] ' || {_short('content', 150)} ||
    CASE WHEN coalesce(tool, '') <> '' THEN ' → call ' || tool || '("' || {_short('args', 200)} || '")' ELSE '' END
  WHEN 'tool' THEN 'Step ' || step_index || ': [result] ' || {_short("CASE WHEN result <> '' THEN result ELSE content END", 300)}
  ELSE 'Step ' || step_index || ': [' || role || '] ' || {_short('content', 150)} END"""
_BODIES = f"bodies AS (SELECT conv_id, string_agg({_LINE}, chr(10) ORDER BY step_index) AS body FROM st GROUP BY conv_id)"


@query(f"WITH {_LOGGED}, {_BODIES} SELECT tid AS trajectory_id, md5(body) AS summary_md5 FROM bodies JOIN named USING (conv_id)")
def log_summaries(spark, sf_dir):
    return _named(log_slices(spark, sf_dir)).select("trajectory_id", F.md5(tx.summary(F.col("steps"))).alias("summary_md5"))


@query(f"""
WITH {_LOGGED}, {_BODIES}, three AS (SELECT tid, body FROM bodies JOIN named USING (conv_id) WHERE conv_id % 5 <> 0 ORDER BY tid LIMIT 3),
j AS (SELECT string_agg('[trajectory_id: ' || tid || ']' || chr(10) || body, chr(10) || chr(10) ORDER BY tid) AS e FROM three)
SELECT CASE WHEN length(e) > 4000 THEN left(e, 4000) || chr(10) || '...(截断)' ELSE e END AS evidence FROM j""")
def failure_evidence(spark, sf_dir):
    """Evidence for prompts: the first three summaries."""
    rows = log_slices(spark, sf_dir).where("trajectory_id not like 'traj_%'")
    return specs.failure_evidence(rows, ["trajectory_id"])


@query(f"WITH {_LOGGED} SELECT tid AS trajectory_id, count(*) AS steps, min(step_index) AS first_step, max(step_index) AS last_step FROM st JOIN named USING (conv_id) WHERE conv_id % 5 <> 0 GROUP BY tid")
def ingested_slices(spark, sf_dir):
    """Ingest of log files: slices of each trajectory cover its steps."""
    root = scratch(spark, "warehouse")
    curation.ingest(spark, logs(spark, sf_dir), root)
    rows = stores.open_stores(spark, root)["slices"].read().where("trajectory_id not like 'traj_%'")
    return rows.groupBy("trajectory_id").agg(F.sum(F.size("steps")).alias("steps"), *[f(F.col(c)).cast("long").alias(n) for f, c, n in ((F.min, "start_step", "first_step"), (F.max, "end_step", "last_step"))])


@query("SELECT count(DISTINCT conv_id) AS trajectories, count(DISTINCT conv_id) AS with_path, 0::BIGINT AS problems FROM conversations")
def store_stats(spark, sf_dir):
    """Counts of the tables after an ingest of the same files, twice."""
    root, path = scratch(spark, "warehouse"), logs(spark, sf_dir)
    curation.ingest(spark, path, root)
    curation.ingest(spark, path, root)
    tables = stores.open_stores(spark, root)
    counts = stores.stats(tables)
    paths = tables["trajectories"].read().agg(F.count_if(F.length("trajectory_path") > 0).alias("with_path"))
    return paths.select(F.lit(counts["trajectories"]).cast("long").alias("trajectories"), "with_path", F.lit(counts["problems"]).cast("long").alias("problems"))


@query(f"WITH {_LOGGED} SELECT tid AS trajectory_id, count(*) AS steps FROM st JOIN named USING (conv_id) WHERE conv_id % 5 <> 0 GROUP BY tid")
def streamed_slices(spark, sf_dir):
    """The same through a file stream that also fills the trajectories; only slices that have one count."""
    root = scratch(spark, "warehouse")
    stream_ingest(spark, logs(spark, sf_dir), root, scratch(spark, "offsets")).awaitTermination()
    tables = stores.open_stores(spark, root)
    known = tables["trajectories"].read().where("length(trajectory_path) > 0").select("trajectory_id")
    rows = tables["slices"].read().where("trajectory_id not like 'traj_%'").join(known, "trajectory_id")
    return rows.groupBy("trajectory_id").agg(F.sum(F.size("steps")).alias("steps"))


@query(_SQL["outcome_window_rates"])
def streamed_window_rates(spark, sf_dir):
    """Rates of a stream of the events in three parts, in order of time, and one last event that lets the watermark pass."""
    rows = catalogue._outcomes(spark, sf_dir).select("user_id", "ts", "event_id", "outcome")
    folder, out = scratch(spark, "outcomes"), scratch(spark, "rates")
    ends = rows.select(F.unix_micros(F.col("ts").cast("timestamp")).alias("t")).agg(F.percentile_approx("t", [0.33, 0.66], F.lit(100)).alias("t")).first().t
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    part = (at > ends[0]).cast("int") + (at > ends[1]).cast("int")
    kinds = dict(rows.dtypes)
    last = spark.range(1).select(F.lit(-1).cast(kinds["user_id"]).alias("user_id"), F.expr(f"cast(timestamp'2200-01-01' as {kinds['ts']})").alias("ts"), F.lit(-1).cast("long").alias("event_id"), F.lit("success").alias("outcome"))
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        for k in range(4):  # the stream runs once for each part that has come
            (rows.where(part == k) if k < 3 else last).write.parquet(f"{folder}/{k}")
            stream = spark.readStream.schema(rows.schema).option("recursiveFileLookup", "true").parquet(folder)
            stream_health.rates(stream, "user_id", "ts").writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{out}-offsets").trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.set(name, before)
    rates = spark.read.parquet(out)
    return rates.select("event_id", "total", *[F.round(c, 6).alias(c) for c in ("timeout_rate", "overload_rate", "abnormal_rate", "infra_rate")])


# ---- transcripts -----------------------------------------------------------------------


def transcript_folder(spark, sf_dir) -> str:
    """Four files of session events; the one of conversations with remainder 3 never calls a tool."""
    said = F.coalesce("text", F.lit(""))
    block = lambda *c: F.struct(*c)
    user = F.to_json(F.struct(F.lit("user").alias("type"), F.struct(F.lit("user").alias("role"), said.alias("content")).alias("message")))
    tool = F.to_json(F.struct(F.struct(F.lit("user").alias("role"), F.array(
        block(F.lit("tool_result").alias("type"), F.concat(F.lit("t"), F.col("turn").cast("string")).alias("tool_use_id"), F.array(block(F.lit("text").alias("type"), said.alias("text"))).alias("content")),
    ).alias("content")).alias("message")))
    text = F.to_json(block(F.lit("text").alias("type"), said.alias("text")))
    think = '{"type":"thinking","thinking":" why "}'
    use = F.concat(F.lit('{"type":"tool_use","id":"t'), F.col("turn").cast("string"), F.lit('","name":"Edit","input":{"path": "é", "n": [1, 2]}}'))
    blocks = F.when(F.col("conv_id") % 4 == 3, F.array(text)).otherwise(F.array(text, F.lit(think), use))
    assistant = F.concat(F.lit('{"type":"assistant","message":{"role":"assistant","content":['), F.array_join(blocks, ","), F.lit("]}}"))
    system = F.to_json(F.struct(F.lit("system").alias("type"), said.alias("content")))
    line = F.when(F.col("role") == "system", system).when(F.col("role") == "assistant", assistant).when(F.col("turn") % 3 == 2, tool).otherwise(user)
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", line.alias("value"))
    folder = scratch(spark, "transcripts")
    fs = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs.mkdirs(path(folder))
    noise = spark.createDataFrame([(-1, 0, "broken {"), (-1, 1, "[]"), (-1, 2, '{"message": 5}')], "conv_id long, turn long, value string")
    for k in range(4):
        part = rows.where(F.col("conv_id") % 4 == k).unionByName(noise).orderBy("conv_id", "turn").select("value")
        part.coalesce(1).write.text(f"{folder}/part{k}")
        file = next(s.getPath() for s in fs.listStatus(path(f"{folder}/part{k}")) if s.getPath().getName().endswith(".txt"))
        fs.rename(file, path(f"{folder}/session{k}.jsonl"))
        fs.delete(path(f"{folder}/part{k}"), True)
    return folder


_STRIPPED = r"regexp_replace(coalesce(text, ''), '^\s+|\s+$', '', 'g')"
_TRANSCRIPT = f"""
ev AS (
  SELECT conv_id % 4 AS k, row_number() OVER (PARTITION BY conv_id % 4 ORDER BY conv_id, turn) AS i, turn,
    CASE WHEN role = 'system' THEN 'system' WHEN role = 'assistant' THEN 'assistant' WHEN turn % 3 = 2 THEN 'tool' ELSE 'user' END AS role,
    {_STRIPPED} AS content, role = 'assistant' AND conv_id % 4 <> 3 AS calls
  FROM conversations),
kept AS (SELECT * FROM ev WHERE k <> 3 AND (content <> '' OR calls OR role = 'tool'))
"""


@query(f"""
WITH {_TRANSCRIPT}
SELECT 'session' || k AS trajectory_id, row_number() OVER (PARTITION BY k ORDER BY i) - 1 AS at, role, md5(content) AS content_md5,
  CASE WHEN calls THEN 'why' END AS reasoning, CASE WHEN role = 'tool' THEN 't' || turn END AS tool_call_id,
  CASE WHEN calls THEN '{{"id":"t' || turn || '","type":"function","function":{{"name":"Edit","arguments":"{{\\"path\\":\\"é\\",\\"n\\":[1,2]}}"}}}}' END AS calls
FROM kept""")
def transcript_messages(spark, sf_dir):
    """Messages of session transcripts: text, thoughts, calls, results; a file without calls is no trajectory."""
    rows = transcripts.scan_transcripts(spark, transcript_folder(spark, sf_dir)).select("trajectory_id", F.posexplode("messages").alias("at", "m"))
    return rows.select("trajectory_id", F.col("at").cast("long").alias("at"), "m.role", F.md5("m.content").alias("content_md5"), "m.reasoning", "m.tool_call_id", F.array_join("m.tool_calls", ";").alias("calls"))


@query(f"WITH {_TRANSCRIPT} SELECT 3::BIGINT AS converted, 1::BIGINT AS skipped, 'session' || k AS id, count(*) AS messages FROM kept GROUP BY k")
def converted_transcripts(spark, sf_dir):
    """Transcripts written as trajectories and read again."""
    target = scratch(spark, "converted")
    counts = transcripts.convert_folder(spark, transcript_folder(spark, sf_dir), target)
    rows = trajectories.scan_jsonl(spark, target)
    return rows.select(*[F.lit(counts[k]).cast("long").alias(k) for k in ("converted", "skipped")], F.col("trajectory_id").alias("id"), F.size("messages").cast("long").alias("messages"))


# ---- specs, taxonomies, manifests --------------------------------------------------------


@query(r"""
SELECT doc_id, CASE WHEN doc_id % 4 = 1 THEN 'why ' || doc_id WHEN doc_id % 4 = 2 THEN '{"question": ""}' ELSE 'plain ' || doc_id END AS question,
  CASE WHEN doc_id % 4 = 1 AND doc_id % 8 = 1 THEN 'p' || doc_id END AS failure_trajectory
FROM documents WHERE doc_id % 4 <> 3""")
def manifest_questions(spark, sf_dir):
    """Manifest lines: plain, JSON with and without a question, blank."""
    ident, kind = F.col("doc_id").cast("string"), F.col("doc_id") % 4
    path = F.when(F.col("doc_id") % 8 == 1, F.concat(F.lit(', "failure_trajectory": "p'), ident, F.lit('"'))).otherwise(F.lit(', "failure_trajectory": 5'))
    line = (
        F.when(kind == 1, F.concat(F.lit(' {"question": "why '), ident, F.lit('"'), path, F.lit("} ")))
        .when(kind == 2, '{"question": ""}').when(kind == 3, " \t ").otherwise(F.concat(F.lit("  plain "), ident))
    )
    return specs.manifest_lines(read(spark, sf_dir, "documents").select("doc_id", line.alias("value")))


@query("""
SELECT 'f.' || item_id || '-' || k AS id, CASE WHEN k = 1 THEN 'clarified' ELSE 'original' END AS origin, length(text) AS n_chars, 2::BIGINT AS n_hyde,
  CASE WHEN item_id % 2 = 0 THEN 'python' END AS language, CASE WHEN item_id % 3 = 0 THEN 'recovery' END AS kind
FROM benchmark, range(0, 2) r(k)""")
def spec_scan(spark, sf_dir):
    """Spec files scanned with all checks of the contract."""
    def sub(k: int):
        return F.struct(
            F.concat(F.col("item_id").cast("string"), F.lit(f"-{k}")).alias("id"), F.lit("clarified" if k else "original").alias("origin"),
            F.lit("0" if k else None).cast("string").alias("parent_id"), F.col("text").alias("raw_text"), F.lit("fails").alias("failure_summary"),
            tx.strings("a").alias("target_capability"), F.lit("s").alias("trajectory_signal"), tx.strings("h", "i").alias("hyde_positive"), tx.strings("k").alias("keywords"),
            F.struct(F.when(F.col("item_id") % 2 == 0, tx.strings("python")).alias("languages"), tx.strings("Bash").alias("tools_used")).alias("structured_filters"),
            F.lit(0.9).alias("confidence"), F.lit("pass").alias("route"),
            F.when(F.col("item_id") % 3 == 0, F.struct(F.lit("recovery").alias("capability_kind"))).alias("rubric"),
        )

    path = scratch(spark, "specs")
    read(spark, sf_dir, "benchmark").select(F.col("text").alias("raw_input"), F.array(sub(0), sub(1)).alias("sub_problems")).write.json(path)
    rows = specs.scan_specs(spark, path, multi_line=False)
    return rows.select(
        specs.prefixed(F.col("id"), F.lit("f")).alias("id"), "origin", F.length("raw_text").cast("long").alias("n_chars"), F.size("hyde_positive").cast("long").alias("n_hyde"),
        F.col("structured_filters.languages")[0].alias("language"), F.col("rubric.capability_kind").alias("kind"),
    )


@query(f"""
WITH {_PLACES}
SELECT '1.2.3' AS version, label, parent, row_number() OVER (ORDER BY parent NULLS FIRST, label) - 1 AS ord, CASE WHEN parent IS NULL THEN 'root' ELSE '' END AS description FROM places""")
def taxonomy_round_trip(spark, sf_dir):
    """A taxonomy written as JSON and scanned."""
    places = catalogue._places(spark, sf_dir)
    ranked = places.agg(F.sort_array(F.collect_list(F.struct(F.coalesce("parent", F.lit("")).alias("p"), "label", "parent"))).alias("l")).select(F.posexplode("l").alias("ord", "l"))
    none = F.lit(None)
    labels = ranked.select(
        "ord", "l.label", "l.parent", none.cast("boolean").alias("new_root"), F.when(F.col("l.parent").isNull(), "root").alias("description"), none.cast("array<string>").alias("keywords"),
        none.cast("array<float>").alias("description_embedding"), none.cast("boolean").alias("taxonomy_extension"), none.cast("string").alias("created_at"),
    )
    path = scratch(spark, "taxonomy")
    specs.write_taxonomy(labels, "1.2.3", "now", path)
    rows = specs.scan_taxonomy(spark, path)
    return rows.where("not new_root and size(keywords) = 0").select("version", "label", "parent", F.col("ord").cast("long").alias("ord"), "description")


@query(f"""
WITH {_PLACES}
SELECT coalesce(parent, label) AS root, parent IS NOT NULL AS is_child, label, CASE WHEN parent IS NULL THEN '- ' ELSE '  - ' END || label || ': ' || CASE WHEN parent IS NULL THEN 'root' ELSE '' END AS line
FROM places""")
def taxonomy_prompt(spark, sf_dir):
    return taxonomy.prompt_tree(catalogue._places(spark, sf_dir).withColumn("description", F.when(F.col("parent").isNull(), "root")))


@query(f"""
WITH {_PLACES} SELECT label, parent, '1.0.2' AS version, 't1' AS updated_at, CASE WHEN parent IS NULL AND label > 'B' THEN 'again' ELSE 'first' END AS description FROM places""")
def taxonomy_store(spark, sf_dir):
    """Labels seeded once, roots after B replaced, leaves added; the patch number counts both changes."""
    tables = stores.open_stores(spark, scratch(spark, "warehouse"))
    store = taxonomy.TaxonomyStore(tables["labels"], tables["taxonomy"])

    def labels(rows: DataFrame, text: str) -> DataFrame:
        none = {"new_root": "boolean", "keywords": "array<string>", "description_embedding": "array<float>", "taxonomy_extension": "boolean", "created_at": "string"}
        return rows.select("label", "parent", F.lit(text).alias("description"), *[F.lit(None).cast(k).alias(n) for n, k in none.items()])

    places = catalogue._places(spark, sf_dir)
    store.seed(labels(places.where("parent is null"), "first"), "1.0.0", "t0")
    store.seed(labels(places, "never"), "9.9.9", "t9")
    store.add(labels(places.where("parent is null and label > 'B'"), "again"), "t1")
    store.add(labels(places.where("parent is not null"), "first"))
    version, at = store.state()
    return store.labels().select("label", "parent", F.lit(version).alias("version"), F.lit(at).alias("updated_at"), "description")


# ---- stores ------------------------------------------------------------------------------


def _kept(spark, sf_dir) -> stores.KeyedTable:
    docs = read(spark, sf_dir, "documents").select("doc_id", F.lit("old").alias("state"), "n_chars")
    table = stores.KeyedTable(spark, f"{scratch(spark, 'table')}/t", ["doc_id"], "doc_id long, state string, n_chars long")
    table.append(docs, "doc_id")
    table.append(docs.where("doc_id % 3 = 0").withColumn("state", F.lit("new")).withColumn("extra", F.lit(1)), "doc_id")
    return table


@query("""
SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'new' ELSE 'old' END AS state, CASE WHEN doc_id % 3 = 0 THEN 1 END AS extra,
  row_number() OVER (ORDER BY doc_id % 3 = 0, doc_id) AS place FROM documents""")
def store_upsert(spark, sf_dir):
    """Upserts keep a key's last row, later columns are null before, and a replaced key moves to the end."""
    table = _kept(spark, sf_dir)
    table.compact()
    rows = table.read().select(F.struct("ingest_seq", "doc_id", "state", "extra").alias("r"))
    listed = rows.agg(F.sort_array(F.collect_list("r")).alias("l")).select(F.posexplode("l").alias("i", "r"))  # the stand-in's rows
    return listed.select("r.doc_id", "r.state", "r.extra", (F.col("i") + 1).cast("long").alias("place"))


@query("SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'new' ELSE 'old' END AS state, (SELECT count(*) FROM documents) AS n FROM documents WHERE doc_id IN (3, 4)")
def store_get(spark, sf_dir):
    table = _kept(spark, sf_dir)
    return table.get(doc_id=3).unionByName(table.get(doc_id=4)).select("doc_id", "state", F.lit(table.count()).cast("long").alias("n"))


@query("SELECT 'one' AS name, (SELECT count(*) FROM documents) AS problems, NULL::BIGINT AS trajectories, true AS is_current UNION ALL SELECT 'two', NULL, 1, false")
def store_databases(spark, sf_dir):
    """Listing of database folders; then one is cleared and switched."""
    parent = scratch(spark, "databases")
    one, two = (stores.open_stores(spark, f"{parent}/{n}") for n in ("one", "two"))
    rows = read(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("problem_id"), F.lit("q").alias("raw_question"), F.lit("{}").alias("spec"), F.lit(None).cast("array<double>").alias("vector"))
    one["problems"].append(rows)
    two["trajectories"].append(spark.createDataFrame([("a", "b")], "trajectory_id string, raw string"))
    two["problems"].append(rows)
    two["problems"].clear()
    listed = stores.databases(spark, parent, f"{parent}/one")
    return spark.createDataFrame([(r["name"], r["problems"], r["trajectories"], r["is_current"]) for r in listed], "name string, problems long, trajectories long, is_current boolean")


@query("SELECT doc_id, n_chars, count(*) OVER () AS n FROM (SELECT doc_id, n_chars FROM documents UNION ALL SELECT doc_id, n_chars FROM documents WHERE doc_id % 2 = 0)")
def memory_table(spark, sf_dir):
    """A table of one session keeps equal keys."""
    table = stores.MemoryTable(spark, "doc_id long, n_chars long")
    docs = read(spark, sf_dir, "documents").select("doc_id", "n_chars")
    table.append(docs)
    table.append(docs.where("doc_id % 2 = 0"), "doc_id")
    return table.read().select("doc_id", "n_chars", F.lit(table.count()).cast("long").alias("n"))


def _run_log(spark, sf_dir) -> RunLog:
    """Users as runs, their events in order; a signup ends a run."""
    order = Window.partitionBy("user_id").orderBy("ts", "event_id")
    kind = F.when(F.col("event_type") == "signup", "done").otherwise(F.col("event_type"))
    rows = read(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("run_id"), (F.row_number().over(order) - 1).cast("long").alias("seq"), kind.alias("kind"), F.col("props").alias("payload"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("at")
    )
    log = RunLog(spark, scratch(spark, "runs"))
    log.append(rows.where("seq < 20"))
    log.append(rows.where("seq >= 10"))
    return log


_RUNS = """
e AS (SELECT user_id::VARCHAR AS run_id, CASE event_type WHEN 'signup' THEN 'done' WHEN 'error' THEN 'error' END AS fin, strftime(ts, '%Y-%m-%d %H:%M:%S') AS t FROM events),
r AS (SELECT run_id, count(*) AS events, coalesce(max(fin), 'running') AS status, max(t) FILTER (fin IS NOT NULL) AS finished_at FROM e GROUP BY 1)
"""


@query(f"WITH {_RUNS} SELECT * FROM r WHERE finished_at IS NULL UNION ALL (SELECT * FROM r WHERE finished_at IS NOT NULL ORDER BY finished_at DESC, run_id LIMIT 50)")
def run_log(spark, sf_dir):
    """Runs of a log whose events were written twice in part, as far as they are kept."""
    return _run_log(spark, sf_dir).kept()


@query("""
SELECT seq, kind FROM (
  SELECT row_number() OVER (ORDER BY ts, event_id) - 1 AS seq, CASE event_type WHEN 'signup' THEN 'done' ELSE event_type END AS kind FROM events WHERE user_id = 7) WHERE seq > 4""")
def run_events(spark, sf_dir):
    return _run_log(spark, sf_dir).events("7", 4).select("seq", "kind")


# ---- judging -----------------------------------------------------------------------------


def _answer(i: int, n: int = 2) -> str | None:
    """Raw answers of a model, sound and broken."""
    good = [{"match": True, "confidence": 0.8, "spans": [{"start_step": 0, "end_step": i % 4}], "reasoning": "r", "evidence_step": i, "criteria_hit": ["a", 1]}] * n
    return {
        0: json.dumps(good),
        1: "Here:\n```json\n" + json.dumps(good) + "\n```\nDone.",
        2: "so " + json.dumps(good[:1]) + " end",
        3: None,
        4: "no json [ at all",
        5: json.dumps([{"match": "yes", "confidence": "0.5", "spans": [{"start_step": 3, "end_step": 1}, 5, {"start_step": True, "end_step": 2}]}, 7]),
        6: json.dumps([{"match": 1, "confidence": "much"}, {"confidence": 0.25, "evidence_step": "x"}]),
        7: "{" + json.dumps(good[0])[1:],
    }[i % 8]


@query("""
WITH d AS (SELECT doc_id, (doc_id % 8)::INT AS k, p FROM documents, range(0, 2) r(p)),
g AS (SELECT *, k IN (0, 1) OR (k = 2 AND p = 0) AS good FROM d)
SELECT doc_id, p AS place, good OR (k = 5 AND p = 0) AS match,
  CASE WHEN good THEN 0.8 WHEN k = 5 AND p = 0 THEN 0.5 WHEN k = 6 AND p = 1 THEN 0.25 ELSE 0.0 END::DOUBLE AS confidence, CASE WHEN good THEN '0-' || (doc_id % 4) ELSE '' END AS spans,
  CASE WHEN good THEN 'r' WHEN k = 3 THEN 'empty_response' WHEN k IN (4, 7) THEN 'parse_error' WHEN k = 6 AND p = 0 THEN 'field_coercion_error' WHEN k IN (2, 5) AND p = 1 THEN 'missing_in_response' ELSE '' END AS reasoning,
  CASE WHEN good THEN doc_id END AS evidence_step, CASE WHEN good THEN 'a' ELSE '' END AS criteria
FROM g""")
def parsed_verdicts(spark, sf_dir):
    """Raw answers parsed: fenced, bracketed, broken, with fields of the wrong kind."""
    def work(frames):
        for frame in frames:
            rows = [(i, p, v) for i in frame["doc_id"] for p, v in enumerate(judging.parse_verdicts(_answer(int(i)), 2))]
            yield pd.DataFrame(rows, columns=["doc_id", "place", "v"])

    rows = read(spark, sf_dir, "documents").select("doc_id").mapInPandas(work, f"doc_id long, place long, v {judging.VERDICT}")
    spans = F.array_join(F.transform("v.spans", lambda s: view.span_key(s["start_step"], s["end_step"])), ",")
    return rows.select("doc_id", "place", "v.match", "v.confidence", spans.alias("spans"), "v.reasoning", F.col("v.evidence_step").cast("long").alias("evidence_step"), F.array_join("v.criteria_hit", ",").alias("criteria"))


_HITS = """
hits AS (SELECT n_chars % 50 AS sub_problem_id, doc_id AS trajectory_id, row_number() OVER (PARTITION BY n_chars % 50 ORDER BY doc_id) AS rank FROM documents),
miss AS (SELECT *, row_number() OVER (PARTITION BY sub_problem_id ORDER BY rank) - 1 AS i FROM hits WHERE trajectory_id % 4 <> 0)
"""


def _judged(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Hits with gaps where the cache answers, judged by an injected judge: every third request of a sub-problem fails."""
    rank = F.row_number().over(Window.partitionBy("sub_problem_id").orderBy("trajectory_id"))
    hits = read(spark, sf_dir, "documents").select((F.col("n_chars") % 50).alias("sub_problem_id"), F.col("doc_id").alias("trajectory_id"), F.lit(0).alias("slice_index"))
    hits = hits.withColumns({"rank": rank, "summary": F.col("trajectory_id").cast("string"), "failure_summary": F.col("sub_problem_id").cast("string")})

    def ask(problem: dict, summaries: list[str]) -> str:
        if sum(map(int, summaries)) % 3 == 0:
            raise RuntimeError("no answer")
        return json.dumps([{"match": int(s) % 2 == 0, "confidence": len(summaries) / 10, "reasoning": problem["failure_summary"]} for s in summaries])

    cached = hits.where("trajectory_id % 4 = 0").select(*judging.KEY, F.lit(True).alias("match"), F.lit(1.0).alias("confidence"), F.lit("cached").alias("reasoning"))
    _, misses = judging.with_cache(hits, cached)
    return cached, judging.judge(misses, ask).select(*judging.KEY, "match", "confidence", "reasoning")


_VERDICTS = f"""{_HITS},
req AS (SELECT sub_problem_id, i // 3 AS b, sum(trajectory_id) AS s, count(*) AS n FROM miss GROUP BY ALL),
v AS (
  SELECT m.sub_problem_id, trajectory_id, s % 3 <> 0 AND trajectory_id % 2 = 0 AS match, CASE WHEN s % 3 = 0 THEN 0.0 ELSE n / 10.0::DOUBLE END::DOUBLE AS confidence,
    CASE WHEN s % 3 = 0 THEN 'gateway_error' ELSE m.sub_problem_id::VARCHAR END AS reasoning
  FROM miss m JOIN req r ON r.sub_problem_id = m.sub_problem_id AND r.b = m.i // 3)
"""


@query(f"WITH {_VERDICTS} SELECT * FROM v")
def judged_hits(spark, sf_dir):
    """Misses judged in requests of three, in the order of their ranks."""
    return _judged(spark, sf_dir)[1].drop("slice_index")


@query(f"WITH {_VERDICTS} SELECT * FROM v UNION ALL SELECT sub_problem_id, trajectory_id, true, 1.0, 'cached' FROM hits WHERE trajectory_id % 4 = 0")
def judge_cache(spark, sf_dir):
    """The cache with the new verdicts."""
    cached, new = _judged(spark, sf_dir)
    table = stores.KeyedTable(spark, f"{scratch(spark, 'table')}/v", judging.KEY, "sub_problem_id long, trajectory_id long, slice_index int, match boolean, confidence double, reasoning string")
    table.append(cached)
    table.append(new)
    return table.read().select("sub_problem_id", "trajectory_id", "match", "confidence", "reasoning")


@query("SELECT n_chars % 50 AS sub_problem_id, doc_id AS trajectory_id, true AS match, 0.9::DOUBLE AS confidence, '0-1' AS spans FROM documents")
def fake_judge(spark, sf_dir):
    """The deterministic stand-in of a judge."""
    rows = read(spark, sf_dir, "documents").select((F.col("n_chars") % 50).alias("sub_problem_id"), F.col("doc_id").alias("trajectory_id"), F.lit(0).alias("slice_index"))
    rows = rows.withColumns({"rank": F.col("trajectory_id"), "summary": F.lit("s"), "failure_summary": F.lit("f")})
    found = judging.judge(rows, judging.always_match)
    return found.select("sub_problem_id", "trajectory_id", "match", "confidence", F.array_join(F.transform("spans", lambda s: view.span_key(s["start_step"], s["end_step"])), ",").alias("spans"))


# ---- compiling ---------------------------------------------------------------------------


def _script(name: str, payload: dict) -> str | None:
    """A language model by rule: two items a question, confidence by the question's length, an ambiguous one is split in two."""
    item = lambda i, text: {"id": i, "raw_text": text, "failure_summary": f"sum {text}"}
    if name == "decompose":
        n = int(payload["question"])
        return "Sure: " + json.dumps({"sub_problems": [item("a", str(n)), item("b", str(n + 1))]})
    if name == "clarify":
        return json.dumps([{"original_id": x["id"], "clarified": [item(x["id"] + "1", x["raw_text"]), item(x["id"] + "2", str(int(x["raw_text"]) + 5))]} for x in payload["items"]])
    out = []
    for x in payload["items"]:
        n = int(x["raw_text"])
        route = "pass" if name == "relabel" or n % 3 else "drop"
        out.append({
            "id": x["id"], "target_capability": ["c"] if n % 7 else [], "trajectory_signal": "s", "hyde_positive": ["h", "i"], "keywords": ["k"], "structured_filters": {},
            "confidence": (n % 10) / 10, "route": route, "drop_reason": "ambiguous" if n % 2 else "not_applicable", "label_proposals": [{"label": f"l{n % 4}", "taxonomy_extension": n % 4 == 1}],
        })
    return "```json\n" + json.dumps(out if name == "label" else {"results": out}) + "\n```"


_COMPILED = """
raw AS (SELECT item_id, length(text) + k AS n, CASE k WHEN 0 THEN 'a' ELSE 'b' END AS id FROM benchmark, range(0, 2) r(k)),
first AS (SELECT *, n % 3 <> 0 AND n % 10 >= 8 AS passed FROM raw),
kept AS (SELECT *, passed AND n % 7 <> 0 AS good FROM first),
dropped AS (SELECT *, CASE WHEN passed THEN 'other' WHEN n % 2 = 1 THEN 'ambiguous' ELSE 'not_applicable' END AS reason FROM kept WHERE NOT good),
again AS (SELECT item_id, id || (k + 1) AS id, n + 5 * k AS n FROM dropped, range(0, 2) r(k) WHERE reason = 'ambiguous'),
clear AS (SELECT * FROM again WHERE n % 10 >= 8 AND n % 7 <> 0)
"""


def _compiled(spark, sf_dir) -> DataFrame:
    kind = "item_id long, part string, id string, origin string, reason string, n long"

    def work(frames):
        compiler = compiling.Compiler(_script)
        for frame in frames:
            rows = []
            for ident, n in zip(frame["item_id"], frame["n"]):
                out = compiler.compile(str(n))
                rows += [(ident, "kept", x["id"], x["origin"], None, int(x["raw_text"])) for x in out["sub_problems"]]
                rows += [(ident, "dropped", x["id"], None, x["drop_reason"], int(x["raw_text"])) for x in out["dropped"]]
                rows += [(ident, "proposal", x["source_sub_problem_id"], None, x["label"], 0) for x in out["proposals"]]
            yield pd.DataFrame(rows, columns=["item_id", "part", "id", "origin", "reason", "n"])

    return read(spark, sf_dir, "benchmark").select("item_id", F.length("text").alias("n")).mapInPandas(work, kind)


@query(f"""
WITH {_COMPILED}
SELECT item_id, 'kept' AS part, id, 'original' AS origin, NULL AS reason, n FROM kept WHERE good
UNION ALL SELECT item_id, 'kept', id, 'clarified', NULL, n FROM clear
UNION ALL SELECT item_id, 'dropped', id, NULL, reason, n FROM dropped
UNION ALL SELECT item_id, 'proposal', id, NULL, 'l1', 0 FROM kept WHERE good AND n % 4 = 1
UNION ALL SELECT item_id, 'proposal', id, NULL, 'l1', 0 FROM clear WHERE n % 4 = 1""")
def compiled_questions(spark, sf_dir):
    """Questions compiled through all four calls: kept, dropped with reasons, clarified, proposals."""
    return _compiled(spark, sf_dir)


@query(f"""
WITH {_COMPILED}, p AS (SELECT item_id, id FROM kept WHERE good AND n % 4 = 1 UNION ALL SELECT item_id, id FROM clear WHERE n % 4 = 1)
SELECT 'l1' AS label, count(DISTINCT item_id::VARCHAR || id) AS priority, 1::BIGINT AS jobs FROM p HAVING count(*) > 0""")
def proposal_jobs(spark, sf_dir):
    """Proposals of compiled questions as backfill jobs."""
    rows = _compiled(spark, sf_dir).where("part = 'proposal'").select(F.col("reason").alias("label"), F.concat(F.col("item_id").cast("string"), "id").alias("sub_problem_id"), F.lit(1).alias("seq"))
    return taxonomy.priorities(rows).select("label", "priority", F.lit(1).cast("long").alias("jobs"))


@query("""
WITH n AS (SELECT item_id, chr(10) AS nl, text FROM benchmark)
SELECT item_id, md5('capability: c, d' || nl || 'signal: ' || text || nl
  || CASE WHEN item_id % 2 = 0 THEN 'rubric:' || nl || CASE WHEN item_id % 4 = 0 THEN '  kind: recovery' || nl ELSE '' END || '  positive: p' || nl || '  positive: q' || nl || '  decisive: e' || nl ELSE '' END
  || nl || 'slice 1:' || nl || 'one' || nl || nl || 'slice 2:' || nl || text || nl || nl || 'Judge all 2 slices.') AS prompt_md5 FROM n""")
def judge_prompts(spark, sf_dir):
    """The judge's question with and without a rubric."""
    @F.pandas_udf("string")
    def prompt(ident: pd.Series, text: pd.Series) -> pd.Series:
        rubric = lambda i: {"capability_kind": "recovery" if i % 4 == 0 else None, "positive_criteria": ["p", "q"], "negative_criteria": None, "decisive_evidence": "e"}
        problem = lambda i, t: {"target_capability": ["c", "d"], "trajectory_signal": t, "rubric": rubric(i) if i % 2 == 0 else None}
        return pd.Series([prompts.judge_prompt(problem(i, t), ["one", t]) for i, t in zip(ident, text)])

    return read(spark, sf_dir, "benchmark").select("item_id", F.md5(prompt("item_id", "text")).alias("prompt_md5"))


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_LABEL_PROMPT = "\n\n".join([prompts.LABEL, "languages: bash, cpp, go, html, java, javascript, other, python\ntools_used: Bash, Edit, Glob, Grep, NotebookEdit, Read, Task, TodoWrite, WebFetch, WebSearch, Write, other"])


@query(f"""
WITH s AS (SELECT {_quoted(_LABEL_PROMPT)} AS label, {_quoted(prompts.EVIDENCE)} AS evidence, chr(10) AS nl)
SELECT item_id, CASE WHEN item_id % 3 = 0 THEN text WHEN item_id % 3 = 1 THEN '- id: a' || nl || '  raw_text: ' || text || nl || '  failure_summary: f'
    ELSE '- id: a' || nl || '  raw_text: ' || text || nl || '  failure_summary: f' || nl || '  labels so far: x, y' END AS asked,
  CASE item_id % 3 WHEN 0 THEN {_quoted(prompts.DECOMPOSE)} WHEN 2 THEN {_quoted(prompts.CLARIFY)}
    ELSE label || nl || nl || CASE WHEN item_id % 2 = 0 THEN {_quoted(prompts.KNOWN_LABELS)} || nl || 'tree' ELSE {_quoted(prompts.NO_LABELS)} END
      || CASE WHEN item_id % 5 = 0 THEN nl || nl || {_quoted(prompts.RELABEL)} WHEN item_id % 4 = 1 THEN nl || nl || evidence || nl || 'seen' ELSE '' END END AS told
FROM benchmark, s""")
def call_prompts(spark, sf_dir):
    """Messages of the compiler's four calls, with and without a taxonomy and evidence."""
    def work(frames):
        for frame in frames:
            rows = []
            for i, text in zip(frame["item_id"], frame["text"]):
                item = {"id": "a", "raw_text": text, "failure_summary": "f", "target_capability": ["x", "y"] if i % 3 == 2 else None}
                call = {0: "decompose", 1: "relabel" if i % 5 == 0 else "label", 2: "clarify"}[i % 3]
                found = prompts.messages(call, {"question": text, "items": [item], "evidence": "seen" if i % 4 == 1 else None}, "tree" if i % 2 == 0 else "")
                rows.append((i, found[1]["content"], found[0]["content"]))
            yield pd.DataFrame(rows, columns=["item_id", "asked", "told"])

    return read(spark, sf_dir, "benchmark").select("item_id", "text").mapInPandas(work, "item_id long, asked string, told string")


@query(r"""
SELECT doc_id, CASE WHEN doc_id % 3 = 2 THEN 'x' || doc_id ELSE '{"a":' || doc_id || '}' END AS inside FROM documents""")
def stripped_fences(spark, sf_dir):
    """Answers with and without a fence."""
    @F.pandas_udf("string")
    def inside(answers: pd.Series) -> pd.Series:
        return answers.map(specs.strip_fence)

    ident = F.col("doc_id").cast("string")
    value = F.concat(F.lit('{"a":'), ident, F.lit("}"))
    answer = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("```json\n"), value, F.lit("\n```\n"))).when(F.col("doc_id") % 3 == 1, value).otherwise(F.concat(F.lit("x"), ident))
    return read(spark, sf_dir, "documents").select("doc_id", inside(answer).alias("inside"))


@query("""
WITH q AS (SELECT nation.n_nationkey AS i, length(n_name) AS b FROM nation)
SELECT count(DISTINCT b) AS added, count(*) - count(DISTINCT b) AS skipped_dup, 0::BIGINT AS failed FROM q""")
def ingested_manifest(spark, sf_dir):
    """Questions compiled and stored one by one; a near copy of a stored one is skipped."""
    names = [r.n_name for r in read(spark, sf_dir, "nation").orderBy("n_nationkey").collect()]  # 25 rows
    embedder = lambda texts: [[1.0 if k == len(t) else 0.0 for k in range(40)] for t in texts]

    class Compiles:
        def compile(self, question, evidence=None):
            return {"raw_input": question}

    counts = curation.ingest_manifest(spark, scratch(spark, "warehouse"), [(n, None) for n in names], Compiles(), embedder)
    return spark.createDataFrame([(counts["added"], counts["skipped_dup"], counts["failed"])], "added long, skipped_dup long, failed long")


# ---- taxonomy evolution --------------------------------------------------------------------


@query("""
WITH p AS (SELECT n_nationkey AS i, n_name AS label, n_regionkey AS g, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) AS r FROM nation)
SELECT label, CASE WHEN r = 1 THEN 'new_root' WHEN r = 2 THEN 'new_leaf' ELSE 'duplicate' END AS kind,
  CASE WHEN r = 1 THEN NULL WHEN r = 2 THEN first_value(label) OVER w ELSE nth_value(label, 2) OVER (PARTITION BY g ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) END AS target,
  CASE WHEN r <= 2 THEN 'done' END AS job
FROM p WINDOW w AS (PARTITION BY g ORDER BY i)""")
def evolved_labels(spark, sf_dir):
    """Nations as proposals: the first of a region is a root, the second a leaf below it, the others copies of the leaf; stored with their jobs."""
    rows = read(spark, sf_dir, "nation").orderBy("n_nationkey").collect()  # 25 rows
    seen: dict[int, int] = {}
    proposals = []
    for r in rows:
        k = seen[r.n_regionkey] = seen.get(r.n_regionkey, 0) + 1
        turn = [1.0, 0.0] if k == 1 else [0.7, 0.7141428]
        vector = [0.0] * 10
        vector[2 * r.n_regionkey : 2 * r.n_regionkey + 2] = turn
        proposals.append({"label": r.n_name, "vector": vector, "description": "", "source_sub_problem_id": r.n_nationkey})
    root = scratch(spark, "warehouse")
    out = curation.evolve(spark, root, proposals, [], "t0", run=lambda label: 0)
    tables = stores.open_stores(spark, root)
    found = spark.createDataFrame([(x["label"], x["kind"], x["target"]) for x in out["resolved"]], "label string, kind string, target string")
    jobs = tables["jobs"].read().select("label", F.col("status").alias("job"))
    return found.join(jobs, "label", "left").join(tables["labels"].read().select("label", F.lit(True).alias("stored")), "label", "left").where("stored or kind = 'duplicate'").drop("stored")


@query("SELECT o_orderstatus AS status, count(*) AS n FROM orders GROUP BY 1")
def job_counts(spark, sf_dir):
    return taxonomy.status_counts(read(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("status")))


@query(f"""
WITH {_CENTROIDS}, c AS (SELECT list_cosine_similarity(embedding::DOUBLE[], vector) AS s FROM embeddings JOIN cent USING (label))
SELECT round(min(s), 6) AS least, round(max(s), 6) AS largest, round(avg(s), 6) AS mean FROM c""")
def mount_threshold(spark, sf_dir):
    """Cosines of vectors with the centre of their label."""
    pairs = read(spark, sf_dir, "embeddings").select("label", F.col("embedding").alias("a")).join(catalogue._centroids(spark, sf_dir).withColumnRenamed("vector", "b"), "label")
    return taxonomy.cosine_range(pairs).select(*[F.round(c, 6).alias(c) for c in ("least", "largest", "mean")])


# ---- ranking, merging, selection ---------------------------------------------------------------


@query(f"""
WITH {_SCORED} SELECT item_id AS sub_problem_id, doc_id AS trajectory_id, row_number() OVER (ORDER BY relevance DESC, item_id, rank) AS place FROM scored""")
def global_order(spark, sf_dir):
    """All scored rows in one order."""
    rows = ranking.global_order(catalogue._scored(spark, sf_dir), ["sub_problem_id", "rank"])
    place = F.row_number().over(Window.orderBy(F.desc("relevance"), "sub_problem_id", "rank"))  # sub-problems times recall depth
    return rows.select("sub_problem_id", "trajectory_id", place.cast("long").alias("place"))


@query(f"""
WITH {_SCORED}, p AS (SELECT DISTINCT item_id, unnest(['x', 'y']) AS label FROM scored), h AS (SELECT item_id, count(*) AS n FROM scored WHERE m GROUP BY 1)
SELECT item_id AS sub_problem_id, label, coalesce(n, 0) AS hit_count FROM p LEFT JOIN h USING (item_id)""")
def capability_counts(spark, sf_dir):
    return view.capability_counts(catalogue._scored(spark, sf_dir).withColumn("target_capability", tx.strings("x", "y")))


@query(f"WITH {_SCORED} SELECT least(10, greatest(1, count(*))) AS budget FROM merged")
def default_budget(spark, sf_dir):
    return spark.createDataFrame([(selection.default_budget(catalogue._merged(spark, sf_dir)),)], "budget long")


@query(f"""
WITH {_SCORED}, q AS (SELECT *, min(seq) OVER (PARTITION BY lang) AS survivor FROM merged),
s AS (SELECT q.survivor, scored.item_id, max(scored.relevance) AS r FROM q JOIN scored ON scored.doc_id = q.doc_id AND scored.m GROUP BY ALL)
SELECT h.doc_id AS trajectory_id, round(max(s.r), 6) AS relevance, count(*) AS n_problems, round(sum(s.r), 6) AS total,
  (SELECT count(DISTINCT span_end) FROM q x WHERE x.survivor = h.survivor) AS n_spans, 1 + (SELECT count(DISTINCT source) FROM q x WHERE x.survivor = h.survivor) AS n_capabilities
FROM q h JOIN s ON s.survivor = h.survivor WHERE h.seq = h.survivor GROUP BY h.doc_id, h.survivor""")
def absorbed_duplicates(spark, sf_dir):
    """Merged slices of one language as copies of the first of them."""
    merged = catalogue._merged(spark, sf_dir).withColumn("lang", F.col("capability")[0])
    first = merged.groupBy("lang").agg(F.min("seq").alias("survivor"))
    rows = merging.absorb(merged.drop("lang"), merged.join(first, "lang").select("seq", "survivor"))
    total = F.aggregate(F.map_values("relevance_by_problem"), F.lit(0.0), lambda a, x: a + x)
    return rows.select(
        "trajectory_id", F.round("relevance", 6).alias("relevance"), F.size("sub_problem_ids").cast("long").alias("n_problems"), F.round(total, 6).alias("total"),
        F.size("spans").cast("long").alias("n_spans"), F.size("capability").cast("long").alias("n_capabilities"),
    )


@query("SELECT item_id AS sub_problem_id, p AS place, length(text)::DOUBLE + p AS first FROM benchmark, range(0, 2) r(p) WHERE item_id % 3 <> 0")
def query_vectors(spark, sf_dir):
    """Query texts embedded by an injected embedder, here their length; none for sub-problems without texts."""
    texts = F.when(F.col("item_id") % 3 != 0, F.array("text", F.concat("text", F.lit("x"))))
    rows = read(spark, sf_dir, "benchmark").select(F.col("item_id").alias("sub_problem_id"), texts.alias("hyde_positive"))
    rows = with_query_vectors(rows, lambda said: [[float(len(t)), 0.5] for t in said])
    return rows.select("sub_problem_id", F.posexplode("query_vectors").alias("p", "v")).select("sub_problem_id", F.col("p").cast("long").alias("place"), F.col("v")[0].alias("first"))


# ---- functions -----------------------------------------------------------------------------


@query("""
WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings),
c AS (SELECT vec_id, v, list_concat(v, [0.0::DOUBLE, 0.0])[1:5] AS five FROM v)
SELECT vec_id, round(list_distance(v, list_reverse(v)), 6) AS l2, round(five[1] / sqrt(list_inner_product(five, five)), 6) AS first_of_five, round(v[64] / sqrt(list_inner_product(v, v)), 6) AS last_of_more FROM c""")
def vector_functions(spark, sf_dir):
    """Euclidean distance, and vectors cut or padded to a dimension."""
    v = F.col("embedding")
    return read(spark, sf_dir, "embeddings").select(
        "vec_id", F.round(vectors.l2(v, F.reverse(v)), 6).alias("l2"), F.round(vectors.ensure_dimension(v, 5)[0], 6).alias("first_of_five"),
        F.round(vectors.ensure_dimension(v, 70)[63], 6).alias("last_of_more"),
    )


@query("SELECT doc_id, coalesce(length(text), 0) // 4 AS tokens, CASE WHEN doc_id % 2 = 0 THEN '1.' || (doc_id % 7) || '.' || (doc_id + 1) ELSE 'v' || doc_id END AS version FROM documents")
def text_estimates(spark, sf_dir):
    """Estimated tokens and bumped versions."""
    ident = F.col("doc_id").cast("string")
    version = F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("1."), (F.col("doc_id") % 7).cast("string"), F.lit("."), ident)).otherwise(F.concat(F.lit("v"), ident))
    return read(spark, sf_dir, "documents").select("doc_id", tx.estimated_tokens(F.coalesce("text", F.lit(""))).alias("tokens"), tx.bump_patch(version).alias("version"))


# ---- request health --------------------------------------------------------------------------


@query("""
SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'timeout' ELSE 'transient_error' END AS outcome, event_type IN ('click', 'error') AS retryable FROM events""")
def failed_requests(spark, sf_dir):
    """Classes of requests without an answer, and which outcomes are worth another try."""
    error = F.when(F.col("event_id") % 3 == 0, "ReadTimeout: late").when(F.col("event_id") % 3 == 1, "ConnectError: timeout of peer").otherwise(F.lit(None))
    outcome = F.when(F.col("event_type") == "click", "overload").when(F.col("event_type") == "error", "abnormal_response").when(F.col("event_type") == "view", "auth_error").otherwise("success")
    return read(spark, sf_dir, "events").select("event_id", health.exception_class(error).alias("outcome"), health.is_retryable(outcome).alias("retryable"))


_MONITOR = """
o AS (
  SELECT user_id, event_id, event_type <> 'view' AS failed, event_type IN ('error', 'click', 'purchase') AS fatal, row_number() OVER w AS i FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
c AS (SELECT *, sum(failed::INT) OVER (PARTITION BY user_id ORDER BY i) AS bad, sum((NOT fatal)::INT) OVER (PARTITION BY user_id ORDER BY i) AS island FROM o),
s AS (SELECT *, sum(fatal::INT) OVER (PARTITION BY user_id, island ORDER BY i) AS streak FROM c),
x AS (SELECT user_id, min(i) AS stop FROM s WHERE (failed AND fatal AND streak >= 5) OR (failed AND i >= 20 AND bad::DOUBLE / i >= 0.95) GROUP BY 1)
"""


@query(f"WITH {_MONITOR} SELECT user_id, max(i) AS total, max(bad)::BIGINT AS failed, stop AS stopped_at FROM s LEFT JOIN x USING (user_id) GROUP BY user_id, stop")
def abort_monitor(spark, sf_dir):
    """The monitor over each user's outcomes: where it stops the run."""
    kind = F.col("event_type")
    outcome = F.when(kind.isin("error", "click", "purchase"), "auth_error").when(kind == "view", "success").otherwise("timeout")
    rows = read(spark, sf_dir, "events").select("user_id", "ts", "event_id", outcome.alias("outcome"))

    def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        monitor, stop = health.AbortMonitor(), None
        for i, o in enumerate(frame.sort_values(["ts", "event_id"])["outcome"], 1):
            if monitor.record(o) and stop is None:
                stop = i
        return pd.DataFrame({"user_id": [key[0]], "total": [monitor.total], "failed": [monitor.failed], "stopped_at": pd.array([stop], "Int64")})

    return rows.groupBy("user_id").applyInPandas(run, f"user_id {dict(rows.dtypes)['user_id']}, total long, failed long, stopped_at long")
