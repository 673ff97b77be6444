"""Named queries over the contract tables, with the SQL that must return the same rows.

The tables stand in for trajectories: documents are slices with signatures,
embeddings their vectors, benchmark items are complaints, labels are verdicts,
a user's events are a long tool trajectory, regions and nations a taxonomy.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracequarry.functions import text as tx
from tracequarry.lineage import scratch
from tracequarry.operators import dedup, evaluation, health, judging, keyword_index, merging, ranking, recall, selection, slicing, taxonomy, vector_index, view
from tracequarry.operators.signatures import signatures
from tracequarry.plans.oracles import SQL
from tracequarry.sources import trajectories

_REGISTERED: dict = {}


def query(f):
    _REGISTERED[f.__name__] = f
    return f


def queries() -> dict:
    return dict(_REGISTERED)


def oracle_sql() -> dict:
    return {k: v for k, v in SQL.items() if k in _REGISTERED}


def read(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def long(*names: str) -> list:
    return [F.col(n).cast("long").alias(n) for n in names]


# ---- stand-ins -------------------------------------------------------------


def event_steps(spark, sf_dir) -> DataFrame:
    """A user's events as steps of a trajectory."""
    kind = F.col("event_type")
    order = Window.partitionBy("user_id").orderBy("ts", "event_id")
    tool = F.when(kind == "view", "Read").when(kind == "click", "Edit").when(kind == "purchase", "Bash")
    return read(spark, sf_dir, "events").select(
        F.col("user_id").alias("trajectory_id"),
        (F.row_number().over(order) - 1).alias("step_index"),
        F.when(kind == "signup", "user").when(kind == "error", "tool").otherwise("assistant").alias("role"),
        F.coalesce("props", F.lit("")).alias("content"),
        tool.alias("tool_call_name"),
        F.when(kind == "purchase", "run tests").when(tool.isNotNull(), F.concat(F.lit("file "), F.col("event_id").cast("string"))).alias("tool_call_args"),
        F.when(kind == "error", F.lit("Error: failed")).alias("tool_result"),
    )


def corpus(spark, sf_dir) -> DataFrame:
    """Documents as signatures: tokens, language, tool, verification, vector, arrival."""
    docs, vectors = read(spark, sf_dir, "documents"), read(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding")
    return docs.join(vectors, "doc_id", "left").select(
        "doc_id",
        F.col("doc_id").alias("ingest_seq"),
        F.array("lang").alias("languages"),
        F.array("source").alias("tools_used"),
        F.col("text").rlike(tx.VERIFY_PATTERN).alias("verified"),
        F.sort_array(F.array_distinct(tx.identifiers(F.col("text")))).alias("bm25_tokens"),
        "embedding",
    )


def complaints(spark, sf_dir) -> DataFrame:
    """Benchmark items as sub-problems: keywords, one or two query vectors, and wishes for languages, tools and verification.

    Every seventh has neither keywords nor vectors."""
    items, vectors = read(spark, sf_dir, "benchmark"), read(spark, sf_dir, "embeddings")
    first, ident = F.lower(F.substring("text", 1, 1)), F.col("item_id")
    silent = ident % 7 == 3
    wish = F.when(first < "i", tx.strings("en", "fr")).when(first < "p", tx.strings("en"))
    tools = F.when(ident % 3 == 0, tx.strings(*[f"src{i}" for i in range(10)]))
    filters = F.struct(wish.alias("languages"), tools.alias("tools_used"), F.when(ident % 4 == 1, True).alias("has_verification_step"))
    one = vectors.select(F.col("vec_id").alias("item_id"), F.col("embedding").alias("v1"))
    two = vectors.select((F.col("vec_id") - 1).alias("item_id"), F.reverse("embedding").alias("v2"))
    both = F.filter(F.array("v1", F.when(ident % 2 == 0, F.col("v2"))), lambda v: v.isNotNull())
    return items.join(one, "item_id", "left").join(two, "item_id", "left").select(
        ident.alias("sub_problem_id"),
        F.when(silent, tx.strings()).otherwise(tx.identifiers(F.col("text"))).alias("keywords"),
        F.when(~silent & (F.size(both) > 0), both).alias("query_vectors"),
        filters.alias("filters"),
    )


def _recalled(spark, sf_dir, top_n: int = 20) -> DataFrame:
    condition = lambda q: recall.passes(F.col("languages"), F.col("tools_used"), F.col("verified"), q["filters"])
    return recall.recall(corpus(spark, sf_dir), complaints(spark, sf_dir), condition, top_n=top_n)


def _scored(spark, sf_dir) -> DataFrame:
    """Recalled documents with verdicts from labels, spans and capabilities."""
    hits = _recalled(spark, sf_dir)
    docs = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("ingest_seq"), "lang", "source", "n_chars")
    verdicts = read(spark, sf_dir, "labels").select(F.col("doc_id").alias("ingest_seq"), "quality", "toxic")
    match = F.coalesce(F.col("quality") == 1, F.lit(False))
    span = F.struct(F.lit(0).alias("start_step"), F.floor(F.col("n_chars") / 1000).cast("int").alias("end_step"))
    rows = hits.join(docs, "ingest_seq").join(verdicts, "ingest_seq", "left")
    rows = rows.select(
        "sub_problem_id",
        F.col("ingest_seq").alias("trajectory_id"),
        F.lit(0).alias("slice_index"),
        "rrf",
        "rank",
        match.alias("match"),
        match.alias("judge_match"),
        F.when(F.col("toxic") == 1, 0.6).otherwise(0.9).alias("confidence"),
        F.when(match, F.array(span)).otherwise(F.array().cast("array<struct<start_step:int,end_step:int>>")).alias("spans"),
        F.array("lang", "source").alias("capability"),
    )
    return rows.withColumns({"relevance": ranking.relevance(F.col("rrf"), F.col("match")), "seq": F.col("sub_problem_id") * 1000 + F.col("rank")})


# ---- sources, steps, signatures ---------------------------------------------


def logged(spark, sf_dir) -> DataFrame:
    """Conversations as parsed trajectories: messages without calls."""
    message = F.struct("role", F.col("text").alias("content"), F.lit(None).cast("string").alias("tool_call_id"), F.lit(None).cast("array<string>").alias("tool_calls"))
    rows = read(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", message.alias("m")))).alias("m"))
    return rows.select(F.col("conv_id").alias("trajectory_id"), F.transform("m", lambda x: x["m"]).alias("messages"))


@query
def steps_from_conversations(spark, sf_dir):
    rows = trajectories.steps(logged(spark, sf_dir))
    return rows.select(F.col("trajectory_id").alias("conv_id"), *long("step_index"), "role", F.md5("content").alias("content_md5"))


@query
def turn_and_step_counts(spark, sf_dir):
    rows = trajectories.steps(logged(spark, sf_dir)).withColumn("i", F.col("step_index"))
    step = F.struct("step_index", "role", "content", "tool_call_name", "tool_call_args", "tool_result")
    whole = rows.groupBy("trajectory_id").agg(F.sort_array(F.collect_list(step)).alias("steps"))
    return signatures(whole).select(F.col("trajectory_id").alias("conv_id"), *long("step_count", "turn_count"))


@query
def text_flags(spark, sf_dir):
    t = F.col("text")
    return read(spark, sf_dir, "documents").select(
        "doc_id",
        t.rlike(tx.VERIFY_PATTERN).alias("verifies"),
        tx.is_error(t).alias("has_error"),
        tx.is_success(t).alias("has_success"),
        F.array_join(tx.languages(t), ",").alias("languages"),
    )


@query
def bm25_tokens(spark, sf_dir):
    tokens = F.sort_array(F.array_distinct(tx.identifiers(F.col("text"))))
    return read(spark, sf_dir, "documents").select("doc_id", F.size(tokens).cast("long").alias("n_tokens"), F.md5(F.array_join(tokens, " ")).alias("tokens_md5"))


@query
def boundary_scores(spark, sf_dir):
    return slicing.boundary_scores(event_steps(spark, sf_dir)).select("trajectory_id", *long("step_index", "boundary_score"))


@query
def greedy_slices(spark, sf_dir):
    return slicing.slice_bounds(event_steps(spark, sf_dir)).select("trajectory_id", *long("slice_index", "start_step", "end_step"))


@query
def slice_signatures(spark, sf_dir):
    signed = signatures(slicing.slices(event_steps(spark, sf_dir)))
    return signed.select(
        "trajectory_id", *long("slice_index", "step_count", "turn_count"), F.array_join("tools_used", ",").alias("tools_used"),
        "has_error_pattern", "has_success_pattern", "has_verification_step",
    )


@query
def summary_lines(spark, sf_dir):
    """Turns as steps: every fourth turn is a tool's, assistants call something at even turns, one role is unknown."""
    role = F.when(F.col("turn") % 4 == 3, "tool").when(F.col("turn") == 6, "critic").otherwise(F.col("role"))
    calls = (F.col("role") == "assistant") & (F.col("turn") % 2 == 0)
    said = F.coalesce("text", F.lit(""))
    step = F.struct(
        F.col("turn").cast("int").alias("step_index"), role.alias("role"), said.alias("content"),
        F.when(calls, "Edit").alias("tool_call_name"), F.when(calls, F.reverse(said)).alias("tool_call_args"),
        F.when(F.col("turn") == 3, F.concat(F.lit("result\n"), said)).alias("tool_result"),
    )
    return read(spark, sf_dir, "conversations").select("conv_id", "turn", tx.summary_line(step).alias("line"))


@query
def problem_ids(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", tx.problem_id("text").alias("problem_id"))


# ---- recall ------------------------------------------------------------------


@query
def document_frequency(spark, sf_dir):
    rows = corpus(spark, sf_dir)
    n = rows.agg(F.count("*").alias("n"))
    df = recall.document_frequency(rows).join(F.broadcast(n))  # one row
    return df.select("token", "df", F.round(recall.idf(F.col("n"), F.col("df")), 6).alias("idf"))


@query
def structured_filter_overlap(spark, sf_dir):
    condition = recall.passes(F.col("languages"), F.col("tools_used"), F.col("verified"), F.col("filters"))
    pairs = corpus(spark, sf_dir).select("doc_id", "languages", "tools_used", "verified").join(F.broadcast(complaints(spark, sf_dir).select("sub_problem_id", "filters")), condition)
    return pairs.groupBy("sub_problem_id").agg(F.count("*").alias("candidates"), F.max("doc_id").alias("last_doc"))


@query
def bm25_topn(spark, sf_dir):
    """From a stored index that was written twice: even documents, then odd ones; a third of the even ones was replaced."""
    rows = _token_items(spark, sf_dir).withColumnRenamed("seq", "ingest_seq")
    index = keyword_index.KeywordIndex(spark, scratch(spark, "keyword-index"))
    old = rows.where("ingest_seq % 6 = 0").withColumn("ingest_seq", -F.col("ingest_seq") - 1)
    index.append(rows.where("ingest_seq % 6 in (2, 4)").unionByName(old))
    index.remove(old)
    index.append(rows.where("ingest_seq % 6 not in (2, 4)"))
    top = index.search(complaints(spark, sf_dir))
    return top.select("sub_problem_id", F.col("ident").alias("doc_id"), *long("rank"), F.round("bm25", 6).alias("bm25"))


@query
def vector_topn(spark, sf_dir):
    """From a stored index that was written twice."""
    rows = corpus(spark, sf_dir).select("ingest_seq", "embedding")
    index = vector_index.VectorIndex(spark, scratch(spark, "vector-index"))
    index.append(rows.where("ingest_seq % 3 <> 0"))
    index.append(rows.where("ingest_seq % 3 = 0"))
    top = index.search(complaints(spark, sf_dir))
    return top.select("sub_problem_id", F.col("ident").alias("doc_id"), *long("rank"), F.round("cosine", 5).alias("cosine"))


@query
def rrf_recall_multi(spark, sf_dir):
    """For each complaint the 20 best documents by hybrid recall."""
    return _recalled(spark, sf_dir).select("sub_problem_id", F.col("ingest_seq").alias("doc_id"), *long("rank"), F.round("rrf", 6).alias("rrf"))


# ---- judging and ranking -------------------------------------------------------


def _cached(spark, sf_dir):
    """Recalled slices, and a cache with the verdicts on labelled documents that even sub-problems asked for."""
    found = _recalled(spark, sf_dir).select("sub_problem_id", F.col("ingest_seq").alias("trajectory_id"), F.lit(0).alias("slice_index"), "rank")
    quality = read(spark, sf_dir, "labels").select(F.col("doc_id").alias("trajectory_id"), "quality")
    asked = found.where("sub_problem_id % 2 = 0").select("sub_problem_id", "trajectory_id", "slice_index")
    return found, asked.join(quality, "trajectory_id").select(*judging.KEY, "quality")


@query
def cache_hits(spark, sf_dir):
    hits, _ = judging.with_cache(*_cached(spark, sf_dir))
    return hits.select("sub_problem_id", "trajectory_id", *long("rank", "quality"))


@query
def cache_misses(spark, sf_dir):
    _, misses = judging.with_cache(*_cached(spark, sf_dir))
    return misses.select("sub_problem_id", "trajectory_id", *long("rank"))


@query
def soft_rerank(spark, sf_dir):
    hits = ranking.soft_rerank(_scored(spark, sf_dir), [F.col("rank")])
    return hits.select("sub_problem_id", "trajectory_id", *long("local_rank"), F.round("relevance", 6).alias("relevance"))


@query
def hard_filter_group(spark, sf_dir):
    kept = ranking.confident(_scored(spark, sf_dir))
    groups = ranking.grouped(kept, "seq", ["sub_problem_id", "confidence"])
    ids = F.array_join(F.transform("matched_problems", lambda x: x["sub_problem_id"].cast("string")), ",")
    return groups.select("trajectory_id", F.size("matched_problems").cast("long").alias("n"), ids.alias("sub_problems"))


@query
def inherit_rerank(spark, sf_dir):
    nations = read(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("label"), F.col("n_regionkey"))
    regions = read(spark, sf_dir, "region").select("r_regionkey", F.col("r_name").alias("parent"))
    labels = nations.join(F.broadcast(regions), F.col("n_regionkey") == F.col("r_regionkey")).select("label", "parent")  # 5 rows
    target = taxonomy.families(labels).groupBy().agg(F.min_by(F.struct("label", "family"), "label").alias("t"))
    hits = read(spark, sf_dir, "supplier").join(F.broadcast(nations), F.col("s_nationkey") == F.col("n_nationkey"))  # 25 rows
    hits = hits.select("s_suppkey", F.array("label").alias("capability_labels"), F.col("s_acctbal").alias("rrf")).join(F.broadcast(target))  # one row
    hits = hits.select("s_suppkey", "capability_labels", "rrf", F.col("t.label").alias("target_label"), F.col("t.family").alias("family"))
    ranked = ranking.rerank_with_inheritance(hits, [F.col("s_suppkey")])
    return ranked.select("s_suppkey", *long("rank"), F.round("weighted", 4).alias("weighted"))


# ---- merging, dedup, selection ---------------------------------------------------


@query
def trainable_filter(spark, sf_dir):
    return merging.trainable(_scored(spark, sf_dir)).select("sub_problem_id", "trajectory_id", F.size("spans").cast("long").alias("n_spans"))


def _merged(spark, sf_dir) -> DataFrame:
    return merging.merge_by_slice(merging.trainable(_scored(spark, sf_dir)))


@query
def merge_by_slice(spark, sf_dir):
    return _merged(spark, sf_dir).select(
        "trajectory_id",
        F.array_join(F.transform("sub_problem_ids", lambda x: x.cast("string")), ",").alias("sub_problems"),
        F.round("relevance", 6).alias("relevance"),
        F.array_join(F.transform("spans", lambda x: view.span_key(x["start_step"], x["end_step"])), ",").alias("spans"),
        F.array_join("capability", ",").alias("capability"),
    )


def _token_items(spark, sf_dir) -> DataFrame:
    """Documents and their tokens; without :func:`corpus`'s join with the vectors, which shuffles every text."""
    tokens = F.sort_array(F.array_distinct(tx.identifiers(F.col("text"))))
    return read(spark, sf_dir, "documents").select(F.col("doc_id").alias("seq"), tokens.alias("bm25_tokens"))


@query
def dedup_token_pairs(spark, sf_dir):
    pairs, _ = dedup.token_pairs(_token_items(spark, sf_dir))
    return pairs


@query
def minhash_pairs(spark, sf_dir):
    """Pairs by estimated similarity; no SQL, as DuckDB has no such hash."""
    pairs, _ = dedup.minhash_pairs(_token_items(spark, sf_dir))
    return pairs.select("a", "b", F.col("equal").cast("long").alias("equal"))


@query
def dedup_cosine_pairs(spark, sf_dir):
    items = read(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("seq"), "embedding")
    return dedup.cosine_pairs(items, 0.40)


@query
def dedup_greedy(spark, sf_dir):
    pairs, sets = dedup.token_pairs(_token_items(spark, sf_dir))
    kept = dedup.survivors(sets.select(F.col("first").alias("seq")).distinct(), pairs)
    return sets.join(kept.withColumnRenamed("seq", "first"), "first").select(F.col("seq").alias("doc_id"), "survivor")


@query
def select_budget(spark, sf_dir):
    top = selection.select_by_total(_merged(spark, sf_dir), 10)
    return top.select("trajectory_id", *long("pick"), F.round("total", 6).alias("total"))


@query
def select_coverage(spark, sf_dir):
    vectors = read(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("trajectory_id"), "embedding")
    merged = _merged(spark, sf_dir).join(vectors, "trajectory_id", "left")
    merged = merged.withColumns(
        {
            "run_id": F.lit("run"),
            "sub_problem_ids": F.transform("sub_problem_ids", lambda x: x.cast("string")),
            "relevance_by_problem": F.transform_keys("relevance_by_problem", lambda k, _: k.cast("string")),
        }
    )
    problems = [str(r.item_id) for r in read(spark, sf_dir, "benchmark").select("item_id").orderBy("item_id").collect()]
    config = selection.SelectionConfig(n=12, min_per_problem=0, cap_per_problem=3, coverage_cap_per_problem=0.05)
    return selection.select_set(merged, config, problems)


@query
def compose_manifest(spark, sf_dir):
    top = selection.select_by_total(_merged(spark, sf_dir), 10)
    return merging.manifest(top, 0.3)


# ---- taxonomy ---------------------------------------------------------------------


def _centroids(spark, sf_dir) -> DataFrame:
    each = read(spark, sf_dir, "embeddings").select("label", F.posexplode("embedding").alias("i", "x"))
    means = each.groupBy("label", "i").agg(F.avg(F.col("x").cast("double")).alias("x"))
    return means.groupBy("label").agg(F.sort_array(F.collect_list(F.struct("i", "x"))).alias("v")).select(
        F.col("label").cast("long").alias("label"), F.transform("v", lambda p: p["x"]).alias("vector")
    )


@query
def nearest_question(spark, sf_dir):
    asked = complaints(spark, sf_dir).where("query_vectors is not null").select(F.col("sub_problem_id").alias("item_id"), F.col("query_vectors")[0].alias("vector"))
    stored = _centroids(spark, sf_dir).select(F.col("label").alias("problem"), F.col("label").alias("ord"), "vector")
    best = taxonomy.nearest(asked, stored, "item_id", "problem", "ord")
    return best.select("item_id", "problem", F.round("cosine", 5).alias("cosine"), (F.col("cosine") >= 0.90).alias("reuse"))


@query
def resolve_labels(spark, sf_dir):
    vectors = read(spark, sf_dir, "embeddings")
    roots = _centroids(spark, sf_dir).select(F.concat(F.lit("root-"), F.col("label")).alias("label"), F.lit(None).cast("string").alias("parent"), "vector", F.col("label").alias("ord"))
    leaf = vectors.groupBy("label").agg(F.min_by("embedding", "vec_id").alias("vector"))
    leaf = leaf.select(
        F.concat(F.lit("leaf-"), F.col("label")).alias("l"), F.concat(F.lit("root-"), F.col("label")).alias("parent"),
        F.col("vector").cast("array<double>").alias("vector"), (F.col("label") + 100).cast("long").alias("ord"),
    ).withColumnRenamed("l", "label")
    proposals = vectors.select(F.col("vec_id").alias("proposal"), F.col("embedding").alias("vector"))
    found = taxonomy.resolve(proposals, roots.unionByName(leaf))
    return found.select("proposal", "kind", "target", F.round("any_cos", 5).alias("any_cos"), F.round("root_cos", 5).alias("root_cos"))


def _places(spark, sf_dir) -> DataFrame:
    regions = read(spark, sf_dir, "region").select(F.col("r_name").alias("label"), F.lit(None).cast("string").alias("parent"))
    nations = read(spark, sf_dir, "nation").join(F.broadcast(read(spark, sf_dir, "region")), F.col("n_regionkey") == F.col("r_regionkey"))  # 5 rows
    return regions.unionByName(nations.select(F.col("n_name").alias("label"), F.col("r_name").alias("parent")))


@query
def leaf_labels(spark, sf_dir):
    return taxonomy.leaves(_places(spark, sf_dir)).select("label", "parent")


@query
def label_family(spark, sf_dir):
    return taxonomy.families(_places(spark, sf_dir)).select("label", F.array_join("family", ",").alias("family"))


@query
def label_merge(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", F.array("lang", "source").alias("capability_labels"))
    quality, toxic = F.when(F.col("quality") == 1, "quality"), F.when(F.col("toxic") == 1, "toxic")
    found = read(spark, sf_dir, "labels").select("doc_id", F.filter(F.array(quality, toxic, F.lit("en")), lambda x: x.isNotNull()).alias("labels"))
    return taxonomy.update_labels(docs, found, ["doc_id"]).select("doc_id", F.array_join("capability_labels", ",").alias("labels"))


@query
def backfill_candidates(spark, sf_dir):
    rows = read(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("ingest_seq"), "embedding", "label")
    asked = _centroids(spark, sf_dir).select(F.col("label").alias("sub_problem_id"), F.array("vector").alias("query_vectors"))
    scores = recall.vector_scores(rows, asked)
    hits = recall.ranked(scores, "cosine", "rank").join(rows.select("ingest_seq", F.array("label").alias("capability_labels")), "ingest_seq")
    found = taxonomy.backfill_candidates(hits, F.col("sub_problem_id").cast("int"))
    return found.select("sub_problem_id", F.col("ingest_seq").alias("vec_id"), *long("rank"))


@query
def queue_priority(spark, sf_dir):
    """Jobs in the order of their claims."""
    proposals = read(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("label"), F.col("o_custkey").alias("sub_problem_id"), F.col("o_orderkey").alias("seq"))
    jobs = taxonomy.priorities(proposals).withColumn("status", F.lit("pending"))
    claimed = taxonomy.claims(jobs, 1000).agg(F.collect_list(F.struct("label", "priority", "job_id")).alias("j"))  # a row per label of the taxonomy
    return claimed.select(F.posexplode("j").alias("i", "j")).select("j.label", "j.priority", "j.job_id", (F.col("i") + 1).cast("long").alias("claim_order"))


# ---- request health ------------------------------------------------------------------


def _outcomes(spark, sf_dir) -> DataFrame:
    kind = F.col("event_type")
    outcome = F.when(kind == "error", "timeout").when(kind == "purchase", "overload").when(kind == "click", "abnormal_response").otherwise("success")
    return read(spark, sf_dir, "events").select("event_id", "user_id", "ts", outcome.alias("outcome"), kind.alias("event_type"))


@query
def outcome_window_rates(spark, sf_dir):
    rates = health.window_rates(_outcomes(spark, sf_dir), "user_id", "ts", "event_id")
    return rates.select("event_id", "total", *[F.round(c, 6).alias(c) for c in ("timeout_rate", "overload_rate", "abnormal_rate", "infra_rate")])


@query
def failure_streaks(spark, sf_dir):
    rows = _outcomes(spark, sf_dir).withColumn("outcome", F.when(F.col("event_type") == "error", "auth_error").otherwise("success"))
    return health.streaks(rows, "user_id", "ts", "event_id")


@query
def http_stats(spark, sf_dir):
    return health.status_stats(_outcomes(spark, sf_dir))


@query
def outcome_classes(spark, sf_dir):
    status = (F.lit(200) + F.col("p_size") * 7).cast("int")
    rows = read(spark, sf_dir, "part")
    return rows.select("p_partkey", health.outcome_class(status, F.concat(F.col("p_type"), F.lit(" Moderation")), F.col("p_retailprice") > 1000).alias("outcome"))


@query
def truncate_text(spark, sf_dir):
    cut = health.truncate_text(F.coalesce("text", F.lit("")), F.lit(400))
    return read(spark, sf_dir, "documents").select("doc_id", F.length(cut).cast("long").alias("n"), F.md5(cut).alias("cut_md5"))


@query
def truncate_conversations(spark, sf_dir):
    cut = health.truncate_conversations(read(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text", 200)
    return cut.select("conv_id", "turn", F.length("text").cast("long").alias("n"), F.md5("text").alias("text_md5"))


# ---- evaluation and views --------------------------------------------------------------


@query
def drift_mode(spark, sf_dir):
    """Runs of equal length as runs of one case, their roles as signature."""
    runs = read(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role"))).alias("m"))
    runs = runs.select(F.size("m").cast("long").alias("case_id"), F.array_join(F.transform("m", lambda x: x["role"]), ">").alias("signature"))
    return evaluation.drift(runs).select(F.col("case_id").alias("n_steps"), F.round("stability", 3).alias("mode_share"))


def _routes(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Expected and produced routes of documents by source: labels against a rule on lengths."""
    rows = read(spark, sf_dir, "labels").join(read(spark, sf_dir, "documents").select("doc_id", "n_chars", "source"), "doc_id")
    route = lambda c: F.when(c, "pass").otherwise("drop").alias("route")
    return rows.select(F.col("source").alias("case_id"), route(F.col("quality") == 1)), rows.select(F.col("source").alias("case_id"), route(F.col("n_chars") >= 300))


@query
def route_scores(spark, sf_dir):
    return evaluation.route_score(*_routes(spark, sf_dir)).select("case_id", *long("agreed", "expected"))


@query
def label_accuracy(spark, sf_dir):
    return evaluation.totals(evaluation.route_score(*_routes(spark, sf_dir))).select(*long("agreed", "expected"), "accuracy")


@query
def label_hits(spark, sf_dir):
    """Documents' language and source as expected labels; other documents of the same length as produced rows."""
    docs = read(spark, sf_dir, "documents")
    expected = docs.where("doc_id % 3 = 0").select(F.col("n_chars").alias("case_id"), F.when(F.col("doc_id") % 4 == 0, F.array(F.lit(evaluation.ANY_NEW))).otherwise(F.array("lang", "source")).alias("labels"), "doc_id")
    actual = docs.where("doc_id % 3 = 1").select(F.col("n_chars").alias("case_id"), F.array("source").alias("labels"), (F.col("doc_id") % 5 == 0).alias("is_new"))
    return evaluation.label_hits(expected, actual).select("doc_id")


@query
def retained_runs(spark, sf_dir):
    """Orders as runs: open ones run, the others finished on their date."""
    runs = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("run_id"), F.when(F.col("o_orderstatus") != "O", F.col("o_orderdate")).alias("finished_at"))
    return evaluation.retained_runs(runs).select("run_id")


@query
def label_colors(spark, sf_dir):
    labels = read(spark, sf_dir, "documents").select(F.col("source").alias("label")).where("label is not null").distinct()
    return view.color_index(labels).select("label", *long("color"))


@query
def inspector_view(spark, sf_dir):
    scored = _scored(spark, sf_dir)
    chosen = selection.select_by_total(merging.merge_by_slice(merging.trainable(scored)), 10)
    problems = complaints(spark, sf_dir).select("sub_problem_id")
    rows = view.inspector(problems, scored, chosen)
    return rows.select("sub_problem_id", "trajectory_id", F.round("relevance", 6).alias("relevance"), "confidence", "selected")


@query
def span_step_join(spark, sf_dir):
    steps = read(spark, sf_dir, "conversations").select("conv_id", F.col("turn").alias("step_index"), "role")
    spans = steps.where("role = 'assistant'").groupBy("conv_id").agg(F.min("step_index").alias("start_step"), F.max("step_index").alias("end_step"))
    return view.steps_in_spans(steps, spans, "conv_id").select("conv_id", "step_index", "role", "start_step", "end_step")


@query
def trajectory_index(spark, sf_dir):
    rows = read(spark, sf_dir, "conversations").select(F.col("conv_id").alias("trajectory_id"), F.col("turn").alias("ingest_seq"), F.md5("text").alias("steps"))
    return view.trajectory_index(rows)


@query
def capability_hits(spark, sf_dir):
    each = merging.trainable(_scored(spark, sf_dir)).select("trajectory_id", "slice_index", F.explode("capability").alias("label"), "spans")
    rows = view.capability_hits(each)
    return rows.select("trajectory_id", F.array_join("labels", ",").alias("labels"), F.size("spans").cast("long").alias("n_spans"))
