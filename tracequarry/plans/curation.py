"""The engine's entry points: ingest logs, search them, evolve labels."""

from __future__ import annotations

import hashlib
import json
import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracequarry.functions import text as tx
from tracequarry.lineage import materialize
from tracequarry.operators import dedup, judging, merging, ranking, recall, selection, taxonomy
from tracequarry.operators.signatures import Embedder, signatures, with_embeddings, with_query_vectors
from tracequarry.operators.slicing import slices
from tracequarry.sources import stores, trajectories


def sign(found: DataFrame, embedder: Embedder | None = None) -> DataFrame:
    """Trajectories to signed slices, with vectors if there is an embedder."""
    cut = slices(trajectories.steps(found.select("trajectory_id", "messages")))
    signed = signatures(cut)
    return with_embeddings(signed, embedder) if embedder else signed.withColumn("embedding", F.expr("cast(null as array<float>)"))


def ingest(spark: SparkSession, path: str, root: str, embedder: Embedder | None = None) -> int:
    """Add a file's or folder's slices to the tables below ``root``; how many trajectories it has."""
    tables = stores.open_stores(spark, root)
    found = trajectories.scan_jsonl(spark, path)
    found = found.groupBy("trajectory_id").agg(*[F.max_by(c, F.struct("file", "line")).alias(c) for c in ("messages", "raw", "file", "line")])
    found = materialize(found, "trajectories")
    tables["slices"].append(sign(found, embedder))
    tables["trajectories"].append(found.select("trajectory_id", "raw", F.col("file").alias("trajectory_path")))
    return found.count()


def search(
    spark: SparkSession, root: str, problems: DataFrame, judge: judging.Judge = judging.always_match, config: selection.SelectionConfig | None = None, top_n: int = 20,
    embedder: Embedder | None = None,
) -> dict[str, DataFrame]:
    """Recall, judge what isn't cached, rerank, merge, dedup and select for all sub-problems.

    ``problems``: sub_problem_id, keywords, filters, failure_summary, capability, ord and query_vectors; with an embedder
    these are made of ``hyde_positive``."""
    tables = stores.open_stores(spark, root)
    if embedder is not None:
        problems = materialize(with_query_vectors(problems, embedder), "problems")
    corpus = tables["slices"].read()
    condition = lambda q: recall.passes(F.col("languages"), F.col("tools_used"), F.col("has_verification_step"), q["filters"])
    hits = recall.recall(corpus, problems.select("sub_problem_id", "keywords", "query_vectors", "filters"), condition, top_n=top_n)
    detail = corpus.select("ingest_seq", "trajectory_id", "slice_index", "steps", "embedding", "bm25_tokens")
    hits = hits.join(detail, "ingest_seq").join(problems.select("sub_problem_id", "failure_summary", "capability", F.col("ord").alias("sub_ord")), "sub_problem_id")
    hits = materialize(hits, "hits")
    verdicts = tables["verdicts"].read().drop("ingest_seq")
    _, misses = judging.with_cache(hits, verdicts)
    asked = misses.withColumn("summary", tx.summary(F.col("steps")))
    new = materialize(judging.judge(asked, judge), "verdicts")
    tables["verdicts"].append(new)
    known = judging.remember(verdicts.select(new.columns), new)
    scored = hits.join(known, judging.KEY).withColumns({"judge_match": F.col("match"), "relevance": ranking.relevance(F.col("rrf"), F.col("match"))})
    depth = int(top_n) + 1  # ranks of a sub-problem stay below it
    scored = materialize(scored.withColumn("seq", F.col("sub_ord") * depth + F.col("rank")), "scored")
    merged = merging.merge_by_slice(merging.trainable(scored), extra=("embedding", "bm25_tokens"))
    survivors = near_duplicates(merged)
    unique = materialize(merging.absorb(merged, survivors), "unique")
    names = [r.sub_problem_id for r in problems.orderBy("ord").select("sub_problem_id").collect()]  # the stated queries
    config = config or selection.SelectionConfig(n=selection.default_budget(unique), min_per_problem=1)
    picks = selection.select_set(unique.withColumn("run_id", F.lit("run")), config, names).drop("run_id")
    chosen = unique.join(picks, "seq")
    scored = ranking.global_order(scored, ["sub_ord", "rank"])
    return {"scored": scored, "merged": merged, "selected": chosen, "manifest": merging.manifest(chosen, 0.3)}


def near_duplicates(merged: DataFrame) -> DataFrame:
    """seq and survivor; earlier means more relevant, then earlier arrived.

    Places come from a sort by ranges; equal token sets and equal vectors stand for all their items, so copies
    cost a row each."""
    items = merged.select("seq", "relevance", "embedding", "bm25_tokens").orderBy(F.desc("relevance"), "seq")
    items = materialize(items.withColumn("at", F.monotonically_increasing_id()), "items")
    found = dedup.survivors_of_sets(items, [dedup.token_pairs(items, ident="at"), dedup.vector_pairs(items, ident="at")], "at")
    back = items.select("at", "seq")
    return found.join(back, "at").join(back.select(F.col("at").alias("survivor"), F.col("seq").alias("s")), "survivor").select("seq", F.col("s").alias("survivor"))


def backfill(spark: SparkSession, root: str, label: dict, judge: judging.Judge = judging.always_match, top: int = taxonomy.BACKFILL_TOP) -> int:
    """Give a label to the recalled slices that the judge accepts; how many got it. Twice is harmless."""
    tables = stores.open_stores(spark, root)
    corpus = tables["slices"].read()
    schema = "sub_problem_id string, keywords array<string>, query_vectors array<array<double>>, failure_summary string"
    asked = spark.createDataFrame([(label["label"], label.get("keywords") or [], [label["vector"]] if label.get("vector") else None, label.get("description", ""))], schema)
    hits = recall.recall(corpus, asked.drop("failure_summary"), lambda q: F.lit(True), top_n=top)
    rows = hits.join(corpus, "ingest_seq").withColumn("failure_summary", F.lit(label.get("description", "")))
    rows = taxonomy.backfill_candidates(rows, F.lit(label["label"]), top).withColumn("summary", tx.summary(F.col("steps")))
    accepted = materialize(judging.judge(rows, judge).where("match").select("trajectory_id", "slice_index"), "accepted")
    found = accepted.withColumn("labels", F.array(F.lit(label["label"])))
    changed = taxonomy.update_labels(corpus.join(accepted, ["trajectory_id", "slice_index"], "left_semi"), found, ["trajectory_id", "slice_index"])
    n = accepted.count()
    if n:
        tables["slices"].append(materialize(changed, "labelled"), "ingest_seq")
    return n


def evolve(spark: SparkSession, root: str, proposals: list[dict], labels: list[dict], created_at: str, run: Callable[[dict], int] | None = None) -> dict:
    """Add proposals to the taxonomy and backfill the new labels by priority; labels, version and jobs are stored."""
    tables = stores.open_stores(spark, root)
    after, resolved = taxonomy.ingest_proposals(proposals, labels, created_at)
    asked: dict[str, set] = {}
    for p in proposals:
        asked.setdefault(p["label"], set()).add(p.get("source_sub_problem_id"))
    queue, known = taxonomy.JobQueue(tables["jobs"]), {x["label"]: x for x in after}
    _store_labels(spark, tables, labels, after, created_at)
    for r in resolved:
        if r["kind"] != "duplicate" and all(j["label"] != r["label"] for j in queue.jobs):
            queue.enqueue(r["label"], len(asked[r["label"]]))
    work = run or (lambda label: backfill(spark, root, label))
    return {"labels": after, "resolved": resolved, "jobs": queue.drain(lambda name: work(known[name]), set(known)), "queue": queue.jobs}


def _store_labels(spark: SparkSession, tables: dict, before: list[dict], after: list[dict], created_at: str) -> None:
    """The first taxonomy if none is stored, then what is new."""

    def rows(labels: list[dict]) -> DataFrame:
        fields = ("label", "parent", "new_root", "description", "keywords", "description_embedding", "taxonomy_extension", "created_at")
        full = [{**x, "description_embedding": x.get("vector"), "keywords": x.get("keywords") or []} for x in labels]
        return spark.createDataFrame([tuple(x.get(f) for f in fields) for x in full], tables["labels"].schema)

    store = taxonomy.TaxonomyStore(tables["labels"], tables["taxonomy"])
    if before:
        store.seed(rows(before), "1.0.0", created_at)
    if new := after[len(before) :]:
        store.add(rows(new), created_at)


def ingest_manifest(spark: SparkSession, root: str, questions: list[tuple[str, str | None]], compiler, embedder: Embedder, least: float = 0.90, evidence=None) -> dict[str, int]:
    """Compile and store new questions, one after another: each may be a near copy of the one before.

    A manifest is a list of complaints, so the loop is the driver's. ``evidence`` turns a failure path into
    text for the compiler; a question that fails costs itself only."""
    table = stores.open_stores(spark, root)["problems"]
    known = [(r.problem_id, list(r.vector)) for r in table.read().select("problem_id", "vector").collect()]
    counts, rows = {"added": 0, "skipped_dup": 0, "failed": 0}, []
    for question, path in questions:
        try:
            vector = [float(x) for x in embedder([question])[0]]
            if max((_cosine(vector, v) for _, v in known), default=-1.0) >= least:
                counts["skipped_dup"] += 1
                continue
            spec = compiler.compile(question, evidence=evidence(path) if evidence and path else None)
        except Exception:  # isolated: the next question goes on
            counts["failed"] += 1
            continue
        ident = hashlib.sha1(tx.normalized_question(question).encode()).hexdigest()[:16]
        rows.append((ident, question, json.dumps(spec, ensure_ascii=False), vector))
        known.append((ident, vector))
        counts["added"] += 1
    if rows:
        table.append(spark.createDataFrame(rows, table.schema))
    return counts


def _cosine(a: list[float], b: list[float]) -> float:
    size = math.sqrt(sum(x * x for x in a)) * math.sqrt(sum(x * x for x in b))
    return sum(x * y for x, y in zip(a, b)) / size if size else 0.0


def nearest_problem(spark: SparkSession, root: str, embedder: Embedder):
    """A lookup for ``compiling.QuestionCache``: id, similarity and spec of the nearest stored question."""
    rows = stores.open_stores(spark, root)["problems"].read().orderBy("ingest_seq").collect()

    def find(question: str):
        vector = [float(x) for x in embedder([question])[0]]
        best = max(rows, key=lambda r: _cosine(vector, r.vector), default=None)
        return None if best is None else (best.problem_id, _cosine(vector, best.vector), json.loads(best.spec))

    return find
