"""Hybrid recall: structured filters, BM25, vectors, reciprocal rank fusion.

All sub-problems are answered together.  Each row gets the sub-problems whose filters it
passes, tasks score their rows for these and keep bounded heaps (``scoring``), and ranks
beyond a heap are counted, so nothing that is shuffled grows with the corpus.
``vector_scores`` and ``ranked`` give all scores and all ranks where those are wanted.
Every order is total: score, then arrival.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracequarry.lineage import discard, materialize
from tracequarry.operators import scoring

#: Constant of rank fusion.
RRF_K = 60
#: Ranges of scores, and of arrivals under one score, in which rows are ranked.
RANK_RANGES = 256


def overlap(values: Column, wanted: Column) -> Column:
    """No wish, or a common value. An empty wish list matches nothing."""
    clean = F.filter(values, lambda x: x.isNotNull())
    return wanted.isNull() | F.coalesce(F.arrays_overlap(clean, F.filter(wanted, lambda x: x.isNotNull())), F.lit(False))


def passes(languages: Column, tools: Column, verified: Column, filters: Column) -> Column:
    """All structured filters of a sub-problem; an unset one passes everything."""
    checked = filters["has_verification_step"]
    return overlap(languages, filters["languages"]) & overlap(tools, filters["tools_used"]) & (checked.isNull() | (checked == verified))


def document_frequency(corpus: DataFrame, tokens: str = "bm25_tokens") -> DataFrame:
    """token (lower case) and the number of rows that have it."""
    each = corpus.select(F.explode(F.array_distinct(F.transform(tokens, F.lower))).alias("token"))
    return each.groupBy("token").agg(F.count("*").alias("df"))


def idf(n: Column, df: Column) -> Column:
    return F.log((n - df + 0.5) / (df + 0.5) + 1.0)


def vector_scores(corpus: DataFrame, queries: DataFrame, ident: str = "ingest_seq", vector: str = "embedding") -> DataFrame:
    """sub_problem_id, ident, cosine > 0: the best over a sub-problem's query vectors of the row's length.

    The query vectors are the stated query set; they go to the tasks as one matrix."""
    asked = [(r.sub_problem_id, [list(v) for v in r.query_vectors or []]) for r in queries.select("sub_problem_id", "query_vectors").collect()]
    flat = [(i, np.asarray(v, np.float64)) for i, (_, vs) in enumerate(asked) for v in vs if len(v) and np.linalg.norm(v) > 0]
    sent = corpus.sparkSession.sparkContext.broadcast((sorted({len(v) for _, v in flat}), flat, [s for s, _ in asked]))
    kind = dict(corpus.dtypes)[ident]

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        dims, vectors, names = sent.value
        for frame in frames:
            length = frame[vector].map(lambda v: 0 if v is None else len(v))
            for dim in dims:
                rows = frame[length == dim]
                if rows.empty:
                    continue
                x = np.stack(rows[vector].to_numpy()).astype(np.float64)
                size = np.linalg.norm(x, axis=1)
                x = np.divide(x, size[:, None], out=np.zeros_like(x), where=size[:, None] > 0)
                best = np.zeros((len(rows), len(names)))
                for i, v in vectors:
                    if len(v) == dim:
                        # row by row the same sum, wherever a row stands: equal vectors tie
                        best[:, i] = np.maximum(best[:, i], np.einsum("ij,j->i", x, v / np.linalg.norm(v), optimize=False))
                r, c = np.nonzero(best > 0)
                yield pd.DataFrame({"sub_problem_id": np.array(names, dtype=object)[c], ident: rows[ident].to_numpy()[r], "cosine": best[r, c]})

    return corpus.select(ident, vector).mapInPandas(work, f"sub_problem_id {dict(queries.dtypes)['sub_problem_id']}, {ident} {kind}, cosine double")


def ranked(scores: DataFrame, score: str, name: str, ident: str = "ingest_seq") -> DataFrame:
    """``scores`` plus ``name``, the rank in the sub-problem from 1: highest score first, then arrival.

    Rows are dealt to ranges of scores and, in a range, to ranges of arrival; a row's rank is the number of rows in the
    ranges before its own and its place in its own."""
    ends = scores.agg(F.max(score).alias("s1"), F.min(ident).alias("i0"), F.max(ident).alias("i1"))
    part = lambda x, low, high: F.floor((x - low) / F.greatest(high - low, F.lit(1e-300)) * RANK_RANGES)
    told = scores.crossJoin(F.broadcast(ends))  # one row
    cells = ["sub_problem_id", "__s", "__i"]
    told = told.withColumns({"__s": -part(F.col(score), F.lit(0.0), F.col("s1")), "__i": part(F.col(ident).cast("double"), F.col("i0").cast("double"), F.col("i1").cast("double"))})
    told = told.drop("s1", "i0", "i1")
    # ranges of arrival part only rows of one score: others are parted by their score alone
    one = told.groupBy("sub_problem_id", "__s").agg((F.min(score) == F.max(score)).alias("same"))
    told = told.join(one, ["sub_problem_id", "__s"]).withColumn("__i", F.when(F.col("same"), F.col("__i")).otherwise(0)).drop("same")
    counts = told.groupBy(*cells).agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("sub_problem_id").orderBy("__s", "__i").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(*cells, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first"))
    within = F.row_number().over(Window.partitionBy(*cells).orderBy(F.desc(score), ident))
    return told.withColumn("__r", within).join(counts, cells).select(*scores.columns, (F.col("first") + F.col("__r")).cast("long").alias(name))


def stated(queries: DataFrame) -> tuple[list, list[dict], list[list]]:
    """Names, words with their counts and vectors of the stated sub-problems."""
    words = F.transform(F.coalesce("keywords", F.expr("cast(array() as array<string>)")), F.lower)
    rows = queries.select("sub_problem_id", words.alias("words"), "query_vectors").collect()
    counts = [{w: r.words.count(w) for w in r.words if w is not None} for r in rows]
    return [r.sub_problem_id for r in rows], counts, [[v for v in r.query_vectors or [] if v is not None] for r in rows]


def weights(corpus: DataFrame, words: set[str], tokens: str = "bm25_tokens") -> dict[str, float]:
    """idf of the stated words that the corpus has."""
    each = sorted(words)
    df = scoring.frequency(corpus.select(F.transform(tokens, F.lower).alias("tokens")), each)
    n = corpus.agg(F.count("*").alias("n"))
    return {each[r.place]: r.idf for r in df.join(F.broadcast(n)).select("place", idf(F.col("n"), F.col("df")).alias("idf")).collect()}  # one row; a row for each stated word


def recall(corpus: DataFrame, queries: DataFrame, condition: Callable[[Column], Column], ident: str = "ingest_seq", top_n: int = 20) -> DataFrame:
    """sub_problem_id, ident, rrf, rank and channel ranks of the best rows.

    ``condition`` gives the structured filter between a row and a sub-problem (a struct of its columns but for keywords and
    vectors); frequencies ignore it. No rows or no candidates give no hits, a sub-problem without keywords or vectors skips
    that channel.  Ties: keyword rank, then vector rank, then arrival.  Rows that neither channel scores follow by arrival:
    with 1 where no row is scored, else with 0.

    A row beyond rank 2 (60 + top_n) - 60 in both channels scores less than the first ``top_n`` of either one, so heaps of
    that depth hold all hits; what they lack is the other channel's rank of a few rows, which is counted."""
    spark = corpus.sparkSession
    names, words, vectors = stated(queries)
    out = f"sub_problem_id {dict(queries.dtypes)['sub_problem_id']}, {ident} long, bm25_rank long, vector_rank long, rrf double, rank int"
    if not names:
        return spark.createDataFrame([], out)
    order = spark.createDataFrame(list(zip(names, range(len(names)))), f"sub_problem_id {dict(queries.dtypes)['sub_problem_id']}, __i int")
    wished = queries.drop("keywords", "query_vectors").join(F.broadcast(order), "sub_problem_id")
    packed = wished.agg(F.collect_list(F.struct(*wished.columns)).alias("__asked"))
    who = F.transform(F.filter("__asked", condition), lambda q: q["__i"])
    rows = corpus.join(F.broadcast(packed)).select(  # one row: the stated sub-problems
        F.col(ident).cast("long").alias("ident"), F.transform("bm25_tokens", F.lower).alias("tokens"), F.col("embedding").cast("array<double>").alias("vector"), who.alias("who")
    )
    whole = materialize(rows, "candidates")  # tokens and filters are worked out once
    rows = whole.where(F.size("who") > 0)
    known = set().union(*words)
    scorer = scoring.Scorer(words, weights(whole, known, "tokens") if known else {}, vectors)
    depth = 2 * (RRF_K + top_n) - RRF_K
    best = materialize(scoring.met(scoring.heaps(rows, scorer, depth, top_n), depth), "heaps")
    channel = lambda k: F.max(F.when(F.col("kind") == k, F.col("rank")))
    near = best.where(F.col("kind") != scoring.REST).groupBy("i", "ident").agg(channel(scoring.KEYWORDS).alias("r1"), channel(scoring.VECTORS).alias("r2"), F.max("bm25").alias("bm25"), F.max("cosine").alias("cosine"))
    near = near_ = materialize(near, "near")
    lack = near.where("(r1 is null and bm25 > 0) or (r2 is null and cosine > 0)").collect()  # sub-problems x depth
    asked = [(r.i, k, r.ident, s) for r in lack for k, rank, s in ((scoring.KEYWORDS, r.r1, r.bm25), (scoring.VECTORS, r.r2, r.cosine)) if rank is None and s > 0]
    if asked:
        late = scoring.counted(rows, scorer, asked).groupBy("i", "ident").agg(channel(scoring.KEYWORDS).alias("l1"), channel(scoring.VECTORS).alias("l2"))
        near = near.join(late, ["i", "ident"], "left").withColumns({"r1": F.coalesce("r1", "l1"), "r2": F.coalesce("r2", "l2")})
    share = lambda r: F.coalesce(1.0 / (RRF_K + F.col(r)), F.lit(0.0))
    scored = near.select("i", "ident", "r1", "r2", (share("r1") + share("r2")).alias("rrf"))
    has = near.select("i").distinct().withColumn("has", F.lit(0.0))
    none = F.lit(None).cast("long")
    rest = best.where(F.col("kind") == scoring.REST).join(has, "i", "left").select("i", "ident", none.alias("r1"), none.alias("r2"), F.coalesce("has", F.lit(1.0)).alias("rrf"))
    first = Window.partitionBy("i").orderBy(F.desc("rrf"), F.asc_nulls_last("r1"), F.asc_nulls_last("r2"), "ident")
    hits = scored.unionByName(rest).withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= top_n)
    hits = materialize(hits.join(F.broadcast(order), hits["i"] == order["__i"]), "hits")
    for done in (whole, best, near_):
        discard(done)
    return hits.select("sub_problem_id", F.col("ident").alias(ident), F.col("r1").alias("bm25_rank"), F.col("r2").alias("vector_rank"), "rrf", "rank")
