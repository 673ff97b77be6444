"""Stored inverted index for BM25: postings of every write, in blocks with their highest term frequency.

A block holds a token's postings of ``SPAN`` neighbouring ids, so blocks of different
tokens cover the same rows and the most that a row of a block can score is the sum over
the tokens that have the block.  A search scores the most promising blocks of each
sub-problem, takes the score that its last hit reaches, and then only scores blocks that
can still reach it.  The result is that of scoring all rows.

Postings lie in folders by the tokens' hash, sorted by token and block.  A write counts
once its document count is there, which is written last; rows that a later write replaces
are taken out by :meth:`KeywordIndex.remove`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tracequarry.lineage import discard, materialize
from tracequarry.operators import recall
from tracequarry.operators.scoring import K1, SCORE_UNIT, Scorer, pieces
from tracequarry.sources.stores import KeyedTable

#: Ids of a block, folders of tokens, and blocks of a sub-problem that are scored first.
SPAN, BUCKETS, FIRST = 1024, 16, 8
#: Rows of a batch, rows whose postings one task sorts, and blocks that one task scores: what a task holds doesn't grow with the corpus.
BATCH, ROWS, BLOCKS = 8192, 8192, 16


def _fragments(span: int):
    """What gives token, block and postings of so many rows as a piece has."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (p for b in batches for p in pieces(b, BATCH)):
            row, tokens = batch.column("tokens").value_parent_indices().to_numpy(), batch.column("tokens").flatten()
            fine = tokens.is_valid().to_numpy(zero_copy_only=False)
            coded = tokens.filter(pa.array(fine)).dictionary_encode()
            idents, place = np.unique(batch.column("ident").to_numpy(), return_inverse=True)
            met, tf = np.unique(coded.indices.to_numpy().astype(np.int64) * max(1, len(idents)) + place[row[fine]], return_counts=True)
            code, at = np.divmod(met, max(1, len(idents)))
            block = idents[at] // span
            begin = np.flatnonzero(np.diff(code, prepend=-1).astype(bool) | np.diff(block, prepend=0).astype(bool))
            postings = pa.StructArray.from_arrays([pa.array(idents[at]), pa.array(tf.astype(np.int32))], ["ident", "tf"])
            lists = pa.ListArray.from_arrays(pa.array(np.append(begin, len(met)).astype(np.int32)), postings)
            yield pa.RecordBatch.from_arrays([coded.dictionary.take(pa.array(code[begin])), pa.array(block[begin]), lists], ["token", "block", "postings"])

    return work


class KeywordIndex:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        #: Postings of the stated words, and those that the last search scored.
        self.asked = self.scored = 0

    def _write(self, rows: DataFrame, ident: str, tokens: str, sign: int) -> None:
        number = KeyedTable(self.spark, self.path, [], "")._next_write()
        n = rows.count()
        # null ids have no postings; a task counts the words of a batch, so only lists of postings are dealt
        each = rows.select(F.col(ident).cast("long").alias("ident"), F.transform(tokens, F.lower).alias("tokens")).where("ident is not null and tokens is not null")
        each = each.mapInArrow(_fragments(SPAN), "token string, block long, postings array<struct<ident:long,tf:int>>")
        dealt = each.repartition(max(-(-n // ROWS), self.spark.sparkContext.defaultParallelism), "token", "block").groupBy("token", "block")
        kept = dealt.agg(F.sort_array(F.flatten(F.collect_list("postings"))).alias("postings"))
        once = F.array_distinct(F.transform("postings", lambda p: p["ident"]))
        times = lambda i: F.aggregate(F.filter("postings", lambda p: p["ident"] == i), F.lit(0), lambda s, p: s + p["tf"])
        summed = F.transform(once, lambda i: F.struct(i.alias("ident"), times(i).alias("tf")))
        kept = kept.withColumn("postings", F.when(F.size(once) < F.size("postings"), summed).otherwise(F.col("postings")))
        kept = kept.withColumns({"n": F.size("postings").cast("long"), "max_tf": F.array_max(F.transform("postings", lambda p: p["tf"]))})
        kept = kept.withColumns({"bucket": F.pmod(F.xxhash64("token"), F.lit(BUCKETS)).cast("int"), "sign": F.lit(sign)})
        kept.sortWithinPartitions("bucket", "token", "block").write.partitionBy("bucket").parquet(f"{self.path}/postings/write={number}")
        rows.agg(F.count("*").alias("n")).select((F.col("n") * sign).alias("n")).write.parquet(f"{self.path}/documents/write={number}")

    def append(self, rows: DataFrame, ident: str = "ingest_seq", tokens: str = "bm25_tokens") -> None:
        """Add rows whose ids are new. Null ids and rows without tokens count as documents but have no postings."""
        self._write(rows, ident, tokens, 1)

    def remove(self, rows: DataFrame, ident: str = "ingest_seq", tokens: str = "bm25_tokens") -> None:
        """Take out rows that were appended, as they were; once each."""
        self._write(rows, ident, tokens, -1)

    def exists(self) -> bool:
        return KeyedTable(self.spark, f"{self.path}/documents", [], "").exists()

    def documents(self) -> dict[int, int]:
        """Rows added (or, below zero, taken out) by each finished write."""
        if not self.exists():
            return {}
        rows = self.spark.read.schema("n long, write int").parquet(f"{self.path}/documents")
        return {r["write"]: r["n"] for r in rows.groupBy("write").agg(F.sum("n").alias("n")).collect()}

    def postings(self, words: list[str]) -> DataFrame:
        """Blocks of these words in finished writes."""
        writes = sorted(self.documents())
        schema = "token string, block long, postings array<struct<ident:long,tf:int>>, n long, max_tf int, sign int, write int, bucket int"
        rows = self.spark.read.schema(schema).parquet(f"{self.path}/postings")
        asked = self.spark.createDataFrame([(w,) for w in words], "token string")
        buckets = [r[0] for r in asked.select(F.pmod(F.xxhash64("token"), F.lit(BUCKETS)).cast("int")).distinct().collect()]
        rows = rows.where(F.col("bucket").isin(buckets) & F.col("write").isin(writes) & F.col("token").between(min(words), max(words)))
        return rows.join(F.broadcast(asked), "token")  # the stated words

    def search(self, queries: DataFrame, top_n: int = 20) -> DataFrame:
        """sub_problem_id, ident, bm25 and rank of the best rows by keywords; ties by id."""
        names, words, _ = recall.stated(queries.withColumn("query_vectors", F.expr("cast(null as array<array<double>>)")))
        kind = dict(queries.dtypes)["sub_problem_id"]
        known = sorted(set().union(*words)) if words else []
        if not known or not self.exists():
            return self.spark.createDataFrame([], f"sub_problem_id {kind}, ident long, bm25 double, rank int")
        rows = self.postings(known)
        n = F.lit(sum(self.documents().values()))
        df = rows.groupBy("token").agg(F.sum(F.col("n") * F.col("sign")).alias("df")).where("df > 0")
        df = df.select("token", recall.idf(n, F.col("df")).alias("idf")).collect()  # a row for each stated word
        idf = {r.token: r.idf for r in df}
        stated = [(i, w, times, idf[w]) for i, each in enumerate(words) for w, times in each.items() if w in idf]
        terms = F.broadcast(self.spark.createDataFrame(stated, "i int, token string, times int, idf double"))
        part = lambda tf: F.col("times") * F.col("idf") * (tf * (K1 + 1)) / (tf + K1)
        meta = rows.where("sign = 1").select("token", "block", "n", "max_tf").join(terms, "token")
        caps = materialize(meta.groupBy("i", "block").agg(F.sum(part(F.col("max_tf"))).alias("cap"), F.sum("n").alias("n")), "caps")
        asked: dict[str, tuple[list, list]] = {}
        for i, w, times, weight in stated:
            asked.setdefault(w, ([], []))[0].append(i)
            asked[w][1].append(times * weight)
        asked = {w: (np.array(i), np.array(x)) for w, (i, x) in asked.items()}

        def scores(wanted: DataFrame, least: dict[int, float]) -> DataFrame:
            """i, ident and bm25 of each wanted block's (i, block) best rows; none below a sub-problem's least score."""
            whole = wanted.groupBy("block").agg(F.collect_list("i").alias("who"))
            sent = self.spark.sparkContext.broadcast((asked, least))  # the stated words and sub-problems
            near = F.transform("postings", lambda p: (p["ident"] - F.col("block") * SPAN).cast("int"))
            each = rows.join(F.broadcast(whole.select("block")), "block").select("block", "token", "sign", near.alias("at"), F.transform("postings", lambda p: p["tf"]).alias("tf"))
            told = whole.select("block", F.lit(None).cast("string"), F.lit(0), "who", F.lit(None).cast("array<int>"))
            many = max(-(-whole.count() // BLOCKS), self.spark.sparkContext.defaultParallelism)
            return each.union(told).repartition(many, "block").groupBy("block").applyInArrow(work_of(sent), "i int, ident long, bm25 double")

        def work_of(sent):
            def work(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                asked, least = sent.value
                total, gone, who = np.zeros((SPAN, len(names))), np.zeros(SPAN, bool), np.zeros(0, int)
                for batch in batches:
                    at, tf = batch.column("at"), batch.column("tf")
                    for k, (token, sign) in enumerate(zip(batch.column("token").to_pylist(), batch.column("sign").to_pylist())):
                        some = at[k].values.to_numpy()
                        if sign == 0:
                            who = some
                        elif sign < 0:
                            gone[some] = True
                        elif token in asked:
                            i, weight = asked[token]
                            # whole numbers add up to the same sum in any order, so rows with the same terms tie
                            total[some[:, None], i] += Scorer._part(1, weight, tf[k].values.to_numpy()[:, None])
                total[gone] = 0
                out = [(np.zeros(0, int), np.zeros(0, int), np.zeros(0))]
                for i in who.tolist():
                    score = total[:, i] / SCORE_UNIT
                    good = np.flatnonzero((score > 0) & (score >= least.get(i, 0.0)))
                    good = good[np.lexsort((good, -score[good]))][:top_n]
                    out.append((np.full(len(good), i), good + key[0].as_py() * SPAN, score[good]))
                i, ident, score = (np.concatenate(c) for c in zip(*out))
                yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(ident), pa.array(score)], ["i", "ident", "bm25"])

            return work

        best = lambda: F.row_number().over(Window.partitionBy("i").orderBy(F.desc("bm25"), "ident"))
        first = caps.withColumn("k", F.row_number().over(Window.partitionBy("i").orderBy(F.desc("cap"), "block"))).where(F.col("k") <= FIRST)
        first = materialize(first, "first")
        found = materialize(scores(first, {}).withColumn("rank", best()).where(F.col("rank") <= top_n), "found")
        least = found.where(F.col("rank") == top_n).select("i", (F.col("bm25") - 1e-9).alias("least"))  # at most a row for each sub-problem
        floor = dict(map(tuple, least.collect()))
        later = caps.join(first.select("i", "block"), ["i", "block"], "left_anti").join(F.broadcast(least), "i", "left")
        later = materialize(later.where(F.col("cap") >= F.coalesce("least", F.lit(0.0))), "later")
        self.asked = caps.agg(F.sum("n")).first()[0] or 0
        self.scored = first.select("n").unionAll(later.select("n")).agg(F.sum("n")).first()[0] or 0
        both = found.select("i", "ident", "bm25").unionByName(scores(later, floor))
        order = self.spark.createDataFrame(list(zip(range(len(names)), names)), f"i int, sub_problem_id {kind}")
        out = both.withColumn("rank", best()).where(F.col("rank") <= top_n).join(F.broadcast(order), "i")  # the stated sub-problems
        out = materialize(out.select("sub_problem_id", "ident", "bm25", "rank"), "hits")
        for done in (caps, first, found, later):
            discard(done)
        return out
