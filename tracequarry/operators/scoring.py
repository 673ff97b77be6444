"""Scores of rows for a stated set of sub-problems, with bounded heaps instead of a table of rows x sub-problems.

A task scores its rows in Arrow blocks and keeps, of each sub-problem and channel, only
the best ones; heaps meet in two steps.  A rank beyond a heap comes from counting: every
task says how many of its rows are better than a stated candidate.  What is shuffled
depends on the tasks, the sub-problems and the depth, not on the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: BM25's constant (length doesn't count); contributions are added in units of 10^-12.
K1, SCORE_UNIT = 1.2, 1e12
#: Scores (rows x sub-problems) of a block, tokens of a block, and contributions of words that are added at once.
BLOCK, TOKENS, ADDED = 500_000, 500_000, 1_000_000
#: A word that this share of the sub-problems ask for is common: its contributions come from a product of matrices.
COMMON_SHARE = 1 / 32
#: Groups of tasks whose heaps meet first.
BRANCH = 64
KEYWORDS, VECTORS, REST = 0, 1, 2
HEAP = "i int, kind int, ident long, bm25 double, cosine double"


def met_words(tokens: pa.Array, vocabulary: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, place in the vocabulary and count of each word of the vocabulary that a row (a list of tokens) has."""
    row = pc.list_parent_indices(tokens).to_numpy().astype(np.int64)
    term = pc.fill_null(pc.index_in(tokens.flatten(), value_set=vocabulary), -1).to_numpy(zero_copy_only=False)
    met, tf = np.unique((row * len(vocabulary) + term)[term >= 0], return_counts=True)
    return *np.divmod(met, len(vocabulary)), tf


class Scorer:
    """What the tasks know of the sub-problems: words with their weights, unit vectors by length.

    ``words``: a dict of lower-case word to count for each sub-problem; ``weights``: idf of the words that the corpus
    has; ``vectors``: lists of query vectors."""

    def __init__(self, words: list[dict[str, int]], weights: dict[str, float], vectors: list[list]):
        self.n = len(words)
        self.vocabulary = pa.array(sorted(weights), pa.string())
        self.idf = np.array([weights[w] for w in sorted(weights)], np.float64)
        place = {w: k for k, w in enumerate(sorted(weights))}
        asked = sorted((place[w], i, times) for i, each in enumerate(words) for w, times in each.items() if w in place)
        self.asked = np.array(asked, np.int64).reshape(-1, 3)
        self.first = np.searchsorted(self.asked[:, 0], np.arange(len(place) + 1))
        # common words and what one occurrence adds to each sub-problem
        common = np.flatnonzero(np.diff(self.first) > max(4, self.n * COMMON_SHARE))
        self.common = np.full(len(place), -1)
        self.common[common] = np.arange(len(common))
        some = self.asked[np.isin(self.asked[:, 0], common)]
        self.once = np.zeros((len(common), self.n))
        self.once[self.common[some[:, 0]], some[:, 1]] = self._part(some[:, 2], self.idf[some[:, 0]], 1)
        flat = [(i, np.asarray(v, np.float64)) for i, vs in enumerate(vectors) for v in vs if len(v)]
        flat = [(i, v / np.linalg.norm(v)) for i, v in flat if np.isfinite(v).all() and np.linalg.norm(v) > 0]
        self.units = {d: [(i, v) for i, v in flat if len(v) == d] for d in {len(v) for _, v in flat}}

    @staticmethod
    def _part(times, idf, tf):
        """What a word adds to a score, in whole units."""
        return np.floor(times * idf * (tf * (K1 + 1)) / (tf + K1) * SCORE_UNIT + 0.5)

    def keywords(self, tokens: pa.Array) -> np.ndarray:
        """BM25 of rows (lists of lower-case tokens) by sub-problem; whole numbers add up alike in any order, so equal rows tie."""
        out = np.zeros((len(tokens), self.n))
        if not len(self.vocabulary) or not len(tokens):
            return out
        row, term, tf = met_words(tokens, self.vocabulary)
        often = (tf == 1) & (self.common[term] >= 0)
        if often.any():
            has = np.zeros((len(tokens), len(self.once)))
            has[row[often], self.common[term[often]]] = 1
            out += has @ self.once  # whole numbers below 2^53: exact in any order
            row, term, tf = row[~often], term[~often], tf[~often]
        total = np.cumsum(self.first[term + 1] - self.first[term])
        a = 0
        while a < len(row):  # so many words of rows as make at most ADDED contributions, one at least
            b = max(a + 1, int(np.searchsorted(total, (total[a - 1] if a else 0) + ADDED, side="right")))
            self._add(out, row[a:b], term[a:b], tf[a:b])
            a = b
        return out / SCORE_UNIT

    def _add(self, out: np.ndarray, row: np.ndarray, term: np.ndarray, tf: np.ndarray) -> None:
        many = self.first[term + 1] - self.first[term]
        at = np.repeat(self.first[term] - np.cumsum(many) + many, many) + np.arange(int(many.sum()))
        part = self._part(self.asked[at, 2], np.repeat(self.idf[term], many), np.repeat(tf, many))
        np.add.at(out, (np.repeat(row, many), self.asked[at, 1]), part)

    def vectors(self, rows: pa.Array) -> np.ndarray:
        """The best cosine of each row with a sub-problem's vectors of its length; 0 where there is none above."""
        out = np.zeros((len(rows), self.n))
        size = pc.fill_null(pc.list_value_length(rows), 0).to_numpy(zero_copy_only=False)
        for dim, units in self.units.items():
            some = np.flatnonzero(size == dim)
            if not len(some):
                continue
            x = rows.take(pa.array(some)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
            length = np.linalg.norm(x, axis=1)
            fine = np.isfinite(length) & (length > 0)
            x = np.divide(x, length[:, None], out=np.zeros_like(x), where=fine[:, None])
            for i, v in units:
                # row by row the same sum, wherever a row stands: equal vectors tie
                out[some, i] = np.maximum(out[some, i], np.einsum("ij,j->i", x, v, optimize=False))
        return out


def _lists(column: pa.Array) -> pa.Array:
    """A list column without nulls."""
    return pc.fill_null(column, pa.scalar([], column.type)) if column.null_count else column


def pieces(batch: pa.RecordBatch, rows: int) -> Iterator[pa.RecordBatch]:
    """Slices of at most ``rows`` rows and about ``TOKENS`` tokens, one row at least."""
    ends = np.cumsum(pc.fill_null(pc.list_value_length(batch.column("tokens")), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    a = 0
    while a < batch.num_rows:
        b = int(np.searchsorted(ends, (ends[a - 1] if a else 0) + TOKENS, side="right"))
        b = min(max(b, a + 1), a + rows)
        yield batch.slice(a, b - a)
        a = b


def blocks(batches: Iterator[pa.RecordBatch], scorer: Scorer) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """ident, who may have the row (rows x sub-problems), BM25 and cosines (0 where it may not)."""
    for whole in batches:
        for batch in pieces(whole, max(1, BLOCK // max(1, scorer.n, len(scorer.once)))):
            who = _lists(batch.column("who"))
            may = np.zeros((batch.num_rows, scorer.n), bool)
            may[pc.list_parent_indices(who).to_numpy(), who.flatten().to_numpy()] = True
            yield batch.column("ident").to_numpy(), may, scorer.keywords(_lists(batch.column("tokens"))) * may, scorer.vectors(batch.column("vector")) * may


def frequency(rows: DataFrame, words: list[str]) -> DataFrame:
    """place (of a word in ``words``) and df: rows whose ``tokens`` have it. Tasks count, only counts of stated words are shuffled."""
    sent = rows.sparkSession.sparkContext.broadcast(words)  # the stated words

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = pa.array(sent.value, pa.string())
        df = np.zeros(len(vocabulary), np.int64)
        for batch in batches:
            for piece in pieces(batch, BLOCK):
                df += np.bincount(met_words(_lists(piece.column("tokens")), vocabulary)[1], minlength=len(df))
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(df[some])], ["place", "df"])

    return rows.select("tokens").mapInArrow(work, "place int, df long").groupBy("place").agg(F.sum("df").alias("df"))


class Heap:
    """The best rows of each sub-problem: highest score first, then arrival."""

    def __init__(self, n: int, depth: int):
        self.depth = depth
        self.kept = [np.empty((0, 3))] * n  # score, BM25, cosine
        self.idents = [np.empty(0, np.int64)] * n
        #: Of each sub-problem, once its heap is full: the lowest score in it, and its last row.
        self.least, self.last = np.full(n, -np.inf), np.full(n, np.iinfo(np.int64).max)

    def add(self, i: int, score: np.ndarray, ident: np.ndarray, bm25: np.ndarray, cosine: np.ndarray) -> None:
        if len(self.idents[i]) == self.depth:
            better = score >= self.kept[i][-1, 0]
            score, ident, bm25, cosine = score[better], ident[better], bm25[better], cosine[better]
        if not len(score):
            return
        rows = np.concatenate([self.kept[i], np.stack([score, bm25, cosine], 1)])
        idents = np.concatenate([self.idents[i], ident])
        if len(idents) > self.depth:
            least = np.partition(rows[:, 0], len(rows) - self.depth)[len(rows) - self.depth]
            rows, idents = rows[(near := rows[:, 0] >= least)], idents[near]
        order = np.lexsort((idents, -rows[:, 0]))[: self.depth]
        self.kept[i], self.idents[i] = rows[order], idents[order]
        if len(order) == self.depth:
            self.least[i], self.last[i] = self.kept[i][-1, 0], self.idents[i][-1]

    def told(self, kind: int) -> pa.RecordBatch:
        n = [len(x) for x in self.idents]
        rows = np.concatenate([np.empty((0, 3)), *self.kept])
        i = np.repeat(np.arange(len(n), dtype=np.int32), n)
        idents = np.concatenate([np.empty(0, np.int64), *self.idents])
        return pa.RecordBatch.from_arrays([pa.array(i), pa.array(np.full(len(i), kind, np.int32)), pa.array(idents), pa.array(rows[:, 1]), pa.array(rows[:, 2])], ["i", "kind", "ident", "bm25", "cosine"])


def heaps(rows: DataFrame, scorer: Scorer, depth: int, top_n: int) -> DataFrame:
    """Heap rows of all tasks: the best ``depth`` of both channels, and the first ``top_n`` rows that no channel scores.

    ``rows``: ident, tokens, vector, who (sub-problems that may have the row)."""
    sent = rows.sparkSession.sparkContext.broadcast(scorer)  # the stated sub-problems

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = sent.value
        kept = [Heap(scorer.n, depth), Heap(scorer.n, depth), Heap(scorer.n, top_n)]
        for ident, may, bm25, cosine in blocks(batches, scorer):
            rest = may & (bm25 <= 0) & (cosine <= 0)
            for kind, some in ((KEYWORDS, bm25 > 0), (VECTORS, cosine > 0), (REST, rest)):
                score = cosine if kind == VECTORS else bm25
                # rows that a full heap can't take are left out for all sub-problems at once
                some &= score >= kept[kind].least if kind != REST else ident[:, None] <= kept[kind].last
                of, row = np.nonzero(some.T)
                ends = np.searchsorted(of, np.arange(scorer.n + 1))
                for i in np.flatnonzero(np.diff(ends)).tolist():
                    r = row[ends[i] : ends[i + 1]]
                    kept[kind].add(i, score[r, i], ident[r], bm25[r, i], cosine[r, i])
        for kind, heap in enumerate(kept):
            yield heap.told(kind)

    return rows.select("ident", "tokens", "vector", "who").mapInArrow(work, HEAP)


def met(found: DataFrame, depth: int) -> DataFrame:
    """The best rows of all heaps and their rank; heaps meet by groups of tasks first, so no task reads all of them."""
    score = F.when(F.col("kind") == KEYWORDS, F.col("bm25")).when(F.col("kind") == VECTORS, F.col("cosine")).otherwise(0.0)
    best = lambda *keys: F.row_number().over(Window.partitionBy("i", "kind", *keys).orderBy(F.desc(score), "ident"))
    some = found.withColumn("branch", F.spark_partition_id() % BRANCH)
    some = some.withColumn("rank", best("branch")).where(F.col("rank") <= depth)
    return some.withColumn("rank", best().cast("long")).where(F.col("rank") <= depth).drop("branch")


def counted(rows: DataFrame, scorer: Scorer, candidates: list[tuple[int, int, int, float]]) -> DataFrame:
    """i, kind, ident and rank of stated candidates (i, kind, ident, score): one more than the rows that are better."""
    groups: dict[tuple[int, int], list] = {}
    for i, kind, ident, score in candidates:
        groups.setdefault((i, kind), []).append((-score, ident))
    sent = rows.sparkSession.sparkContext.broadcast((scorer, {g: sorted(c) for g, c in groups.items()}))  # sub-problems x depth

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer, groups = sent.value
        asked = {g: (np.array([s for s, _ in c]), np.array([d for _, d in c], np.int64)) for g, c in groups.items()}
        better = {g: np.zeros(len(c), np.int64) for g, c in groups.items()}
        for ident, _, *scores in blocks(batches, scorer):
            for (i, kind), (low, ids) in asked.items():
                s = scores[kind][:, i]
                some = np.flatnonzero((s > 0) & (s >= -low[-1]))
                s, d = -s[some], ident[some]
                # a row is better than all candidates from some place on: of equal score, those with later ids
                a, b = np.searchsorted(low, s, side="left"), np.searchsorted(low, s, side="right")
                tied = np.flatnonzero(a < b)
                for k in np.unique(a[tied]).tolist():
                    same = tied[a[tied] == k]
                    b[same] = k + np.searchsorted(ids[k : b[same[0]]], d[same], side="right")
                better[i, kind] += np.cumsum(np.bincount(b, minlength=len(low) + 1))[: len(low)]
        flat = [(i, kind, d, n) for (i, kind), (_, ids) in asked.items() for d, n in zip(ids.tolist(), better[i, kind].tolist())]
        i, kind, ident, n = zip(*flat) if flat else ((), (), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(kind, pa.int32()), pa.array(ident, pa.int64()), pa.array(n, pa.int64())], ["i", "kind", "ident", "n"])

    each = rows.select("ident", "tokens", "vector", "who").mapInArrow(work, "i int, kind int, ident long, n long")
    return each.groupBy("i", "kind", "ident").agg((F.sum("n") + 1).alias("rank"))
