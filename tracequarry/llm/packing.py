"""Best-fit packing of documents into sequences through a configuration linear program.

Lengths lie between 1 and the capacity, so their histogram has a fixed size and
the whole planning happens on it, however many documents there are.  The
configuration program (fewest sequences, each filled by a pattern of lengths,
covering the histogram) is solved by multiplicative weights: prices of lengths
start at their share of the capacity and rise where coverage lags behind the
sequences that the volume needs; a knapsack dynamic program over the capacity
prices the patterns.  No pattern covers more than there is.  The fractional
solution is rounded down and by largest fraction; what that leaves is priced on by
the same knapsack program in whole patterns.  Several roundings are compared.

The plan is a table from (length, rank among pieces of this length) to a
sequence and a place.  Ranks come from counts by (bucket, length): no task sees
all pieces of a length, however common it is.

A text is tokenised whole and gets the end id; null text is empty and gives the
end id alone.  Repeated rows are packed again, null ids are packed like any
other; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracequarry.lineage import materialize
from tracequarry.llm.bpe import Codec, slices

CAPACITY = 2048
#: Rounds of the multiplicative weights and their learning rate.
ROUNDS, RATE = 6, 0.1
#: A round takes patterns whose value is within this share of the best.
WORTH = 0.01
#: Shares of the fractional amounts that are rounded, and tokens of waste that a piece counts as when the rest is priced;
#: the plan with fewest sequences stays.
ROUNDINGS = ((1.0, 0), (0.5, 0), (0.5, 64), (0.0, 64))
#: Values that differ by less are equal; a pattern may miss the value of a table of earlier prices by the second.
NEAR, SLACK = 1e-9, 0.002
#: Rows of a bucket in which ranks are counted, on average.
BUCKET_ROWS = 100_000


def pieces(docs: DataFrame, model_json: str, capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """Token pieces of each document: doc_id, piece, start, length, ids_crc32.

    A document of more than ``capacity`` tokens is cut so that only its first piece may be shorter."""
    model = docs.sparkSession.sparkContext.broadcast(model_json)  # the vocabulary file's size

    def work(batches):
        codec = Codec.of(model.value, True)
        for batch in batches:
            for part in slices(batch, "text"):
                ids, bounds = codec.encode(part.column("text"))
                ids = np.insert(ids, bounds[1:], end_id).astype("<u4", copy=False)
                total = np.diff(bounds) + 1
                base = np.cumsum(total) - total
                n = -(-total // capacity)
                doc = np.repeat(np.arange(len(total)), n)
                piece = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                head = total - (n - 1) * capacity
                start = np.where(piece == 0, 0, head[doc] + (piece - 1) * capacity)
                length = np.where(piece == 0, head[doc], capacity)
                at = base[doc] + start
                data = memoryview(ids.tobytes())
                crc = [zlib.crc32(data[a:b]) for a, b in zip((at * 4).tolist(), ((at + length) * 4).tolist())]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(pa.array(doc)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array(crc, pa.int64())],
                    ["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    return docs.select("doc_id", "text").mapInArrow(work, "doc_id long, piece int, start long, length long, ids_crc32 long")


def price(lengths: np.ndarray, values: np.ndarray, capacity: int) -> np.ndarray:
    """Knapsack: the best value that fits into each capacity; ``lengths`` ascend."""
    best = np.zeros(capacity + 1)
    upto = np.searchsorted(lengths, np.arange(capacity + 1), side="right")
    for c in range(1, capacity + 1):
        best[c] = best[c - 1]
        if k := upto[c]:
            best[c] = max(best[c], (best[c - lengths[:k]] + values[:k]).max())
    return best


class Pricer:
    """Patterns of nearly the best value under given prices, made of amounts that are left."""

    def __init__(self, lengths: np.ndarray, prices: np.ndarray, left: np.ndarray, least: float, capacity: int):
        self.lengths, self.prices, self.left, self.least, self.capacity = lengths, prices, left, least, capacity
        self.solve()

    def solve(self):
        there = np.flatnonzero(self.left >= self.least)
        self.best = price(self.lengths[there], self.prices[there], self.capacity)
        self.known, self.gone = len(there), 0

    def through(self) -> np.ndarray:
        """Value of the best pattern with each length."""
        return self.prices + self.best[self.capacity - self.lengths]

    def _fill(self, seed: int) -> tuple[dict[int, int], float]:
        times, room, value = {seed: 1}, self.capacity - self.lengths[seed], self.prices[seed]
        want = self.left[seed]
        while k := int(np.searchsorted(self.lengths, room, side="right")):
            share = self.left[:k].copy()
            for i, n in times.items():
                if i < k:
                    share[i] /= n + 1
            score = np.where(share >= self.least, self.prices[:k] + self.best[room - self.lengths[:k]], -1.0)
            if (top := score.max()) < 0:
                break
            near = np.flatnonzero(score >= top - NEAR)
            lasting = near[share[near] >= want]  # a length that lasts as long as the first, so that patterns are few
            i = int(lasting[-1] if len(lasting) else near[share[near].argmax()])
            times[i] = times.get(i, 0) + 1
            room -= self.lengths[i]
            value += self.prices[i]
        return times, value

    def pattern(self, seed: int) -> tuple[dict[int, int], float]:
        """Lengths and how often a pattern with ``seed`` has each, and its value; priced anew once a tenth of the lengths is used up,
        or a hundredth and the pattern misses the value that the table promises."""
        if self.gone > self.known // 10:
            self.solve()
        times, value = self._fill(seed)
        if self.gone * 100 > self.known and value < self.prices[seed] + self.best[self.capacity - self.lengths[seed]] - SLACK:
            self.solve()
            times, value = self._fill(seed)
        return times, value

    def take(self, times: dict[int, int], amount: float):
        for i, n in times.items():
            self.left[i] = max(0.0, self.left[i] - n * amount)
            self.gone += self.left[i] < self.least


def fractional(lengths: np.ndarray, counts: np.ndarray, capacity: int, rounds: int = ROUNDS, rate: float = RATE) -> tuple[dict[tuple, float], np.ndarray]:
    """Multiplicative weights on the configuration program: amounts of patterns, ((place of length, times), ...), and prices.

    A round may use its share of the sequences that the volume needs, and no length is covered beyond the round's share of
    it. Patterns of the highest value come first; prices of lengths that lag rise, so they come earlier next time."""
    prices = lengths / capacity
    covered = np.zeros(len(lengths))
    budget = float(lengths @ counts) / capacity / rounds
    amounts: dict[tuple, float] = {}
    for t in range(1, rounds + 1):
        pricer = Pricer(lengths, prices, counts * t / rounds - covered, 1e-9, capacity)
        start, spare = pricer.left.copy(), budget
        for seed in np.lexsort((-lengths, -np.round(pricer.through(), 3))).tolist():
            while pricer.left[seed] >= 1e-9 and spare > 1e-9:
                times, value = pricer.pattern(seed)
                if value < (1 - WORTH) * pricer.best[capacity]:
                    break
                step = min(spare, *(pricer.left[i] / n for i, n in times.items()))
                pricer.take(times, step)
                key = tuple(sorted(times.items()))
                amounts[key] = amounts.get(key, 0.0) + step
                spare -= step
        covered += start - pricer.left
        prices = prices * np.exp(rate * (t / rounds - covered / counts))
        prices /= max(1.0, price(lengths, prices, capacity)[capacity])  # no pattern is worth more than a sequence
    return amounts, prices


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """Patterns and how many sequences have each; together they hold exactly the histogram.

    The roundings of the fractional solution are compared; all lie within a piece of a kind for each pattern."""
    left = {int(k): int(n) for k, n in histogram.items() if n}
    out = [((capacity,), left.pop(capacity))] if capacity in left else []
    if not left:
        return out
    lengths = np.array(sorted(left))
    counts = np.array([left[k] for k in lengths.tolist()], float)
    amounts, _ = fractional(lengths, counts, capacity)
    least = -(-int(lengths @ counts) // capacity)
    best: list[tuple[dict[int, int], int]] = []
    fewest = None
    for share, piece in ROUNDINGS:
        found = rounded(amounts, share, piece, lengths, counts, capacity)
        used = sum(n for _, n in found)
        if fewest is None or used < fewest:
            best, fewest = found, used
        if fewest == least:
            break
    return out + [(tuple(x for i, k in sorted(times.items(), reverse=True) for x in [int(lengths[i])] * k), n) for times, n in best]


def rounded(amounts: dict[tuple, float], share: float, piece: int, lengths: np.ndarray, counts: np.ndarray, capacity: int) -> list[tuple[dict[int, int], int]]:
    """Whole patterns: ``share`` of each amount rounded down, then full patterns of the largest fractions while items last.

    What is left is priced on at its lengths less ``piece`` in whole patterns, longest pieces first, until nothing is left."""
    rest = counts.copy()
    whole: dict[tuple, int] = {}

    def take(times: tuple, most: int):
        n = max(0, min(most, *(int(rest[i] // k) for i, k in times)))
        for i, k in times:
            rest[i] -= k * n
        whole[times] = whole.get(times, 0) + n

    for times, x in amounts.items():
        take(times, int(share * x))
    for times in sorted(amounts, key=lambda p: -(share * amounts[p] % 1)):
        if share * amounts[times] % 1 >= 0.5 and sum(int(lengths[i]) * k for i, k in times) == capacity:
            take(times, 1)
    out = [(dict(times), n) for times, n in whole.items() if n]
    pricer = Pricer(lengths, np.maximum(lengths - piece, lengths / 2) / capacity, rest, 1.0, capacity)
    for seed in range(len(lengths) - 1, -1, -1):
        while rest[seed] >= 1:
            times, _ = pricer.pattern(seed)
            n = int(min(rest[i] // k for i, k in times.items()))
            pricer.take(times, n)
            out.append((times, n))
    return out


def lookup(patterns: list[tuple[tuple[int, ...], int]]) -> np.ndarray:
    """Rows (length, first rank, first sequence, items of the length in a sequence, offset), sorted."""
    rows, ranks, sequence = [], {}, 0
    for pattern, n in patterns:
        offset = 0
        for size in sorted(set(pattern), reverse=True):
            k = pattern.count(size)
            rows.append((size, ranks.get(size, 0), sequence, k, offset))
            ranks[size] = ranks.get(size, 0) + k * n
            offset += k * size
        sequence += n
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def pack(docs: DataFrame, model_json: str, capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """Pieces of all documents with the sequence that holds each and its place there.

    The driver gets the histogram, at most ``capacity`` rows; the broadcast plan has a row for each
    pattern and length, bounded by the rounds and the capacity."""
    spark = docs.sparkSession
    cut = pieces(docs, model_json, capacity, end_id)
    cut = materialize(cut.withColumn("deal", F.xxhash64("doc_id", F.monotonically_increasing_id())), "pieces")  # parts equal rows as well
    buckets = max(64, cut.count() // BUCKET_ROWS)
    cut = cut.withColumn("bucket", F.pmod("deal", F.lit(buckets)))
    counts = cut.groupBy("bucket", "length").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select("bucket", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    table = spark.sparkContext.broadcast(lookup(plan(histogram, capacity)))

    @F.pandas_udf(T.StructType([T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]))
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        rows = table.value
        size, r = length.to_numpy(), rank.to_numpy()
        at = np.searchsorted((rows[:, 0] << 44) + rows[:, 1], (size << 44) + r, side="right") - 1
        _, first, sequence, k, offset = rows[at].T
        return pd.DataFrame({"sequence_id": sequence + (r - first) // k, "offset": offset + (r - first) % k * size})

    within = Window.partitionBy("bucket", "length").orderBy("doc_id", "piece", "deal")
    ranked = (
        cut.withColumn("r", F.row_number().over(within))
        .join(firsts, ["bucket", "length"])
        .withColumn("at", place("length", (F.col("first") + F.col("r") - 1).cast("long")))
    )
    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "at.sequence_id", "at.offset")
