"""Embedding near-dedup by collision-counting projections.

Every vector is projected on many random lines.  A pair whose cosine reaches the
threshold lies close on most lines; the number of lines on which the second falls
into a window around the first follows a binomial law at the threshold, and the
count that a pair must reach is its lowest quantile at the wanted recall.  Pairs
that reach it are verified by cosine in double precision.

Vectors of a label are sorted along a line and dealt to blocks of neighbours; blocks
whose ranges on it are farther apart than a linked pair lies once in a billion never
meet.  Where two blocks meet, one is sorted along every line.  The windows around a
vector of the other are found by binary search; as the vectors before each place of a
line are kept as bit sets, a window is an exclusive or of two of them, and collisions
are counted for 64 vectors at once.  A pair of blocks yields link counts per vector
and the edges of a spanning forest, so large groups of copies give rows in proportion
to their members, not to their pairs.

In many dimensions a line tells little of two unrelated vectors, so most blocks of a
label meet: the work is that of all pairs of its blocks, at a few word operations for
64 pairs and a line.

Equal vectors of a label are one vector with a weight.  Null labels, null, empty
or zero vectors and those with null or non-finite components link with nothing.
Vectors of different lengths don't link.  Rows with a null or repeated ``vec_id``
are vectors of their own; a null id never is a component's id unless it stands
alone.  An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracequarry.lineage import materialize
from tracequarry.llm.components import components, with_least, with_values

THRESHOLD = 0.93
#: Lines, and half the window in units of the largest distance of a linked pair on a line (one deviation).
LINES, HALF_WINDOW = 24, 2.0
#: Chance that a pair at the threshold reaches the count.
RECALL = 0.99999
#: Vectors of a block, of a sorted part of a block, and points whose windows are looked up at once.
BLOCK, SORTED, TILE = 4096, 2048, 256
#: Vectors for which there is one more deal of a slice of the sorting line.
DEALT = 50_000
SEED = 20240229


def needed_count(lines: int = LINES, half: float = HALF_WINDOW, recall: float = RECALL) -> int:
    """Largest count that a pair at the threshold reaches with probability ``recall``."""
    p = math.erf(half / math.sqrt(2))
    below = 0.0
    for k in range(lines + 1):
        below += math.comb(lines, k) * p**k * (1 - p) ** (lines - k)
        if below > 1 - recall:
            return k
    return lines


def directions(dim: int, lines: int = LINES) -> np.ndarray:
    """Random lines: independent normal components, so a projected distance is normal as well."""
    return np.random.default_rng([SEED, dim]).normal(size=(dim, lines))


def _decode(data: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(data), "<f8").reshape(len(data), -1)


class SortedLines:
    """Vectors sorted along each line, and, as bit sets, which vectors stand before each place of a line.

    The vectors in a window are those before its end less those before its start: one exclusive or of two bit sets."""

    def __init__(self, points: np.ndarray):
        n, self.words = len(points), -(-len(points) // 64)
        order = np.argsort(points, axis=0, kind="stable")
        self.at = np.take_along_axis(points, order, axis=0)
        self.before = np.zeros((points.shape[1], n + 1, self.words), np.uint64)
        for line, places in zip(self.before, order.T):
            line[np.arange(1, n + 1), places >> 6] = np.uint64(1) << (places & 63).astype(np.uint64)
            np.bitwise_xor.accumulate(line, axis=0, out=line)

    def reached(self, points: np.ndarray, half: float, need: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (point, vector) that collide in the windows around the point on at least ``need`` lines.

        Collisions are counted for 64 vectors at once, a bit set for each binary digit of the counts."""
        digits = [np.zeros((len(points), self.words), np.uint64) for _ in range(len(self.before).bit_length())]
        for k, line in enumerate(self.before):
            start, end = (np.searchsorted(self.at[:, k], points[:, k] + x, side) for x, side in ((-half, "left"), (half, "right")))
            carry = line[start] ^ line[end]
            for d in digits:
                d ^= carry
                carry &= ~d  # a digit that was set and met a one is clear now
        more, equal = np.zeros_like(digits[0]), np.full_like(digits[0], 2**64 - 1)
        for bit in reversed(range(len(digits))):
            if need >> bit & 1:
                equal &= digits[bit]
            else:
                more |= equal & digits[bit]
                equal &= ~digits[bit]
        more |= equal
        row, word = np.nonzero(more)
        at, bit = np.nonzero(np.unpackbits(more[row, word].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
        return row[at], word[at] * 64 + bit


def block_links(a: np.ndarray, b: np.ndarray, same: bool, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Linked pairs (i, j) of two blocks of unit vectors; i < j if the blocks are the same."""
    lines, need, half = directions(a.shape[1]), needed_count(), HALF_WINDOW * math.sqrt(2 * (1 - threshold))
    left, right = [np.empty(0, np.int32)], [np.empty(0, np.int32)]
    for c in range(0, len(b), SORTED):
        known = SortedLines(b[c : c + SORTED] @ lines)
        for r in range(0, min(len(a), c + SORTED) if same else len(a), TILE):
            i, j = known.reached(a[r : r + TILE] @ lines, half, need)
            i, j = i + r, j + c
            keep = (i < j) if same else (j < len(b))
            i, j = i[keep], j[keep]
            for s in range(0, len(i), 1 << 16):  # bounded memory in groups of copies
                x, y = i[s : s + (1 << 16)], j[s : s + (1 << 16)]
                ok = np.einsum("ij,ij->i", a[x], b[y]) >= threshold
                left.append(x[ok].astype(np.int32))
                right.append(y[ok].astype(np.int32))
    return np.concatenate(left), np.concatenate(right)


def forest(i: np.ndarray, j: np.ndarray, n: int) -> list[tuple[int, int]]:
    """Edges that connect what the pairs connect: at most n - 1."""
    parent = list(range(n))
    out = []
    for x, y in zip(i.tolist(), j.tolist()):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        while parent[y] != y:
            parent[y] = parent[parent[y]]
            y = parent[y]
        if x != y:
            parent[max(x, y)] = min(x, y)
            out.append((x, y))
    return out


def _unit_vectors(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Usable vectors as label and data (doubles, length 1); ids of the rest."""
    usable = F.expr(
        "label is not null and size(embedding) > 0 and not exists(embedding, x -> x is null or isnan(x) or abs(x) = double('infinity'))"
        " and exists(embedding, x -> x <> 0)"
    )
    rows = vectors.select("vec_id", F.col("label").cast("string").alias("label"), F.col("embedding").cast("array<double>").alias("embedding"))
    rows = rows.withColumn("usable", F.coalesce(usable, F.lit(False)))

    @F.pandas_udf("binary")
    def unit(v: pd.Series) -> pd.Series:
        out = []
        for x in v:
            y = np.asarray(x, np.float64)
            y = y / np.abs(y).max()
            out.append((y / np.sqrt((y * y).sum())).astype("<f8").tobytes())
        return pd.Series(out, dtype=object)

    good = rows.where("usable").withColumn("data", unit("embedding")).drop("embedding", "usable")
    return good, rows.where("not usable").select("vec_id")


def cluster(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    good, rest = _unit_vectors(vectors)
    good = materialize(good.withColumn("key", F.sha2("data", 256)), "vectors")
    distinct = good.groupBy("label", "key").agg(
        F.first("data").alias("data"), F.count("*").alias("weight"), F.min("vec_id").alias("first")
    )

    @F.pandas_udf("double")
    def along(data: pd.Series) -> pd.Series:
        return pd.Series([float(v @ directions(len(v), 1)[:, 0]) for v in (np.frombuffer(x, "<f8") for x in data)])

    distinct = distinct.withColumns({"dim": (F.octet_length("data") / 8).cast("long"), "at": along("data")})
    distinct = materialize(distinct, "distinct")
    deals = max(16, distinct.count() // DEALT)
    # rank within (label, dim) from counts by slice of the sorting line: no task sorts a whole label
    # a slice is dealt out further, as near copies all lie in one
    distinct = distinct.withColumns({"slice": F.floor(F.col("at") * 64), "deal": F.pmod(F.xxhash64("key"), F.lit(deals))})
    group, cell = ["label", "dim"], ["label", "dim", "slice", "deal"]
    counts = distinct.groupBy(*cell).agg(F.count("*").alias("n"))
    before = Window.partitionBy(*group).orderBy("slice", "deal").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(*cell, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    within = Window.partitionBy(*cell).orderBy("at", "key")
    ranked = distinct.withColumn("r", F.row_number().over(within)).join(counts, cell)
    placed = ranked.withColumn("block", F.floor((F.col("before") + F.col("r") - 1) / BLOCK))
    placed = materialize(placed.select(*group, "block", "key", "data", "weight", "first", "at"), "blocks")
    # which blocks meet: their ranges on the line, widened by the farthest that a linked pair may lie apart
    reach = 6.0 * math.sqrt(2 * (1 - threshold))
    ranges = placed.groupBy(*group, "block").agg(F.min("at").alias("low"), F.max("at").alias("high"))
    a, b = ranges.alias("a"), ranges.alias("b")
    same = (F.col("a.label") == F.col("b.label")) & (F.col("a.dim") == F.col("b.dim"))
    meet = (F.col("a.block") <= F.col("b.block")) & (F.col("b.low") - F.col("a.high") <= reach)
    pairs = a.join(b, same & meet).select("a.label", "a.dim", F.col("a.block").alias("block_a"), F.col("b.block").alias("block_b"))
    sides = pairs.withColumn("block", F.explode(F.array_distinct(F.array("block_a", "block_b"))))
    dealt = sides.join(placed, [*group, "block"]).select(*group, "block_a", "block_b", "block", "key", "data", "weight")

    def work(key, rows: pd.DataFrame) -> pd.DataFrame:
        _, _, block_a, block_b = key
        rows = rows.sort_values(["block", "key"])
        one = rows[rows.block == block_a]
        two = rows[rows.block == block_b]
        i, j = block_links(_decode(one.data), _decode(two.data), block_a == block_b, threshold)
        w1, w2 = one.weight.to_numpy(), two.weight.to_numpy()
        n1 = np.bincount(i, weights=w2[j], minlength=len(one)).astype(np.int64)
        n2 = np.bincount(j, weights=w1[i], minlength=len(two)).astype(np.int64)
        k1, k2 = one.key.to_numpy(), two.key.to_numpy()
        shift = 0 if block_a == block_b else len(one)
        names = k1 if block_a == block_b else np.concatenate([k1, k2])
        edges = forest(i, j + shift, len(names))
        counted = [(k, None, int(n)) for k, n in zip(np.concatenate([k1, k2]), np.concatenate([n1, n2])) if n]
        found = counted + [(names[x], names[y], 0) for x, y in edges]
        out = pd.DataFrame(found, columns=["key", "other", "n"])
        out["label"] = rows.label.iloc[0]
        return out[["label", "key", "other", "n"]]

    found = dealt.groupBy(*group, "block_a", "block_b").applyInPandas(work, "label string, key string, other string, n long")
    found = materialize(found, "links")
    linked = found.where("other is null").groupBy("label", "key").agg(F.sum("n").alias("n"))
    node = lambda k: F.concat_ws("/", "label", k)
    roots = components(found.where("other is not null").select(node("key").alias("a"), node("other").alias("b")))
    named = placed.select("label", "key", "weight", "first", node("key").alias("node")).join(roots, "node", "left")
    named = materialize(named.withColumn("root", F.coalesce("root", "node")), "named")
    named = with_least(named, "root", "first", "component_id", named.count())
    classes = named.join(linked, ["label", "key"], "left")
    classes = classes.select("node", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "component_id", F.col("weight").alias("__n"))
    out = with_values(good.select("vec_id", node("key").alias("node")), classes, "node", good.count()).select("vec_id", "n_links", "component_id")
    alone = rest.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return out.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
