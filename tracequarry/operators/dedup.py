"""Greedy near-duplicate removal: an item goes if an earlier kept one is too similar.

Comparing with kept items only is not the same as taking connected components.
Pairs above a threshold come from joins; then rounds decide all items whose
earlier neighbours are decided, until nothing is open.
"""

from __future__ import annotations

from collections.abc import Container, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracequarry.functions import vectors
from tracequarry.lineage import discard, materialize
from tracequarry.operators.vector_index import SAMPLE, centres

COSINE, JACCARD = 0.95, 0.9
#: Hash functions of a signature, least places of a band, equal places of near-duplicates (a Jaccard similarity of 0.9), sets of a band that meet in one part.
PERMUTATIONS, BAND, LEAST_EQUAL, HOT = 64, 4, 58, 512
#: Places by which candidates may fall short where pairs are verified: four standard deviations at a similarity of 0.9.
SLACK = 10
#: Vectors that one task compares with as many others, rows of a tile, vectors for which there is a pivot, most pivots of a length.
BLOCK, TILE, CELL, MOST_PIVOTS = 4096, 512, 512, 1024
#: Where cells prune too little and all blocks meet: most vectors of a block, least blocks of many vectors; cosines of a tile.
WHOLE_BLOCK, LEAST_BLOCKS, PRODUCT = 16_384, 8, 2_000_000
#: Room for rounding in distances and angles; open rows that one task decides.
ROOM, MOST_LOCAL = 1e-9, 100_000


def jaccard(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b))


def digest(tokens: Column) -> Column:
    """A name of a sorted token set that takes little room."""
    return F.sha2(F.to_json(F.struct(tokens.alias("t"))), 256)


def _classes(least: float, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Where classes of set sizes begin, and by how many tokens a similar pair differs whose smaller set is in a class.

    A class ends where sets are too large for its first size, so a pair's larger set is in the same class or the next."""
    starts = [1]
    while starts[-1] <= most:
        starts.append(max(starts[-1] + 1, int(np.ceil(starts[-1] / least + 1e-9))))
    largest = np.array(starts[1:]) - 1
    return np.array(starts[:-1]), np.floor((largest + largest / least) * (1 - least) / (1 + least) + 1e-6).astype(int)


def _part_keys(kinds: DataFrame, least: float) -> DataFrame:
    """first, n, key and ``upper`` (the set's class is not the key's but the next) of every part of every set."""
    kind = dict(kinds.dtypes)["first"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(k, TILE) for b in batches for k in range(0, b.num_rows, TILE)):
            first, hashes = batch.column("first"), batch.column("h")
            h = hashes.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            n = hashes.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            starts, differ = _classes(least, int(n.max(initial=1)))
            of = np.searchsorted(starts, n, side="right") - 1
            for upper in (False, True):
                at = of - upper
                parts = np.where(at >= 0, differ[np.maximum(at, 0)], 0)
                parts = np.where(parts > 0, parts + 1, 0)  # sets that may not differ are equal
                begin, token_row = np.cumsum(parts) - parts, np.repeat(np.arange(len(n)), n)
                some = parts[token_row] > 0
                token_row, own = token_row[some], h[some]
                sums = np.zeros(int(parts.sum()), np.uint64)
                np.add.at(sums, begin[token_row] + (own % parts[token_row].astype(np.uint64)).astype(np.int64), own)
                row = np.repeat(np.arange(len(n)), parts)
                place = (at[row] << 32) + np.arange(len(row)) - begin[row]
                key = (sums ^ (place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xBF58476D1CE4E5B9)
                columns = [first.take(pa.array(row)), pa.array(n[row].astype(np.int32)), pa.array(key.view(np.int64)), pa.array(np.full(len(row), upper))]
                yield pa.RecordBatch.from_arrays(columns, ["first", "n", "key", "upper"])

    hashed = kinds.select("first", F.transform("t", lambda x: F.xxhash64(x)).alias("h"))
    return hashed.mapInArrow(work, f"first {kind}, n int, key long, upper boolean")


def token_pairs(items: DataFrame, least: float = JACCARD, ident: str = "seq", tokens: str = "bm25_tokens") -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b), a before b, whose token sets have at least this Jaccard similarity; exact.

    Sets this similar differ by at most d tokens, which their sizes give.  Tokens are dealt to d + 1 parts by their hash, so at
    least one part is the same in both: sets meet where a part's hash is equal, then are compared as they are.  Parts hold
    several tokens, so hardly any others meet, however frequent their tokens.  Items without tokens have no pair.  Equal sets
    are one: the first item of each set stands in the pairs, and the second table maps each item to it."""
    # written before it is filtered, or the tokens would be worked out twice
    sets = materialize(items.select(ident, F.sort_array(F.array_distinct(tokens)).alias("t")).withColumn("d", digest(F.col("t"))), "tokens").where(F.size("t") > 0)
    kinds = materialize(sets.groupBy("t", "d").agg(F.min(ident).alias("first")), "sets")
    keyed = materialize(_part_keys(kinds, least), "parts")
    a, b = keyed.alias("a"), keyed.alias("b")
    fits = (F.least("a.n", "b.n") >= F.greatest("a.n", "b.n") * (least - 1e-9)) & ~(F.col("a.upper") & F.col("b.upper")) & (F.col("a.first") < F.col("b.first"))
    found = a.join(b, (F.col("a.key") == F.col("b.key")) & fits).select(F.col("a.first").alias("a"), F.col("b.first").alias("b")).distinct()
    close = found.join(kinds.select(F.col("first").alias("a"), F.col("t").alias("ta")), "a").join(kinds.select(F.col("first").alias("b"), F.col("t").alias("tb")), "b")
    both = F.size(F.array_intersect("ta", "tb"))
    close = close.where(both / (F.size("ta") + F.size("tb") - both) >= least)
    return close.select("a", "b"), sets.select(ident, "d").join(kinds.select("d", "first"), "d").select(ident, "first")


def minhash(tokens: Column) -> Column:
    """Signature of a token set: for each of ``PERMUTATIONS`` hash functions the least hash of its tokens."""
    seeds = F.sequence(F.lit(0), F.lit(PERMUTATIONS - 1))
    return F.transform(seeds, lambda i: F.array_min(F.transform(tokens, lambda t: F.xxhash64(t, i))))


def band_edges(least_equal: int) -> list[int]:
    """Where bands begin and end: signatures that differ in fewer places than there are bands have one in common, and wide bands bring few others together."""
    bands = min(PERMUTATIONS - least_equal + 1, PERMUTATIONS // BAND)
    return [PERMUTATIONS * k // bands for k in range(bands + 1)]


def minhash_pairs(
    items: DataFrame, least_equal: int = LEAST_EQUAL, ident: str = "seq", tokens: str = "bm25_tokens", verify: float | None = None
) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b, equal), a before b, whose signatures have at least ``least_equal`` equal places: Jaccard similarity as estimated.

    Signatures meet where a band of places is equal.  There is one band more than places that may differ, so no such pair is
    missed; where that would make bands narrower than ``BAND`` (with ``verify``), there are ``PERMUTATIONS / BAND``, of which at
    a similarity of 0.9 all but some 4 in 10^8 pairs share one.  Equal sets are one (see :func:`token_pairs`, which is exact);
    the rest of a band that very many share is dealt to parts of ``HOT`` sets, and parts meet in pairs, so no task holds them all.  Items without tokens have no pair.

    An estimate misses about half of the pairs right at its threshold.  With ``verify``, pairs with ``SLACK`` fewer equal
    places are taken as candidates and kept by their exact similarity."""
    sets = materialize(items.select(ident, F.sort_array(F.array_distinct(tokens)).alias("t")), "tokens").where(F.size("t") > 0)
    kinds = materialize(sets.groupBy("t").agg(F.min(ident).alias("first")).select("first", "t", minhash(F.col("t")).alias("sig")), "signatures")
    edges = band_edges(least_equal - (0 if verify is None else SLACK))
    bands = F.array(*[F.xxhash64(F.lit(k), F.slice("sig", low + 1, high - low)) for k, (low, high) in enumerate(zip(edges, edges[1:]))])
    keyed = materialize(kinds.select("first", F.explode(bands).alias("key")), "bands")
    shared = keyed.groupBy("key").agg(F.ceil(F.count("*") / HOT).alias("parts"), F.count("*").alias("n")).where("n > 1").drop("n")
    told = keyed.join(shared, "key").withColumn("own", F.pmod(F.xxhash64("first"), F.col("parts")))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("other")
    dealt = told.select("key", "first", "own", other).withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other")})
    a, b = dealt.where("own = i").alias("a"), dealt.where("own = j").alias("b")
    met = (F.col("a.key") == F.col("b.key")) & (F.col("a.i") == F.col("b.i")) & (F.col("a.j") == F.col("b.j")) & (F.col("a.first") != F.col("b.first"))
    found = a.join(b, met).select(F.least("a.first", "b.first").alias("a"), F.greatest("a.first", "b.first").alias("b")).distinct()
    sig = kinds.select("first", "sig")
    both = found.join(sig.withColumnsRenamed({"first": "a", "sig": "sa"}), "a").join(sig.withColumnsRenamed({"first": "b", "sig": "sb"}), "b")
    equal = F.size(F.filter(F.zip_with("sa", "sb", lambda x, y: x == y), lambda x: x))
    close = both.select("a", "b", equal.alias("equal")).where(F.col("equal") >= least_equal - (0 if verify is None else SLACK))
    if verify is not None:
        whole = kinds.select("first", "t")
        close = close.join(whole.withColumnsRenamed({"first": "a", "t": "ta"}), "a").join(whole.withColumnsRenamed({"first": "b", "t": "tb"}), "b")
        close = close.where(jaccard(F.col("ta"), F.col("tb")) >= verify).select("a", "b", "equal")
    return close, sets.join(kinds.select("t", "first"), "t").select(ident, "first")


def _pivots(rows: DataFrame) -> dict[int, np.ndarray]:
    """Pivots of each length, near which a sample (the smallest hashes of vectors) gathers."""
    some = rows.orderBy(F.xxhash64("v"), "id").limit(SAMPLE).select("dim", "v").collect()  # bounded
    out = {}
    for dim, n in rows.groupBy("dim").count().collect():
        x = np.array([r.v for r in some if r.dim == dim]).reshape(-1, dim)
        if len(x):
            out[dim] = centres(x / np.linalg.norm(x, axis=1, keepdims=True), min(MOST_PIVOTS, -(-n // CELL)))
    return out


def _units(batch: pa.RecordBatch, skip: Container[int] = ()) -> Iterator[tuple[int, np.ndarray, np.ndarray | None]]:
    """Length, rows and unit vectors of the rows of each length; none of lengths to skip."""
    dims = batch.column("dim").to_numpy()
    for dim in np.unique(dims).tolist():
        some, x = np.flatnonzero(dims == dim), None
        if dim not in skip:
            x = batch.column("v").take(pa.array(some)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
            x /= np.linalg.norm(x, axis=1, keepdims=True)
        yield dim, some, x


class MetricJoin:
    """Vectors told where they lie and whom they may meet.

    A vector's home is the cell of its nearest pivot and a ring of angles about it, as wide as the threshold's angle.  Vectors
    that are close differ in their angle to any pivot by no more than that, and lie on both sides of the plane between
    two pivots only if they are within the threshold's distance of it; a vector is a guest in every ring of an earlier cell,
    and in the inner ring of its own, that both bounds allow.  Homes and guests are dealt to parts of ``BLOCK``, so a ring of
    any size is split and no task holds it.

    A low threshold makes a vector a guest nearly everywhere.  Where vectors of a length would have more places than
    blocks of them all ask for (counted before anything is written), they get one cell and one ring, and all blocks meet.

    ``met``: comparisons, of ``pairs`` that a product of all vectors has."""

    def __init__(self, items: DataFrame, above: float, ident: str, vector: str):
        kinds = dict(items.dtypes)
        self.kind, self.above = kinds[ident], above
        # floats travel as they are; tasks take them as doubles
        self.number = "float" if kinds[vector] == "array<float>" else "double"
        v = F.col(vector).cast(f"array<{self.number}>")
        finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        rows = items.where(vectors.usable(F.col(vector))).select(F.col(ident).alias("id"), v.alias("v")).where(finite)
        self.rows = materialize(rows, "vectors")
        kinds = self.rows.groupBy("v").agg(F.min("id").alias("id"), (F.count("*") > 1).alias("many"))
        self.kinds = materialize(kinds.select("id", "v", F.size("v").alias("dim"), "many"), "kinds")
        self.pivots = self.kinds.sparkSession.sparkContext.broadcast(_pivots(self.kinds))  # at most MOST_PIVOTS of each length
        self.whole = self._whole()
        self.told = materialize(self._tell(), "cells")
        rings = self.told.select("dim", F.explode("rings").alias("r"), F.col("home").alias("h")).groupBy("dim", "r.cell", "r.ring")
        own = (F.col("r.cell") == F.col("h.cell")) & (F.col("r.ring") == F.col("h.ring"))
        rings = rings.agg(F.count_if(own).alias("n"), F.count_if(~own).alias("guests")).where("n > 0")
        block = F.lit(BLOCK)
        for dim, n in self.whole.items():
            block = F.when(F.col("dim") == dim, n).otherwise(block)
        self.rings = materialize(rings.withColumns({"block": block, "parts": F.ceil(F.col("n") / block)}), "rings")  # at most pivots x rings

    def _placer(self):
        """What gives the unit vectors' home, rings about all pivots and the earlier cells that they meet."""
        sent, width = self.pivots, float(np.arccos(np.clip(self.above, -1, 1))) + ROOM
        reach = float(np.sqrt(2 - 2 * self.above)) + ROOM

        def place(x: np.ndarray, dim: int, apart: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            at = sent.value.get(dim, np.eye(1, dim))  # a length that the sample lacks has one cell
            if dim not in apart:  # a chord's length is computed with an error of some 3e-8
                apart[dim] = np.sqrt(np.maximum(0, 2 - 2 * at @ at.T)) + 1e-7
            near = x @ at.T
            home = np.argmax(near, axis=1)
            ring = np.floor(np.arccos(np.clip(near, -1, 1)) / width).astype(int)
            lead = near[np.arange(len(x)), home][:, None] - near
            return home, ring, (lead <= reach * apart[dim][home] + ROOM) & (np.arange(len(at)) < home[:, None])

        return place

    def _whole(self) -> dict[int, int]:
        """Lengths whose vectors would have too many places in cells, and vectors of a block for these."""
        place = self._placer()

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            apart, places = {}, {}
            for batch in (b.slice(k, TILE) for b in batches for k in range(0, b.num_rows, TILE)):
                for dim, _, x in _units(batch):
                    home, ring, meets = place(x, dim, apart)
                    own = ring[np.arange(len(x)), home]
                    inside = 2 + (ring > 0)  # the rings y >= 0 of ring - 1, ring and ring + 1
                    places[dim] = places.get(dim, 0) + int(len(x) + (own > 0).sum() + inside[meets].sum())
            yield pa.RecordBatch.from_arrays([pa.array(list(places), pa.int32()), pa.array(list(places.values()), pa.int64())], ["dim", "places"])

        places = self.kinds.select("v", "dim").mapInArrow(work, "dim int, places long").groupBy("dim").agg(F.sum("places").alias("places"))
        n = self.kinds.groupBy("dim").agg(F.count("*").alias("n"))
        out = {}
        for r in n.join(places, "dim").collect():  # a row for each length
            block = min(WHOLE_BLOCK, max(TILE, -(-r.n // LEAST_BLOCKS)))
            # blocks that all meet: a vector is a host at each table and a guest of half the parts
            if r.places > r.n * 1.5 * -(-r.n // block):
                out[r.dim] = block
        return out

    def _tell(self) -> DataFrame:
        place, whole = self._placer(), self.whole

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            apart = {}
            for batch in (b.slice(k, TILE) for b in batches for k in range(0, b.num_rows, TILE)):
                homes, rings = [None] * batch.num_rows, [None] * batch.num_rows
                for dim, some, x in _units(batch, whole):
                    if dim in whole:
                        for row in some.tolist():
                            homes[row], rings[row] = {"cell": 0, "ring": 0}, [{"cell": 0, "ring": 0}]
                        continue
                    home, ring, meets = place(x, dim, apart)
                    for k, row in enumerate(some.tolist()):
                        h, r = int(home[k]), int(ring[k, home[k]])
                        homes[row] = {"cell": h, "ring": r}
                        rings[row] = [{"cell": h, "ring": y} for y in (r - 1, r) if y >= 0] + [
                            {"cell": int(c), "ring": int(ring[k, c]) + y} for c in np.flatnonzero(meets[k]).tolist() for y in (-1, 0, 1) if ring[k, c] + y >= 0
                        ]
                at = pa.struct([("cell", pa.int32()), ("ring", pa.int32())])
                columns = [*batch.columns, pa.array(homes, at), pa.array(rings, pa.list_(at))]
                yield pa.RecordBatch.from_arrays(columns, ["id", "v", "dim", "many", "home", "rings"])

        schema = f"id {self.kind}, v array<{self.number}>, dim int, many boolean, home struct<cell:int,ring:int>, rings array<struct<cell:int,ring:int>>"
        return self.kinds.mapInArrow(work, schema)

    def work(self) -> tuple[int, int]:
        met = self.rings.agg(F.sum(F.expr("n * (n - 1) div 2 + n * guests"))).first()[0] or 0
        every = self.kinds.groupBy("dim").count().agg(F.sum(F.expr("count * (count - 1) div 2"))).first()[0] or 0
        return met, every

    def pairs(self) -> DataFrame:
        """Pairs (a, b) of different vectors, a before b, with a cosine above the threshold; ``many``: one of them stands for several items."""
        seat = self.told.select("id", "v", "dim", "many", "home", F.explode("rings").alias("r")).select("id", "v", "dim", "many", "home", "r.cell", "r.ring")
        seat = seat.join(F.broadcast(self.rings), ["dim", "cell", "ring"])  # at most pivots x rings
        own = (F.col("home.cell") == F.col("cell")) & (F.col("home.ring") == F.col("ring"))
        part = F.pmod(F.xxhash64("id"), F.col("parts"))
        tables = F.greatest(F.lit(1).cast("long"), F.ceil((F.col("guests") + F.when(F.col("parts") > 1, F.col("n")).otherwise(0)) / F.col("block")))
        seat = seat.withColumns({"own": own, "part": part, "tables": tables})
        upto = lambda n: F.sequence(F.lit(0).cast("long"), n - 1)
        row = ["id", "v", "many", "dim", "cell", "ring"]
        hosts = seat.where("own").select(*row, "part", F.explode(upto(F.col("tables"))).alias("table"), F.lit(True).alias("host"))
        visited = F.when(~F.col("own"), upto(F.col("parts"))).when(F.col("part") > 0, upto(F.col("part")))
        at = F.pmod(F.xxhash64("id", F.lit(1)), F.col("tables"))
        guests = seat.select(*row, F.explode(visited).alias("part"), at.alias("table"), F.lit(False).alias("host"))
        above = self.above

        def close(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            ids, many, host, x = [], [], [], []
            for batch in batches:
                ids.append(batch.column("id"))
                many.append(batch.column("many").to_numpy(zero_copy_only=False))
                host.append(batch.column("host").to_numpy(zero_copy_only=False))
                x.append(batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1))
            kind = ids[0].type
            ids, many, host, x = pa.concat_arrays(ids).to_numpy(zero_copy_only=False), np.concatenate(many), np.concatenate(host), np.concatenate(x).astype(np.float64)
            x /= np.linalg.norm(x, axis=1, keepdims=True)
            left, others = np.flatnonzero(host), np.flatnonzero(~host)
            # hosts meet one another at the first table
            for right, same in ((others, False), (left, True)) if key[-1].as_py() == 0 else ((others, False),):
                y = x[right]
                step = max(1, min(TILE, PRODUCT // max(1, len(y))))
                for k in range(0, len(left), step):
                    some = left[k : k + step]
                    r, c = np.nonzero(x[some] @ y.T > above)
                    r, c = some[r], right[c]
                    keep = ids[r] < ids[c] if same else ids[r] != ids[c]
                    r, c = r[keep], c[keep]
                    columns = [pa.array(f(ids[r], ids[c]), kind) for f in (np.minimum, np.maximum)]
                    yield pa.RecordBatch.from_arrays([*columns, pa.array(many[r] | many[c])], ["a", "b", "many"])

        met = hosts.unionByName(guests).groupBy("dim", "cell", "ring", "part", "table")
        return met.applyInArrow(close, f"a {self.kind}, b {self.kind}, many boolean")

    def sets(self, ident: str) -> DataFrame:
        return self.rows.join(self.kinds.select("v", F.col("id").alias("first")), "v").select(F.col("id").alias(ident), "first")


def vector_pairs(items: DataFrame, above: float = COSINE, ident: str = "seq", vector: str = "embedding") -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b), a before b, with cosine above the threshold (less than 1); exact.

    Equal vectors are one: the first item of each stands in the pairs, and the second table maps each item to it.  Vectors
    that are null or zero, or have parts that are null or no numbers, have no pair."""
    join = MetricJoin(items, above, ident, vector)
    return join.pairs().select("a", "b"), join.sets(ident)


def cosine_pairs(items: DataFrame, above: float = COSINE, ident: str = "seq", vector: str = "embedding") -> DataFrame:
    """All pairs (a, b) of items, a before b, with cosine above the threshold; see :func:`vector_pairs`."""
    join = MetricJoin(items, above, ident, vector)
    pairs = materialize(join.pairs(), "pairs")
    copied = join.kinds.where("many").select("v", F.col("id").alias("first"))
    sets = materialize(join.rows.join(copied, "v").select("id", "first"), "sets")
    left, right = sets.select(F.col("first").alias("a"), F.col("id").alias("x")), sets.select(F.col("first").alias("b"), F.col("id").alias("y"))
    # only pairs of vectors that several items have are joined with these
    met = pairs.where("many").join(left, "a", "left").join(right, "b", "left").select(F.coalesce("x", "a").alias("x"), F.coalesce("y", "b").alias("y"))
    across = met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
    same = left.join(right.withColumnRenamed("b", "a"), "a").where("x < y").select(F.col("x").alias("a"), F.col("y").alias("b"))
    return pairs.where("not many").select("a", "b").unionByName(across).unionByName(same)


def survivors(items: DataFrame, pairs: DataFrame, ident: str = "seq") -> DataFrame:
    """ident and survivor: itself if kept, else the first kept item that it is similar to. ``pairs`` (a, b) with a before b."""
    links = materialize(pairs.select("a", "b").distinct(), "pairs")
    some = links.select(F.col("a").alias(ident)).union(links.select("b")).distinct()
    return survivors_of_sets(items, [(links, some.withColumn("first", F.col(ident)))], ident)


def survivors_of_sets(items: DataFrame, channels: list[tuple[DataFrame, DataFrame]], ident: str = "seq") -> DataFrame:
    """As :func:`survivors`, for items that are similar if in one of the channels their sets are the same or a pair.

    A channel is a table of pairs (a, b) of sets and one of each item's set (ident, first), as :func:`token_pairs` and
    :func:`vector_pairs` give them.  A set keeps one item at most, so what a round knows of a set is its first open and its
    kept item: rows are items and pairs of sets, however many equal items there are.  A round keeps open items without an open
    or kept earlier neighbour, and drops those next to a kept one; the last few open rows are gone through in order by
    one task, so that a chain of copies doesn't cost a round for each."""
    member, beside = None, None
    for c, (pairs, sets) in enumerate(channels):
        own = sets.select(F.lit(c).alias("c"), F.col(ident).alias("at"), F.col("first").alias("s"))
        both = pairs.select("a", "b").union(pairs.select("b", "a")).union(sets.select("first", "first")).distinct().toDF("s", "t")
        both = both.select(F.lit(c).alias("c"), "s", "t")
        member, beside = (own, both) if member is None else (member.unionByName(own), beside.unionByName(both))
    kind = dict(member.dtypes)["at"]
    member, beside = materialize(member, "members"), materialize(beside, "beside")
    state = materialize(member.sparkSession.createDataFrame([], f"at {kind}, kept boolean"), "state")  # decided items only

    def known() -> DataFrame:
        """c, s and the first open and first kept item of the sets that a set is similar to."""
        told = member.join(state, "at", "left").groupBy("c", "s").agg(
            F.min(F.when(F.col("kept").isNull(), F.col("at"))).alias("open"), F.min(F.when(F.col("kept"), F.col("at"))).alias("held")
        )
        near = beside.join(told.withColumnRenamed("s", "t"), ["c", "t"]).groupBy("c", "s")
        return near.agg(F.min("open").alias("open"), F.min("held").alias("held"))

    def walk(_: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        held = {(c, s): at for c, s, at in frame.loc[frame["what"] == 1, ["c", "s", "at"]].itertuples(index=False)}
        near: dict[tuple, list] = {}
        for c, s, t in frame.loc[frame["what"] == 2, ["c", "s", "at"]].itertuples(index=False):
            near.setdefault((c, s), []).append((c, t))
        out = []
        for at, rows in frame[frame["what"] == 0].groupby("at", sort=True):
            own = list(rows[["c", "s"]].itertuples(index=False, name=None))
            kept = not any(t in held and held[t] < at for one in own for t in near[one])
            if kept:
                held |= dict.fromkeys(own, at)
            out.append((at, kept))
        return pd.DataFrame(out, columns=["at", "kept"])

    while True:
        todo = materialize(member.join(state.select("at"), "at", "left_anti"), "open")
        of = beside.join(todo.select("c", "s").distinct(), ["c", "s"])
        if (left := todo.count()) <= MOST_LOCAL and (left := left + of.limit(MOST_LOCAL + 1).count()) <= MOST_LOCAL:
            break
        each = todo.join(known(), ["c", "s"]).groupBy("at").agg(F.min("open").alias("open"), F.min("held").alias("held"))
        near_kept = F.coalesce(F.col("held") < F.col("at"), F.lit(False))
        new = each.where(near_kept | (F.col("open") >= F.col("at"))).select("at", (~near_kept).alias("kept"))
        state, before = materialize(state.unionByName(new), "state"), state
        discard(before)
        discard(todo)
    if left:
        held = member.join(state.where("kept"), "at").join(of.select("c", F.col("t").alias("s")).distinct(), ["c", "s"])
        rows = todo.select(F.lit(0).alias("what"), "c", "s", "at").union(held.select(F.lit(1), "c", "s", "at")).union(of.select(F.lit(2), "c", "s", "t"))
        state = materialize(state.unionByName(rows.withColumn("one", F.lit(0)).groupBy("one").applyInPandas(walk, f"at {kind}, kept boolean")), "state")
    gone = member.join(state.where("not kept").select("at"), "at").join(known(), ["c", "s"])
    first = gone.where(F.col("held") < F.col("at")).groupBy(F.col("at").alias("gone")).agg(F.min("held").alias("survivor"))
    return items.select(ident).join(first, F.col(ident) == F.col("gone"), "left").select(ident, F.coalesce("survivor", F.col(ident)).alias("survivor"))
