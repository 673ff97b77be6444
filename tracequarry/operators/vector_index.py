"""Stored vector index: an inverted file of cells, searched exactly.

Centres are fitted on at most ``SAMPLE`` vectors (the smallest hashes of ids), every
usable vector is assigned to its nearest centre and stored with its angle to it.  Angles
obey the triangle inequality: a row at angle a to its centre is at least |q - a| from a
query at angle q to that centre.  A search reads the nearest cells, takes the cosine that
a sub-problem's last hit reaches, and then reads only cells, and scores only rows, that
can still reach it.  The result is that of scoring all rows.

Cells lie in folders of their own, so a cell that isn't wanted isn't read; a cell of any
size is written by several tasks, by ranges of the angle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tracequarry.functions import vectors as vx
from tracequarry.lineage import discard, materialize
from tracequarry.operators import recall
from tracequarry.operators.scoring import Heap, Scorer
from tracequarry.sources.stores import KeyedTable

#: Vectors that centres are fitted on, most cells of one length, rounds of fitting.
SAMPLE, MOST_CELLS, ROUNDS = 16_384, 1024, 8
#: Rows of the nearest cells that are read first, for each hit wanted.
AHEAD = 8
#: Rows that a task compares with all centres, or scores, at once.
TILE = 1024
#: Angles and cosines are compared with this much room for rounding.
ROOM = 1e-6


def centres(sample: np.ndarray, n: int) -> np.ndarray:
    """At most ``n`` unit vectors near which the sample's unit vectors gather."""
    rng = np.random.default_rng(7)
    found = sample[rng.permutation(len(sample))[:n]]
    for _ in range(ROUNDS):
        own = np.argmax(sample @ found.T, axis=1)
        sums = np.zeros_like(found)
        np.add.at(sums, own, sample)
        size = np.linalg.norm(sums, axis=1)
        found = np.where(size[:, None] > 1e-12, sums / np.maximum(size, 1e-12)[:, None], found)
    return found


def _unit(rows: pa.Array, dim: int) -> np.ndarray:
    x = rows.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    return x / np.linalg.norm(x, axis=1)[:, None]


class VectorIndex:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        #: Rows of the index, rows in cells that the last search read, and rows that it scored.
        self.rows = self.read = self.scored = 0

    def exists(self) -> bool:
        return KeyedTable(self.spark, f"{self.path}/cells", [], "").exists()

    def _centres(self) -> dict[int, np.ndarray]:
        out: dict[int, list] = {}
        for r in self.spark.read.parquet(f"{self.path}/centres").collect():  # at most MOST_CELLS of each length
            out.setdefault(r.dim, []).append((r.cell, r.centre))
        return {dim: np.array([c for _, c in sorted(each)]) for dim, each in out.items()}

    def append(self, rows: DataFrame, ident: str = "ingest_seq", vector: str = "embedding") -> None:
        """Add every usable vector (not null, zero or with parts that are no numbers); the first write fits the centres.

        A length that no centre has gets a centre of its own, its first axis."""
        usable = rows.where(vx.usable(F.col(vector))).select(F.col(ident).cast("long").alias("ident"), F.col(vector).cast("array<double>").alias("vector"))
        finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        usable = materialize(usable.where(finite).withColumn("dim", F.size("vector")), "vectors")
        new = KeyedTable(self.spark, self.path, [], "")._next_write()
        if not KeyedTable(self.spark, f"{self.path}/centres", [], "").exists():
            some = usable.orderBy(F.xxhash64("ident"), "ident").limit(SAMPLE).select("dim", "vector").collect()  # bounded
            total = dict(map(tuple, usable.groupBy("dim").count().collect()))
            table = []
            for dim in sorted({r.dim for r in some}):
                x = np.array([r.vector for r in some if r.dim == dim])
                x = centres(x / np.linalg.norm(x, axis=1)[:, None], min(MOST_CELLS, max(1, round(2 * total[dim] ** 0.5))))
                table += [(dim, cell, [float(v) for v in c]) for cell, c in enumerate(x)]
            self.spark.createDataFrame(table, "dim int, cell int, centre array<double>").coalesce(1).write.parquet(f"{self.path}/centres")
        sent = self.spark.sparkContext.broadcast(self._centres())

        def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in (b.slice(k, TILE) for b in batches for k in range(0, b.num_rows, TILE)):
                dims = batch.column("dim").to_numpy()
                cell, angle = np.zeros(len(dims), np.int32), np.zeros(len(dims))
                for dim in np.unique(dims).tolist():
                    some = np.flatnonzero(dims == dim)
                    x = _unit(batch.column("vector").take(pa.array(some)), dim)
                    near = x @ sent.value.get(dim, np.eye(1, dim)).T
                    cell[some] = np.argmax(near, axis=1)
                    angle[some] = np.arccos(np.clip(near[np.arange(len(some)), cell[some]], -1, 1))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell), pa.array(angle)], ["ident", "vector", "dim", "cell", "angle"])

        told = usable.mapInArrow(assign, "ident long, vector array<double>, dim int, cell int, angle double")
        told = told.repartitionByRange("dim", "cell", "angle").sortWithinPartitions("dim", "cell", "angle")
        told.write.partitionBy("dim", "cell").parquet(f"{self.path}/rows/write={new}")
        done = self._rows().where(F.col("write") == new)
        done.groupBy("dim", "cell").agg(F.count("*").alias("n"), F.min("angle").alias("low"), F.max("angle").alias("high")).write.parquet(f"{self.path}/cells/write={new}")
        discard(usable)

    def _rows(self) -> DataFrame:
        return self.spark.read.schema("ident long, vector array<double>, angle double, write int, dim int, cell int").parquet(f"{self.path}/rows")

    def search(self, queries: DataFrame, top_n: int = 20) -> DataFrame:
        """sub_problem_id, ident, cosine (the best of the sub-problem's vectors, above 0) and rank of the best rows; ties by id."""
        names, _, vectors = recall.stated(queries.withColumn("keywords", F.expr("cast(null as array<string>)")))
        kind = dict(queries.dtypes)["sub_problem_id"]
        scorer = Scorer([{} for _ in names], {}, vectors)
        if not scorer.units or not self.exists():
            return self.spark.createDataFrame([], f"sub_problem_id {kind}, ident long, cosine double, rank int")
        stored = self.spark.read.schema("n long, low double, high double, write int, dim int, cell int").parquet(f"{self.path}/cells")
        cells = stored.groupBy("dim", "cell").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high")).collect()
        writes = [r[0] for r in stored.select("write").distinct().collect()]
        self.rows, centres_ = sum(r.n for r in cells), self._centres()
        # the least angle that a row of a cell can have to a sub-problem's vectors
        reach = np.full((len(names), len(cells)), np.inf)
        turn: dict[tuple[int, int], list[tuple[int, float]]] = {}  # of a cell: sub-problem, angle of a vector to the centre
        for c, r in enumerate(cells):
            for i, v in scorer.units.get(r.dim, ()):
                at = centres_[r.dim][r.cell] if r.dim in centres_ else np.eye(1, r.dim)[0]
                q = float(np.arccos(np.clip(v @ at, -1, 1)))
                reach[i, c] = min(reach[i, c], max(0.0, r.low - q, q - r.high))
                turn.setdefault((r.dim, r.cell), []).append((i, q))
        size = np.array([r.n for r in cells])
        seen = np.zeros(reach.shape, bool)
        for i in range(len(names)):
            order = np.argsort(reach[i], kind="stable")
            enough = np.concatenate([[0], np.cumsum(size[order])])[:-1] < AHEAD * top_n
            seen[i, order[enough]] = True
        seen &= np.isfinite(reach)
        best = lambda: F.row_number().over(Window.partitionBy("i").orderBy(F.desc("cosine"), "ident"))
        none = np.full(len(names), np.pi / 2)
        found = materialize(self._scored(scorer, cells, writes, turn, seen, none, top_n).withColumn("rank", best()).where(F.col("rank") <= top_n), "found")
        far = none.copy()
        for r in found.where(F.col("rank") == top_n).select("i", "cosine").collect():  # at most a row for each sub-problem
            far[r.i] = np.arccos(np.clip(r.cosine, -1, 1))
        late = ~seen & (reach <= far[:, None] + ROOM)
        tally = self.spark.sparkContext.accumulator(0)
        more = self._scored(scorer, cells, writes, turn, late, far, top_n, tally)
        both = found.select("i", "ident", "cosine").unionByName(more)
        names_ = self.spark.createDataFrame(list(zip(range(len(names)), names)), f"i int, sub_problem_id {kind}")
        out = both.withColumn("rank", best()).where(F.col("rank") <= top_n).join(F.broadcast(names_), "i")  # the stated sub-problems
        out = materialize(out.select("sub_problem_id", "ident", "cosine", "rank"), "hits")
        self.read = int(size[(seen | late).any(axis=0)].sum())
        self.scored = int((seen * size).sum()) + tally.value
        discard(found)
        return out

    def _scored(self, scorer: Scorer, cells: list, writes: list, turn: dict, wanted: np.ndarray, far: np.ndarray, top_n: int, tally=None) -> DataFrame:
        """i, ident and cosine: each task's best rows of the wanted cells, for each sub-problem that wants the cell."""
        plan = {}
        for c, r in enumerate(cells):
            if (who := np.flatnonzero(wanted[:, c])).size:
                some = [(i, q) for i, q in turn[r.dim, r.cell] if wanted[i, c]]
                plan[r.dim, r.cell] = np.array([i for i, _ in some], np.int32), np.array([q for _, q in some])
        sent = self.spark.sparkContext.broadcast((scorer, plan, far))  # stated sub-problems x bounded cells
        named = F.concat_ws("/", "dim", "cell")
        rows = self._rows().where(F.col("write").isin(writes) & F.col("dim").isin(sorted({d for d, _ in plan})) & F.col("cell").isin(sorted({c for _, c in plan})))
        rows = rows.where(named.isin([f"{d}/{c}" for d, c in plan])).select("ident", "vector", "dim", "cell", "angle")

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            scorer, plan, far = sent.value
            units: dict[tuple[int, int], list] = {}
            for dim, each in scorer.units.items():
                for i, v in each:
                    units.setdefault((dim, i), []).append(v)
            heap = Heap(scorer.n, top_n)
            for batch in (b.slice(k, TILE) for b in batches for k in range(0, b.num_rows, TILE)):
                key = batch.column("dim").to_numpy().astype(np.int64) << 32 | batch.column("cell").to_numpy()
                angle, ident = batch.column("angle").to_numpy(), batch.column("ident").to_numpy()
                for one in np.unique(key).tolist():
                    dim, cell = one >> 32, one & 0xFFFFFFFF
                    some = np.flatnonzero(key == one)
                    x = _unit(batch.column("vector").take(pa.array(some)), dim)
                    turns: dict[int, list[float]] = {}
                    for i, q in zip(*(a.tolist() for a in plan.get((dim, cell), ()))):
                        turns.setdefault(i, []).append(q)
                    for i, qs in turns.items():
                        near = np.zeros(len(some), bool)
                        for q in qs:
                            near |= np.abs(angle[some] - q) <= far[i] + ROOM
                        if not near.any():
                            continue
                        if tally is not None:
                            tally.add(int(near.sum()))
                        cosine = np.max([np.einsum("ij,j->i", x[near], v, optimize=False) for v in units[dim, i]], axis=0)
                        good = cosine > 0
                        heap.add(i, cosine[good], ident[some][near][good], cosine[good], cosine[good])
            told = heap.told(0)
            yield pa.RecordBatch.from_arrays([told.column(c) for c in ("i", "ident", "cosine")], ["i", "ident", "cosine"])

        return rows.mapInArrow(work, "i int, ident long, cosine double")
