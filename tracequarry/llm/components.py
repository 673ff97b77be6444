"""Connected components of an edge table, as DataFrame operations.

Large-star and small-star steps in turn: every step joins each node with the
smallest of its neighbours, which halves what is left of long paths.  Minima are
aggregated before the shuffle and hubs' minima are broadcast, so no task reads a
hub's edges, and each round is written to the shared folder: lost executors cost no
earlier round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracequarry.lineage import discard, materialize


#: A key with more rows than this, and than all rows divided by ``MOST_HUBS``, is a hub: there are at most ``MOST_HUBS`` of them.
HUB_ROWS, MOST_HUBS = 500, 100_000


def with_values(rows: DataFrame, table: DataFrame, key: str, total: int) -> DataFrame:
    """``rows`` plus the columns of ``table`` (a row for each ``key``, and ``__n``, how many of ``rows`` have it).

    Rows of a hub get its values from a broadcast of bounded size and stay where they are; only rows of other keys are
    dealt out by key, so no task reads more than a hub's bound for one key. ``total``: number of rows, or more."""
    bound = max(HUB_ROWS, total // MOST_HUBS)
    values = [c for c in table.columns if c not in (key, "__n")]
    table = table.withColumnRenamed(key, "__key")
    hubs = table.where(F.col("__n") > bound).select("__key", F.struct(*values).alias("__hub"))
    told = rows.join(F.broadcast(hubs), F.col(key) == F.col("__key"), "left").drop("__key")
    columns = [F.col(c) for c in rows.columns]
    hot = told.where("__hub is not null").select(*columns, *[F.col("__hub")[v].alias(v) for v in values])
    cold = told.where("__hub is null").join(table.where(F.col("__n") <= bound), F.col(key) == F.col("__key"))
    return hot.unionAll(cold.select(*columns, *values))


def with_least(rows: DataFrame, key: str, value: str, name: str, total: int) -> DataFrame:
    """``rows`` plus ``name``, the least ``value`` of the rows of the same ``key``; minima are aggregated before they move."""
    return with_values(rows, rows.groupBy(key).agg(F.min(value).alias(name), F.count("*").alias("__n")), key, total)


def _large(edges: DataFrame, total: int) -> DataFrame:
    """Larger neighbours of each node move to the smallest of its neighbourhood."""
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    near = with_least(both, "u", "v", "m", 2 * total).select("u", "v", F.least("u", "m").alias("m"))
    return near.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")


def _small(edges: DataFrame, total: int) -> DataFrame:
    """Smaller neighbours of each node, and itself, move to the smallest of them."""
    near = with_least(edges, "u", "v", "m", total)
    moved = near.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(near.where("v = m").select("u", "v"))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for each node that has an edge; root is the smallest node that it reaches.

    Null ends and loops are ignored, repeated edges harmless; no edges give no rows."""
    big, small = F.greatest(a, b), F.least(a, b)
    now = edges.where(F.col(a) != F.col(b)).select(big.alias("u"), small.alias("v")).distinct()
    now, before = materialize(now, "edges"), None
    total = now.count()
    while True:
        moved = materialize(_large(now, total).distinct(), "edges")
        new = materialize(_small(moved, moved.count()).distinct(), "edges")
        discard(moved)
        state = new.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        discard(now)
        now, total = new, state[0]
        if state == before:
            break
        before = state
    roots = now.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(roots)
