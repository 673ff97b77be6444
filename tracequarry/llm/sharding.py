"""Sharding by jump consistent hashing.

A row's shard follows from its stable key and the number of shards alone: no ring
table, no state.  With one more shard a row stays where it is or moves into the
new shard.  Slots number the rows of a shard without gaps; they come from counts
by (bucket, shard), so no task sees a whole shard.

A null key hashes like any other value; null text has no bytes (size 16) and the
CRC of an empty text.  Repeated rows get slots of their own.  An empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from tracequarry.lineage import materialize

SHARDS = 40
#: What a row takes besides its text.
ROW_BYTES = 16
#: Rows of a bucket in which slots are counted, on average.
BUCKET_ROWS = 200_000


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each unsigned 64-bit key: each jump goes to the next count of shards that moves the key."""
    if shards < 1:
        raise ValueError("at least one shard is needed")
    state = keys.astype(np.uint64)
    at, goal = np.zeros(len(state), np.int64), np.zeros(len(state), np.int64)
    active = np.arange(len(state))
    with np.errstate(over="ignore"):
        while len(active):
            at[active] = goal[active]
            state[active] = state[active] * np.uint64(2862933555777941757) + np.uint64(1)
            draw = (state[active] >> np.uint64(33)).astype(np.float64) + 1
            goal[active] = np.floor((at[active] + 1) * (2147483648.0 / draw)).astype(np.int64)
            active = active[goal[active] < shards]
    return at.astype(np.int32)


def shard_of(key: Column, shards: int) -> Column:
    """Jump hash of a column's 64-bit hash, an Arrow function of longs: texts stay in the JVM.

    Numbers are hashed as longs, so a column that is widened keeps its shards; other types by their text."""

    @F.pandas_udf("int")
    def assign(hashed: pd.Series) -> pd.Series:
        return pd.Series(jump(hashed.to_numpy().view(np.uint64), shards))

    return assign(F.xxhash64(key))


def stable(docs: DataFrame, name: str) -> Column:
    """A key column in the type that it is hashed in."""
    kind = docs.schema[name].dataType
    return F.col(name).cast("long" if isinstance(kind, IntegralType) else "string")


def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """One row per document: size, CRC, shard, slot and the shard that one more shard would give."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        shard_of(stable(docs, "doc_id"), shards).alias("shard"),
        shard_of(stable(docs, "doc_id"), shards + 1).alias("grown_shard"),
        F.xxhash64("doc_id", F.monotonically_increasing_id()).alias("deal"),  # parts equal rows as well
    )
    rows = materialize(rows, "shards")
    buckets = max(64, rows.count() // BUCKET_ROWS)
    rows = rows.withColumn("bucket", F.pmod("deal", F.lit(buckets)))
    counts = rows.groupBy("bucket", "shard").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select("bucket", "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    within = Window.partitionBy("bucket", "shard").orderBy("doc_id", "deal")
    ranked = rows.withColumn("r", F.row_number().over(within)).join(firsts, ["bucket", "shard"])
    slot = (F.col("first") + F.col("r") - 1).cast("long")
    return ranked.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", slot.alias("slot"), "grown_shard")
