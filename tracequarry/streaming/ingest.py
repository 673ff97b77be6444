"""Incremental ingest: new log files become signed slices as they arrive."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tracequarry.lineage import discard, materialize
from tracequarry.operators.signatures import Embedder
from tracequarry.plans.curation import sign
from tracequarry.sources import stores, trajectories


def stream_ingest(spark: SparkSession, source: str, root: str, checkpoint: str, embedder: Embedder | None = None) -> StreamingQuery:
    """Read the files that are new in ``source``, then stop: their trajectories and slices are upserted.

    A batch is written under its own name, so one that runs again after a failure replaces what it wrote before."""
    lines = spark.readStream.text(source).select("value", F.col("_metadata.file_path").alias("file"))
    return lines.writeStream.foreachBatch(batch_writer(spark, root, checkpoint, embedder)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def batch_writer(spark: SparkSession, root: str, checkpoint: str, embedder: Embedder | None = None) -> Callable[[DataFrame, int], None]:
    """What a stream with this checkpoint does with each of its batches."""
    tables, stream = stores.open_stores(spark, root), hashlib.sha1(checkpoint.encode()).hexdigest()[:12]

    def write(batch: DataFrame, number: int) -> None:
        found = trajectories.parse_records(batch.withColumn("line", F.monotonically_increasing_id()))
        last = found.groupBy("trajectory_id").agg(*[F.max_by(c, F.struct("file", "line")).alias(c) for c in ("messages", "raw", "file")])
        last = materialize(last, "batch")
        name = f"{stream}-{number}"
        tables["trajectories"].append(last.select("trajectory_id", "raw", F.col("file").alias("trajectory_path")), batch=name)
        tables["slices"].append(sign(last, embedder), batch=name)
        discard(last)

    return write
