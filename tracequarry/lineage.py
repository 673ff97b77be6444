"""Cutting lineage through the folder that all executors share.

A query that needs a result more than once writes it as Parquet below
``spark.checkpoint.dir`` and reads it again.  Unlike ``Dataset.checkpoint``
this computes the result once, lets later reads prune columns, and a lost
executor costs nothing: the files are in shared storage.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; a temporary one only where it is unset and all runs on one machine."""
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not folder and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if not folder:
        folder = tempfile.mkdtemp(prefix="tracequarry-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder, deleted when the driver ends."""
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path


def materialize(df: DataFrame, label: str = "step") -> DataFrame:
    """``df`` written once to the shared folder and read back; deleted when the driver ends."""
    spark = df.sparkSession
    path = scratch(spark, label)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._tracequarry_path = path
    return out


def discard(df: DataFrame | None) -> None:
    """Delete what :func:`materialize` wrote for ``df``; nothing may read it afterwards."""
    path = getattr(df, "_tracequarry_path", None)
    if path:
        spark = df.sparkSession
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
