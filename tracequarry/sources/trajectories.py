"""Lenient scans of agent logs: JSON lines to trajectories, trajectories to steps.

A bad line never stops a scan.  File, line and slice order are kept in
``ingest_seq``, as results break ties by arrival.
"""

from __future__ import annotations

import hashlib
import json

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tracequarry.schemas import ROLES
from tracequarry.sources import log_source

CALL = "struct<id:string,type:string,name:string,arguments:string,`function`:struct<name:string,arguments:string>>"
MESSAGE = "struct<role:string,content:string,tool_call_id:string,tool_calls:array<string>>"


@F.pandas_udf(StringType())
def surrogate_id(record: pd.Series) -> pd.Series:
    """Id of a record without one: hash of its canonical JSON (key order and spacing are not Spark's)."""

    def one(text: str) -> str:
        canonical = json.dumps(json.loads(text), sort_keys=True)
        return "traj_" + hashlib.sha256(canonical.encode()).hexdigest()[:16]

    return record.map(lambda text: None if text is None else one(text))


def parse_records(lines: DataFrame) -> DataFrame:
    """``value`` lines (with any order columns) to trajectory_id, messages, raw and ingest order.

    Lines that are blank, no JSON object, or without a list of messages are skipped."""
    body = F.regexp_replace(F.col("value"), r"(?U)^\s+|\s+$", "")
    rows = lines.withColumn("raw", body).where("raw like '{%'")
    rows = rows.withColumn("parsed", F.from_json("raw", "struct<id:string,messages:array<string>>"))
    listed = F.get_json_object("raw", "$.messages").startswith("[")
    rows = rows.where(F.expr("try_parse_json(raw) is not null") & listed & F.col("parsed.messages").isNotNull())
    has_id = F.array_contains(F.expr("json_object_keys(raw)"), "id")
    own = F.when(has_id, F.col("parsed.id")).otherwise(surrogate_id(F.when(~has_id, F.col("raw"))))  # others are not sent
    messages = F.transform("parsed.messages", lambda m: F.from_json(m, MESSAGE))
    return rows.select(*[c for c in lines.columns if c != "value"], own.alias("trajectory_id"), messages.alias("messages"), "raw")


def scan_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """Trajectories of a file or folder of JSON lines, in file and line order."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("line"))
    return parse_records(lines).withColumn("trajectory_path", F.col("file"))


def scan_log(spark: SparkSession, path: str, range_bytes: int = log_source.RANGE_BYTES) -> DataFrame:
    """As :func:`scan_jsonl`, by ranges of bytes: ``line`` is where the line begins, so the order doesn't depend on the tasks."""
    lines = log_source.read_lines(spark, path, range_bytes)
    return parse_records(lines.withColumnRenamed("offset", "line")).withColumn("trajectory_path", F.col("file"))


def _call(text: Column) -> Column:
    return F.from_json(text, CALL)


def steps(trajectories: DataFrame, key: str = "trajectory_id") -> DataFrame:
    """One row per step: an assistant's calls are a step each and share its content.

    Messages that are no objects or of another role take no number."""
    others = [c for c in trajectories.columns if c not in ("messages", "raw")]
    each = trajectories.select(*others, F.posexplode("messages").alias("pos", "m")).where(F.col("m.role").isin(*ROLES))
    calls = F.when(F.col("m.role") == "assistant", F.col("m.tool_calls"))
    each = each.select(*others, "pos", "m", F.posexplode_outer(F.when(F.size(calls) > 0, calls)).alias("call_pos", "call_text"))
    call = _call(F.col("call_text"))
    content = F.coalesce(F.col("m.content"), F.lit(""))
    each = each.select(
        *others,
        "pos",
        F.coalesce("call_pos", F.lit(0)).alias("call_pos"),
        F.col("m.role").alias("role"),
        content.alias("content"),
        F.coalesce(call["function"]["name"], call["name"]).alias("tool_call_name"),
        F.coalesce(call["function"]["arguments"], call["arguments"]).alias("tool_call_args"),
        F.when(F.col("m.role") == "tool", content).alias("tool_result"),
    )
    # a trajectory is one row of the source, so this window is bounded by a line of input
    order = Window.partitionBy(key).orderBy("pos", "call_pos")
    return each.withColumn("step_index", F.row_number().over(order) - 1).drop("pos", "call_pos")
