"""Inspection views: hits of each sub-problem with selection flags, spans, colours."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PALETTE_SIZE = 10


def inspector(problems: DataFrame, scored: DataFrame, selected: DataFrame, order: str = "seq") -> DataFrame:
    """First matching row with spans of each (sub-problem, slice), flagged if its slice was selected."""
    hits = scored.where(F.col("judge_match") & (F.size("spans") > 0))
    first = Window.partitionBy("sub_problem_id", "trajectory_id", "slice_index").orderBy(order)
    hits = hits.withColumn("__r", F.row_number().over(first)).where("__r = 1").drop("__r")
    chosen = selected.select("trajectory_id", "slice_index").distinct().withColumn("selected", F.lit(True))
    joined = problems.join(hits, "sub_problem_id").join(chosen, ["trajectory_id", "slice_index"], "left")
    return joined.withColumn("selected", F.coalesce("selected", F.lit(False)))


def color_index(labels: DataFrame) -> DataFrame:
    """label and its colour: distinct labels in order, round the palette. Labels of a taxonomy are few."""
    order = Window.orderBy("label")
    return labels.select("label").distinct().withColumn("color", (F.row_number().over(order) - 1) % PALETTE_SIZE)


def steps_in_spans(steps: DataFrame, spans: DataFrame, key: str, at: str = "step_index") -> DataFrame:
    """Steps that lie in a span of their trajectory (both ends included), once per span; null ends have no step.

    A span of n steps lies in one or two bins of the least power of two that is no less than n (from 2 on), a step in one bin of each width
    that the spans of its trajectory have: those meet by equality, so a step meets spans near it only."""
    size = F.col("end_step").cast("long") - F.col("start_step").cast("long") + 1
    width = F.call_function("shiftleft", F.lit(1).cast("long"), F.length(F.bin(size - 1)))
    low, high = (F.floor(F.col(c).cast("long") / F.col("__width")).cast("long") for c in ("start_step", "end_step"))
    told = spans.where("start_step <= end_step").withColumn("__width", width).withColumn("__bin", F.explode(F.array_distinct(F.array(low, high))))
    widths = told.groupBy(key).agg(F.collect_set("__width").alias("__widths"))  # at most one for each power of two
    binned = steps.join(widths, key).withColumn("__width", F.explode("__widths")).drop("__widths")
    binned = binned.withColumn("__bin", F.floor(F.col(at).cast("long") / F.col("__width")).cast("long"))
    within = F.col(at).between(F.col("start_step"), F.col("end_step"))
    return binned.join(told, [key, "__width", "__bin"]).where(within).drop("__width", "__bin")


def capability_hits(hits: DataFrame) -> DataFrame:
    """One row per slice with the capabilities and distinct sorted spans of all its hits."""
    return hits.groupBy("trajectory_id", "slice_index").agg(
        F.sort_array(F.collect_set("label")).alias("labels"), F.sort_array(F.array_distinct(F.flatten(F.collect_list("spans")))).alias("spans")
    )


def trajectory_index(trajectories: DataFrame) -> DataFrame:
    """The last arrived row of each trajectory id."""
    return trajectories.groupBy("trajectory_id").agg(F.max_by("steps", "ingest_seq").alias("steps"), F.max("ingest_seq").alias("ingest_seq"))


def span_key(start: Column, end: Column) -> Column:
    return F.concat_ws("-", start.cast("string"), end.cast("string"))


def capability_counts(hits: DataFrame) -> DataFrame:
    """sub_problem_id, label, hit_count: each target capability has all distinct slices of its sub-problem's hits.

    ``hits``: sub_problem_id, target_capability, trajectory_id, slice_index, judge_match, spans."""
    good = hits.where(F.col("judge_match") & (F.size("spans") > 0))
    slices = good.select("sub_problem_id", "trajectory_id", "slice_index").distinct().groupBy("sub_problem_id").agg(F.count("*").alias("n"))
    labels = hits.select("sub_problem_id", F.explode("target_capability").alias("label")).distinct()
    return labels.join(slices, "sub_problem_id", "left").select("sub_problem_id", "label", F.coalesce("n", F.lit(0).cast("long")).alias("hit_count"))
