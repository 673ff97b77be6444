"""Quality of labels: expected against produced items, routes, drift between runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: An expected label that any proposed label satisfies.
ANY_NEW = "__NEW__"
#: Finished runs that are kept.
KEPT_RUNS = 50


def label_hits(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Expected rows (case_id, labels) that share a label with a produced row of their case.

    ``actual``: case_id, labels and is_new, true if the row proposes a label of its own."""
    e, a = expected.alias("e"), actual.alias("a")
    shared = F.coalesce(F.arrays_overlap("e.labels", "a.labels"), F.lit(False))
    fresh = F.array_contains("e.labels", ANY_NEW) & F.col("a.is_new")
    return e.join(a, (F.col("e.case_id") == F.col("a.case_id")) & (shared | fresh), "left_semi")


def route_score(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Per case: how many routes agree, counting each route as often as both sides have it."""
    key = ["case_id", "route"]
    want = expected.groupBy(*key).agg(F.count("*").alias("w"))
    got = actual.groupBy(*key).agg(F.count("*").alias("g"))
    return want.join(got, key, "left").groupBy("case_id").agg(F.sum(F.least("w", F.coalesce("g", F.lit(0)))).alias("agreed"), F.sum("w").alias("expected"))


def totals(scores: DataFrame) -> DataFrame:
    """One row: agreed, expected and accuracy with three decimals."""
    both = scores.agg(F.coalesce(F.sum("agreed"), F.lit(0)).alias("agreed"), F.coalesce(F.sum("expected"), F.lit(0)).alias("expected"))
    return both.withColumn("accuracy", F.round(F.col("agreed") / F.greatest("expected", F.lit(1)), 3))


def drift(runs: DataFrame) -> DataFrame:
    """case_id and the share of its runs that have its most common signature."""
    counts = runs.groupBy("case_id", "signature").agg(F.count("*").alias("n"))
    return counts.groupBy("case_id").agg((F.max("n") / F.sum("n")).alias("stability"))


def retained_runs(runs: DataFrame, keep: int = KEPT_RUNS) -> DataFrame:
    """Running runs, and of the finished ones the latest ``keep``."""
    finished = runs.where("finished_at is not null").orderBy(F.desc("finished_at"), "run_id").limit(keep)
    return runs.where("finished_at is null").unionByName(finished)
