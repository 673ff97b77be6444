"""Score adjustments after recall: verdict decay, inheritance, grouping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MISS_DECAY = 0.3
MIN_CONFIDENCE = 0.7
EXACT, INHERITED = 1.0, 0.3


def relevance(rrf: Column, match: Column) -> Column:
    """Recall score, reduced where the judge saw no match."""
    return rrf * F.when(match, 1.0).otherwise(MISS_DECAY)


def soft_rerank(hits: DataFrame, order: list[Column]) -> DataFrame:
    """hits (sub_problem_id, rrf, match) plus relevance and its rank in the sub-problem; ``order`` breaks ties."""
    scored = hits.withColumn("relevance", relevance(F.col("rrf"), F.col("match")))
    window = Window.partitionBy("sub_problem_id").orderBy(F.desc("relevance"), *order)
    return scored.withColumn("local_rank", F.row_number().over(window))


def confident(hits: DataFrame, least: float = MIN_CONFIDENCE) -> DataFrame:
    """Hard filter of the batch path."""
    return hits.where(F.col("match") & (F.col("confidence") >= least))


def grouped(hits: DataFrame, order: str, fields: list[str], key: str = "trajectory_id") -> DataFrame:
    """One row per trajectory with its matched problems in arrival order."""
    return hits.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(order, *[f for f in fields if f != order]))).alias("matched_problems"))


def inherited_weight(labels: Column, target: Column, family: Column) -> Column:
    """1 for the label itself, less for its parent or siblings, 1 for slices without either."""
    labels = F.coalesce(labels, F.expr("cast(array() as array<string>)"))
    return (
        F.when(F.array_contains(labels, target), EXACT)
        .when(F.coalesce(F.arrays_overlap(labels, F.coalesce(family, F.expr("cast(array() as array<string>)"))), F.lit(False)), INHERITED)
        .otherwise(1.0)
    )


def rerank_with_inheritance(hits: DataFrame, order: list[Column]) -> DataFrame:
    """hits with labels, target_label, family and rrf: weighted score and rank."""
    weighted = hits.withColumn("weighted", F.col("rrf") * inherited_weight(F.col("capability_labels"), F.col("target_label"), F.col("family")))
    window = Window.partitionBy("target_label").orderBy(F.desc("weighted"), *order)
    return weighted.withColumn("rank", F.row_number().over(window))


def global_order(scored: DataFrame, keys: list[str]) -> DataFrame:
    """All sub-problems' rows by relevance, best first; ``keys`` (order of sub-problems, local rank) break ties."""
    return scored.orderBy(F.desc("relevance"), *keys)
