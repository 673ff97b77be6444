"""Merging scored slices of several sub-problems, and composing the data set."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PK = ["trajectory_id", "slice_index"]


def trainable(scored: DataFrame) -> DataFrame:
    """Matches with a span to train on."""
    return scored.where(F.col("judge_match") & (F.size("spans") > 0))


def union_spans(lists: Column) -> Column:
    """Distinct spans of a list of lists, by start and end."""
    return F.sort_array(F.array_distinct(F.flatten(lists)))


def _ordered_union(lists: Column) -> Column:
    return F.array_distinct(F.flatten(lists))


def merge_by_slice(scored: DataFrame, order: str = "seq", extra: tuple[str, ...] = ()) -> DataFrame:
    """One row per slice: its sub-problems in order of arrival, best relevance of each and of all.

    Spans are united and sorted only where there is more than one row. ``extra`` columns, ``order`` and
    ``judge_match`` are those of the first row."""
    by_sub = scored.groupBy(*PK, "sub_problem_id").agg(F.max("relevance").alias("best"), F.min(order).alias("at"))
    subs = by_sub.groupBy(*PK).agg(F.sort_array(F.collect_list(F.struct("at", "sub_problem_id", "best"))).alias("subs"))
    members = F.sort_array(F.collect_list(F.struct(F.col(order).alias("at"), F.col("spans").alias("spans"), F.col("capability").alias("capability"))))
    rows = scored.groupBy(*PK).agg(
        members.alias("m"), F.min(order).alias(order), *[F.min_by(c, order).alias(c) for c in ("judge_match", *extra)]
    )
    spans = F.when(F.size("m") == 1, F.col("m")[0]["spans"]).otherwise(union_spans(F.transform("m", lambda x: x["spans"])))
    return rows.join(subs, PK).select(
        *PK,
        order,
        F.transform("subs", lambda x: x["sub_problem_id"]).alias("sub_problem_ids"),
        F.map_from_entries(F.transform("subs", lambda x: F.struct(x["sub_problem_id"], x["best"]))).alias("relevance_by_problem"),
        F.array_max(F.transform("subs", lambda x: x["best"])).alias("relevance"),
        spans.alias("spans"),
        _ordered_union(F.transform("m", lambda x: x["capability"])).alias("capability"),
        "judge_match",
        *extra,
    )


def absorb(merged: DataFrame, survivors: DataFrame) -> DataFrame:
    """Merged rows with a survivor each (``survivors``: order, survivor) become one row per survivor.

    Attribution, best relevance, spans and capabilities are united, the survivor's own first."""
    rows = merged.join(survivors, "seq")
    own = rows.where("seq = survivor").select(F.col("seq").alias("survivor"), *PK, "judge_match", "spans", *[c for c in ("embedding", "bm25_tokens") if c in merged.columns])
    rows = rows.withColumn("rank", F.when(F.col("seq") == F.col("survivor"), F.lit(-1).cast("long")).otherwise(F.col("seq").cast("long")))
    each = rows.select("survivor", "rank", F.explode("relevance_by_problem").alias("sub", "r"), F.col("sub_problem_ids").alias("ids"))
    best = each.groupBy("survivor", "sub").agg(F.max("r").alias("r"), F.min(F.struct("rank", F.array_position("ids", F.col("sub")).alias("at"))).alias("o"))
    subs = best.groupBy("survivor").agg(F.sort_array(F.collect_list(F.struct("o", "sub", "r"))).alias("subs"))
    lists = rows.groupBy("survivor").agg(
        F.count("*").alias("members"), F.sort_array(F.collect_list(F.struct("rank", F.col("capability").alias("c"), F.col("spans").alias("s")))).alias("m")
    )
    rest = [c for c in own.columns if c not in ("survivor", "spans", *PK)]
    return own.join(subs, "survivor").join(lists, "survivor").select(
        *PK,
        F.col("survivor").alias("seq"),
        F.transform("subs", lambda x: x["sub"]).alias("sub_problem_ids"),
        F.map_from_entries(F.transform("subs", lambda x: F.struct(x["sub"], x["r"]))).alias("relevance_by_problem"),
        F.array_max(F.transform("subs", lambda x: x["r"])).alias("relevance"),
        F.when(F.col("members") == 1, F.col("spans")).otherwise(union_spans(F.transform("m", lambda x: x["s"]))).alias("spans"),
        _ordered_union(F.transform("m", lambda x: x["c"])).alias("capability"),
        *rest,
    )


def manifest(selected: DataFrame, general_ratio: float = 0.25) -> DataFrame:
    """One row of counts. General data is not loaded, so its count is 0 and its share is a wish."""
    return selected.agg(F.count("*").alias("targeted_count")).select(
        "targeted_count",
        F.lit(0).cast("long").alias("general_count"),
        F.col("targeted_count").alias("total_count"),
        F.lit(general_ratio).alias("general_ratio"),
    )
