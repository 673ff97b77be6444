"""Scans of query inputs: manifests, problem specs, taxonomies, failure evidence."""

from __future__ import annotations

import os
import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tracequarry import schemas
from tracequarry.functions import text as tx


def manifest_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """question and failure_trajectory of each line that isn't blank.

    A JSON object with a non-empty text ``question`` is read as one; any other line is the question."""
    line = F.regexp_replace(F.col(column), r"(?U)^\s+|\s+$", "")
    rows = lines.withColumn("line", line).where("line <> ''")
    variant = F.when(F.col("line").startswith("{"), F.expr("try_parse_json(line)"))
    kind = F.schema_of_variant(F.try_variant_get(variant, "$.question", "variant"))
    question = F.try_variant_get(variant, "$.question", "string")
    structured = F.coalesce((kind == "STRING") & (question != ""), F.lit(False))
    path_kind = F.schema_of_variant(F.try_variant_get(variant, "$.failure_trajectory", "variant"))
    path = F.when(structured & (path_kind == "STRING"), F.try_variant_get(variant, "$.failure_trajectory", "string"))
    keep = [c for c in lines.columns if c != column]
    return rows.select(*keep, F.when(structured, question).otherwise(F.col("line")).alias("question"), path.alias("failure_trajectory"))


def check_sub_problem(item: dict) -> dict:
    """The item if it keeps the contract, else ``ValueError``. Unset parts are None."""
    required = ("id", "origin", "raw_text", "failure_summary", "target_capability", "trajectory_signal", "hyde_positive", "keywords", "structured_filters", "confidence", "route")
    missing = [k for k in required if k not in item]
    if missing:
        raise ValueError(f"missing {missing}")
    filters = item["structured_filters"] or {}
    tests = [
        (item["origin"] in ("original", "clarified"), "origin"),
        (item["origin"] != "clarified" or item.get("parent_id"), "parent_id"),
        (1 <= len(item["target_capability"]) <= 3, "target_capability"),
        (2 <= len(item["hyde_positive"]) <= 3, "hyde_positive"),
        (0.0 <= item["confidence"] <= 1.0, "confidence"),
        (item["route"] == "pass", "route"),
        (set(filters.get("languages") or ()) <= set(schemas.LANGUAGES), "languages"),
        (set(filters.get("tools_used") or ()) <= set(schemas.TOOLS_USED), "tools_used"),
        (not item.get("rubric") or item["rubric"].get("capability_kind") in schemas.CAPABILITY_KINDS, "capability_kind"),
    ]
    for ok, name in tests:
        if not ok:
            raise ValueError(f"{name} breaks the contract: {item.get(name)!r}")
    return item


def scan_specs(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Sub-problems of spec files, one row each, ids prefixed to be unique; a bad spec stops the query."""
    specs = spark.read.schema(schemas.PROBLEM_SPEC).json(path, multiLine=multi_line).withColumn("file", F.col("_metadata.file_path"))
    each = specs.select("file", F.explode("sub_problems").alias("s")).select("file", "s.*")

    def within(values: str, known) -> Column:
        return F.coalesce(F.forall(values, lambda x: F.coalesce(x.isin(*known), F.lit(False))), F.lit(True))

    ok = (
        F.col("origin").isin("original", "clarified")
        & F.size("target_capability").between(1, 3)
        & F.size("hyde_positive").between(2, 3)
        & F.col("confidence").between(0, 1)
        & (F.col("route") == "pass")
        & ((F.col("origin") != "clarified") | (F.coalesce("parent_id", F.lit("")) != ""))
        & within("structured_filters.languages", schemas.LANGUAGES)
        & within("structured_filters.tools_used", schemas.TOOLS_USED)
        & (F.col("rubric").isNull() | F.coalesce(F.col("rubric.capability_kind").isin(*schemas.CAPABILITY_KINDS), F.lit(False)))
    )
    checked = F.when(F.coalesce(ok, F.lit(False)), F.col("id")).otherwise(F.raise_error(F.concat(F.lit("sub-problem breaks the contract: "), F.coalesce("id", F.lit("?")))))
    return each.withColumn("id", checked)


def scan_taxonomy(spark: SparkSession, path: str) -> DataFrame:
    """Labels of a taxonomy file, in order, with its version."""
    rows = spark.read.schema(schemas.TAXONOMY).json(path, multiLine=True)
    each = rows.select("version", F.posexplode("labels").alias("ord", "l")).select("version", "ord", "l.*")
    none = F.expr("cast(array() as array<string>)")
    return each.withColumns(
        {
            "keywords": F.coalesce("keywords", none),
            "description": F.coalesce("description", F.lit("")),
            "new_root": F.coalesce("new_root", F.lit(False)),
            "taxonomy_extension": F.coalesce("taxonomy_extension", F.lit(False)),
        }
    )


def write_taxonomy(labels: DataFrame, version: str, updated_at: str, path: str) -> None:
    """One JSON document in the contract's layout; a taxonomy is a few hundred labels."""
    fields = ["label", "parent", "new_root", "description", "keywords", "description_embedding", "taxonomy_extension", "created_at"]
    one = labels.groupBy().agg(F.sort_array(F.collect_list(F.struct("ord", *fields))).alias("l"))
    whole = one.select(F.lit(version).alias("version"), F.lit(updated_at).alias("updated_at"), F.transform("l", lambda x: F.struct(*[x[f].alias(f) for f in fields])).alias("labels"))
    whole.write.mode("overwrite").json(path)


def failure_evidence(slices: DataFrame, order: list[str]) -> DataFrame:
    """``evidence``: summaries of the first three slices that have one, cut to 4000 characters.

    It goes into prompts only and never into a table of positives."""
    rows = slices.withColumn("body", tx.summary(F.col("steps"))).where("body <> ''")
    first = rows.orderBy(*order).limit(3).withColumn("at", F.row_number().over(Window.orderBy(*order)))
    block = F.concat(F.lit("[trajectory_id: "), F.col("trajectory_id"), F.lit("]\n"), F.col("body"))
    joined = first.groupBy().agg(F.sort_array(F.collect_list(F.struct("at", block.alias("b")))).alias("blocks"))
    whole = F.array_join(F.transform("blocks", lambda x: x["b"]), "\n\n")
    cut = F.when(F.length(whole) > 4000, F.concat(F.substring(whole, 1, 4000), F.lit("\n...(截断)"))).otherwise(whole)
    return joined.where(F.size("blocks") > 0).select(cut.alias("evidence"))


def home(given: str | None = None) -> str:
    """Folder of the engine's tables: given, or named by the environment, or below the user's data folder."""
    base = os.environ.get("XDG_DATA_HOME") or os.path.join(os.path.expanduser("~"), ".local", "share")
    return given or os.environ.get("TRACEQUARRY_HOME") or os.path.join(base, "tracequarry")


def strip_fence(answer: str) -> str:
    """The inside of an answer that starts with a Markdown fence."""
    lines = answer.strip().split("\n")
    if not lines[0].startswith("```"):
        return answer
    end = next((i for i in range(len(lines) - 1, 0, -1) if re.fullmatch(r"\s*```\s*", lines[i])), len(lines))
    return "\n".join(lines[1:end])


def prefixed(column: Column, prefix: Column) -> Column:
    """Sub-problem ids that are unique over questions."""
    return F.concat(prefix, F.lit("."), column)
