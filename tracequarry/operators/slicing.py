"""Cutting trajectories into slices at scored boundaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracequarry.functions import text

#: Trajectories up to this length stay whole; sizes of slices otherwise.
WHOLE, LEAST, MOST = 10, 4, 10


def tool_type(name: Column) -> Column:
    """What a tool is used for; null for other tools."""
    return (
        F.when(name.isin("Read", "Grep", "Glob", "WebFetch", "WebSearch"), "explore")
        .when(name.isin("Write", "Edit"), "modify")
        .when(name == "Bash", "verify")
    )


def boundary_scores(steps: DataFrame, key: str = "trajectory_id") -> DataFrame:
    """``steps`` plus ``boundary_score``: how well a slice would start there.

    The tool before is that of the nearest earlier call of the assistant; if its type is unknown, so
    is a change of type."""
    is_call = (F.col("role") == "assistant") & (F.coalesce("tool_call_name", F.lit("")) != "")
    kind = tool_type(F.col("tool_call_name"))
    before = Window.partitionBy(key).orderBy("step_index").rowsBetween(Window.unboundedPreceding, -1)
    last = F.last(F.when(is_call, F.struct(kind.alias("kind"))), ignorenulls=True).over(before)
    score = (
        F.when(F.col("role") == "user", 10).otherwise(0)
        + F.when(is_call & kind.isNotNull() & (last["kind"] != kind), 5).otherwise(0)
        + F.when((F.col("role") == "assistant") & text.is_transition(F.col("content")), 4).otherwise(0)
        + F.when(text.is_verification(F.col("tool_call_name"), F.col("tool_call_args")), 3).otherwise(0)
    )
    return steps.withColumn("boundary_score", F.when(F.col("step_index") == 0, 0).otherwise(score).cast("int"))


def cut_points(scores: str = "scores", n: str = "n") -> Column:
    """Starts of the slices, from the array of all steps' scores in order.

    From each cut the best boundary (then the first) of the next 4 to 10 steps is taken, or else the
    tenth step if there is one. A cut looks at those steps only."""
    window = f"transform(slice({scores}, acc.pos + {LEAST} + 1, {MOST - LEAST + 1}), (s, i) -> named_struct('score', s, 'back', -(acc.pos + {LEAST} + i)))"
    best = f"-array_max(filter({window}, x -> x.score > 0)).back"
    step = f"coalesce({best}, if(acc.pos + {MOST} < {n}, acc.pos + {MOST}, -1))"
    return F.expr(
        f"aggregate(sequence(0, cast({n} div {LEAST} as int)), named_struct('pos', 0, 'cuts', array(0), 'done', {n} <= {WHOLE}),"
        f" (acc, k) -> if(acc.done, acc, transform(array({step}), next ->"
        " if(next < 0, named_struct('pos', acc.pos, 'cuts', acc.cuts, 'done', true),"
        " named_struct('pos', next, 'cuts', concat(acc.cuts, array(next)), 'done', false)))[0]),"
        " acc -> acc.cuts)"
    )


def slice_bounds(steps: DataFrame, key: str = "trajectory_id") -> DataFrame:
    """key, slice_index, start_step, end_step; the slices of a trajectory cover its steps."""
    scored = boundary_scores(steps, key)
    each = F.sort_array(F.collect_list(F.struct("step_index", "boundary_score")))
    whole = scored.groupBy(key).agg(F.transform(each, lambda x: x["boundary_score"]).alias("scores"), F.count("*").cast("int").alias("n"))
    whole = whole.select(key, "n", cut_points().alias("cuts"))
    cuts = whole.select(key, "n", "cuts", F.posexplode("cuts").alias("slice_index", "start_step"))
    end = F.coalesce(F.get("cuts", F.col("slice_index") + 1), F.col("n")) - 1
    return cuts.select(key, "slice_index", "start_step", end.alias("end_step"))


def slices(steps: DataFrame, key: str = "trajectory_id") -> DataFrame:
    """Slices with their steps, in order. A step belongs to the last slice that starts at it or before."""
    bounds = slice_bounds(steps, key)
    bound = ["slice_index", "start_step", "end_step"]
    starts = bounds.select(key, F.col("start_step").alias("step_index"), F.struct(*bound).alias("own"))
    until = Window.partitionBy(key).orderBy("step_index").rowsBetween(Window.unboundedPreceding, 0)
    told = steps.join(starts, [key, "step_index"], "left").withColumn("own", F.last("own", ignorenulls=True).over(until))
    fields = ["step_index", "role", "content", "tool_call_name", "tool_call_args", "tool_result"]
    rows = told.select(key, *[F.col(f"own.{c}").alias(c) for c in bound], F.struct(*fields).alias("step"))
    return rows.groupBy(key, *bound).agg(F.sort_array(F.collect_list("step")).alias("steps"))
