"""The log of runs: events in order, states, and which runs are kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracequarry.operators.evaluation import KEPT_RUNS, retained_runs
from tracequarry.sources.stores import KeyedTable


class RunLog:
    """Events of runs in a keyed table; a run is over with its ``done`` or ``error`` event."""

    def __init__(self, spark: SparkSession, root: str):
        self.table = KeyedTable(spark, f"{root}/events", ["run_id", "seq"], "run_id string, seq long, kind string, payload string, at string")

    def append(self, events: DataFrame) -> None:
        """Events (run_id, seq, kind, payload, at); writing one twice is harmless."""
        self.table.append(events.select("run_id", "seq", "kind", "payload", "at"))

    def events(self, run_id: str, after: int = -1) -> DataFrame:
        """A run's events behind ``after``, in order."""
        return self.table.read().where((F.col("run_id") == run_id) & (F.col("seq") > after)).select("seq", "kind", "payload", "at").orderBy("seq")

    def runs(self) -> DataFrame:
        """run_id, events, status and finished_at (null: running)."""
        over = F.col("kind").isin("done", "error")
        return self.table.read().groupBy("run_id").agg(
            F.count("*").alias("events"), F.coalesce(F.max(F.when(over, F.col("kind"))), F.lit("running")).alias("status"), F.max(F.when(over, F.col("at"))).alias("finished_at")
        )

    def kept(self, most: int = KEPT_RUNS) -> DataFrame:
        return retained_runs(self.runs(), most)
