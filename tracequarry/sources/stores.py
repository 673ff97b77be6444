"""Keyed tables on shared storage: append, latest row of each key, upsert order.

A table is a folder of Parquet files; each write carries a growing ``write_seq``,
taken by creating a file of that number, so two writers never share one.  Reading
keeps a key's last write; compaction keeps nothing else.  Columns that later writes
add are null in earlier rows.
"""

from __future__ import annotations

from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class KeyedTable:
    def __init__(self, spark: SparkSession, path: str, keys: list[str], schema: str):
        self.spark, self.path, self.keys, self.schema = spark, path, keys, schema

    def _folder(self):
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.path)
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), path

    def _path(self, suffix: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path + suffix)

    def exists(self) -> bool:
        """Whether the table was ever written; a compaction that died before its last step is finished first."""
        fs, path = self._folder()
        if not fs.exists(path) and fs.exists(self._path(".compact/_SUCCESS")):
            fs.rename(self._path(".compact"), path)
        return fs.exists(path)

    def history(self) -> DataFrame:
        """All rows as written, with ``write_seq`` and ``row_seq``."""
        if not self.exists():
            return self.spark.createDataFrame([], f"{self.schema}, write_seq long, row_seq long")
        return self.spark.read.option("mergeSchema", "true").option("recursiveFileLookup", "true").parquet(self.path)

    def read(self) -> DataFrame:
        """The last row of each key; ``ingest_seq`` orders keys by their last write."""
        rows = self.history()
        values = [c for c in rows.columns if c not in (*self.keys, "write_seq", "row_seq")]
        last = rows.groupBy(*self.keys).agg(F.max_by(F.struct("write_seq", "row_seq", *values), F.struct("write_seq", "row_seq")).alias("r"))
        seq = (F.col("r.write_seq") * F.lit(1 << 40) + F.col("r.row_seq")).alias("ingest_seq")
        return last.select(*self.keys, *[F.col(f"r.{c}").alias(c) for c in values if c != "ingest_seq"], seq)

    def append(self, rows: DataFrame, order: str | None = None, batch: str | None = None) -> None:
        """Upsert: a key that is there moves to the end. ``order`` numbers the rows of this write.

        ``batch`` names a write that may be repeated: it keeps its number and its folder, so a repetition replaces what the
        first try wrote and changes nothing else."""
        number = F.col(order).cast("long") if order else F.monotonically_increasing_id()
        rows = rows.drop("ingest_seq") if order != "ingest_seq" else rows
        self.exists()
        told = lambda seq: rows.withColumns({"write_seq": F.lit(seq).cast("long"), "row_seq": number})
        if batch is None:
            told(self._next_write()).write.mode("append").parquet(self.path)
            return
        fs, folder = self._folder()[0], self._path(f".batches/{batch}")
        if not fs.exists(folder) or not fs.listStatus(folder):
            fs.create(self._path(f".batches/{batch}/{self._next_write()}")).close()
        told(min(int(f.getPath().getName()) for f in fs.listStatus(folder))).write.mode("overwrite").parquet(f"{self.path}/batch-{batch}")

    def _next_write(self) -> int:
        """A number that no other write has: the file system creates each number's file once only."""
        fs, _ = self._folder()
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        folder = path(f"{self.path}.writes")
        fs.mkdirs(folder)
        number = max((int(f.getPath().getName()) for f in fs.listStatus(folder)), default=0) + 1
        while not fs.createNewFile(path(folder, str(number))):
            number += 1
        return number

    def compact(self) -> None:
        """Keep only the last row of each key; no writer may be at work.

        The new table is whole before the old one goes; if the driver dies between the two, :meth:`exists` takes it up."""
        if not self.exists():
            return
        last = self.read().withColumns({"write_seq": F.shiftright("ingest_seq", 40), "row_seq": F.col("ingest_seq").bitwiseAND((1 << 40) - 1)})
        last.drop("ingest_seq").write.mode("overwrite").parquet(f"{self.path}.compact")
        fs, path = self._folder()
        fs.delete(path, True)
        fs.rename(self._path(".compact"), path)

    def get(self, **key) -> DataFrame:
        rows = self.history()
        for k, v in key.items():
            rows = rows.where(F.col(k) == v)
        return rows.orderBy(F.desc("write_seq"), F.desc("row_seq")).limit(1).drop("write_seq", "row_seq")

    def count(self) -> int:
        return self.history().select(*self.keys).distinct().count()

    def clear(self) -> None:
        fs, path = self._folder()
        fs.delete(path, True)
        for more in (".writes", ".batches", ".compact"):
            fs.delete(self._path(more), True)


class Table(Protocol):
    """What the engine asks of a table: rows are DataFrames, keys are upserted or appended."""

    def append(self, rows: DataFrame, order: str | None = None) -> None: ...

    def read(self) -> DataFrame: ...

    def count(self) -> int: ...

    def clear(self) -> None: ...


class MemoryTable:
    """Rows of one session without a folder, appended as they come; equal keys stay. For tests and single runs."""

    def __init__(self, spark: SparkSession, schema: str):
        self.spark, self.schema, self.parts = spark, schema, []

    def append(self, rows: DataFrame, order: str | None = None) -> None:
        number = F.col(order).cast("long") if order else F.monotonically_increasing_id()
        self.parts.append(rows.withColumn("ingest_seq", F.lit(len(self.parts)) * F.lit(1 << 40) + number))

    def read(self) -> DataFrame:
        rows = self.spark.createDataFrame([], f"{self.schema}, ingest_seq long")
        for part in self.parts:
            rows = rows.unionByName(part, allowMissingColumns=True)
        return rows

    def count(self) -> int:
        return self.read().count()

    def clear(self) -> None:
        self.parts = []


def open_stores(spark: SparkSession, root: str) -> dict[str, KeyedTable]:
    """The engine's tables below one folder."""
    verdict = "sub_problem_id string, trajectory_id string, slice_index int, match boolean, confidence double, spans array<struct<start_step:int,end_step:int>>, reasoning string, evidence_step int, criteria_hit array<string>"
    slices = "trajectory_id string, slice_index int"
    problems = "problem_id string, raw_question string, spec string, vector array<double>"
    return {
        "slices": KeyedTable(spark, f"{root}/slices", ["trajectory_id", "slice_index"], slices),
        "problems": KeyedTable(spark, f"{root}/problems", ["problem_id"], problems),
        "trajectories": KeyedTable(spark, f"{root}/trajectories", ["trajectory_id"], "trajectory_id string, raw string"),
        "verdicts": KeyedTable(spark, f"{root}/verdicts", ["sub_problem_id", "trajectory_id", "slice_index"], verdict),
        "jobs": KeyedTable(spark, f"{root}/jobs", ["job_id"], "job_id int, label string, priority int, status string, attempts int, error string"),
        "taxonomy": KeyedTable(spark, f"{root}/taxonomy", ["name"], "name string, version string, updated_at string"),
        "labels": KeyedTable(spark, f"{root}/labels", ["label"], "label string, parent string, new_root boolean, description string, keywords array<string>, description_embedding array<float>, taxonomy_extension boolean, created_at string"),
    }


def stats(stores: dict[str, KeyedTable]) -> dict[str, int]:
    """Rows of each table; a table that was never written has none."""
    return {name: table.count() if table.exists() else 0 for name, table in stores.items()}


def databases(spark: SparkSession, parent: str, current: str | None = None) -> list[dict]:
    """Folders of tables below ``parent``: name, path, bytes, problems, trajectories, is_current.

    A folder whose tables can't be read has no counts, and never stops the listing. Switching is opening another one."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(parent)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = []
    for status in fs.listStatus(folder) if fs.exists(folder) else []:
        if not status.isDirectory():
            continue
        path = status.getPath()
        row = {"name": path.getName(), "path": path.toString(), "size_bytes": fs.getContentSummary(path).getLength()}
        tables = open_stores(spark, path.toString())
        for name in ("problems", "trajectories"):
            try:
                row[name] = tables[name].count() if tables[name].exists() else None
            except Exception:  # a damaged table costs its own count only
                row[name] = None
        row["is_current"] = current is not None and jvm.org.apache.hadoop.fs.Path(current).getName() == path.getName()
        out.append(row)
    return sorted(out, key=lambda r: r["name"])
