"""Agent logs as a Spark data source: lines of files, read by ranges of bytes, in batches or as a stream.

``spark.read.format("agent_log").load(path)`` has a row for each line: value, file and
offset (the byte at which the line begins), so (file, offset) is the order of arrival whatever
the tasks.  A line belongs to the range in which it begins and is read to its end there, so
files of any size are split and no line is lost or read twice.

What isn't wanted is left out where the source is loaded, by options: files whose names don't fit aren't opened, ranges
that lie outside the bounds of ``offset`` aren't planned.  ``where`` isn't pushed to the source: Spark 4.1 keeps one reader for a
loaded frame, so what one query had pushed would be missing in the next query of the same frame.

As a stream it reads complete lines (up to the last line end) that are behind
the bytes read before, of new files and of files that have grown; what a batch holds is fixed by its offsets, so it
can run again.

Options: ``path`` (a file, or a folder whose files are read, those that begin with a dot or an underscore aside),
``range_bytes``, and for batches ``names`` (a pattern), ``from_offset`` and ``to_offset`` (not included).  Bytes that are no UTF-8 become the replacement character; a carriage return before the line end is cut off.
Paths are those that ``pyarrow.fs`` knows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fnmatch import fnmatchcase

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

SCHEMA = "value string, file string, offset bigint"
#: Bytes of a range, of a read, and of rows that go to Spark at once.
RANGE_BYTES, READ_BYTES, BATCH_BYTES = 64 << 20, 1 << 20, 4 << 20


@dataclass
class Range(InputPartition):
    file: str
    start: int
    end: int


def open_path(path: str) -> tuple[fs.FileSystem, str, str]:
    """File system, path in it, and what has to stand before its paths to name them from outside."""
    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path, ""
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/"), ""
    system, inner = fs.FileSystem.from_uri(path)
    return system, inner, path[: path.index(inner)] if inner in path else path.split("://")[0] + "://"


def list_files(path: str) -> dict[str, int]:
    """Sizes of the files that a path stands for, by name."""
    system, inner, before = open_path(path)
    info = system.get_file_info(inner)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    found = [info] if info.type == fs.FileType.File else system.get_file_info(fs.FileSelector(inner))
    named = {before + f.path: f.size for f in found if f.type == fs.FileType.File and not f.base_name.startswith((".", "_"))}
    return dict(sorted(named.items()))


def ranges(start: dict[str, int], end: dict[str, int], size: int) -> list[Range]:
    return [Range(f, a, min(a + size, end[f])) for f in sorted(end) for a in range(start.get(f, 0), end[f], size)]


def _lines(file: pa.NativeFile, part: Range) -> Iterator[tuple[int, bytes]]:
    """Where each line of the range begins, and its bytes without the line end."""
    at, mid_line = part.start, part.start > 0  # the line that is running before the range belongs to an earlier one
    if mid_line:
        at -= 1
        file.seek(at)
    held: list[bytes] = []  # of a line without its end yet
    while more := file.read(READ_BYTES):
        *ended, tail = more.split(b"\n")
        for piece in ended:
            line, held = b"".join([*held, piece]), []
            if not mid_line:
                yield at, line
            at, mid_line = at + len(line) + 1, False
            if at >= part.end:
                return
        held.append(tail)
    if not mid_line and (line := b"".join(held)):
        yield at, line


def read_range(part: Range, low: int = 0, high: int | None = None) -> Iterator[pa.RecordBatch]:
    """Lines that begin in the range, and at ``low`` or later and before ``high``; memory is that of a few reads and the longest line."""
    system, inner, _ = open_path(part.file)
    values, offsets, held = [], [], 0
    with system.open_input_file(inner) as file:
        for at, line in _lines(file, part):
            if at < low or (high is not None and at >= high):
                continue
            values.append(line.removesuffix(b"\r").decode("utf-8", "replace"))
            offsets.append(at)
            held += len(line) + 64
            if held >= BATCH_BYTES:
                yield _batch(part.file, values, offsets)
                values, offsets, held = [], [], 0
    if values:
        yield _batch(part.file, values, offsets)


def _batch(file: str, values: list[str], offsets: list[int]) -> pa.RecordBatch:
    columns = [pa.array(values, pa.string()), pa.array([file] * len(values), pa.string()), pa.array(offsets, pa.int64())]
    return pa.RecordBatch.from_arrays(columns, ["value", "file", "offset"])


class LogReader(DataSourceReader):
    def __init__(self, path: str, size: int, names: str, low: int, high: int | None):
        self.path, self.size, self.names, self.low, self.high = path, size, names, low, high

    def partitions(self) -> list[Range]:
        end = {f: n for f, n in list_files(self.path).items() if fnmatchcase(f.rsplit("/", 1)[-1], self.names)}
        return [r for r in ranges({}, end, self.size) if r.end > self.low and (self.high is None or r.start < self.high)]

    def read(self, partition: Range | None) -> Iterator[pa.RecordBatch]:
        if partition is not None:
            yield from read_range(partition, self.low, self.high)


class LogStreamReader(DataSourceStreamReader):
    """Offsets are the bytes read of each file: they grow with the number of files, which a folder of logs should bound by age."""

    def __init__(self, path: str, size: int):
        self.path, self.size, self.known = path, size, {}

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        for file, size in list_files(self.path).items():
            if size != self.known.get(file, (None, 0))[0]:
                self.known[file] = size, complete(file, size)
        return {f: end for f, (_, end) in self.known.items()}

    def partitions(self, start: dict, end: dict) -> list[Range]:
        return ranges(start, end, self.size)

    def read(self, partition: Range | None) -> Iterator[pa.RecordBatch]:
        if partition is not None:
            yield from read_range(partition)


def complete(file: str, size: int) -> int:
    """Bytes up to the last line end of a file."""
    system, inner, _ = open_path(file)
    with system.open_input_file(inner) as data:
        while size:
            first = max(0, size - READ_BYTES)
            data.seek(first)
            if (at := data.read(size - first).rfind(b"\n")) >= 0:
                return first + at + 1
            size = first
    return 0


class LogSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "agent_log"

    def schema(self) -> str:
        return SCHEMA

    def _asked(self) -> tuple[str, int]:
        if not (path := self.options.get("path")):
            raise ValueError("agent_log needs a path")
        return path, int(self.options.get("range_bytes", RANGE_BYTES))

    def reader(self, schema) -> LogReader:
        upto = self.options.get("to_offset")
        return LogReader(*self._asked(), self.options.get("names", "*"), int(self.options.get("from_offset", 0)), None if upto is None else int(upto))

    def streamReader(self, schema) -> LogStreamReader:
        return LogStreamReader(*self._asked())


def read_lines(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES, **options: str | int) -> DataFrame:
    spark.dataSource.register(LogSource)
    return spark.read.format("agent_log").option("range_bytes", range_bytes).options(**options).load(path)
