"""Rates of outcomes over a stream, the same as ``operators.health.window_rates`` has of the whole table.

Outcomes may come out of order.  Each waits in the state until the watermark has passed
it, which an event-time timer tells; then all earlier ones are known.  Outcomes that are
older than the watermark when they come are late and leave no row.

Keys are dealt to ``BUCKETS``, and a bucket's keys share a state and a timer: one call
orders and counts all their outcomes as arrays.  A bucket's state is what waits and the
last outcomes of each key's window, in chunks, and goes when both are empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tracequarry.operators.health import INFRA, OVERLOADS, WINDOW_REQUESTS, WINDOW_SECONDS

#: Groups of keys that share a state, and rows of a chunk of it.
BUCKETS, CHUNK = 512, 50_000
KINDS = (("timeout",), OVERLOADS, ("abnormal_response",), INFRA)
COLUMNS = ["event_id", "total", "timeout_rate", "overload_rate", "abnormal_rate", "infra_rate"]
OUT = "event_id long, total long, timeout_rate double, overload_rate double, abnormal_rate double, infra_rate double"


def _packed(rows: pd.DataFrame) -> list[tuple[bytes]]:
    """Rows (key, at, event_id, outcome) as chunks of Arrow's format."""
    out = []
    for k in range(0, len(rows), CHUNK):
        batch, sink = pa.RecordBatch.from_pandas(rows[k : k + CHUNK], preserve_index=False), pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, batch.schema) as writer:
            writer.write_batch(batch)
        out.append((sink.getvalue().to_pybytes(),))
    return out


def _unpacked(state) -> list[pd.DataFrame]:
    return [pa.ipc.open_stream(c[0]).read_all().to_pandas() for c in state.get()] if state.exists() else []


def _places(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Of rows in order of key and time: the first row of each one's key, and of its window."""
    key, at, n = rows["key"].to_numpy(), rows["at"].to_numpy(), np.arange(len(rows))
    new = np.ones(len(rows), bool)
    new[1:] = (key[1:] != key[:-1]) & ~(pd.isna(key[1:]) & pd.isna(key[:-1]))
    begin = np.maximum.accumulate(np.where(new, n, 0))
    group = np.cumsum(new) - 1
    low = np.maximum(begin, n - (WINDOW_REQUESTS - 1))
    # times as places in order, so that a group and a time are one whole number
    times = np.unique(at)
    place = group * (len(times) + 1) + np.searchsorted(times, at)
    since = group * (len(times) + 1) + np.searchsorted(times, at - WINDOW_SECONDS * 1_000_000)
    return begin, np.maximum(low, np.searchsorted(place, since))


class Rates(StatefulProcessor):
    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "chunk binary")
        self.recent = handle.getListState("recent", "chunk binary")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802
        """Keep what came and wake up when the watermark reaches the first of it."""
        first = None
        for frame in rows:
            self.waiting.appendList(_packed(frame[["key", "at", "event_id", "outcome"]]))
            first = min(int(frame["at"].min()), first if first is not None else int(frame["at"].min()))
        if first is not None:
            self.handle.registerTimer(first // 1000 + 1)
        yield pd.DataFrame({c: [] for c in COLUMNS})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802
        """Rows of all that the watermark has passed, in order."""
        mark = timerValues.getCurrentWatermarkInMs()
        waiting, recent = _unpacked(self.waiting), _unpacked(self.recent)
        rows = pd.concat([f.assign(old=old) for old, frames in ((False, waiting), (True, recent)) for f in frames] or [pd.DataFrame({c: [] for c in ("key", "at", "event_id", "outcome", "old")})], ignore_index=True)
        late = rows["at"] // 1000 >= mark
        later, rows = rows[late], rows[~late].sort_values(["key", "at", "event_id"], ignore_index=True)
        begin, low = _places(rows)
        n = np.arange(len(rows))
        total = n + 1 - low
        counts = [np.concatenate([[0], np.cumsum(rows["outcome"].isin(kinds).to_numpy())]) for kinds in KINDS]
        shares = [(c[n + 1] - c[low]) / np.maximum(total, 1) for c in counts]
        new = ~rows["old"].to_numpy(bool)
        out = pd.DataFrame(dict(zip(COLUMNS, [rows["event_id"].to_numpy(), total, *shares])))[new]
        self.waiting.clear()
        self.recent.clear()
        if len(later):
            self.waiting.put(_packed(later.drop(columns="old")))
            self.handle.registerTimer(int(later["at"].min()) // 1000 + 1)
        # a key's last outcomes that a later one's window may reach
        left = pd.Series(begin).map(pd.Series(begin).value_counts()).to_numpy() - (n - begin) if len(rows) else n
        keep = rows[(left < WINDOW_REQUESTS) & (rows["at"] // 1000 >= mark - WINDOW_SECONDS * 1000)]
        if len(keep):
            self.recent.put(_packed(keep.drop(columns="old")))
            self.handle.registerTimer(mark + WINDOW_SECONDS * 1000)  # else the state would stay when the keys fall silent
        yield out

    def close(self) -> None:
        pass


def rates(outcomes: DataFrame, key: str, ts: str, late: str = "60 seconds") -> DataFrame:
    """Counts and shares over the last 20 seconds and at most 50 outcomes, at each outcome (``event_id``, ``outcome``) of ``key``."""
    told = outcomes.withColumn(ts, F.col(ts).cast("timestamp"))
    told = told.withColumn("at", F.unix_micros(ts)).withWatermark(ts, late)
    told = told.select(F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int").alias("bucket"), F.col(key).cast("string").alias("key"), ts, "at", "event_id", "outcome")
    return told.groupBy("bucket").transformWithStateInPandas(Rates(), OUT, "Append", "EventTime")
