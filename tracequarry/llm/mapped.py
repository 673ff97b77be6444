"""Read-only arrays that every worker maps instead of loading.

The driver writes one file to the folder that all executors share and names it to
Spark, which fetches it once to each machine (a new executor fetches it again); the
workers of a machine map the same pages.  Meant for tables of a proven size only.
"""

from __future__ import annotations

import json
import os

import numpy as np
from pyspark import SparkFiles
from pyspark.sql import SparkSession

from tracequarry.lineage import scratch


def packed(arrays: dict[str, np.ndarray]) -> bytes:
    """The arrays behind a header of their kinds, lengths and places."""
    head, at, body = {}, 0, []
    for name, x in arrays.items():
        raw = np.ascontiguousarray(x).tobytes()
        head[name] = (x.dtype.str, len(x), at)
        body.append(raw + b"\0" * (-len(raw) % 64))
        at += len(body[-1])
    text = json.dumps(head).encode()
    text += b" " * (-(len(text) + 8) % 64)
    return len(text).to_bytes(8, "little") + text + b"".join(body)


def opened(path: str) -> dict[str, np.ndarray]:
    """The arrays of a file of :func:`packed`, mapped; empty ones are plain."""
    with open(path, "rb") as f:
        size = int.from_bytes(f.read(8), "little")
        head = json.loads(f.read(size))
    return {
        name: np.memmap(path, kind, "r", 8 + size + at, (n,)) if n else np.empty(0, kind)
        for name, (kind, n, at) in head.items()
    }


def ship(spark: SparkSession, label: str, arrays: dict[str, np.ndarray]) -> str:
    """Give the arrays to all executors; the name by which :func:`fetched` opens them."""
    path = scratch(spark, label)
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(target)
    data = packed(arrays)
    for a in range(0, len(data), 1 << 20):
        out.write(bytearray(data[a : a + (1 << 20)]))
    out.close()
    spark.sparkContext.addFile(path)
    return os.path.basename(path)


def fetched(name: str) -> str:
    """The place of a shipped file on the machine of the calling task."""
    return SparkFiles.get(name)
