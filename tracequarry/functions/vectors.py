"""Vector expressions over arrays; all arithmetic is in double precision."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _double(v: Column) -> Column:
    return v.cast("array<double>")


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def dot(a: Column, b: Column) -> Column:
    return _total(F.zip_with(_double(a), _double(b), lambda x, y: x * y))


def norm(a: Column) -> Column:
    return F.sqrt(_total(F.transform(_double(a), lambda x: x * x)))


def cosine(a: Column, b: Column) -> Column:
    """0 if either vector has no length."""
    length = norm(a) * norm(b)
    return F.when(length > 0, dot(a, b) / length).otherwise(F.lit(0.0))


def l2(a: Column, b: Column) -> Column:
    return F.sqrt(_total(F.zip_with(_double(a), _double(b), lambda x, y: (x - y) * (x - y))))


def usable(a: Column) -> Column:
    """Not null, not empty, not all zero."""
    return F.coalesce(F.exists(a, lambda x: x != 0), F.lit(False))


def ensure_dimension(a: Column, dim: int) -> Column:
    """Cut or padded with zeros to ``dim``, then of length 1 (zero vectors stay)."""
    cut = F.slice(F.concat(_double(a), F.array_repeat(F.lit(0.0), dim)), 1, dim)
    return F.transform(F.array(cut), lambda v: F.transform(v, lambda x: F.when(norm(v) > 0, x / norm(v)).otherwise(x)))[0]
