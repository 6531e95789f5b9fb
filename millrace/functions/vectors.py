"""Vector expressions on array columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def doubles(v: Column) -> Column:
    return v.cast("array<double>")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)


def norm(v: Column) -> Column:
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x * x))


def cosine_similarity(a: Column, b: Column) -> Column:
    """Cosine of two vectors of equal dimension; null for a zero vector or unequal dimensions."""
    x, y = doubles(a), doubles(b)
    scale = F.nullif(norm(x) * norm(y), F.lit(0.0))
    return F.when(F.size(x) == F.size(y), dot(x, y) / scale)
