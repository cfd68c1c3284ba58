"""Dense-vector expressions over ``array<float|double>`` columns (fp64 arithmetic)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def as_double(col) -> Column:
    return _c(col).cast("array<double>")


def _sum(arr: Column) -> Column:
    return F.aggregate(arr, F.lit(0.0).cast("double"), lambda acc, v: acc + v)


def dot(a, b) -> Column:
    return _sum(F.zip_with(as_double(a), as_double(b), lambda x, y: x * y))


def norm(a) -> Column:
    return F.sqrt(_sum(F.transform(as_double(a), lambda x: x * x)))


def sq_dist(a, b) -> Column:
    return _sum(F.zip_with(as_double(a), as_double(b), lambda x, y: (x - y) * (x - y)))


def euclid(a, b) -> Column:
    return F.sqrt(sq_dist(a, b))


def cosine(a, b) -> Column:
    """Cosine similarity; 0 when either vector has zero norm (as sklearn)."""
    den = norm(a) * norm(b)
    return F.when(den == 0, F.lit(0.0)).otherwise(dot(a, b) / den)
