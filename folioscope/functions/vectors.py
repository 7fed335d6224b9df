"""Vector expressions over array columns, computed in double."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def literal(vector: Sequence[float]) -> Column:
    return F.array(*(F.lit(float(x)) for x in vector))


def doubles(vector: Column) -> Column:
    return vector.cast("array<double>")


def dot(a: Column, b: Column) -> Column:
    same = F.when(F.size(a) != F.size(b), F.raise_error(F.lit("vectors of different widths"))).otherwise(F.lit(0.0))
    return F.aggregate(F.zip_with(doubles(a), doubles(b), lambda x, y: x * y), same.cast("double"), lambda s, x: s + x)


def norm(v: Column) -> Column:
    return F.sqrt(F.aggregate(F.transform(doubles(v), lambda x: x * x), F.lit(0.0), lambda s, x: s + x))


def l2_normalize(v: Column) -> Column:
    """The unit vector; a zero vector stays as it is."""
    n = norm(v)
    return F.when(n == 0, doubles(v)).otherwise(F.transform(doubles(v), lambda x: x / n))


def cosine(a: Column, b: Column) -> Column:
    """0.0 if either is a zero vector; different widths are an error."""
    n = norm(a) * norm(b)
    return F.when(n == 0, F.lit(0.0)).otherwise(dot(a, b) / n)


def cosine_unit(a: Column, unit: Column) -> Column:
    n = norm(a)
    return F.when(n == 0, F.lit(0.0)).otherwise(dot(a, unit) / n)


def cosine_distance(a: Column, b: Column) -> Column:
    return 1 - cosine(a, b)
