"""Vectors as arrays of numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def doubles(c: Column) -> Column:
    return c.cast("array<double>")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, x: s + x * x))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity in double precision; null when sizes differ or a norm is zero."""
    x, y = doubles(a), doubles(b)
    size = norm(x) * norm(y)
    return F.when((F.size(x) == F.size(y)) & (size > 0), dot(x, y) / size)


def cosine_to(a: Column, query: list[float]) -> Column:
    """Cosine similarity to a fixed vector, whose norm is worked out once."""
    length = sum(x * x for x in map(float, query)) ** 0.5
    x = doubles(a)
    size = norm(x) * F.lit(length)
    return F.when((F.size(x) == len(query)) & (size > 0), dot(x, F.array(*[F.lit(float(v)) for v in query])) / size)
