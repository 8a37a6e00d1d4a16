"""Vector arithmetic on array columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_doubles(v: Column) -> Column:
    return v.cast("array<double>")


def total(v: Column) -> Column:
    return F.aggregate(v, F.lit(0.0), lambda a, x: a + x)


def dot(a: Column, b: Column) -> Column:
    return total(F.zip_with(a, b, lambda x, y: x * y))


def norm(v: Column) -> Column:
    return F.sqrt(total(F.transform(v, lambda x: x * x)))


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two vectors, NULL when one of them is zero."""
    return dot(a, b) / F.nullif(norm(a) * norm(b), F.lit(0.0))


def unit(v: Column) -> Column:
    # the length is repeated next to the elements, a value used inside the lambda would be recomputed per element
    length = F.array_repeat(F.nullif(norm(v), F.lit(0.0)), F.size(v))
    return F.zip_with(v, length, lambda x, n: x / n)


def add(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x + y)


def subtract(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x - y)


def scale(v: Column, factor) -> Column:
    return F.transform(v, lambda x: x * factor)


def arg_max(v: Column) -> Column:
    """0-based position of the first largest element."""
    return (F.array_position(v, F.array_max(v)) - 1).cast("int")


def mean_vector(v: Column, size: int) -> Column:
    """Aggregate expression: element-wise mean over rows (one mergeable average per element)."""
    return F.array(*[F.avg(F.get(v, F.lit(i))) for i in range(size)])


def linear(coefs: list[float], cols: list[Column], intercept: float = 0.0) -> Column:
    """Weighted sum of columns with driver-held coefficients."""
    return reduce(lambda a, b: a + b, [c * float(w) for w, c in zip(coefs, cols)], F.lit(float(intercept)))
