"""Row filters and duplicate handling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def missing(df: DataFrame, name: str) -> Column:
    """NULL, or NaN for floating columns."""
    c = F.col(name)
    if dict(df.dtypes)[name] in ("double", "float"):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def out_of_range_count(df: DataFrame, col: str, low, high) -> DataFrame:
    return df.where((F.col(col) < low) | (F.col(col) > high)).agg(F.count("*").alias("n_outside"))


def route_by_prefix(col: Column, routes: dict[str, str], default: str) -> Column:
    """Bucket name of the first case-insensitive prefix that matches."""
    text = F.lower(col)
    expr: Column | None = None
    for prefix, bucket in routes.items():
        test = text.startswith(prefix.lower())
        expr = F.when(test, bucket) if expr is None else expr.when(test, bucket)
    return expr.otherwise(default)


def dedupe_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep the first row per key. Spark limits each map partition to one row per key before the shuffle."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(window)).where("__rn = 1").drop("__rn")


def any_missing(df: DataFrame) -> DataFrame:
    """One row per column: does it hold a missing value? One pass over the table."""
    flags = df.agg(*[F.coalesce(F.bool_or(missing(df, c)), F.lit(False)).alias(c) for c in df.columns])
    return flags.unpivot([], list(df.columns), "column_name", "has_missing")
