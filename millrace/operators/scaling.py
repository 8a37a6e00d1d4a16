"""Scaling expressed as columns; the fitted numbers are one small row per frame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.quantiles import exact_quantiles


def _apply(df: DataFrame, params: dict[str, tuple[float, float]]) -> DataFrame:
    """(x - centre) / width, a zero width counts as one."""
    return df.withColumns({c: (F.col(c).cast("double") - m) / (w or 1.0) for c, (m, w) in params.items()})


def fit_standard(df: DataFrame, cols: Sequence[str], with_std: bool = True, ddof: int = 1) -> dict[str, tuple[float, float]]:
    dev = F.stddev_samp if ddof == 1 else F.stddev_pop
    row = df.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)], *[dev(c).alias(f"s{i}") for i, c in enumerate(cols)]).first()
    return {c: (row[f"m{i}"], row[f"s{i}"] if with_std else 1.0) for i, c in enumerate(cols)}


def fit_robust(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    q = exact_quantiles(df, cols, [0.25, 0.5, 0.75])
    return {c: (q[c][1], q[c][2] - q[c][0]) for c in cols}


def fit_min_max(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    row = df.agg(*[F.min(c).alias(f"a{i}") for i, c in enumerate(cols)], *[F.max(c).alias(f"b{i}") for i, c in enumerate(cols)]).first()
    return {c: (float(row[f"a{i}"]), float(row[f"b{i}"]) - float(row[f"a{i}"])) for i, c in enumerate(cols)}


def scale(df: DataFrame, params: dict[str, tuple[float, float]]) -> DataFrame:
    return _apply(df, params)


def min_max_matrix(df: DataFrame, vector: str) -> DataFrame:
    """Scale array elements by one global minimum and maximum."""
    bounds = df.agg(F.struct(F.min(F.array_min(vector)).alias("lo"), F.max(F.array_max(vector)).alias("hi")).alias("b")).scalar()
    lo, hi = bounds["lo"].cast("double"), bounds["hi"].cast("double")
    shifted = df.withColumns({"__lo": lo, "__w": F.nullif(hi - lo, F.lit(0.0))})
    scaled = F.transform(vector, lambda x: (x.cast("double") - F.col("__lo")) / F.col("__w"))
    return shifted.withColumn(vector, scaled).drop("__lo", "__w")
