"""Profiling: counts, shares, pivots, describe tables, correlations, histograms, densities."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.filters import missing
from millrace.operators.joins import top_keys
from millrace.operators.quantiles import exact_quantiles


def value_counts(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(col).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.asc(col))


def value_shares(df: DataFrame, col: str, digits: int = 6) -> DataFrame:
    """Count and share per value, NULL is a group."""
    counts = df.groupBy(col).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n")).scalar()  # over the grouped counts, whose shuffle is reused
    return counts.withColumn("share", F.round(F.col("n").cast("double") / total, digits)).orderBy(col)


def topk_profile(df: DataFrame, key: str, k: int, measures: Sequence[str], digits: int = 4) -> DataFrame:
    """The ``k`` most frequent keys with the mean of each measure, in one aggregate."""
    means = [F.round(F.avg(m), digits).alias(f"mean_{m}") for m in measures]
    return df.groupBy(key).agg(F.count("*").alias("n"), *means).orderBy(F.desc("n"), F.asc(key)).limit(k)


def by_hour(df: DataFrame, ts: str, measure: str) -> DataFrame:
    """Count, sum and mean per hour of day, ranked by (mean, hour) descending, with a text line."""
    hourly = df.groupBy(F.hour(ts).alias("hour")).agg(
        F.count("*").alias("n_rows"), F.sum(measure).alias("total"), F.avg(measure).alias("mean")
    )
    rank = F.row_number().over(Window.orderBy(F.desc("mean"), F.desc("hour")))  # at most 24 rows
    line = F.format_string("%02d:00: %.2f average comments per post", "hour", "mean")
    return hourly.select(
        rank.alias("position"),
        "hour",
        "n_rows",
        F.round("total", 4).alias("total"),
        F.round("mean", 6).alias("mean"),
        line.alias("line"),
    ).orderBy("position")


def crosstab_count(df: DataFrame, index: str, columns: str, value: str, classes: Sequence[str]) -> DataFrame:
    """Count of non-missing values per index × class; an absent cell is NULL."""
    return df.groupBy(index).pivot(columns, list(classes)).agg(F.count(value))


def describe_numeric(df: DataFrame, cols: Sequence[str], digits: int = 4) -> DataFrame:
    """count, mean, std (sample), min, quartiles, max: one row per column."""
    quartiles = exact_quantiles(df, cols, [0.25, 0.5, 0.75])
    stats = df.agg(
        *[
            F.struct(
                F.count(c).alias("n"),
                F.avg(c).alias("mean"),
                F.stddev_samp(c).alias("std"),
                F.min(c).cast("double").alias("min"),
                F.max(c).cast("double").alias("max"),
            ).alias(c)
            for c in cols
        ]
    )
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col(f"{c}.n").alias("n"),
            *[F.round(F.col(f"{c}.{s}"), digits).alias(s) for s in ("mean", "std", "min", "max")],
            *[F.round(F.lit(q).cast("double"), digits).alias(f"q{p}") for p, q in zip((25, 50, 75), quartiles[c])],
        )
        for c in cols
    ]
    return stats.select(F.inline(F.array(*rows)))


def describe_text(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """count, distinct, most frequent value (smallest on ties) and its frequency per text column."""
    counts = df.select(*cols).unpivot([], list(cols), "column_name", "value").where("value IS NOT NULL")
    per_value = counts.groupBy("column_name", "value").agg(F.count("*").alias("freq"))
    # max over (freq) with the smallest value: two mergeable aggregates instead of a sort per column
    per_column = per_value.groupBy("column_name").agg(
        F.sum("freq").alias("n"),
        F.count("*").alias("n_unique"),
        F.min(F.struct((-F.col("freq")).alias("neg"), F.col("value"))).alias("mode"),
    )
    return per_column.select(
        "column_name", "n", "n_unique", F.col("mode.value").alias("top"), (-F.col("mode.neg")).alias("freq")
    )


def profile(df: DataFrame) -> DataFrame:
    """Column name, type, rows and non-missing rows, from one pass."""
    counts = df.agg(F.count("*").alias("__rows"), *[F.count(F.when(~missing(df, c), 1)).alias(c) for c in df.columns])
    rows = [
        F.struct(
            F.lit(c).alias("column_name"), F.lit(t).alias("dtype"), F.col("__rows").alias("n_rows"), F.col(c).alias("n_present")
        )
        for c, t in df.dtypes
    ]
    return counts.select(F.inline(F.array(*rows)))


def null_shares(df: DataFrame, digits: int = 6) -> DataFrame:
    shares = df.agg(*[F.round(F.avg(missing(df, c).cast("double")), digits).alias(c) for c in df.columns])
    return shares.unpivot([], list(df.columns), "column_name", "null_share")


def _correlation(a: str, b: str) -> Column:
    """Pearson correlation over rows that hold both values; NULL for a constant column."""
    x, y = F.when(F.col(b).isNotNull(), F.col(a)), F.when(F.col(a).isNotNull(), F.col(b))
    return F.covar_pop(a, b) / F.nullif(F.stddev_pop(x) * F.stddev_pop(y), F.lit(0.0))


def corr_matrix(df: DataFrame, cols: Sequence[str], digits: int = 6) -> DataFrame:
    """Pearson correlation of every column pair (strict lower triangle), one pass."""
    pairs = list(combinations(cols, 2))
    stats = df.agg(*[_correlation(a, b).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])
    rows = [
        F.struct(F.lit(b).alias("col_a"), F.lit(a).alias("col_b"), F.round(F.col(f"r{i}"), digits).alias("r"))
        for i, (a, b) in enumerate(pairs)
    ]
    return stats.select(F.inline(F.array(*rows)))


def histogram(df: DataFrame, cols: Sequence[str], bins: int = 10) -> DataFrame:
    """Equal-width counts per column; the last bin is closed and empty bins are kept."""
    span = df.agg(
        F.struct(*[F.struct(F.min(c).alias("lo"), F.max(c).alias("hi")).alias(c) for c in cols]).alias("s")
    ).scalar()
    slots = []
    for c in cols:
        lo, hi = span[c]["lo"].cast("double"), span[c]["hi"].cast("double")
        slot = F.floor((F.col(c) - lo) / F.nullif(hi - lo, F.lit(0.0)) * bins)
        slots.append(F.when(F.col(c).isNotNull(), F.least(F.lit(bins - 1), F.coalesce(slot, F.lit(0))).cast("int")).alias(c))
    counted = (
        df.select(*slots).unpivot([], list(cols), "column_name", "bin").where("bin IS NOT NULL")
        .groupBy("column_name", "bin").agg(F.count("*").alias("n"))
    )
    names = F.array(*map(F.lit, cols))
    grid = df.sparkSession.range(1).select(F.explode(names).alias("column_name")).select(
        "column_name", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin")
    )
    return F.broadcast(grid).join(counted, ["column_name", "bin"], "left").select(
        "column_name", "bin", F.coalesce("n", F.lit(0)).cast("long").alias("n")
    )


def density(df: DataFrame, col: str, points: int = 32, digits: int = 8) -> DataFrame:
    """Gaussian kernel density on an even grid over the column's range, with the mean as a marker.

    Bandwidth 0.9·min(sd, IQR/1.34)·n^-0.2. One pass: one kernel sum per grid point.
    """
    q1, q3 = exact_quantiles(df, [col], [0.25, 0.75])[col]
    s = df.agg(F.count(col), F.stddev_samp(col), F.avg(col), F.min(col), F.max(col)).first()
    n, sd, mean, lo, hi = s
    bandwidth = 0.9 * min(sd, (q3 - q1) / 1.34) * n**-0.2
    grid = [lo + (hi - lo) * i / (points - 1) for i in range(points)]
    x = F.col(col)
    sums = df.agg(*[F.sum(F.exp(-0.5 * ((F.lit(g) - x) / bandwidth) ** 2)).alias(f"k{i}") for i, g in enumerate(grid)])
    scale = 1.0 / (n * bandwidth * (2 * 3.141592653589793) ** 0.5)
    rows = [
        F.struct(
            F.lit(i).alias("point"),
            F.round(F.lit(g), 6).alias("x"),
            F.round(F.col(f"k{i}") * scale, digits).alias("density"),
            F.round(F.lit(mean), 6).alias("mean_marker"),
        )
        for i, g in enumerate(grid)
    ]
    return sums.select(F.inline(F.array(*rows)))


def series(df: DataFrame, entity: str, date: Column, measure: str, digits: int = 4) -> DataFrame:
    """Per entity and day: new amount, new count and their running totals.

    The window runs over days per entity (one row per day after the aggregate).
    """
    daily = df.groupBy(entity, date.alias("day")).agg(
        F.sum(measure).alias("new_value"), F.count("*").alias("new_count")
    )
    upto = Window.partitionBy(entity).orderBy("day")
    return daily.select(
        entity,
        "day",
        F.round("new_value", digits).alias("new_value"),
        "new_count",
        F.round(F.sum("new_value").over(upto), digits).alias("total_value"),
        F.sum("new_count").over(upto).alias("total_count"),
    ).orderBy(entity, "day")


def top_frequent(df: DataFrame, key: str, k: int) -> DataFrame:
    return top_keys(df, key, k)


def disagreement(df: DataFrame, key: str, preds: Sequence[str]) -> DataFrame:
    """0/1 flag per pair of prediction columns."""
    flags = [(F.col(a) != F.col(b)).cast("int").alias(f"{a}_vs_{b}") for a, b in combinations(preds, 2)]
    return df.select(key, *flags)


def class_baseline(df: DataFrame, label: str, digits: int = 6) -> DataFrame:
    """Classes, majority share (zero-rule accuracy) and minority share."""
    shares = value_shares(df, label, digits=12)
    return shares.agg(
        F.count("*").alias("n_classes"),
        F.round(F.max("share"), digits).alias("majority_share"),
        F.round(F.min("share"), digits).alias("minority_share"),
    )
