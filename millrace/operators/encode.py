"""Category encoders: index, dummy columns and weight of evidence."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.runtime import cut_lineage


def category_list(df: DataFrame, col: str, limit: int = 10_000) -> list:
    """Sorted categories of a column; refuses a column with more than ``limit`` of them."""
    rows = df.select(col).where(F.col(col).isNotNull()).distinct().limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{col} has more than {limit} categories, too many for one column each")
    return sorted(r[0] for r in rows)


def dummies(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One 0/1 column per category, none dropped; other columns are untouched."""
    new = {}
    for c in cols:
        for v in category_list(df, c):
            new[f"{c}_{v}"] = F.coalesce(F.col(c) == v, F.lit(False)).cast("int")
    return df.withColumns(new).drop(*cols)


def woe_fit(train: DataFrame, cols: Sequence[str], label: str, regularization: float = 1.0) -> DataFrame:
    """Weight of evidence per (column, value): ln of the value's share of events over its share of non-events.

    One aggregate over the unpivoted columns; rows are pre-aggregated per partition, so a hot value
    or column is no bottleneck. A value seen once gets 0.
    """
    y = F.col(label).cast("double")
    long = train.select(y.alias("__y"), *[F.col(c).cast("string").alias(c) for c in cols]).unpivot(
        ["__y"], list(cols), "column_name", "value"
    )
    counts = long.groupBy("column_name", "value").agg(F.count("*").alias("n"), F.sum("__y").alias("pos"))
    totals = counts.groupBy("column_name").agg(F.sum("n").cast("double").alias("all_n"), F.sum("pos").alias("all_pos"))
    r = float(regularization)
    n, pos = F.col("n").cast("double"), F.col("pos")
    all_n, all_pos = F.col("all_n"), F.col("all_pos")
    up = (pos + r) / (all_pos + 2 * r)
    down = (n - pos + r) / (all_n - all_pos + 2 * r)
    # one total per listed column
    return counts.join(F.broadcast(totals), "column_name").select(
        "column_name", "value", "n", "pos", F.when((F.col("n") > 1) & F.col("value").isNotNull(), F.log(up / down)).otherwise(0.0).alias("woe")
    )


def woe_apply(df: DataFrame, table: DataFrame, cols: Sequence[str], suffix: str = "_woe") -> DataFrame:
    """Add the fitted value per column; values not seen in training and NULL get 0. The table is worked out once."""
    out, table = df, cut_lineage(table.where(F.col("column_name").isin(*cols)))
    for c in cols:
        lookup = table.where(F.col("column_name") == c).select(F.col("value").alias(f"__{c}"), F.col("woe").alias(c + suffix))
        out = out.join(lookup, F.col(c).cast("string") == F.col(f"__{c}"), "left").drop(f"__{c}")
    return out.withColumns({c + suffix: F.coalesce(F.col(c + suffix), F.lit(0.0)) for c in cols})
