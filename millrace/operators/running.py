"""Running totals and row numbers over a global order, without a single-task window.

The order column is cut into ranges at approximate quantiles. Totals per range are a small
table whose running sum gives each range its offset; the window then runs inside ranges.
Results are exact whatever the edges are: they only decide the balance of the work.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.runtime import cut_lineage, shuffle_width

_RANGE = "__range"
_ORDER = "__order"


def range_edges(df: DataFrame, order: Column, ranges: int) -> list[float]:
    """Distinct approximate quantiles that split the order column into similar ranges."""
    if ranges < 2:
        return []
    probs = [i / ranges for i in range(1, ranges)]
    row = df.agg(F.percentile_approx(order.cast("double"), probs, max(1000, 20 * ranges)).alias("e")).first()
    return sorted(set(row["e"] or []))


def _with_range(df: DataFrame, order: str, edges: list[float]) -> DataFrame:
    if not edges:
        return df.withColumn(_RANGE, F.lit(0.0))
    splits = [float("-inf"), *edges, float("inf")]
    keyed = df.withColumn(_ORDER, F.col(order).cast("double"))
    return Bucketizer(splits=splits, inputCol=_ORDER, outputCol=_RANGE, handleInvalid="keep").transform(keyed).drop(_ORDER)


def running_totals(
    df: DataFrame,
    order: str,
    measures: Sequence[str],
    by: Sequence[str] = (),
    edges: list[float] | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """Add ``<m>_run``: the sum of ``m`` over all rows with an order value up to the row's own.

    Ties share one total. Aggregate to one row per order value first when values repeat, so that
    a hot value is one row. ``edges`` may be passed when they are known already.
    """
    by = list(by)
    width = ranges or shuffle_width(df.sparkSession)
    if edges is None:
        edges = range_edges(df, F.col(order), width)
    parts = _with_range(df, order, edges)
    window = Window.partitionBy(*by, _RANGE).orderBy(order)
    inner = parts.select("*", *[F.sum(m).over(window).alias(f"{m}_run") for m in measures])
    if not edges:
        return inner.drop(_RANGE)
    totals = parts.groupBy(*by, _RANGE).agg(*[F.sum(m).alias(f"__t_{m}") for m in measures])
    earlier = Window.partitionBy(*by).orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *by, _RANGE, *[F.coalesce(F.sum(f"__t_{m}").over(earlier), F.lit(0)).alias(f"__o_{m}") for m in measures]
    )
    if not by:
        offsets = F.broadcast(offsets)  # at most one row per range
    joined = inner.join(offsets, [*by, _RANGE])
    return joined.select(
        *df.columns, *[(F.col(f"{m}_run") + F.col(f"__o_{m}")).alias(f"{m}_run") for m in measures]
    )


def numbered(
    df: DataFrame,
    order: str,
    ties: Sequence[str] = (),
    by: Sequence[str] = (),
    name: str = "rn",
    ranges: int | None = None,
) -> DataFrame:
    """Add a 1-based row number per ``by`` group in (order, ties) order.

    Rows are range-partitioned on the whole key, so neither a hot group nor a hot order value lands
    in one task. The laid-out rows are checkpointed: their places must not change between the two
    uses. Sizes of the pieces, one row per partition and group, then give the offsets.
    """
    by = list(by)
    keys = [*by, order, *ties]
    laid = (
        df.repartitionByRange(ranges or shuffle_width(df.sparkSession), *keys)
        .sortWithinPartitions(*keys)
        .withColumn("__id", F.monotonically_increasing_id())
    )
    # the id is the partition number in the upper bits and the row's place in it below
    placed = cut_lineage(laid).withColumns(
        {"__piece": F.shiftright("__id", 33), "__inner": F.col("__id").bitwiseAND(F.lit((1 << 33) - 1))}
    )
    pieces = placed.groupBy("__piece", *by).agg(F.min("__inner").alias("__first"), F.count("*").alias("__n"))
    earlier = Window.partitionBy(*by).orderBy("__piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = pieces.select(
        F.col("__piece").alias("__p"),
        *[F.col(b).alias(f"__by_{b}") for b in by],
        (F.coalesce(F.sum("__n").over(earlier), F.lit(0)) - F.col("__first") + 1).alias("__off"),
    )
    if not by:
        offsets = F.broadcast(offsets)  # one row per partition
    on = F.col("__piece") == F.col("__p")
    for b in by:
        on = on & F.col(b).eqNullSafe(F.col(f"__by_{b}"))
    return placed.join(offsets, on).select(*df.columns, (F.col("__inner") + F.col("__off")).alias(name))
