"""Robust skewness, skew-adjusted winsorising and the Yeo-Johnson power transform."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.scalars import clip
from millrace.operators.quantiles import exact_quantiles
from millrace.operators.running import range_edges
from millrace.runtime import cut_lineage, shuffle_width

# fixed values: skew-adjusted fence
FENCE = 1.5
LOW_EXPONENT = -3.5
HIGH_EXPONENT = 4.0
# end of fixed values

_STEPS = 32
_BLOCK, _BLOCKS = 512, 4096  # values of a block, and blocks of a side at most


def _kernel_order_statistics(values: np.ndarray, counts: np.ndarray, median: float) -> float:
    """Medcouple from sorted distinct values and their counts (bisection on pair counts)."""
    up, down = values > median, values < median
    a, na = values[up] - median, counts[up]
    b, nb = (median - values[down])[::-1], counts[down][::-1]
    below = np.concatenate([[0], np.cumsum(nb)])
    ties = int(counts[values == median].sum())
    n_up, n_down = int(na.sum()), int(nb.sum())

    def count_upto(t: float) -> int:
        c = (1.0 - t) / (1.0 + t)
        pairs = int((na * (n_down - below[np.searchsorted(b, a * c, side="left")])).sum())
        return pairs + _tie_pairs(t, ties, n_down)

    return _middle(count_upto, ties, n_up, n_down)


def _tie_pairs(t: float, ties: int, n_down: int) -> int:
    """Pairs with kernel <= t among those that involve values equal to the median, for -1 < t < 1."""
    return ties * n_down + ties * (ties - 1) // 2 + (ties if t >= 0 else 0)


def _middle(count_upto, ties: int, n_up: int, n_down: int) -> float:
    total = (n_up + ties) * (n_down + ties)
    ranks = {(total - 1) // 2, total // 2}
    found = [_select(count_upto, r, total, ties, n_up, n_down) for r in sorted(ranks)]
    return sum(found) / len(found)


def _ends(rank: int, total: int, ties: int, n_down: int, n_up: int) -> float | None:
    """Kernel values -1, 0 (ties) and 1 are known without a search."""
    half = ties * (ties - 1) // 2
    if rank < ties * n_down + half:
        return -1.0
    if rank >= total - ties * n_up - half:
        return 1.0
    return None


def _select(count_upto, rank: int, total: int, ties: int, n_up: int, n_down: int) -> float:
    known = _ends(rank, total, ties, n_down, n_up)
    if known is not None:
        return known
    lo, hi = -1.0, 1.0
    for _ in range(60):
        mid = (lo + hi) / 2
        if rank < count_upto(mid):
            hi = mid
        else:
            lo = mid
    return (lo + hi) / 2


def medcouple(df: DataFrame, col: str, limit: int = 200_000) -> float | None:
    """Median over pairs x_i >= m >= x_j of ((x_i-m)-(m-x_j))/(x_i-x_j); ties at m use the sign kernel.

    Values are reduced to distinct values with counts. Up to ``limit`` of them are searched in one
    bounded task; above it ranges of values meet, and only the pairs of ranges that may hold the median are counted again.
    """
    x = F.col(col).cast("double")
    clean = df.select(x.alias("v")).where(x.isNotNull() & ~F.isnan(x))
    median = exact_quantiles(clean, ["v"], [0.5])["v"][0]
    if median is None:
        return None
    counts = clean.groupBy("v").agg(F.count("*").alias("n"))
    if counts.count() <= limit:

        def search(pdf: pd.DataFrame) -> pd.DataFrame:
            ordered = pdf.sort_values("v")
            return pd.DataFrame({"mc": [_kernel_order_statistics(ordered.v.to_numpy(), ordered.n.to_numpy(), median)]})

        return counts.groupBy(F.lit(0).alias("all")).applyInPandas(search, "mc double").first()["mc"]
    return _medcouple_distributed(clean, counts, median)


def _medcouple_distributed(clean: DataFrame, counts: DataFrame, median: float) -> float:
    counts = counts.persist()
    try:
        upper = counts.where(F.col("v") > median).select((F.col("v") - median).alias("a"), "n")
        lower = counts.where(F.col("v") < median).select((F.lit(median) - F.col("v")).alias("y"), F.col("n").alias("nb"))
        sizes = counts.agg(
            F.sum(F.when(F.col("v") > median, F.col("n")).otherwise(0)).alias("up"),
            F.sum(F.when(F.col("v") < median, F.col("n")).otherwise(0)).alias("down"),
            F.sum(F.when(F.col("v") == median, F.col("n")).otherwise(0)).alias("ties"),
        ).first()
        n_up, n_down, ties = int(sizes["up"]), int(sizes["down"]), int(sizes["ties"])
        up, down = (_blocks(x.toDF("x", "n")) for x in (upper, lower))
        total = (n_up + ties) * (n_down + ties)
        ranks = {r: _ends(r, total, ties, n_down, n_up) for r in sorted({(total - 1) // 2, total // 2})}
        asked = [r for r, known in ranks.items() if known is None]
        if asked:
            ends = [_summary(x) for x in (up, down)]
            lo, hi = _bracket(*ends, min(asked), max(asked), ties, n_down)
            count_many, base = _pairs_between(up, down, *ends, lo, hi)
            whole = lambda ts: [n + base + _tie_pairs(t, ties, n_down) for t, n in zip(ts, count_many(ts), strict=True)]
            for r in asked:
                ranks[r] = _narrow(whole, r, lo, hi)
        return sum(ranks.values()) / len(ranks)
    finally:
        counts.unpersist()


def _blocks(values: DataFrame) -> DataFrame:
    """(block, lo, hi, total, x, w): ranges of the values (x, n), sorted, with their counts, as bytes."""
    number = min(_BLOCKS, -(-values.count() // _BLOCK))
    edges = np.array(range_edges(values, F.col("x"), number))

    def part(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(np.searchsorted(edges, batch.column(0).to_numpy(), "right")), *batch.columns], ["block", "x", "n"])

    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by("x")
        x, n = table.column("x").to_numpy(), table.column("n").to_numpy()
        return pa.table({"block": table.column("block").slice(0, 1), "lo": [x[0]], "hi": [x[-1]], "total": [int(n.sum())], "x": pa.array([x.tobytes()], pa.binary()), "w": pa.array([n.tobytes()], pa.binary())})

    parts = values.mapInArrow(part, "block long, x double, n long")
    return cut_lineage(parts.groupBy("block").applyInArrow(pack, "block long, lo double, hi double, total long, x binary, w binary"))


def _summary(blocks: DataFrame) -> dict[str, np.ndarray]:
    rows = blocks.select("block", "lo", "hi", "total").orderBy("block").collect()
    out = {c: np.array([r[c] for r in rows]) for c in ("block", "lo", "hi")}
    return out | {"total": np.array([r["total"] for r in rows], object)}  # products of counts may pass 64 bits


def _factor(t: float) -> float:
    return (1.0 - t) / (1.0 + t) if t > -1 else math.inf


def _from(down: dict[str, np.ndarray], first: np.ndarray) -> np.ndarray:
    """Number of values of the blocks from each of ``first`` on."""
    below = np.concatenate([[0], np.cumsum(down["total"])])
    return below[-1] - below[first]


def _bracket(up, down, first: int, last: int, ties: int, n_down: int) -> tuple[float, float]:
    """An interval that holds the kernels of both ranks, by what the ends of the blocks tell."""

    def least(t: float) -> int:
        return int((up["total"] * _from(down, np.searchsorted(down["lo"], up["hi"] * _factor(t), "left"))).sum()) + _tie_pairs(t, ties, n_down)

    def most(t: float) -> int:
        return int((up["total"] * _from(down, np.searchsorted(down["hi"], up["lo"] * _factor(t), "left"))).sum()) + _tie_pairs(t, ties, n_down)

    found = []
    for below in (lambda t: most(t) <= first, lambda t: least(t) <= last):
        lo, hi = -1.0, 1.0
        for _ in range(60):
            mid = (lo + hi) / 2
            lo, hi = (mid, hi) if below(mid) else (lo, mid)
        found.append((lo, hi))
    return found[0][0], found[1][1]


def _pairs_between(up_blocks: DataFrame, down_blocks: DataFrame, up, down, lo: float, hi: float):
    """A function that counts the pairs with kernels up to each candidate in [lo, hi] among blocks that may hold some above
    ``lo`` and some up to ``hi``, and the number of pairs that are at most ``lo`` in all other blocks."""
    begin = np.searchsorted(down["hi"], up["lo"] * _factor(hi) * (1 - 1e-12), "left")
    end = np.maximum(begin, np.searchsorted(down["lo"], up["hi"] * _factor(lo) * (1 + 1e-12), "left"))
    base = int((up["total"] * _from(down, end)).sum())
    spark = up_blocks.sparkSession
    spans = spark.createDataFrame([(int(b), [int(x) for x in down["block"][i:j]]) for b, i, j in zip(up["block"], begin, end, strict=True)], "block long, others array<long>")
    pairs = spans.select("block", F.explode("others").alias("other"))
    left = up_blocks.select("block", F.col("x").alias("a"), F.col("w").alias("na"))
    right = down_blocks.select(F.col("block").alias("other"), F.col("x").alias("b"), F.col("w").alias("nb"))
    met = cut_lineage(pairs.join(left, "block").join(right, "other").select("a", "na", "b", "nb").repartition(shuffle_width(spark)))

    def count_many(ts: list[float]) -> list[int]:
        factors = [_factor(t) for t in ts]

        def run(batches):
            total = [0] * len(factors)
            for batch in batches:
                for r in range(batch.num_rows):
                    a, na, b, nb = (np.frombuffer(c[r].as_py(), kind) for c, kind in zip(batch.columns, (float, np.int64, float, np.int64), strict=True))
                    above = np.concatenate([np.cumsum(nb[::-1])[::-1], [0]])
                    for j, c in enumerate(factors):
                        total[j] += int((na * above[np.searchsorted(b, a * c, "left")]).sum())
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array([str(x) for x in total])], ["j", "p"])

        rows = met.mapInArrow(run, "j int, p string").groupBy("j").agg(F.sum(F.col("p").cast("decimal(38,0)")).alias("p")).collect()
        got = {r["j"]: int(r["p"]) for r in rows}
        return [got.get(j, 0) for j in range(len(ts))]

    return count_many, base


def _narrow(count_many, rank: int, lo: float = -1.0, hi: float = 1.0) -> float:
    while hi - lo > 1e-13:
        ts = [lo + (hi - lo) * i / (_STEPS + 1) for i in range(1, _STEPS + 1)]
        above = [i for i, n in enumerate(count_many(ts)) if rank < n]
        first = above[0] if above else _STEPS
        lo, hi = (ts[first - 1] if first else lo), (ts[first] if first < _STEPS else hi)
    return (lo + hi) / 2


def adjusted_fences(df: DataFrame, cols: Sequence[str], symmetric: bool = False, limit: int = 200_000) -> dict[str, tuple[float, float]]:
    """Caps q1-1.5·e^(-3.5·MC)·IQR and q3+1.5·e^(4·MC)·IQR per column.

    ``symmetric=True`` swaps the exponents for left-skewed columns as the published rule does.
    """
    quartiles = exact_quantiles(df, cols, [0.25, 0.75])
    fences = {}
    for c in cols:
        q1, q3 = quartiles[c]
        mc = medcouple(df, c, limit)
        low, high = LOW_EXPONENT, HIGH_EXPONENT
        if symmetric and mc < 0:
            low, high = -HIGH_EXPONENT, -LOW_EXPONENT
        iqr = q3 - q1
        fences[c] = (q1 - FENCE * math.exp(low * mc) * iqr, q3 + FENCE * math.exp(high * mc) * iqr)
    return fences


def winsorize_adjusted(df: DataFrame, cols: Sequence[str], fences: dict[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns({c: clip(F.col(c).cast("double"), *fences[c]) for c in cols})


def yeo_johnson(x: Column, lam: float | Column) -> Column:
    """Yeo-Johnson transform for a fixed power, or a power per row."""
    power = lam if isinstance(lam, Column) else F.lit(float(lam))
    rest = F.lit(2.0) - power
    up, down = F.log1p(F.greatest(x, F.lit(0.0))), F.log1p(F.greatest(-x, F.lit(0.0)))
    positive = F.when(F.abs(power) < 1e-12, up).otherwise(F.expm1(power * up) / power)
    negative = -F.when(F.abs(rest) < 1e-12, down).otherwise(F.expm1(rest * down) / rest)
    return F.when(x >= 0, positive).when(x < 0, negative)


def fit_yeo_johnson(df: DataFrame, cols: Sequence[str], low: float = -3.0, high: float = 5.0, rounds: int = 4) -> dict[str, float]:
    """Power of highest likelihood per column: a grid of variances per pass, narrowed around the best.

    Each pass groups by (column, grid point), so the plan stays small however many columns there are.
    """
    long = df.select(
        F.inline(F.array(*[F.struct(F.lit(i).alias("c"), F.col(c).cast("double").alias("x")) for i, c in enumerate(cols)]))
    ).where("x IS NOT NULL")
    spans = {c: (low, high) for c in cols}
    best: dict[str, float] = {}
    for _ in range(rounds):
        grids = [[spans[c][0] + (spans[c][1] - spans[c][0]) * i / 20 for i in range(21)] for c in cols]
        points = F.array(*[F.array(*map(F.lit, g)) for g in grids])
        tried = long.select("c", "x", F.posexplode(F.get(points, F.col("c"))).alias("j", "power"))
        rows = tried.groupBy("c", "j").agg(
            F.count("x").alias("n"),
            F.sum(F.signum("x") * F.log1p(F.abs("x"))).alias("s"),
            F.var_pop(yeo_johnson(F.col("x"), F.col("power"))).alias("v"),
        ).collect()
        for i, c in enumerate(cols):
            scores = {
                r["j"]: -r["n"] / 2 * math.log(r["v"]) + (grids[i][r["j"]] - 1) * r["s"] for r in rows if r["c"] == i and r["v"]
            }
            top = max(scores, key=lambda j: (scores[j], -j)) if scores else 10
            best[c] = grids[i][top]
            step = (spans[c][1] - spans[c][0]) / 20
            spans[c] = (best[c] - step, best[c] + step)
    return best


def apply_yeo_johnson(df: DataFrame, powers: dict[str, float], standardize: bool = True) -> DataFrame:
    """Transform the columns, optionally to mean 0 and population standard deviation 1."""
    out = df.withColumns({c: yeo_johnson(F.col(c).cast("double"), lam) for c, lam in powers.items()})
    if not standardize:
        return out
    stats = out.agg(
        *[F.avg(c).alias(f"m_{c}") for c in powers], *[F.stddev_pop(c).alias(f"s_{c}") for c in powers]
    ).first()
    return out.withColumns(
        {c: (F.col(c) - stats[f"m_{c}"]) / (stats[f"s_{c}"] or 1.0) for c in powers}
    )
