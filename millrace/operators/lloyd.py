"""k-means on one column: many models in one aggregate per round, and the exact optimum by dynamic programming.

All models work on a table of distinct values with a weight per subset of the rows. In one dimension a cluster is a range,
so a task sorts its values, adds them up once per subset, and reads every model's clusters off these sums between its cut
points. A round of all models together is one pass over the table and one aggregate with a row per cluster.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.runtime import cut_lineage

_PIECE = 1 << 16  # values that are sorted and added up together

@dataclass
class Model:
    """``k`` clusters of the rows of one subset; ``centres`` ascend."""

    subset: int
    centres: np.ndarray
    cost: float = float("inf")
    moving: bool = field(default=True, repr=False)

    @property
    def k(self) -> int:
        return len(self.centres)

    @property
    def cuts(self) -> np.ndarray:
        return (self.centres[1:] + self.centres[:-1]) / 2


    def transform(self, value: Column) -> Column:
        """Group 0..k-1 by ascending centres; null for null."""
        return group_by_cuts(value, self.cuts.tolist())


def group_by_cuts(col: Column, cuts: Sequence[float]) -> Column:
    """Group 0..len(cuts) by ascending cut points; a value on a cut belongs to the upper group."""
    expr = F.when(col.isNull(), F.lit(None).cast("int"))
    for i, c in enumerate(cuts):
        expr = expr.when(col < c, i)
    return expr.otherwise(len(cuts))


def value_table(df: DataFrame, value: Column, weights: Sequence[Column]) -> DataFrame:
    """(x, w): distinct values and their weight in each subset."""
    return df.select(value.cast("double").alias("x"), *[w.cast("double").alias(f"w{i}") for i, w in enumerate(weights)]).where("x IS NOT NULL AND NOT isnan(x)").groupBy("x").agg(
        F.array(*[F.sum(f"w{i}") for i in range(len(weights))]).alias("w")
    )


def matrix(batch: pa.RecordBatch, subsets: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted values of a batch and their weights."""
    x = batch.column(0).to_numpy()
    w = batch.column(1).flatten().to_numpy().reshape(len(x), subsets)
    order = np.argsort(x, kind="stable")
    return x[order], w[order]


def slot_sums(values: DataFrame, slots: int, columns: int, add) -> np.ndarray:
    """[slot, column]: ``add(batch, total)`` adds a batch to a task's totals; the driver gets one row per slot that is not empty."""

    def run(batches):
        total = np.zeros((slots, columns))
        for batch in batches:
            if batch.num_rows:
                add(batch, total)
        at = np.flatnonzero((total != 0).any(1))
        yield pa.RecordBatch.from_arrays([pa.array(at), *[pa.array(total[at, c]) for c in range(columns)]], ["slot", *[f"c{i}" for i in range(columns)]])

    schema = ", ".join(["slot long", *[f"c{i} double" for i in range(columns)]])
    rows = values.mapInArrow(run, schema).groupBy("slot").agg(*[F.sum(f"c{i}") for i in range(columns)]).collect()
    out = np.zeros((slots, columns))
    for slot, *sums in rows:
        out[slot] = sums
    return out


def running_sums(values: DataFrame, subsets: int, shift: float) -> DataFrame:
    """(x, sums): pieces of sorted values, and running sums of (weight, value, square) per subset of the values less ``shift``,
    as bytes. Stored, so that a round neither sorts nor adds up values again."""

    def run(batches):
        held, size = [], 0
        for batch in batches:
            held, size = [*held, batch], size + batch.num_rows
            if size >= _PIECE:
                yield packed(held)
                held, size = [], 0
        if size:
            yield packed(held)

    def packed(held):
        parts = [matrix(b, subsets) for b in held]
        x, w = (np.concatenate([p[c] for p in parts]) for c in (0, 1))
        order = np.argsort(x, kind="stable")
        x, w = x[order], w[order]
        y = (x - shift)[:, None]
        sums = np.stack([np.concatenate([np.zeros((1, subsets)), np.cumsum(p, axis=0)]) for p in (w, w * y, w * (y * y))])
        return pa.RecordBatch.from_arrays([pa.array([b.tobytes()], pa.binary()) for b in (x, sums)], ["x", "sums"])

    return cut_lineage(values.mapInArrow(run, "x binary, sums binary"))


def cluster_sums(pieces: DataFrame, models: Sequence[Model], subsets: int) -> np.ndarray:
    """[cluster of all models, (weight, sum, sum of squares)] of the pieces' values, in one aggregate."""
    ks = np.array([m.k for m in models])
    cuts = np.concatenate([m.cuts for m in models])
    number = int(ks.sum())
    first = np.cumsum(ks) - ks  # a model's first cluster
    last = first + ks - 1
    at_cut = np.setdiff1d(np.arange(number), first)  # clusters that begin at a cut
    subset = np.repeat([m.subset for m in models], ks)

    def add(batch, total):
        for r in range(batch.num_rows):
            x = np.frombuffer(batch.column(0)[r].as_buffer())
            sums = np.frombuffer(batch.column(1)[r].as_buffer()).reshape(3, len(x) + 1, subsets)
            begin, end = np.zeros(number, np.int64), np.zeros(number, np.int64)
            begin[at_cut] = np.searchsorted(x, cuts, "left")  # a value on a cut belongs above it
            end[:-1] = begin[1:]
            end[last] = len(x)
            total += (sums[:, end, subset] - sums[:, begin, subset]).T

    return slot_sums(pieces, number, 3, add)


def settle(values: DataFrame, models: Sequence[Model], subsets: int, max_iter: int) -> None:
    """Moves every centre to the mean of its values, all models together, until they stay.

    A model that stays is left out of the rounds that follow. Clusters that lose all values keep their centre. ``values``
    are added up once; a round reads their running sums at the cuts.
    """
    shift = float(np.mean([m.centres.mean() for m in models]))
    pieces = running_sums(values, subsets, shift)
    for _ in range(max_iter + 1):
        moving = [m for m in models if m.moving]
        if not moving:
            return
        sums = cluster_sums(pieces, moving, subsets)
        at = 0
        for m in moving:
            n, s, q = sums[at : at + m.k].T
            at += m.k
            some = n > 0
            mean = np.divide(s, n, out=m.centres - shift, where=some)
            m.cost = float(np.maximum(q - 2 * s * mean + n * mean * mean, 0)[some].sum())
            moved = np.sort(mean + shift)
            m.moving = bool(np.any(np.abs(moved - m.centres) > 1e-12 * (1 + np.abs(moved))))
            m.centres = moved


def starts(values: DataFrame, ks: Sequence[int], restarts: int, seed: int) -> dict[int, list[np.ndarray]]:
    """Starting centres per k: evenly spaced quantiles of all values, then random ones."""
    rng = np.random.default_rng(seed)
    asked = {k: [(np.arange(k) + 0.5) / k] + [np.sort(rng.random(k)) for _ in range(restarts - 1)] for k in ks}
    flat = sorted({float(p) for sets in asked.values() for s in sets for p in s})
    weight = F.aggregate("w", F.lit(0.0), lambda a, b: a + b)
    row = values.where(weight > 0).agg(F.percentile_approx("x", flat, 10_000).alias("q")).first()
    if row["q"] is None:
        raise ValueError("no values to cluster")
    at = dict(zip(flat, row["q"], strict=True))
    return {k: [np.array(sorted(at[float(p)] for p in s)) for s in sets] for k, sets in asked.items()}


def lloyd(values: DataFrame, subsets: int, ks: Sequence[int], wanted: Sequence[int] | None = None, restarts: int = 10, max_iter: int = 100, seed: int = 24) -> dict[tuple[int, int], Model]:
    """The best of ``restarts`` models per (subset, k)."""
    wanted = list(range(subsets)) if wanted is None else list(wanted)
    first = starts(values, ks, restarts, seed)
    models = [Model(s, c.copy()) for s in wanted for k in ks for c in first[k]]
    settle(values, models, subsets, max_iter)
    best: dict[tuple[int, int], Model] = {}
    for m in models:
        held = best.get((m.subset, m.k))
        if held is None or m.cost < held.cost * (1 - 1e-12):
            best[m.subset, m.k] = m
    return best


def _least(best: np.ndarray, cost, first: int, last: int, begin: int, most) -> tuple[np.ndarray, np.ndarray]:
    """For the places ``first``..``last`` the least ``best[i] + cost(i, place)`` and its i, from ``begin`` up to ``most(place)``.

    The best i of a later place is never an earlier one, so the places are halved level by level, and the candidates of a
    level add up to about the number of places.
    """
    now, found = np.full(len(best), np.inf), np.zeros(len(best), int)
    spans = [(first, last, begin, most(last))] if first <= last else []  # places lo..hi whose best is in a..b
    while spans:
        mid = np.array([(lo + hi) // 2 for lo, hi, _, _ in spans])
        a = np.array([s[2] for s in spans])
        b = np.minimum(np.array([s[3] for s in spans]), most(mid))
        size = b - a + 1
        start = np.cumsum(size) - size
        i = np.arange(size.sum()) + np.repeat(a - start, size)
        total = best[i] + cost(i, np.repeat(mid, size))
        least = np.minimum.reduceat(total, start)
        where = np.flatnonzero(total == np.repeat(least, size))
        found[mid] = i[where[np.searchsorted(where, start)]]
        now[mid] = least
        spans = [
            s
            for (lo, hi, a, b), m in zip(spans, mid.tolist(), strict=True)
            for s in ((lo, m - 1, a, int(found[m])), (m + 1, hi, int(found[m]), b))
            if s[0] <= s[1]
        ]
    return now, found


def _spread_of(sums: np.ndarray, i, j) -> np.ndarray:
    """Sum of squared deviations of what lies in i..j-1 of running sums of (weight, value, square); 0 of nothing."""
    n, s, q = (c[np.maximum(i, j)] - c[i] for c in sums)
    return np.where(n > 0, q - s * s / np.where(n > 0, n, 1), 0.0)


def _best_begins(sums: np.ndarray, k: int) -> list[np.ndarray]:
    """For 1..k clusters where each begins, at least total cost, from running sums over what is not divided."""
    n = sums.shape[1] - 1
    k = min(k, n)
    cost = lambda i, j: _spread_of(sums, i, j)
    best = np.full(n + 1, np.inf)
    best[1:] = cost(np.zeros(n, int), np.arange(1, n + 1))
    begins = [np.zeros(n + 1, int)]
    for stage in range(2, k + 1):
        best, begin = _least(best, cost, stage, n, stage - 1, lambda mid: mid - 1)
        begins.append(begin)
    out = []
    for clusters in range(1, k + 1):
        end, found = n, []
        for stage in range(clusters - 1, -1, -1):
            end = int(begins[stage][end]) if stage else 0
            found.append(end)
        out.append(np.array(found[::-1]))
    return out


def _running(*columns: np.ndarray) -> np.ndarray:
    return np.concatenate([np.zeros((len(columns), 1)), np.cumsum(np.stack(columns), axis=1)], 1)


def optimal_ranges(x: np.ndarray, w: np.ndarray, k: int) -> list[np.ndarray]:
    """For 1..k clusters where each begins among the sorted distinct values ``x`` of weights ``w``, at least total cost."""
    y = x - np.average(x, weights=w)
    return _best_begins(_running(w, w * y, w * y * y), k)


def cut_bounds(sums: np.ndarray, places: np.ndarray, single: np.ndarray, k: int) -> np.ndarray:
    """At each of the ``places`` a bound that the cost of ``k`` clusters does not fall below if one of them ends there.

    ``sums`` are running sums over ranges of values. A range of a ``single`` value ends a cluster as a whole. Of another one
    it is not known which values belong to the cluster; it is left out of both, which never costs more.
    """
    n, begin, end = sums.shape[1] - 1, places + 1, places + single
    between = lambda i, j: _spread_of(sums, begin[i], end[j])
    last = len(places) - 1
    left = [_spread_of(sums, np.zeros(len(places), int), end)]
    right = [_spread_of(sums, begin, np.full(len(places), n))]
    for _ in range(k - 2):
        left.append(_least(left[-1], between, 0, last, 0, lambda mid: mid)[0])
        back = lambda i, j: between(last - j, last - i)
        right.append(_least(right[-1][::-1], back, 0, last, 0, lambda mid: mid)[0][::-1])
    return np.min([a + b for a, b in zip(left, right[::-1], strict=True)], axis=0)


_RANGES = 20_000  # ranges that a round of bounds begins with


def optimum(values: DataFrame, ks: Sequence[int], limit: int = 200_000) -> dict[int, Model]:
    """The model of least cost per k, over the rows of the first subset; exact at any number of values.

    Up to ``limit`` distinct values are solved at once. More are first cut into ranges. The best clusters that end with a
    range cost no less than the optimum, and ``cut_bounds`` tells in which ranges a cluster of the optimum may end; only
    those are cut further, until each of them is a single value.
    """
    used = values.select("x", F.get("w", F.lit(0)).alias("w")).where("w > 0")
    total = used.agg(F.count("*"), F.sum("w"), F.sum(F.col("x") * F.col("w"))).first()
    return _optimum_at_once(used, ks) if total[0] <= limit else _optimum_by_bounds(used, ks, limit, total[0], total[2] / total[1])


def _optimum_at_once(used: DataFrame, ks: Sequence[int]) -> dict[int, Model]:
    schema = pa.schema([("k", pa.int64()), ("centres", pa.list_(pa.float64())), ("cost", pa.float64())])

    def solve(table: pa.Table) -> pa.Table:
        x, w = (table.column(c).to_numpy() for c in ("x", "w"))
        order = np.argsort(x, kind="stable")
        x, w = x[order], w[order]
        rows = []
        for k, begin in enumerate(optimal_ranges(x, w, max(ks)), 1):
            if k in ks:
                parts = [slice(a, b) for a, b in zip(begin, [*begin[1:], len(x)], strict=True)]
                centres = [float(np.average(x[p], weights=w[p])) for p in parts]
                rows.append((k, centres, sum(float((w[p] * (x[p] - c) ** 2).sum()) for p, c in zip(parts, centres, strict=True))))
        return pa.Table.from_pylist([dict(zip(("k", "centres", "cost"), r, strict=True)) for r in rows], schema)

    found = used.withColumn("all", F.lit("all")).groupBy("all").applyInArrow(solve, "k long, centres array<double>, cost double").collect()
    return {r["k"]: Model(0, np.array(r["centres"]), r["cost"]) for r in found}


def _after(x: np.ndarray) -> np.ndarray:
    return np.nextafter(x, np.inf)


def _optimum_by_bounds(used: DataFrame, ks: Sequence[int], limit: int, count: int, shift: float) -> dict[int, Model]:
    ranges, lo, hi = min(limit, _RANGES), np.array([-np.inf]), np.array([np.inf])  # lo..hi: where a cluster may end
    while True:
        inner = used.mapInArrow(_inside(lo, _after(hi)), "x double, w double")
        if count <= max(limit, ranges):
            x = inner.select("x").toArrow().column("x").to_numpy()
            edges = np.unique(np.concatenate([lo, _after(hi), x, _after(x)]))
        else:
            x = inner.agg(F.percentile_approx("x", [i / ranges for i in range(1, ranges)], 10 * ranges).alias("e")).first()["e"]
            edges = np.unique(np.concatenate([lo, _after(hi), x]))
        at = np.searchsorted(lo, edges, "right") - 1
        may_end = np.r_[False, (at >= 0) & (edges < _after(hi)[np.maximum(at, 0)])]  # by range; range i lies below edge i
        parts = used.mapInArrow(_range_sums(edges, shift), "part long, n double, s double, q double, c long, low double, high double").groupBy("part")
        parts = parts.agg(*[F.sum(x).alias(x) for x in "nsqc"], F.min("low").alias("low"), F.max("high").alias("high"))
        solved = parts.select(F.lit("all").alias("all"), "*").groupBy("all").applyInArrow(_bounded(may_end, ks, shift), "k long, data array<double>, more array<double>, left long")
        found = {r["k"]: r for r in solved.collect()}
        rest = found.pop(0)
        if not rest["left"]:
            return {k: Model(0, np.array(r["data"]), r["more"][0]) for k, r in found.items()}
        if rest["left"] > count / 2:
            ranges *= 4  # too many ranges of this width are left
        count, lo, hi = rest["left"], np.array(rest["data"]), np.array(rest["more"])


def _range_sums(edges: np.ndarray, shift: float):
    """A function for mapInArrow: per range between edges the running columns, the number of values, the least and the greatest."""

    def run(batches):
        for batch in batches:
            x, w = (batch.column(c).to_numpy() for c in (0, 1))
            part, own = np.unique(np.searchsorted(edges, x, "right"), return_inverse=True)
            y = x - shift
            low, high = np.full(len(part), np.inf), np.full(len(part), -np.inf)
            np.minimum.at(low, own, x)
            np.maximum.at(high, own, x)
            sums = [np.bincount(own, c, len(part)) for c in (w, w * y, w * y * y)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (part, *sums, np.bincount(own, minlength=len(part)), low, high)], ["part", "n", "s", "q", "c", "low", "high"])

    return run


def _bounded(may_end: np.ndarray, ks: Sequence[int], shift: float):
    """A function for applyInArrow over all ranges: the best clusters that end with a range, per k their centres and cost; at
    k 0 least and greatest value of the ranges in which a cluster may yet end, and how many values these have, 0 if the
    clusters are the optimum."""
    schema = pa.schema([("k", pa.int64()), ("data", pa.list_(pa.float64())), ("more", pa.list_(pa.float64())), ("left", pa.int64())])

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("part")
        part, n, s, q, c, low, high = (table.column(x).to_numpy() for x in ("part", "n", "s", "q", "c", "low", "high"))
        may = may_end[part]
        together = np.cumsum(may) - may  # ranges up to one in which a cluster may end
        joined, sums, places = _running(*(np.bincount(together, x) for x in (n, s, q))), _running(n, s, q), np.flatnonzero(may)
        slack = 1e-10 * float(_spread_of(sums, np.array([0]), np.array([len(n)]))[0])
        rows, kept = [], np.zeros(len(places), bool)
        for k, begin in enumerate(_best_begins(joined, max(ks)), 1):
            if k in ks:
                end = np.r_[begin[1:], joined.shape[1] - 1]
                weight, total, _ = joined[:, end] - joined[:, begin]
                cost = float(_spread_of(joined, begin, end).sum())
                rows.append((k, (total / weight + shift).tolist(), [cost], 0))
                if k > 1:
                    kept |= cut_bounds(sums, places, c[places] == 1, k) <= cost + slack
        if len(rows) < len(set(ks)):
            kept[:] = True  # fewer ranges than clusters
        kept = places[kept]
        left = int(c[kept].sum()) if (c[kept] > 1).any() else 0
        rows.append((0, low[kept].tolist(), high[kept].tolist(), left))
        return pa.Table.from_pylist([dict(zip(schema.names, r, strict=True)) for r in rows], schema)

    return run


def _inside(lo: np.ndarray, end: np.ndarray):
    """A function for mapInArrow that keeps the rows whose first column lies in one of the ranges from ``lo`` to before ``end``."""

    def run(batches):
        for batch in batches:
            x = batch.column(0).to_numpy()
            at = np.searchsorted(lo, x, "right") - 1
            yield batch.filter(pa.array((at >= 0) & (x < end[np.maximum(at, 0)])))

    return run
