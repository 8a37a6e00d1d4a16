"""Exact quantiles with linear interpolation that never gather a whole column in one place."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.running import running_totals

_ACCURACY = 10_000
_MANY = 64  # more order statistics are read from running counts: an expression for each would make plans too large


def _valid(name: str):
    c = F.col(name).cast("double")
    return F.when(~F.isnan(c), c)


def exact_quantiles(
    df: DataFrame, cols: Sequence[str], probs: Sequence[float], limit: int = 100_000
) -> dict[str, list[float | None]]:
    """``{column: [quantile per probability]}``, NULL and NaN ignored.

    Columns of at most ``limit`` values use the built-in exact aggregate. Longer ones are narrowed:
    a mergeable sketch brackets each wanted order statistic, one counting pass checks the bracket,
    and the step repeats inside it until few enough values are left for the exact aggregate.
    """
    cols = list(cols)
    counts = df.agg(*[F.count(_valid(c)).alias(f"n{i}") for i, c in enumerate(cols)]).first()
    sizes = {c: counts[f"n{i}"] for i, c in enumerate(cols)}
    small = [c for c in cols if 0 < sizes[c] <= limit]
    out: dict[str, list[float | None]] = {c: [None] * len(probs) for c in cols}
    if small:
        row = df.agg(
            *[F.percentile(_valid(c), F.array(*map(F.lit, probs))).alias(f"q{i}") for i, c in enumerate(small)]
        ).first()
        for i, c in enumerate(small):
            out[c] = list(row[f"q{i}"])
    big = [c for c in cols if sizes[c] > limit]
    if big:
        position = {(c, p): p * (sizes[c] - 1) for c in big for p in probs}
        targets = {(c, math.floor(pos), math.ceil(pos)) for (c, _), pos in position.items()}
        found = _order_statistics(df, targets, sizes, limit) if len(targets) <= _MANY else _by_running_counts(df, targets)
        for c in big:
            for j, p in enumerate(probs):
                pos = position[(c, p)]
                low, high = found[(c, math.floor(pos))], found[(c, math.ceil(pos))]
                out[c][j] = low + (high - low) * (pos - math.floor(pos))
    return out


def _by_running_counts(df, targets):
    """Values at 0-based ranks, all in one go: equal values are counted once, their running counts say which ranks they hold."""
    columns = sorted({t[0] for t in targets})
    ranks = [np.array(sorted({r for t in targets if t[0] == c for r in t[1:]})) for c in columns]
    long = df.select(F.posexplode(F.array(*[_valid(c) for c in columns])).alias("c", "v")).where(F.col("v").isNotNull())
    run = running_totals(long.groupBy("c", "v").agg(F.count("*").alias("n")), "v", ["n"], by=["c"])

    def held(batches):
        for batch in batches:
            which, v, n, upto = (x.to_numpy() for x in batch.columns)
            for c in np.unique(which):
                at = np.flatnonzero(which == c)
                first, last = (np.searchsorted(ranks[c], x[at]) for x in (upto - n, upto))
                some = last > first
                out = np.concatenate([np.arange(a, b) for a, b in zip(first[some], last[some])] or [np.zeros(0, int)])
                value = np.repeat(v[at[some]], (last - first)[some])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(out), c, np.int32)), pa.array(ranks[c][out].astype(np.int64)), pa.array(value)], ["c", "r", "v"])

    counts = run.select("c", "v", "n", F.col("n_run").cast("long").alias("upto"))
    return {(columns[c], r): v for c, r, v in counts.mapInArrow(held, "c int, r long, v double").collect()}


def _order_statistics(df, targets, sizes, limit):
    """Values at 0-based ranks; a target (column, rank, rank or next) keeps one bracket for both."""
    found: dict = {}
    # bracket [lo, hi] with the number of values below it and inside it; None is the whole column
    state = {t: (None, None, 0, sizes[t[0]]) for t in targets}
    while state:
        ready = sorted(t for t in state if state[t][3] <= limit)
        if ready:
            picks = []
            for i, t in enumerate(ready):
                _, _, below, n = state[t]
                shares = [(r - below) / max(1, n - 1) for r in t[1:]]
                picks.append(F.percentile(_inside(t, state[t]), F.array(*map(F.lit, shares))).alias(f"v{i}"))
            row = df.agg(*picks).first()
            for i, t in enumerate(ready):
                found.update({(t[0], r): v for r, v in zip(t[1:], row[f"v{i}"])})
                state.pop(t)
        keys = sorted(state)
        if not keys:
            break
        brackets = _brackets(df, keys, state)
        checks = []
        for i, t in enumerate(keys):
            low, high = brackets[t]
            v = _valid(t[0])
            checks += [F.count(F.when(v < low, 1)).alias(f"l{i}"), F.count(F.when(v.between(low, high), 1)).alias(f"m{i}")]
        tested = df.agg(*checks).first()
        for i, t in enumerate(keys):
            low, high = brackets[t]
            below, mid = tested[f"l{i}"], tested[f"m{i}"]
            holds = below <= t[1] and t[2] < below + mid
            if holds and low == high:
                found.update({(t[0], r): low for r in t[1:]})
                state.pop(t)
            elif holds and mid < state[t][3]:
                state[t] = (low, high, below, mid)
            else:
                state.pop(t)
                found.update({(t[0], r): _split(df, t[0], r) for r in t[1:]})
    return found


def _inside(target, bracket):
    v, (lo, hi, _, _) = _valid(target[0]), bracket
    return v if lo is None else F.when(v.between(lo, hi), v)


def _brackets(df, keys, state):
    """Sketched bounds around every target; targets that still span a whole column share its sketch."""
    margin = 4 / _ACCURACY
    around = {}
    for t in keys:
        _, _, below, n = state[t]
        shares = [(r - below) / max(1, n - 1) for r in t[1:]]
        around[t] = (max(0.0, min(shares) - margin), min(1.0, max(shares) + margin))
    whole: dict[str, list] = {}
    for t in keys:
        if state[t][0] is None:
            whole.setdefault(t[0], []).append(t)
    groups = list(whole.values()) + [[t] for t in keys if state[t][0] is not None]
    row = df.agg(
        *[F.percentile_approx(_inside(g[0], state[g[0]]), [p for t in g for p in around[t]], _ACCURACY).alias(f"b{i}") for i, g in enumerate(groups)]
    ).first()
    return {t: tuple(row[f"b{i}"][2 * j : 2 * j + 2]) for i, g in enumerate(groups) for j, t in enumerate(g)}


def _split(df, column, rank):
    """Bisection on the value for a rank that the sketch does not isolate (few distinct values, huge ties)."""
    v = _valid(column)
    lo, hi = df.agg(F.min(v), F.max(v)).first()
    while lo < hi:
        mid = lo + (hi - lo) / 2
        if mid >= hi:  # neighbouring doubles: the midpoint rounds up
            mid = lo
        # both sides snap to existing values, so the interval always shrinks
        upto, left, right = df.agg(
            F.count(F.when(v <= mid, 1)), F.max(F.when(v <= mid, v)), F.min(F.when(v > mid, v))
        ).first()
        if rank < upto:
            hi = left
        else:
            lo = right
    return lo
