"""One-column k-means groups, exact one-column silhouette, and stability-based choice of k."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import permutations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.lloyd import Model, group_by_cuts, lloyd, matrix, optimum, slot_sums, value_table
from millrace.operators.ordering import hash_order
from millrace.operators.running import running_totals
from millrace.runtime import cut_lineage


class OneColumnKMeans:
    """k-means on one column, best of several starts by cost; groups are numbered by ascending centre.

    ``exact``: the optimum in place of the best of the starts.
    """

    def __init__(self, col: str, k: int, restarts: int = 10, max_iter: int = 100, seed: int = 24, exact: bool = False):
        self.col, self.k, self.restarts, self.max_iter, self.seed, self.exact = col, k, restarts, max_iter, seed, exact

    def fit(self, df: DataFrame) -> "OneColumnKMeans":
        values = value_table(df, F.col(self.col), [F.lit(1)]).persist()
        try:
            if self.exact:
                found = optimum(values, [self.k]).get(self.k)
                if found is None:
                    raise ValueError(f"fewer than {self.k} distinct values")
            else:
                found = lloyd(values, 1, [self.k], restarts=self.restarts, max_iter=self.max_iter, seed=self.seed)[0, self.k]
        finally:
            values.unpersist()
        self.cost, self.centres, self.cuts = found.cost, found.centres.tolist(), found.cuts.tolist()
        return self

    def transform(self, df: DataFrame, out: str = "group") -> DataFrame:
        """In one dimension the nearest centre follows from the midpoints, so this is a plain expression."""
        return df.withColumn(out, group_by_cuts(F.col(self.col), self.cuts))


def silhouette(df: DataFrame, value: str, cluster: str, limit: int = 64) -> DataFrame:
    """(value, cluster, n, silhouette) per distinct value with plain distances, exact.

    Counts and sums of every cluster below a value come from one running total over the distinct
    values, one column pair per cluster, so no pair of rows is ever formed. Rows without a value or
    cluster are left out.
    """
    df = df.where(F.col(value).cast("double").isNotNull() & F.col(cluster).isNotNull())
    clusters = [r[0] for r in df.select(cluster).distinct().orderBy(cluster).limit(limit + 1).collect()]
    if len(clusters) > limit:
        raise ValueError(f"more than {limit} clusters")
    x = F.col(value).cast("double")
    aggs = []
    for j, c in enumerate(clusters):
        mine = F.col(cluster) == c
        aggs += [F.count(F.when(mine, 1)).alias(f"n{j}"), F.coalesce(F.sum(F.when(mine, x)), F.lit(0.0)).alias(f"s{j}")]
    per_value = df.groupBy(x.alias("value")).agg(*aggs)
    measures = [m for j in range(len(clusters)) for m in (f"n{j}", f"s{j}")]
    run = running_totals(per_value, "value", measures)
    totals = df.agg(F.struct(*aggs).alias("t")).scalar()
    wide = run.withColumn("t", totals)
    v = F.col("value")
    distance = [
        v * F.col(f"n{j}_run") - F.col(f"s{j}_run") + (F.col(f"t.s{j}") - F.col(f"s{j}_run")) - v * (F.col(f"t.n{j}") - F.col(f"n{j}_run"))
        for j in range(len(clusters))
    ]
    rows = []
    for j, c in enumerate(clusters):
        others = [distance[i] / F.col(f"t.n{i}") for i in range(len(clusters)) if i != j]
        near = F.least(*others) if len(others) > 1 else (others[0] if others else F.lit(0.0))
        own = distance[j] / F.nullif(F.col(f"t.n{j}") - 1, F.lit(0))
        score = (near - own) / F.nullif(F.greatest(near, own), F.lit(0.0))
        rows.append(F.struct(F.lit(c).alias("cluster"), F.col(f"n{j}").alias("n"), F.coalesce(score, F.lit(0.0)).alias("silhouette")))
    return wide.select("value", F.inline(F.array(*rows))).where("n > 0")


def mean_silhouette(df: DataFrame, value: str, cluster: str) -> DataFrame:
    s = silhouette(df, value, cluster)
    return s.agg((F.sum(F.col("silhouette") * F.col("n")) / F.sum("n")).alias("mean_silhouette"), F.sum("n").alias("n"))


def disagreement(cells: np.ndarray) -> float:
    """Smallest share of mismatches of a k × k table over all relabelings."""
    total = cells.sum()
    if not total:
        return 0.0
    k = len(cells)
    orders = np.array(list(permutations(range(k))))
    return float(1 - cells[np.arange(k), orders].sum(1).max() / total)


def range_classifiers(values: DataFrame, subsets: int, models: Sequence[Model], penalty: float = 1.0, max_iter: int = 50, tol: float = 1e-9) -> list[np.ndarray]:
    """Per model a multinomial logistic regression of its groups on the value: [class, (slope, intercept)].

    Minimises the sum of log losses and ``penalty``/2 times the squared slopes, by Newton steps; all models take a step in
    one aggregate. A step that does not lower a model's objective is halved.
    """
    row = values.agg(F.avg("x").alias("m"), F.stddev_pop("x").alias("s")).first()
    mean, scale = row["m"], row["s"] or 1.0
    ridge = penalty / scale**2
    ks = [m.k for m in models]
    width = 1 + max(2 * k + 3 * k * k for k in ks)  # loss, gradients, and three moments of every pair of classes

    def evaluate(at: list[int], coefs: list[np.ndarray]) -> np.ndarray:
        cuts, subset = [models[i].cuts for i in at], [models[i].subset for i in at]

        def add(batch, total):
            x, w = matrix(batch, subsets)
            z = (x - mean) / scale
            powers = np.stack([np.ones_like(z), z, z * z])
            for n, (c, s, b) in enumerate(zip(cuts, subset, coefs, strict=True)):
                k = len(b)
                group = np.searchsorted(c, x, "right")
                score = z[:, None] * b[:, 0] + b[:, 1]
                score -= score.max(1, keepdims=True)
                p = np.exp(score)
                sums = p.sum(1)
                p /= sums[:, None]
                mine = w[:, s]
                r = p.copy()
                r[np.arange(len(x)), group] -= 1
                r *= mine[:, None]
                cell = total[n]
                cell[0] += (mine * (np.log(sums) - score[np.arange(len(x)), group])).sum()
                cell[1 : 1 + 2 * k] += np.stack([z @ r, r.sum(0)], 1).reshape(-1)
                moments = [np.diag((p * (mine * e)[:, None]).sum(0)) - (p * (mine * e)[:, None]).T @ p for e in powers]
                cell[1 + 2 * k : 1 + 2 * k + 3 * k * k] += np.stack(moments).reshape(-1)

        return slot_sums(values, len(at), width, add)

    coefs = [np.zeros((k, 2)) for k in ks]
    steps = [np.zeros((k, 2)) for k in ks]
    objective = [np.inf] * len(models)
    share = [1.0] * len(models)
    open_ = list(range(len(models)))
    for _ in range(max_iter):
        tried = [coefs[i] + share[i] * steps[i] for i in open_]
        sums = evaluate(open_, tried)
        still = []
        for i, b, cell in zip(open_, tried, sums, strict=True):
            k = ks[i]
            value = cell[0] + ridge / 2 * (b[:, 0] ** 2).sum()
            if value > objective[i] + 1e-12 * abs(objective[i]):
                share[i] /= 2
                if share[i] > 1e-6:
                    still.append(i)
                continue
            coefs[i], objective[i], share[i] = b, value, 1.0
            g = cell[1 : 1 + 2 * k].reshape(k, 2).copy()
            g[:, 0] += ridge * b[:, 0]
            m = cell[1 + 2 * k : 1 + 2 * k + 3 * k * k].reshape(3, k, k)
            h = np.block([[m[2] + ridge * np.eye(k), m[1]], [m[1], m[0]]])
            step = -np.linalg.lstsq(h, np.concatenate([g[:, 0], g[:, 1]]), rcond=1e-12)[0]
            steps[i] = step.reshape(2, k).T
            if -(g * steps[i]).sum() > tol * max(1.0, value):
                still.append(i)
        open_ = still
        if not open_:
            break
    out = []
    for b in coefs:  # back to the column's own scale
        out.append(np.stack([b[:, 0] / scale, b[:, 1] - b[:, 0] * mean / scale], 1))
    return out


def told_and_own(values: DataFrame, subsets: int, cases: Sequence[tuple[int, np.ndarray, Model]]) -> list[np.ndarray]:
    """Per (subset, classifier, model) the k × k table of the classifier's groups against the model's, in one aggregate."""
    ks = [m.k for _, _, m in cases]
    width = max(ks) ** 2
    cuts = [m.cuts for _, _, m in cases]
    plain = [(s, c) for s, c, _ in cases]

    def add(batch, total):
        x, w = matrix(batch, subsets)
        for n, ((s, c), cut) in enumerate(zip(plain, cuts, strict=True)):
            told = (x[:, None] * c[:, 0] + c[:, 1]).argmax(1)
            cell = told * len(c) + np.searchsorted(cut, x, "right")
            total[n, : len(c) ** 2] += np.bincount(cell, w[:, s], len(c) ** 2)

    sums = slot_sums(values, len(cases), width, add)
    return [row[: k * k].reshape(k, k) for row, k in zip(sums, ks, strict=True)]


def best_k_stable(
    df: DataFrame,
    key: str,
    col: str,
    ks: Sequence[int] = range(2, 8),
    folds: int = 2,
    repeats: int = 5,
    random_labelings: int = 100,
    restarts: int = 10,
    seed: int = 24,
) -> tuple[list[tuple[int, float]], int]:
    """Normalised instability per k, and the chosen k (smallest value, ties to the larger k).

    One part is clustered and a logistic model learns its groups; the model's groups for the other part are compared with
    that part's own clustering, relative to random groups. All clusterings of all k, repeats, folds and starts move in the
    same rounds over one table of distinct values, the logistic models likewise, so the number of jobs does not depend on
    how many there are. The table that random groups would make follows from the sizes of the clusters alone: each
    cluster's rows fall into k groups by chance.
    """
    fold = [F.pmod(hash_order([key], seed + r), F.lit(folds)) for r in range(repeats)]
    test = [(r, f) for r in range(repeats) for f in range(folds)]
    inside = [fold[r] == f for r, f in test]
    outside = [] if folds == 2 else [~c for c in inside]  # with two folds the other one
    weights = [c.cast("int") for c in [*inside, *outside]]
    train = [r * folds + 1 - f if folds == 2 else len(test) + r * folds + f for r, f in test]
    values = cut_lineage(value_table(df, F.col(col), weights))
    subsets = len(weights)
    ks = list(ks)
    best = lloyd(values, subsets, ks, restarts=restarts, seed=seed)
    order = [(s, k) for k in ks for s in sorted(set(train))]
    told = dict(zip(order, range_classifiers(values, subsets, [best[o] for o in order]), strict=True))
    cases = [(k, s, t) for k in ks for s, t in enumerate(train)]
    tables = told_and_own(values, subsets, [(s, told[t, k], best[s, k]) for k, s, t in cases])
    rng = np.random.default_rng(seed)
    found, chance = dict.fromkeys(ks, 0.0), dict.fromkeys(ks, 0.0)
    for (k, _, _), cells in zip(cases, tables, strict=True):
        found[k] += disagreement(cells)
        sizes = np.round(cells.sum(0)).astype(np.int64)
        chance[k] += sum(disagreement(rng.multinomial(sizes, [1 / k] * k)) for _ in range(random_labelings)) / random_labelings
    results = [(k, found[k] / chance[k] if chance[k] else 0.0) for k in ks]
    low = min(s for _, s in results)
    return results, max(k for k, s in results if s == low)
