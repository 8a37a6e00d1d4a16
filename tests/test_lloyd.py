"""One-column k-means in batches, and its optimum, against plain versions."""

from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from given import SMALL
from millrace.operators import cluster, lloyd
from millrace.plans import catalog


def cost(x, w):
    m = np.average(x, weights=w)
    return float((w * (x - m) ** 2).sum())


def brute(x, w, k):
    best = (np.inf, None)
    for c in combinations(range(1, len(x)), k - 1):
        parts = [slice(a, b) for a, b in zip((0, *c), (*c, len(x)), strict=True)]
        best = min(best, (sum(cost(x[p], w[p]) for p in parts), c), key=lambda t: t[0])
    return best


def test_optimal_ranges():
    rng = np.random.default_rng(1)
    for n in (1, 2, 5, 9, 13):
        x = np.sort(rng.choice(200, n, replace=False)).astype(float)
        w = rng.integers(1, 6, n).astype(float)
        for k, begins in enumerate(lloyd.optimal_ranges(x, w, 4), 1):
            total = sum(cost(x[a:b], w[a:b]) for a, b in zip(begins, [*begins[1:], n], strict=True))
            assert total == pytest.approx(brute(x, w, k)[0], abs=1e-9) and len(begins) == k
        assert len(lloyd.optimal_ranges(x, w, 20)) == min(n, 20)


def test_optimum_over_merged_values(spark):
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(m, 1, 400) for m in (0, 30, 45, 90)])
    values = lloyd.value_table(spark.createDataFrame([(float(v),) for v in x], "x double"), F.col("x"), [F.lit(1)]).persist()
    exact = lloyd.optimum(values, [2, 4])
    merged = lloyd.optimum(values, [2, 4], limit=50)
    for k in (2, 4):
        assert merged[k].cost == pytest.approx(exact[k].cost, rel=1e-9)
        assert merged[k].centres == pytest.approx(exact[k].centres)


@pytest.mark.parametrize("parts", [1, 7])
def test_models_move_together_as_alone(spark, parts):
    rng = np.random.default_rng(2)
    x = np.round(rng.normal(0, 10, 300), 1)
    sub = rng.integers(0, 2, 300)
    df = spark.createDataFrame([(float(v), int(s)) for v, s in zip(x, sub, strict=True)], "x double, s int").repartition(parts)
    values = lloyd.value_table(df, F.col("x"), [F.expr("int(s = 0)"), F.expr("int(s = 1)"), F.lit(1)]).persist()
    together = lloyd.lloyd(values, 3, [2, 3, 5], restarts=4)
    start = lloyd.starts(values, [2, 3, 5], 4, 24)
    for (s, k), model in together.items():
        mine = x if s == 2 else x[sub == s]
        best = np.inf
        for c in start[k]:
            for _ in range(100):
                g = np.searchsorted((c[1:] + c[:-1]) / 2, mine, "right")
                c = np.array([mine[g == j].mean() if (g == j).any() else c[j] for j in range(k)])
            best = min(best, sum(((mine[g == j] - c[j]) ** 2).sum() for j in range(k)))
        assert model.cost == pytest.approx(best)
    assert lloyd.optimum(values.select("x", F.array(F.get("w", F.lit(2))).alias("w")), [3])[3].cost <= together[2, 3].cost + 1e-9


def test_range_classifiers_are_at_the_optimum(spark):
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(50, 20, 200), 1)
    values = lloyd.value_table(spark.createDataFrame([(float(v),) for v in x], "x double").repartition(3), F.col("x"), [F.lit(1)]).persist()
    models = [lloyd.Model(0, np.array([30.0, 70.0])), lloyd.Model(0, np.array([20.0, 50.0, 80.0]))]
    for m, b in zip(models, cluster.range_classifiers(values, 1, models), strict=True):
        y = np.searchsorted(m.cuts, x, "right")
        score = x[:, None] * b[:, 0] + b[:, 1]
        p = np.exp(score - score.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        r = p - np.eye(m.k)[y]
        assert np.abs(r.sum(0)).max() < 1e-3 and np.abs(x @ r + b[:, 0]).max() < 0.05
        assert (score.argmax(1) == y).mean() > 0.97


def test_best_k_of_planted_groups(spark):
    rng = np.random.default_rng(2)
    df = spark.createDataFrame([(i, float(rng.normal([0, 50, 100, 150][i % 4], 1))) for i in range(400)], "id long, x double")
    scores, best = cluster.best_k_stable(df, "id", "x")
    assert best == 4 and dict(scores)[4] == 0.0 and [k for k, _ in scores] == [2, 3, 4, 5, 6, 7]
    assert cluster.best_k_stable(df, "id", "x", ks=[4], folds=3, repeats=2)[0] == [(4, 0.0)]


def test_disagreement_is_after_the_best_relabeling():
    assert cluster.disagreement(np.array([[0, 7], [5, 1]])) == pytest.approx(1 / 13)
    assert cluster.disagreement(np.zeros((3, 3))) == 0.0


def test_exact_groups_need_enough_values(spark):
    df = spark.createDataFrame([(1.0,), (1.0,), (None,)], "x double")
    with pytest.raises(ValueError):
        cluster.OneColumnKMeans("x", 2, exact=True).fit(df)


def test_registered_search_runs_its_whole_settings(spark):
    rows = catalog.queries()["C2_best_k"](spark, SMALL).collect()
    assert [r.k for r in rows] == [2, 3, 4, 5, 6, 7] and sum(r.chosen for r in rows) == 1


def test_optimum_of_more_values_than_the_limit(spark):
    """Gamma values with a heavy end: clusters of merged ranges lead to a model that costs up to a fifth more (k 3)."""
    x = np.unique(np.round(np.random.default_rng(1).gamma(0.3, 50, 400), 3))
    values = lloyd.value_table(spark.createDataFrame([(float(v),) for v in x], "x double").repartition(3), F.col("x"), [F.lit(1)]).persist()
    exact = lloyd.optimum(values, [1, 2, 3, 5])
    for limit in (2, 12, 100):
        found = lloyd.optimum(values, [1, 2, 3, 5], limit=limit)
        for k, want in exact.items():
            assert found[k].cost == pytest.approx(want.cost, rel=1e-9) and found[k].centres == pytest.approx(want.centres)


def test_bounds_of_cuts_are_no_more_than_any_cost():
    rng = np.random.default_rng(4)
    for _ in range(60):
        n, k = int(rng.integers(6, 12)), int(rng.integers(2, 5))
        x, w = np.sort(rng.choice(300, n, replace=False)).astype(float), rng.integers(1, 5, n).astype(float)
        own = np.unique(np.sort(rng.integers(0, n, n)), return_inverse=True)[1]
        sums, size = lloyd._running(*(np.bincount(own, c) for c in (w, w * x, w * x * x))), np.bincount(own)
        got = lloyd.cut_bounds(sums, np.arange(len(size)), size == 1, k)
        for cuts in combinations(range(1, n), k - 1):
            total = sum(cost(x[a:b], w[a:b]) for a, b in zip((0, *cuts), (*cuts, n), strict=True))
            assert all(got[own[c - 1]] <= total + 1e-6 for c in cuts)
