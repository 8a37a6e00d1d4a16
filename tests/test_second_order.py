"""Second-order boosting against a plain numpy version."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from given import SMALL
from millrace.operators import evaluate, second_order
from millrace.operators.second_order import SecondOrderBoosting
from millrace.plans import catalog


def sample(n=400):
    rng = np.random.default_rng(9)
    a, b, c = np.round(rng.normal(size=n), 1), rng.integers(0, 5, n).astype(float), np.round(rng.uniform(size=n), 2)
    y = (rng.random(n) < 1 / (1 + np.exp(-(2 * a * (b > 2) + c - 0.5)))).astype(int)
    a[rng.random(n) < 0.2] = np.nan
    return np.stack([a, b, c]), y


def plain(x, y, trees, depth, eta, reg, gamma, min_weight, edges):
    """[(gain, column, edge, missing left) or weight, in depth-first order] per tree, all on raw values."""
    margin = np.zeros(len(y))
    out = []

    def grow(rows, level, g, h, log):
        best = None
        if level < depth:
            for side in (False, True):
                for c, es in enumerate(edges):
                    for e in es:
                        left = np.where(np.isnan(x[c, rows]), side, x[c, rows] < e)
                        gl, hl, gr, hr = g[rows][left].sum(), h[rows][left].sum(), g[rows][~left].sum(), h[rows][~left].sum()
                        if hl < min_weight or hr < min_weight:
                            continue
                        gain = (gl**2 / (hl + reg) + gr**2 / (hr + reg) - (gl + gr) ** 2 / (hl + hr + reg)) / 2 - gamma
                        if gain > 1e-9 and (best is None or gain > best[0] + 1e-12):
                            best = (gain, c, e, side, rows[left], rows[~left])
        if best is None:
            w = -eta * g[rows].sum() / (h[rows].sum() + reg)
            margin[rows] += w
            log.append(w)
        else:
            log.append(best[:4])
            grow(best[4], level + 1, g, h, log)
            grow(best[5], level + 1, g, h, log)

    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        log = []
        grow(np.arange(len(y)), 0, p - y, p * (1 - p), log)
        out.append(log)
    return out, margin


def listed(model, tree, node=0):
    if tree.column[node] < 0:
        return [tree.weight[node]]
    c = tree.column[node]
    here = (tree.gain[node], c, model.edges[c][tree.cut[node]], tree.missing_left[node])
    return [here, *listed(model, tree, tree.left[node]), *listed(model, tree, tree.right[node])]


@pytest.mark.parametrize("settings", [{}, {"reg": 3.0, "gamma": 0.4, "min_weight": 4.0}])
def test_trees_as_plain_ones(spark, settings):
    x, y = sample()
    rows = [(i, *[None if math.isnan(v) and i % 2 else float(v) for v in x[:, i]], int(y[i])) for i in range(len(y))]
    df = spark.createDataFrame([*rows, (-1, 1.0, 1.0, 1.0, None)], "id long, a double, b double, c double, label int")
    options = dict(trees=4, depth=3, eta=0.3, reg=1.0, gamma=0.0, min_weight=1.0) | settings
    fits = [SecondOrderBoosting(["a", "b", "c"], bins=16, store_every=2, **options).fit(df.repartition(p)) for p in (1, 4, 16)]
    want, margin = plain(x, y, edges=fits[0].edges, **options)
    for tree, log in zip(fits[0].trees, want, strict=True):
        got = listed(fits[0], tree)
        assert len(got) == len(log)
        for a, b in zip(got, log, strict=True):
            assert a == pytest.approx(b, abs=1e-6)
    for other in fits[1:]:
        assert other.trees == fits[0].trees
    scored = {r.id: r for r in fits[0].transform(df).collect()}
    for i in range(len(y)):
        assert scored[i].probability[1] == pytest.approx(1 / (1 + math.exp(-margin[i])), abs=1e-6)


def test_column_share_and_importances(spark):
    x, y = sample(300)
    df = spark.createDataFrame([(*map(float, x[:, i]), int(y[i])) for i in range(300)], "a double, b double, c double, label int")
    one = SecondOrderBoosting(["a", "b", "c"], trees=6, depth=2, column_share=0.3).fit(df)
    assert all(len({c for c in t.column if c >= 0}) <= 1 for t in one.trees) and len({c for t in one.trees for c in t.column}) > 2
    assert sum(g for _, g in one.importances()) == pytest.approx(1)


def test_nothing_to_split(spark):
    df = spark.createDataFrame([(1.0, None, 1), (1.0, None, 0), (1.0, None, 1)], "a double, b double, label int")
    model = SecondOrderBoosting(["a", "b"], trees=2).fit(df)
    assert all(t.column == [-1] for t in model.trees)


def test_registered_query(spark):
    got = catalog.queries()["M10_boosting_second_order"](spark, SMALL)
    assert got.columns == ["o_orderkey", "prediction", "pd"]
    from millrace.plans.frames import risk

    assert evaluate.auroc(got.join(risk(spark, SMALL), "o_orderkey"), "pd", "label").first()["auroc"] > 0.85
    assert got.where(~F.col("pd").between(0, 1)).count() == 0


def test_passes_and_rows(spark, monkeypatch):
    """A pass per level, none for the last leaves; equal rows are one, however many; sums of many tasks are added in a shuffle."""
    many = spark.range(0, 6_300_000, 1, 8).select((F.col("id") % 3).cast("double").alias("a"), ((F.col("id") % 7 + F.col("id") % 3) > 4).cast("int").alias("label"))
    fit = lambda: SecondOrderBoosting(["a"], trees=3, depth=2).fit(many)
    rows = []
    kept = SecondOrderBoosting._histograms
    monkeypatch.setattr(SecondOrderBoosting, "_histograms", lambda self, blocks, *args: rows.append(blocks) or kept(self, blocks, *args))
    model = fit()
    assert len(rows) == 3 * 2
    assert sum(len(r.n) // 8 for r in rows[0].collect()) == 3
    y = np.array([[(i % 7 + i % 3) > 4 for i in range(v, 42, 3)] for v in range(3)]).mean(1)
    gradient = (0.5 - y) * 2_100_000
    weights = np.array(model.trees[0].weight)
    assert weights[0] == pytest.approx(-0.3 * gradient.sum() / (1_575_000 + 1), rel=1e-9) and len(weights) == 5
    ends = model.trees[0].leaves(np.array([[0, 1, 2]]), model.missing)
    assert weights[ends] == pytest.approx(-0.3 * gradient / (525_000 + 1), rel=1e-9)
    monkeypatch.setattr(second_order, "TASKS", 0)
    assert fit().trees == model.trees


def test_leaves_by_bits():
    rng = np.random.default_rng(3)
    for splits in (0, 1, 20, 63, 90):
        tree = second_order.Tree()
        for _ in range(splits):
            ends = [i for i, c in enumerate(tree.column) if c < 0]
            tree.split(int(rng.choice(ends)), 1.0, int(rng.integers(3)), int(rng.integers(9)), bool(rng.integers(2)))
        bins = rng.integers(0, 11, (3, 500)).astype(np.uint8)
        assert (second_order.Finder(tree, 3, 10)(bins) == tree.leaves(bins, 10)).all()
