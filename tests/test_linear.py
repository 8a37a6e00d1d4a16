"""Logistic grids against single fits and plain numpy."""

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from given import SMALL
from millrace.operators import evaluate, linear, tune
from millrace.plans import catalog

SETTINGS = [(0.0, 0.0), (0.01, 0.0), (0.02, 0.5), (0.05, 1.0), (10.0, 1.0), (3.0, 0.0)]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(4)
    x = rng.normal([0, 2000, -3], [1, 5, 40], (600, 3))
    p = 1 / (1 + np.exp(-(0.8 * x[:, 0] + 0.2 * (x[:, 1] - 2000) - 0.2)))
    y = rng.random(600) < p
    data = [(i, i % 3, int(t), *map(float, v), 7.0) for i, (t, v) in enumerate(zip(y, x, strict=True))]
    return spark.createDataFrame(data, "id long, fold int, label int, a double, b double, c double, same double").persist()


@pytest.mark.parametrize("parts", [1, 5])
def test_as_single_fits(rows, parts):
    grid = linear.LogisticGrid(["a", "b", "c"], "label", SETTINGS, folds=3).fit(rows.repartition(parts))
    assert all(m.converged for m in grid.fits) and len(grid.fits) == 18
    vectors = VectorAssembler(inputCols=["a", "b", "c"], outputCol="v").transform(rows)
    for m in grid.fits:
        one = LogisticRegression(featuresCol="v", regParam=m.reg, elasticNetParam=m.alpha, maxIter=2000, tol=1e-14).fit(vectors.where(F.col("fold") != m.out))
        unit = np.array([1, 5, 40.0])
        assert m.coefficients * unit == pytest.approx(one.coefficients.toArray() * unit, abs=2e-6)
        assert m.intercept + m.coefficients[1] * 2000 == pytest.approx(one.intercept + one.coefficients[1] * 2000, abs=2e-6)


def test_lasso_is_at_its_optimum(rows):
    grid = linear.LogisticGrid(["a", "b", "c", "same"], "label", SETTINGS).fit(rows)
    data = np.array(rows.select("label", "a", "b", "c", "same").collect(), float)
    y, x = data[:, 0], data[:, 1:]
    unit = x.std(0, ddof=1)
    for m in grid.fits:
        p = 1 / (1 + np.exp(-(x @ m.coefficients + m.intercept)))
        assert m.coefficients[3] == 0 and abs((p - y).mean()) < 1e-9
        b, slope = (m.coefficients * unit)[:3], ((p - y) @ ((x - x.mean(0)) / np.where(unit, unit, 1)) / len(y))[:3]
        for bj, g in zip(b, slope, strict=True):
            if bj:
                assert g + m.reg * (m.alpha * np.sign(bj) + (1 - m.alpha) * bj) == pytest.approx(0, abs=1e-8)
            else:
                assert abs(g) <= m.reg * m.alpha + 1e-9
    assert (grid.fits[4].coefficients == 0).all()


def test_aurocs_of_all_models_at_once(rows):
    grid = linear.LogisticGrid(["a", "b", "c"], "label", SETTINGS, folds=3).fit(rows)
    scored = grid.scores(rows, ["label", "fold"])
    found = linear.fold_aurocs(scored, "label", len(SETTINGS))
    for i in (1, 4):
        for f in range(3):
            one = evaluate.auroc(scored.where(F.col("fold") == f).withColumn("s", F.get("scores", F.lit(i))), "s", "label").first()["auroc"]
            assert found[i][f] == pytest.approx(one, abs=1e-12)
    assert found[4][0] == 0.5  # all coefficients are zero


def test_jobs_do_not_depend_on_the_grid(spark, rows):
    def jobs(settings, group):
        spark.sparkContext.setJobGroup(group, group)
        linear.LogisticGrid(["a", "c"], "label", settings, folds=3, max_iter=4, tol=0).fit(rows)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    many = [(10.0**-i, a) for i in range(1, 11) for a in (0.0, 1.0)]
    assert jobs(many, "many models") == jobs(many[:1], "few models")


def test_registered_grid(spark):
    got = catalog.queries()["E7_grid_search"](spark, SMALL).collect()
    assert len(got) == 40 and got[0].mean_auroc > 0.8 and all(0 <= r.std_auroc < 0.3 for r in got)
    folds = {r.fold: r.auroc for r in catalog.queries()["E6_cross_validation"](spark, SMALL).collect()}
    assert folds[-1] == pytest.approx(sum(folds[i] for i in range(5)) / 5)


def test_aurocs_of_parts_are_those_of_the_whole(spark):
    """Ties within and between classes, a constant score, and a fold of one class; any number of parts gives the same."""
    rng = np.random.default_rng(7)
    n = 3000
    fold, y = rng.integers(0, 3, n), rng.integers(0, 2, n)
    y[fold == 2] = 1
    scores = np.stack([np.round(rng.normal(size=n) + y, 1), np.full(n, 0.5), rng.random(n)], 1)
    df = spark.createDataFrame([(int(f), int(v), [float(x) for x in s]) for f, v, s in zip(fold, y, scores, strict=True)] + [(0, None, [0.1, 0.1, 0.1])], "fold int, label int, scores array<double>").repartition(4)
    for size in (10_000, 700, 100):
        got = linear.fold_aurocs(df, "label", 3, bucket_rows=size)
        for m in range(3):
            assert set(got[m]) == {0, 1}
            for f in (0, 1):
                pos, neg = (scores[(fold == f) & (y == c), m] for c in (1, 0))
                want = ((pos[:, None] > neg).sum() + (pos[:, None] == neg).sum() / 2) / (len(pos) * len(neg))
                assert got[m][f] == pytest.approx(want, abs=1e-12)


def test_log_sums():
    x = 1 + np.random.default_rng(3).random((1700, 4))
    assert linear._log_sums(x) == pytest.approx(np.log(x).sum(0), rel=1e-14)
    assert linear._log_sums(np.full((512, 1), 2.0))[0] == pytest.approx(512 * np.log(2))
