"""Medcouple, fences and power transform against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import robust


def brute_medcouple(x):
    x = np.sort(np.asarray(x, dtype=float))
    m = np.median(x)
    upper, lower = x[x >= m], x[x <= m]
    ties = int((x == m).sum())
    values = [((a - m) - (m - b)) / (a - b) for a in upper for b in lower if a != b]
    values += [float(np.sign(ties - 1 - i - j)) for i in range(ties) for j in range(ties)]
    return float(np.median(values))


CASES = {
    "skewed": np.random.default_rng(1).exponential(size=61),
    "even": np.random.default_rng(2).normal(size=40),
    "ties at median": np.array([0, 0, 0, 0, 1, 2, 3, -1, 5, 9, 0, -2.0]),
    "mostly equal": np.array([3.0] * 30 + [1, 8, 9]),
    "constant": np.array([2.0] * 7),
}


@pytest.mark.parametrize("case", CASES)
def test_medcouple_bounded(spark, case):
    df = spark.createDataFrame([(float(v),) for v in CASES[case]], "x double")
    assert robust.medcouple(df, "x") == pytest.approx(brute_medcouple(CASES[case]), abs=1e-9)


@pytest.mark.parametrize("case", ["skewed", "ties at median"])
def test_medcouple_distributed(spark, case):
    df = spark.createDataFrame([(float(v),) for v in CASES[case]], "x double").repartition(3)
    assert robust.medcouple(df, "x", limit=0) == pytest.approx(brute_medcouple(CASES[case]), abs=1e-9)


def test_fences_and_clip(spark):
    x = CASES["skewed"]
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(x)] + [(999, None)], "id long, x double")
    lo, hi = robust.adjusted_fences(df, ["x"])["x"]
    q1, q3 = np.quantile(x, [0.25, 0.75])
    mc = brute_medcouple(x)
    assert lo == pytest.approx(q1 - 1.5 * math.exp(-3.5 * mc) * (q3 - q1))
    assert hi == pytest.approx(q3 + 1.5 * math.exp(4 * mc) * (q3 - q1))
    out = robust.winsorize_adjusted(df, ["x"], {"x": (0.1, 1.0)})
    assert out.where("x IS NULL").count() == 1
    assert out.agg(F.min("x"), F.max("x")).first()[:] == (0.1, 1.0)


def _yj(x, lam):
    with np.errstate(all="ignore"):
        pos = np.log1p(x) if abs(lam) < 1e-12 else ((x + 1) ** lam - 1) / lam
        neg = -np.log1p(-x) if abs(lam - 2) < 1e-12 else -((1 - x) ** (2 - lam) - 1) / (2 - lam)
    return np.where(x >= 0, pos, neg)


@pytest.mark.parametrize("lam", [-1.0, 0.0, 0.5, 1.0, 2.0, 3.0])
def test_yeo_johnson_branches(spark, lam):
    xs = [-2.0, -0.5, 0.0, 0.3, 4.0]
    df = spark.createDataFrame([(x,) for x in xs], "x double").select("x", robust.yeo_johnson(F.col("x"), lam).alias("y"))
    np.testing.assert_allclose([r["y"] for r in df.collect()], [float(_yj(np.array([x]), lam)[0]) for x in xs], atol=1e-12)


def test_fitted_power_is_the_maximum(spark):
    x = np.random.default_rng(4).lognormal(size=300)
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    lam = robust.fit_yeo_johnson(df, ["x"])["x"]

    def ll(p):
        return -len(x) / 2 * math.log(np.var(_yj(x, p))) + (p - 1) * np.sum(np.sign(x) * np.log1p(np.abs(x)))

    fine = np.linspace(lam - 0.5, lam + 0.5, 2001)
    assert abs(lam - fine[np.argmax([ll(p) for p in fine])]) < 2e-3


def test_medcouple_of_many_blocks(spark):
    """More values than a block holds: the same as the search in one task, in few passes."""
    x = np.random.default_rng(5).lognormal(size=9000).round(4)
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    assert robust.medcouple(df, "x", limit=0) == pytest.approx(robust.medcouple(df, "x"), abs=1e-12)
