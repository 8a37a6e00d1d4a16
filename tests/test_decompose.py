"""Decompositions against numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from given import SMALL
from millrace.operators import decompose
from millrace.plans import catalog


def frame(spark, x, parts):
    return spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)] + [(-1, None)], "id long, x array<double>").repartition(parts)


def plain(x, k):
    c = x - x.mean(0)
    _, s, v = np.linalg.svd(c, full_matrices=False)
    v = v[:k].T * np.sign(v[:k].T[np.abs(v[:k].T).argmax(0), np.arange(k)])
    return v, s[:k] ** 2 / (len(x) - 1), (s * s).sum() / (len(x) - 1)


@pytest.mark.parametrize("parts", [1, 3, 40])
@pytest.mark.parametrize("method", [decompose.tall, decompose.wide])
def test_as_numpy(spark, parts, method):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 20)) * np.geomspace(10, 0.1, 20) @ np.linalg.qr(rng.normal(size=(20, 20)))[0] + 100
    loadings, variances, whole = plain(x, 5)
    df = frame(spark, x, parts)
    got = method(df, "x", 5)
    assert np.abs(got.loadings - loadings).max() < 1e-6
    assert got.variances == pytest.approx(variances, rel=1e-8) and got.shares == pytest.approx(variances / whole, rel=1e-8)
    scores = {r.id: r.scores for r in got.transform(df).collect()}
    assert scores[-1] is None
    assert np.abs(np.array([scores[i] for i in range(300)]) - (x - x.mean(0)) @ loadings).max() < 1e-4


def test_more_columns_than_rows(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(12, 400)) * np.geomspace(5, 0.5, 400)
    loadings, variances, _ = plain(x, 3)
    got = decompose.wide(frame(spark, x, 2), "x", 3)
    assert np.abs(got.loadings - loadings).max() < 1e-5 and got.variances == pytest.approx(variances, rel=1e-7)


def test_constant_and_empty(spark):
    df = spark.createDataFrame([(1, [2.0, 3.0]), (2, [2.0, 3.0])], "id long, x array<double>")
    for method in (decompose.tall, decompose.wide):
        assert method(df, "x", 1).variances == pytest.approx([0.0]) and method(df, "x", 1).shares == pytest.approx([0.0])
        with pytest.raises(ValueError):
            method(df.limit(0), "x", 1)


def test_registered_queries(spark):
    vectors = np.array([r.embedding for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").select("embedding").collect()])
    _, variances, whole = plain(vectors, 4)
    rows = catalog.queries()["FE12_wide_components"](spark, SMALL).orderBy("component").collect()
    assert [r.variance for r in rows] == pytest.approx(variances, rel=1e-5) and [r.share for r in rows] == pytest.approx(variances / whole, rel=1e-5)
    tall = {(r.component, r.column_name): r.loading for r in catalog.queries()["FE12_tall_components"](spark, SMALL).collect()}
    old = {(r.component, r.column_name): r.loading for r in catalog.queries()["FE12_pca_variance"](spark, SMALL).collect()}
    assert {k: abs(v) for k, v in tall.items()} == pytest.approx({k: abs(v) for k, v in old.items()}, abs=1e-5)
