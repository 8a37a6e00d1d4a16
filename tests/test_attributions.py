"""Tree attributions against enumeration of all subsets of columns."""

from itertools import combinations
from math import factorial

import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from given import SMALL
from millrace.operators import attributions
from millrace.operators.second_order import SecondOrderBoosting
from millrace.plans import catalog

NAMES = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(6)
    x = np.round(rng.normal(size=(300, 4)), 2)
    y = (x[:, 0] * x[:, 1] + x[:, 2] + 0.3 * rng.normal(size=300) > 0.2).astype(int)
    df = spark.createDataFrame([(i, *map(float, v), int(t)) for i, (v, t) in enumerate(zip(x, y, strict=True))], "id long, a double, b double, c double, d double, label int")
    return VectorAssembler(inputCols=NAMES, outputCol="features").transform(df).persist()


def enumerated(score, x, z):
    """Mean over background rows z of the exact attributions of one row."""
    d = len(x)
    phi = np.zeros(d)
    for b in z:
        value = {s: score(np.where(np.isin(np.arange(d), s), x, b)) for n in range(d + 1) for s in combinations(range(d), n)}
        for j in range(d):
            for s in value:
                if j not in s:
                    w = factorial(len(s)) * factorial(d - len(s) - 1) / factorial(d)
                    phi[j] += w * (value[tuple(sorted((*s, j)))] - value[s])
    return phi / len(z)


def box_score(boxes, v):
    return sum(b.value for b in boxes if b.outside(v[None, :])[0] == 0)


@pytest.mark.parametrize("family", ["tree", "forest", "boosted"])
def test_as_enumerated(spark, rows, family):
    cls = {"tree": DecisionTreeClassifier(maxDepth=5), "forest": RandomForestClassifier(numTrees=4, maxDepth=4, seed=1), "boosted": GBTClassifier(maxIter=3, maxDepth=3, seed=1)}[family]
    model = cls.fit(rows)
    boxes = attributions.spark_boxes(model)
    out = attributions.tree_attributions(rows.repartition(3), "id", NAMES, boxes, rows.where("id < 40"), rows=12, seed=1)
    got = {r.id: r for r in out.collect()}
    raw = "rawPrediction" if family == "boosted" else "probability"
    scores = {r.id: r.s for r in model.transform(rows).select("id", vector_to_array(raw)[1].alias("s")).collect()}
    for i, s in scores.items():
        # a boosted model's raw prediction of class 1 is its margin
        assert sum(got[i][f"phi_{n}"] for n in NAMES) + got[i].base_score == pytest.approx(s, abs=1e-9)
    sample = rows.where("id < 40").select(*[F.col(n).alias(f"x{k}") for k, n in enumerate(NAMES)])
    z = np.array(sample.orderBy(F.xxhash64(*sample.columns, F.lit(1)), *sample.columns).limit(12).collect())
    x = {r.id: np.array(r[1:]) for r in rows.where("id >= 290").select("id", *NAMES).collect()}
    for i, v in x.items():
        assert [got[i][f"phi_{n}"] for n in NAMES] == pytest.approx(enumerated(lambda t: box_score(boxes, t), v, z), abs=1e-9)


def test_boosting_with_missing_values(spark, rows):
    holes = rows.drop("features").withColumn("a", F.when(F.col("id") % 4 != 0, F.col("a"))).withColumn("c", F.when(F.col("id") % 5 == 0, float("nan")).otherwise(F.col("c")))
    model = SecondOrderBoosting(NAMES, trees=3, depth=3, bins=16).fit(holes)
    boxes = attributions.boosting_boxes(model)
    got = {r.id: r for r in attributions.tree_attributions(holes, "id", NAMES, boxes, holes, rows=8).collect()}
    p = {r.id: r.probability[1] for r in model.transform(holes).collect()}
    for i, q in p.items():
        assert sum(got[i][f"phi_{n}"] for n in NAMES) + got[i].base_score == pytest.approx(np.log(q / (1 - q)), abs=1e-6)


def test_registered_query_adds_up(spark):
    out = catalog.queries()["E12_tree_attributions"](spark, SMALL)
    phis = [c for c in out.columns if c.startswith("phi_")]
    bad = out.withColumn("s", sum((F.col(c) for c in phis), F.col("base_score"))).where("s < -1e-5 OR s > 1.00001")
    assert out.count() > 100 and bad.count() == 0
