"""Weakest-link pruning against all pruned subtrees."""

import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from given import SMALL
from millrace.operators import pruning
from millrace.plans import catalog


def subtrees(nodes, at=0):
    """Leaves of every pruned subtree below a node."""
    out = [[at]]
    if nodes.column[at] >= 0:
        out += [a + b for a in subtrees(nodes, nodes.left[at]) for b in subtrees(nodes, nodes.right[at])]
    return out


def random_tree(rng, depth):
    column, left, right = [], [], []

    def grow(d):
        at = len(column)
        column.append(-1), left.append(-1), right.append(-1)
        if d and rng.random() < 0.9:
            column[at] = 0
            left[at] = grow(d - 1)
            right[at] = grow(d - 1)
        return at

    grow(depth)
    return pruning.Nodes(np.array(column), np.zeros(len(column)), np.array(left), np.array(right))


def test_sequence_is_optimal_at_every_penalty():
    rng = np.random.default_rng(8)
    for _ in range(30):
        nodes = random_tree(rng, 3)
        counts = np.where((nodes.column < 0)[:, None], rng.integers(0, 9, (len(nodes.column), 3)), 0)
        counts = nodes.summed(counts)
        if counts[0].sum() == 0:
            continue
        risk = pruning.gini(counts)
        alphas, risks, steps = pruning.weakest_links(nodes, risk)
        trees = pruning.sequence(nodes, steps, len(alphas))
        assert trees[-1].tolist() == [0] and alphas == sorted(alphas)
        every = subtrees(nodes)
        for i, (a, r, leaves) in enumerate(zip(alphas, risks, trees, strict=True)):
            assert r == pytest.approx(risk[leaves].sum())
            upper = alphas[i + 1] if i + 1 < len(alphas) else a + 1
            for at in (a, (a + upper) / 2, upper):
                best = min(risk[t].sum() + at * len(t) for t in every)
                assert r + at * len(leaves) == pytest.approx(best, abs=1e-9)
            # the smallest of the best ones
            assert len(leaves) == min(len(t) for t in every if risk[t].sum() + a * len(t) <= r + a * len(leaves) + 1e-9)


def test_accuracies_of_all_trees(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(500, 2))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.3) ^ (rng.random(500) < 0.2)).astype(int)
    df = spark.createDataFrame([(*map(float, v), int(t), "train" if i % 3 else "check") for i, (v, t) in enumerate(zip(x, y, strict=True))], "a double, b double, y int, part string")
    df = VectorAssembler(inputCols=["a", "b"], outputCol="v").transform(df)
    model = DecisionTreeClassifier(featuresCol="v", labelCol="y", maxDepth=6).fit(df.where("part = 'train'"))
    path = pruning.pruning_path(df.repartition(5), model, "v", "y", "part", "train")
    assert path[0][1] <= (model.numNodes + 1) // 2 and path[-1][1] == 1
    hit = lambda p: model.transform(df.where(F.col("part") == p)).where("prediction = y").count() / df.where(F.col("part") == p).count()
    assert path[0][3]["train"] == pytest.approx(hit("train"))
    assert path[0][3]["check"] == pytest.approx(hit("check"), abs=0.02)  # leaves of equal counts may tell another class
    share = np.mean(y[np.arange(500) % 3 == 0] == np.bincount(y[np.arange(500) % 3 > 0]).argmax())
    assert path[-1][3]["check"] == pytest.approx(share)
    best = pruning.best_alphas(path, "check")
    assert best[0][3]["check"] == max(r[3]["check"] for r in path) and len(best) <= 5


def test_registered_query(spark):
    rows = catalog.queries()["E10_cost_complexity"](spark, SMALL).collect()
    assert 1 <= len(rows) <= 5 and rows[0].validation_accuracy == max(r.validation_accuracy for r in rows)
