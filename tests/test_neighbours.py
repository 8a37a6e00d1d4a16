"""Exact neighbours, SMOTE and neighbour votes against brute force, with one crowded cell."""

import numpy as np
import pytest

from millrace.operators import neighbours, sampling, similarity
from millrace.operators.neighbours import nearest


def _points(n=300, seed=0):
    rng = np.random.default_rng(seed)
    crowd = rng.normal(0, 0.01, (n // 3, 3))
    return np.concatenate([crowd, rng.normal(0, 3, (n - len(crowd), 3))]).round(6)


def _brute(q, x, k, p, skip=None):
    d = np.abs(x - q).sum(1) if p == 1 else np.sqrt(((x - q) ** 2).sum(1))
    order = [i for i in np.lexsort((np.arange(len(x)), d)) if i != skip]
    return order[:k]


@pytest.mark.parametrize("p,block", [(2, 4096), (2, 16), (1, 40)])
def test_nearest(spark, p, block):
    x = _points()
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "id long, vector array<double>")
    out = nearest(df.withColumnRenamed("id", "q"), df.withColumnRenamed("id", "t"), 4, "q", "t", p=p, exclude_self=True, block=block)
    got = {}
    for r in out.orderBy("q", "rank").collect():
        got.setdefault(r["q"], []).append(r["t"])
    for i in range(len(x)):
        assert got[i] == _brute(x[i], x, 4, p, skip=i)


def test_nearest_within_groups_and_small_groups(spark):
    x = _points(90, 3)
    rows = [(i, "a" if i % 3 else "b", [float(v) for v in r]) for i, r in enumerate(x)] + [(900, "c", [0.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "id long, g string, vector array<double>")
    out = nearest(df.withColumnRenamed("id", "q"), df.withColumnRenamed("id", "t"), 3, "q", "t", by="g", exclude_self=True, block=8).collect()
    group = {r[0]: r[1] for r in rows}
    assert all(group[r["q"]] == group[r["t"]] for r in out)
    assert {r["q"] for r in out} == set(range(90))
    ids = [i for i in range(90) if group[i] == "b"]
    for i in ids:
        d = sorted((np.sqrt(((x[j] - x[i]) ** 2).sum()), j) for j in ids if j != i)[:3]
        assert [r["t"] for r in sorted((r for r in out if r["q"] == i), key=lambda r: r["rank"])] == [j for _, j in d]


def test_smote(spark):
    rng = np.random.default_rng(1)
    rows = [(i, 0 if i < 40 else (1 if i < 55 else 2), [float(v) for v in rng.normal(size=4)]) for i in range(62)]
    df = spark.createDataFrame(rows, "id long, y int, v array<double>")
    made = sampling.smote(df, "y", "id", "v", k=3, seed=2)
    out = made.collect()
    assert {y: sum(1 for r in out if r["y"] == y) for y in (1, 2)} == {1: 25, 2: 33}
    vec, cls = {r[0]: np.array(r[2]) for r in rows}, {r[0]: r[1] for r in rows}
    for r in out:
        a, b, m = vec[r["parent"]], vec[r["neighbour"]], np.array(r["v"])
        assert cls[r["parent"]] == cls[r["neighbour"]] == r["y"]
        assert np.all(m >= np.minimum(a, b) - 1e-12) and np.all(m <= np.maximum(a, b) + 1e-12)
    again = sampling.smote(df.repartition(7), "y", "id", "v", k=3, seed=2).collect()
    assert sorted(map(str, out)) == sorted(map(str, again))


def test_smote_balanced_input(spark):
    df = spark.createDataFrame([(1, 0, [1.0]), (2, 1, [2.0])], "id long, y int, v array<double>")
    assert sampling.smote(df, "y", "id", "v").count() == 0


def test_zero_vector_has_no_cosine(spark):
    df = spark.createDataFrame([(1, [0.0, 0.0]), (2, [1.0, 0.0]), (3, [1.0, 1.0])], "id long, v array<double>")
    pairs = spark.createDataFrame([(1, 2), (2, 3)], "a long, b long")
    got = {(r["a"], r["b"]): r["cosine"] for r in similarity.pair_cosine(pairs, df, "id", "v", "a", "b").collect()}
    assert got[(1, 2)] is None and got[(2, 3)] == pytest.approx(2**-0.5)
    assert {r["a"] for r in similarity.cosine_neighbours(df, "id", "v", 1).collect()} == {2, 3}


def test_candidates_do_not_grow_with_cells(spark):
    """A few hundred queries of 64 columns: every query is packed once per matrix that it meets, not repeated per cell and block."""
    x = np.random.default_rng(4).normal(size=(600, 64)).round(4)
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "id long, vector array<double>")
    out = nearest(df.withColumnRenamed("id", "q"), df.withColumnRenamed("id", "t"), 3, "q", "t", exclude_self=True, block=50)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "data" in plan
    got = {}
    for r in out.orderBy("q", "rank").collect():
        got.setdefault(r["q"], []).append(r["t"])
    assert all(got[i] == _brute(x[i], x, 3, 2, skip=i) for i in range(len(x)))


def test_copies_keep_the_order_of_ids(spark):
    """Equal vectors, far from the origin: rounding in products must not decide between them."""
    x = np.repeat(np.array([[1e6, 1e6 + 1e-3], [1e6, 1e6]]), 40, axis=0)
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "id long, vector array<double>")
    out = nearest(df.withColumnRenamed("id", "q"), df.withColumnRenamed("id", "t"), 4, "q", "t", exclude_self=True, block=7).collect()
    for i in (0, 1, 39, 40, 79):
        assert [r["t"] for r in sorted((r for r in out if r["q"] == i), key=lambda r: r["rank"])] == _brute(x[i], x, 4, 2, skip=i)


def test_bounds_of_absolute_differences():
    """Bounds by products are no more than the distances; odd values are looked at."""
    rng = np.random.default_rng(6)
    points, queries = rng.normal(size=(3000, 24)), rng.normal(size=(40, 24))
    points[:500] = np.round(points[:500])
    points[:, 3] = 7.0
    queries[:5] = points[:5]
    least, error = neighbours._Steps(points).least(queries)
    exact = np.abs(queries[:, None] - points[None]).sum(2)
    assert (least <= exact + error).all()
    at, to = neighbours._not_farther(least, error, queries, points, 5)
    seen = np.zeros(exact.shape, bool)
    seen[at, to] = True
    assert seen[exact <= np.partition(exact, 4, axis=1)[:, 4:5]].all() and seen.mean() < 0.6
    points[7], points[8, 0] = np.nan, np.inf
    found = [np.concatenate(x) for x in zip(*neighbours._closest(np.arange(40), queries, np.arange(3000), points, 3, 1, False), strict=True)]
    exact = np.where(np.isnan(points).any(1), np.inf, np.abs(queries[:, None] - points[None]).sum(2))
    assert found[2].reshape(40, 3) == pytest.approx(np.sort(exact, axis=1)[:, :3])
