"""Metrics, votes, attributions, clustering, imputation, models and streaming."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from given import SMALL
from millrace.operators import bayes, boosting, cluster, components, encode, evaluate, impute, models, profile, sampling, tune
from millrace.plans import streams
from millrace.plans.frames import RISK_FEATURES, gaps, risk
from millrace.plans.registry import QUERIES, table
from millrace.runtime import work_path


def _auc(s, y):
    s, y = np.asarray(s), np.asarray(y)
    pos, neg = s[y == 1], s[y == 0]
    return np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg])


@pytest.mark.parametrize("parts", [1, 16])
def test_auroc_with_ties(spark, parts):
    rng = np.random.default_rng(3)
    s, y = rng.integers(0, 6, 200) / 6, rng.integers(0, 2, 200)
    df = spark.createDataFrame([(float(a), int(b)) for a, b in zip(s, y)], "s double, y int").repartition(parts)
    row = evaluate.auroc(df, "s", "y").first()
    assert row["auroc"] == pytest.approx(_auc(s, y), abs=1e-12)
    assert row["somers_d"] == pytest.approx(2 * row["auroc"] - 1)
    monotone = evaluate.auroc(df.withColumn("s", F.exp(3 * F.col("s"))), "s", "y").first()
    assert monotone["auroc"] == pytest.approx(row["auroc"], abs=1e-12)


def test_auroc_single_class_is_null(spark):
    df = spark.createDataFrame([(0.1, 1), (0.2, 1)], "s double, y int")
    assert evaluate.auroc(df, "s", "y").first()["auroc"] is None


def test_vote_of_one_model_is_that_model(spark):
    df = spark.createDataFrame([(1, [0.2, 0.8], [0.9, 0.1]), (2, [0.6, 0.4], [0.1, 0.9])], "id long, a array<double>, b array<double>")
    only = evaluate.vote(df, "id", ["a", "b"], "soft", [1, 0]).orderBy("id").collect()
    assert [r["prediction"] for r in only] == [1, 0]
    tie = evaluate.vote(df, "id", ["a", "b"], "hard").orderBy("id").collect()
    assert [r["prediction"] for r in tie] == [0, 0]


def test_class_scores_unseen_class(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("c", "a")], "y string, p string")
    got = {r["class"]: (r["precision"], r["recall"], r["f1"]) for r in evaluate.class_scores(df, "y", "p").collect()}
    assert got == {"a": (0.5, 0.5, 0.5), "b": (0.0, 0.0, 0.0), "c": (0.0, 0.0, 0.0)}


def test_sampled_attributions_add_up(spark):
    rng = np.random.default_rng(0)
    df = spark.createDataFrame([(i, *map(float, rng.normal(size=3))) for i in range(40)], "id long, a double, b double, c double")
    score = lambda f: f.withColumn("score", F.col("a") * F.col("b") + 2 * F.col("c"))
    out = evaluate.sampled_attributions(df, "id", ["a", "b", "c"], score, df, samples=5, seed=1)
    rows = out.join(score(df).select("id", "score"), "id").collect()
    for r in rows:
        assert r["phi_a"] + r["phi_b"] + r["phi_c"] + r["base_score"] == pytest.approx(r["score"], abs=1e-9)


def test_permutation_importance_finds_the_signal(spark):
    df = spark.createDataFrame([(i, float(i % 50), float(i * 7 % 13), int(i % 50 > 25)) for i in range(400)], "id long, a double, b double, label int")
    ranked = evaluate.permutation_importance(df, "id", ["a", "b"], "label", lambda f: f.withColumn("score", F.col("a")))
    assert ranked[0][0] == "a" and ranked[0][1] > 0.3 and abs(ranked[1][1]) < 1e-9


def _silhouette(x, c):
    out = []
    for i in range(len(x)):
        d = np.abs(x - x[i])
        same = (c == c[i]).sum()
        if same == 1:
            out.append(0.0)
            continue
        a = d[c == c[i]].sum() / (same - 1)
        b = min(d[c == o].mean() for o in set(c) if o != c[i])
        out.append((b - a) / max(a, b))
    return np.array(out)


def test_silhouette(spark):
    x = np.array([1, 1, 2, 3, 10, 11, 11.5, 30.0])
    c = np.array([0, 0, 0, 0, 1, 1, 1, 2])
    df = spark.createDataFrame([(float(a), int(b)) for a, b in zip(x, c)], "x double, c int")
    got = {(r["value"], r["cluster"]): r["silhouette"] for r in cluster.silhouette(df, "x", "c").collect()}
    for v, k, s in zip(x, c, _silhouette(x, c)):
        assert got[(v, k)] == pytest.approx(s, abs=1e-12)
    assert cluster.mean_silhouette(df, "x", "c").first()["mean_silhouette"] == pytest.approx(_silhouette(x, c).mean())


def test_kmeans_groups_and_best_k(spark):
    rng = np.random.default_rng(2)
    rows = [(i, float(rng.normal([0, 50, 100][i % 3], 1))) for i in range(240)]
    df = spark.createDataFrame(rows, "id long, x double")
    fitted = cluster.OneColumnKMeans("x", 3, restarts=2).fit(df)
    groups = fitted.transform(df).collect()
    assert all(r["group"] == r["id"] % 3 for r in groups)
    scores, best = cluster.best_k_stable(df, "id", "x", ks=[2, 3], repeats=1, random_labelings=5, restarts=2)
    assert best == 3 and dict(scores)[3] == 0.0


def test_chained_imputation(spark):
    df = gaps(spark, SMALL).drop("port")
    imputer = impute.ChainedImputer(["age", "fare", "class"], max_iter=3)
    out = imputer.fit_transform(df)
    both = out.join(df.select("c_custkey", F.col("age").alias("age0"), F.col("fare").alias("fare0")), "c_custkey")
    bounds = df.agg(F.min("age"), F.max("age")).first()
    assert both.where("age IS NULL OR fare IS NULL").count() == 0
    assert both.where("age0 IS NOT NULL AND age0 <> age").count() == 0
    assert both.where(~F.col("age").between(bounds[0], bounds[1])).count() == 0
    assert imputer.transform(df).where("age IS NULL OR fare IS NULL").count() == 0


def test_woe_rules(spark):
    train = spark.createDataFrame([("a", 1), ("a", 1), ("a", 0), ("b", 0), ("b", 0), ("once", 1), (None, 1)], "c string, y int")
    t = encode.woe_fit(train, ["c"], "y")
    got = {r["value"]: r["woe"] for r in t.collect()}
    assert got["once"] == 0.0 and got["a"] > 0 > got["b"]
    assert got["a"] == pytest.approx(np.log((3 / 6) / (2 / 5)))
    fresh = spark.createDataFrame([("a",), ("new",), (None,)], "c string")
    coded = {r["c"]: r["c_woe"] for r in encode.woe_apply(fresh, t, ["c"]).collect()}
    assert coded["new"] == 0.0 and coded[None] == 0.0 and coded["a"] == pytest.approx(got["a"])


def test_components_are_orthonormal(spark):
    df = table(spark, SMALL, "lineitem")
    cols = ["l_quantity", "l_extendedprice", "l_discount"]
    fitted = components.Components(cols, 3).fit(df)
    np.testing.assert_allclose(fitted.loadings.T @ fitted.loadings, np.eye(3), atol=1e-9)
    assert sum(fitted.explained) == pytest.approx(1.0)
    means = fitted.transform(df).agg(*[F.avg(f"pc{i}") for i in (1, 2, 3)]).first()
    np.testing.assert_allclose(list(means), 0, atol=1e-9)


def test_gaussian_nb_probabilities(spark):
    df = risk(spark, SMALL)
    out = bayes.GaussianNB(RISK_FEATURES, "label").fit(df).transform(df)
    assert out.where(F.abs(F.aggregate("probability", F.lit(0.0), lambda a, x: a + x) - 1) > 1e-9).count() == 0
    assert out.where(F.col("prediction") != F.col("label")).count() < 0.35 * df.count()


def test_ada_boost_beats_a_stump(spark):
    df = VectorAssembler(inputCols=RISK_FEATURES, outputCol="features").transform(risk(spark, SMALL)).persist()
    one = boosting.AdaBoost("features", "label", rounds=1).fit(df).transform(df)
    many = boosting.AdaBoost("features", "label", rounds=7, cut_every=3).fit(df).transform(df)
    hits = [o.where(F.col("prediction") == F.col("label")).count() for o in (one, many)]
    assert hits[1] >= hits[0]


def test_saved_model_scores_the_same(spark):
    df = risk(spark, SMALL)
    model = models.classifier_stages("tree", RISK_FEATURES, max_depth=3).fit(df)
    path = work_path(spark, "m")
    model.write().overwrite().save(path)
    a = models.score_batch(model, df, ["o_orderkey"]).collect()
    b = models.score_batch(PipelineModel.load(path), df, ["o_orderkey"]).collect()
    assert sorted(a) == sorted(b)


def test_unknown_settings_raise(spark):
    with pytest.raises(ValueError):
        models.settings("logistic", {"max_depth": 3})
    with pytest.raises(ValueError):
        tune.grid(models.classifier("boosted"), {"numTrees": [1, 2]})


def test_tuning(spark):
    train, test = sampling.split_by_key(risk(spark, SMALL), "o_orderkey", 0.7, seed=31)
    assert train.join(test, "o_orderkey").count() == 0
    stages = models.classifier_stages("logistic", RISK_FEATURES)
    rows, _ = tune.cross_validate(train, "o_orderkey", stages, {"regParam": [0.001, 10.0]}, folds=2)
    assert rows[0][1] >= rows[1][1] > 0
    curve = tune.validation_curve(train, "o_orderkey", "tree", RISK_FEATURES, "max_depth", [1, 3], top=5)
    assert curve == sorted(curve, key=lambda r: -r[2]) and len(curve) == 2
    rounds = tune.halving_search(train, "o_orderkey", "tree", RISK_FEATURES, {"max_depth": [1, 2, 4]}, n=3)
    assert [r[0] for r in rounds] == [0, 0, 0, 1]


def test_stream_equals_batch(spark):
    from __spark_entry__ import queries

    streamed = sorted(map(tuple, QUERIES["M17_score_stream"](spark, SMALL).collect()))
    batch = models.score_batch(streams.event_model(spark, SMALL), streams.prepared(table(spark, SMALL, "events")), ["event_id"])
    assert streamed == sorted(map(tuple, batch.withColumn("pd", F.round("pd", 6)).collect()))


def test_profiles_of_edge_frames(spark):
    empty = spark.createDataFrame([], "a double, b string")
    assert profile.value_counts(empty, "b").count() == 0
    assert {r["n_rows"] for r in profile.profile(empty).collect()} == {0}
    constant = spark.createDataFrame([(2.0, "x"), (2.0, None), (float("nan"), "y")], "a double, b string")
    shares = {r["column_name"]: r["null_share"] for r in profile.null_shares(constant).collect()}
    assert shares == {"a": pytest.approx(1 / 3, abs=1e-6), "b": pytest.approx(1 / 3, abs=1e-6)}
    flat = spark.createDataFrame([(2.0,), (2.0,)], "a double")
    assert {r["bin"]: r["n"] for r in profile.histogram(flat, ["a"], 4).collect()} == {0: 2, 1: 0, 2: 0, 3: 0}
    assert profile.corr_matrix(spark.createDataFrame([(1.0, 2.0), (2.0, 2.0)], "a double, b double"), ["a", "b"]).first()["r"] is None


def test_stream_over_a_table_of_part_files(spark, tmp_path):
    spark.read.parquet(f"{SMALL}/events.parquet").repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    assert QUERIES["M17_score_stream"](spark, str(tmp_path)).count() == spark.read.parquet(f"{SMALL}/events.parquet").count()


def test_silhouette_leaves_nulls_out(spark):
    df = spark.createDataFrame([(1.0, 0), (2.0, 0), (8.0, 1), (9.0, 1), (None, None), (None, 0), (5.0, None)], "v double, g int")
    assert sorted(r["value"] for r in cluster.silhouette(df, "v", "g").collect()) == [1.0, 2.0, 8.0, 9.0]
