"""Model selection on the order-risk frame."""

from __future__ import annotations

import statistics

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from millrace.operators import attributions, evaluate, models, pruning, sampling, search, tune
from millrace.plans.frames import RISK_FEATURES, risk
from millrace.plans.registry import query


def _train(spark, sf):
    return sampling.split_by_key(risk(spark, sf), "o_orderkey", 0.7, seed=31)[0]


def _logit(spark, sf):
    return models.classifier_stages("logistic", RISK_FEATURES).fit(_train(spark, sf))


def _scorer(model):
    def score(df):
        scored = model.transform(df)
        return scored.withColumn("score", vector_to_array("probability")[1])

    return score


@query("E6_cross_validation")
def _(spark, sf):
    ((_, _, scores),) = tune.logistic_grid(_train(spark, sf), "o_orderkey", RISK_FEATURES, [(0.0, 0.0)], folds=5)
    rows = [*enumerate(scores), (-1, sum(scores) / len(scores))]
    return spark.createDataFrame(rows, "fold int, auroc double")


@query("E7_grid_search")
def _(spark, sf):
    settings = [(10 ** (-4 + 8 * i / 19), mixture) for i in range(20) for mixture in (0.0, 1.0)]
    found = tune.logistic_grid(_train(spark, sf), "o_orderkey", RISK_FEATURES, settings, folds=5)
    rows = [(f"regParam={r}, elasticNetParam={a}", statistics.fmean(s), statistics.stdev(s)) for r, a, s in found]
    return spark.createDataFrame(rows, "settings string, mean_auroc double, std_auroc double").orderBy(F.desc("mean_auroc"), "settings")


@query("E8_halving_search")
def _(spark, sf):
    space = {"max_depth": [2, 3, 4, 5, 6], "minInfoGain": [0.0, 0.001, 0.01]}
    rows = tune.halving_search(_train(spark, sf), "o_orderkey", "tree", RISK_FEATURES, space, n=9)
    return spark.createDataFrame(rows, "round int, settings string, auroc double")


@query("E8_parzen_search")
def _(spark, sf):
    space = {"max_depth": search.Between(2, 10, whole=True), "minInfoGain": search.Between(1e-5, 0.05, log=True), "minInstancesPerNode": search.Between(1, 50, log=True, whole=True), "impurity": ["gini", "entropy"]}
    rows = tune.learning_search(_train(spark, sf), "o_orderkey", "tree", RISK_FEATURES, space, n=30)
    named = [(t, ", ".join(f"{k}={v}" for k, v in p.items()), b, s) for t, p, b, s in rows]
    return spark.createDataFrame(named, "trial int, settings string, share double, auroc double")


@query("E9_validation_curve")
def _(spark, sf):
    rows = tune.validation_curve(_train(spark, sf), "o_orderkey", "boosted", RISK_FEATURES, "max_depth", [1, 2, 3, 4], n_estimators=20)
    return spark.createDataFrame(rows, "max_depth string, train_accuracy double, validation_accuracy double")


@query("E10_pruning_sweep")
def _(spark, sf):
    rows = tune.validation_curve(
        _train(spark, sf), "o_orderkey", "tree", RISK_FEATURES, "minInfoGain", [0.0, 0.0005, 0.001, 0.005, 0.01, 0.05], max_depth=8
    )
    return spark.createDataFrame(rows, "min_info_gain string, train_accuracy double, validation_accuracy double")


@query("E10_cost_complexity")
def _(spark, sf):
    data = _train(spark, sf).withColumn("part", F.when(sampling.hash_bucket("o_orderkey", 31) < 700, "train").otherwise("validation"))
    model = models.classifier_stages("tree", RISK_FEATURES, scaling=None, max_depth=12).fit(data.where("part = 'train'"))
    path = pruning.pruning_path(model.transform(data).select("part", "label", "raw_features"), model.stages[-1], "raw_features", "label", "part", "train")
    rows = [(a, n, r, s["train"], s["validation"]) for a, n, r, s in pruning.best_alphas(path, "validation")]
    return spark.createDataFrame(rows, "alpha double, leaves int, risk double, train_accuracy double, validation_accuracy double")


@query("E12_sampled_attributions")
def _(spark, sf):
    df = risk(spark, sf)
    phis = evaluate.sampled_attributions(df, "o_orderkey", RISK_FEATURES, _scorer(_logit(spark, sf)), df, samples=8, seed=5)
    return phis.select("o_orderkey", *[F.round(c, 6).alias(c) for c in phis.columns if c != "o_orderkey"])


def _phis(df, *keep):
    return df.select(*keep, *[F.round(c, 6).alias(c) for c in df.columns if c not in keep])


@query("E12_tree_attributions")
def _(spark, sf):
    model = models.classifier_stages("forest", RISK_FEATURES, scaling=None, n_estimators=20, max_depth=5).fit(_train(spark, sf))
    df = risk(spark, sf)
    return _phis(attributions.tree_attributions(df, "o_orderkey", RISK_FEATURES, attributions.spark_boxes(model.stages[-1]), df, rows=100, seed=5), "o_orderkey")


@query("E13_permutation_importance")
def _(spark, sf):
    rows = evaluate.permutation_importance(risk(spark, sf), "o_orderkey", RISK_FEATURES, "label", _scorer(_logit(spark, sf)), seed=5)
    return spark.createDataFrame(rows, "feature string, auroc_drop double")


@query("E14_model_comparison")
def _(spark, sf):
    entries = [
        ("naive bayes", "naive_bayes", "standard", {}),
        ("logistic regression", "logistic", "standard", {}),
        ("decision tree", "tree", None, {}),
        ("random forest", "forest", None, {"n_estimators": 20}),
        ("gradient boosting", "boosted", None, {"n_estimators": 20, "max_depth": 5}),
    ]
    rows = tune.compare(risk(spark, sf), "o_orderkey", RISK_FEATURES, entries)
    return spark.createDataFrame(rows, "model string, scaling string, train_auroc double, test_auroc double")
