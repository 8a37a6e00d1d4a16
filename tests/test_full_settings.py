"""Registered model queries run the operators' whole settings. The fits themselves are not run here."""

import pytest

from __spark_entry__ import queries
from millrace.operators import boosting, evaluate, models, tune

SMALL = "/root/testdata/sf0.001"


class Stop(Exception):
    pass


def called(monkeypatch, spark, name, owner, function):
    """Arguments with which the query calls the operator."""
    got = {}

    def catch(*args, **named):
        got.update(args=args, **named)
        raise Stop

    monkeypatch.setattr(owner, function, catch)
    with pytest.raises(Stop):
        queries()[name](spark, SMALL)
    return got


def test_boosting_settings(spark, monkeypatch):
    got = called(monkeypatch, spark, "M9_boosting_one_vs_rest", models, "classifier")
    assert (got["maxIter"], got["maxDepth"]) == (20, 5)
    assert called(monkeypatch, spark, "M11_ada_boost", boosting, "AdaBoost")["rounds"] == 50
    assert called(monkeypatch, spark, "M10_boosting_deep", models, "classifier_stages")["n_estimators"] == 100


def test_tuning_settings(spark, monkeypatch):
    assert called(monkeypatch, spark, "E9_validation_curve", tune, "validation_curve")["n_estimators"] == 20
    assert called(monkeypatch, spark, "E12_sampled_attributions", evaluate, "sampled_attributions")["samples"] == 8
    got = called(monkeypatch, spark, "E14_model_comparison", tune, "compare")
    assert [x[3] for x in got["args"][3][3:]] == [{"n_estimators": 20}, {"n_estimators": 20, "max_depth": 5}]


def test_word_vector_settings(spark, monkeypatch):
    from millrace.plans import vectors

    got = called(monkeypatch, spark, "N12_word2vec", vectors, "Word2Vec")
    assert (got["vectorSize"], got["windowSize"], got["minCount"]) == (300, 15, 2)
    assert got["numPartitions"] == spark.sparkContext.defaultParallelism
