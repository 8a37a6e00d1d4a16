"""Classifier stages with named settings, margins turned into probabilities, kernel feature maps, scoring tables."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml import classification as C
from pyspark.ml.feature import MinMaxScaler, StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_FAMILIES = {
    "naive_bayes": (C.NaiveBayes, {"modelType": "gaussian"}),
    "logistic": (C.LogisticRegression, {"maxIter": 10}),
    "tree": (C.DecisionTreeClassifier, {}),
    "forest": (C.RandomForestClassifier, {}),
    "linear_svm": (C.LinearSVC, {"maxIter": 20}),
    "boosted": (C.GBTClassifier, {}),
    # deeper trees on row samples stand in for the extreme-gradient variant
    "boosted_deep": (C.GBTClassifier, {"maxDepth": 6, "subsamplingRate": 0.8}),
    "perceptron": (C.MultilayerPerceptronClassifier, {}),
}
_SEEDED = {"tree", "forest", "boosted", "boosted_deep", "perceptron"}
# other names for the same settings
_ALIASES = {
    "learning_rate": "stepSize",
    "n_estimators": {"forest": "numTrees", "boosted": "maxIter", "boosted_deep": "maxIter"},
    "max_depth": "maxDepth",
    "max_features": "featureSubsetStrategy",
    "C": None,
}


def settings(family: str, params: dict) -> dict:
    """Spark parameter names for a settings dict; unknown names raise."""
    cls, preset = _FAMILIES[family]
    out = dict(preset)
    for name, value in params.items():
        target = _ALIASES.get(name, name)
        if isinstance(target, dict):
            target = target.get(family)
        if name == "max_features":
            value = str(value)
        if not target or not cls().hasParam(target):
            raise ValueError(f"{family} has no setting {name}")
        out[target] = value
    return out


def classifier(family: str, features: str = "features", label: str = "label", seed: int = 31, **params):
    cls, _ = _FAMILIES[family]
    args = settings(family, params)
    if family in _SEEDED:
        args.setdefault("seed", seed)
    return cls(featuresCol=features, labelCol=label, **args)


def classifier_stages(family: str, columns: Sequence[str], label: str = "label", scaling: str | None = "standard", seed: int = 31, **params) -> Pipeline:
    """Assemble, optionally scale, fit: one object that trains and scores the same way."""
    stages = [VectorAssembler(inputCols=list(columns), outputCol="raw_features")]
    if scaling == "standard":
        stages.append(StandardScaler(inputCol="raw_features", outputCol="features", withMean=True))
    elif scaling == "min_max":
        stages.append(MinMaxScaler(inputCol="raw_features", outputCol="features"))
    source = "features" if scaling else "raw_features"
    stages.append(classifier(family, source, label, seed, **params))
    return Pipeline(stages=stages)


def fit_svm_probability(columns: Sequence[str], train: DataFrame, label: str = "label", **params) -> PipelineModel:
    """Linear SVM whose margin passes through a logistic fit, so that it yields a probability."""
    margin = classifier_stages("linear_svm", columns, label, **params).fit(train)
    margin.stages[-1].setRawPredictionCol("margin").setPredictionCol("svm_prediction")
    platt = C.LogisticRegression(featuresCol="margin", labelCol=label, maxIter=20).fit(margin.transform(train))
    return PipelineModel(stages=[*margin.stages, platt])


def score_batch(model, df: DataFrame, key: Sequence[str], extra: Sequence[str] = ()) -> DataFrame:
    """Key, prediction and probability of class 1 from the frame that owns the key."""
    scored = model.transform(df)
    pd1 = F.get(vector_to_array("probability"), F.lit(1)) if dict(scored.dtypes)["probability"] == "vector" else F.get("probability", F.lit(1))
    return scored.select(*key, F.col("prediction").cast("int").alias("prediction"), pd1.alias("pd"), *extra)


def class_probabilities(model, df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Key, prediction and the probability array of a multi-class model."""
    return model.transform(df).select(*key, F.col("prediction").cast("int").alias("prediction"), vector_to_array("probability").alias("probability"))


def feature_importances(model: PipelineModel, columns: Sequence[str], n: int) -> list[tuple[str, float]]:
    values = model.stages[-1].featureImportances.toArray()
    return sorted(((c, float(v)) for c, v in zip(columns, values)), key=lambda x: (-x[1], x[0]))[:n]


def coefficient_table(model: PipelineModel, columns: Sequence[str]) -> list[tuple[str, float]]:
    last = model.stages[-1]
    return [(c, float(w)) for c, w in zip(columns, last.coefficients)] + [("intercept", float(last.intercept))]


def fourier_features(df: DataFrame, vector: str, out: str, size: int, gamma: float, components: int = 128, seed: int = 0) -> DataFrame:
    """Random Fourier map of an array column: a linear model on it approximates an RBF kernel.

    The seeded projection is size × components numbers; rows pass through it in Arrow batches.
    """
    rng = np.random.default_rng(seed)
    w = rng.normal(0.0, math.sqrt(2 * gamma), (size, components))
    b = rng.uniform(0.0, 2 * math.pi, components)

    @F.pandas_udf("array<double>")
    def project(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for v in batches:
            x = np.stack(v.to_numpy()).astype(float) if len(v) else np.zeros((0, size))
            z = math.sqrt(2.0 / components) * np.cos(x @ w + b)
            yield pd.Series(list(z))

    return df.withColumn(out, project(F.col(vector)))


def with_vector(df: DataFrame, array: str, out: str = "features") -> DataFrame:
    return df.withColumn(out, array_to_vector(F.col(array).cast("array<double>")))
