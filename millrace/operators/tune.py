"""Cross-validation, grid and successive-halving search, validation curves."""

from __future__ import annotations

import random
from collections.abc import Sequence

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators import models, search
from millrace.operators.linear import LogisticGrid, fold_aurocs
from millrace.operators.sampling import hash_bucket
from millrace.runtime import cut_lineage


def rank_evaluator(label: str = "label") -> BinaryClassificationEvaluator:
    """Exact AUROC on the probability; raw scores of some models do not rank by probability."""
    return BinaryClassificationEvaluator(labelCol=label, rawPredictionCol="probability", metricName="areaUnderROC", numBins=0)


def with_folds(df: DataFrame, key: str, folds: int, seed: int) -> DataFrame:
    """Fold number by key, the same for every model and every run."""
    return df.withColumn("fold", hash_bucket(key, seed, folds))


def grid(estimator, values: dict[str, Sequence]) -> list:
    """Parameter maps for ``estimator`` only; a name it does not have raises."""
    builder = ParamGridBuilder()
    for name, options in values.items():
        if not estimator.hasParam(name):
            raise ValueError(f"{type(estimator).__name__} has no setting {name}")
        builder = builder.addGrid(estimator.getParam(name), list(options))
    return builder.build()


def cross_validate(
    df: DataFrame, key: str, stages, values: dict[str, Sequence] | None = None, label: str = "label", folds: int = 5, seed: int = 31, parallelism: int = 4
) -> tuple[list[tuple[str, float, float]], object]:
    """[(settings, mean AUROC, deviation)] and the fitted search, for the last stage's settings."""
    last = stages.getStages()[-1]
    maps = grid(last, values or {})
    validator = CrossValidator(
        estimator=stages, estimatorParamMaps=maps, evaluator=rank_evaluator(label), numFolds=folds, foldCol="fold", parallelism=parallelism,
        collectSubModels=False,
    )
    data = with_folds(df, key, folds, seed).persist()
    try:
        fitted = validator.fit(data)
    finally:
        data.unpersist()
    names = [", ".join(f"{p.name}={v}" for p, v in m.items()) or "defaults" for m in maps]
    return [(n, float(m), float(d)) for n, m, d in zip(names, fitted.avgMetrics, fitted.stdMetrics)], fitted


def fold_scores(df: DataFrame, key: str, stages, label: str = "label", folds: int = 5, seed: int = 31) -> list[tuple[int, float]]:
    """Exact AUROC of every held-out fold."""
    data = with_folds(df, key, folds, seed).persist()
    try:
        return [
            (f, rank_evaluator(label).evaluate(stages.fit(data.where(F.col("fold") != f)).transform(data.where(F.col("fold") == f))))
            for f in range(folds)
        ]
    finally:
        data.unpersist()


def logistic_grid(
    df: DataFrame, key: str, columns: Sequence[str], settings: Sequence[tuple[float, float]], label: str = "label", folds: int = 5, seed: int = 31
) -> list[tuple[float, float, list[float]]]:
    """[(regularisation, elastic-net mixture, exact AUROC of every held-out fold)]; all models are fitted and judged together."""
    data = cut_lineage(with_folds(df, key, folds, seed).select(label, "fold", *columns))
    fits = LogisticGrid(columns, label, settings, folds).fit(data)
    found = fold_aurocs(fits.scores(data, [label, "fold"]), label, len(settings))
    return [(r, a, [f[i] for i in sorted(f)]) for (r, a), f in zip(settings, found, strict=True)]


def halving_search(
    df: DataFrame, key: str, family: str, columns: Sequence[str], space: dict[str, Sequence], n: int = 9, label: str = "label", seed: int = 31, **fixed
) -> list[tuple[int, str, float]]:
    """Seeded random settings; each round uses three times the rows and keeps the best third.

    The last round trains on all training rows. The score is AUROC on a validation part of the keys.
    """
    rnd = random.Random(seed)
    tried: list[dict] = []
    options = 1
    for v in space.values():
        options *= len(v)
    while len(tried) < min(n, options):
        pick = {k: rnd.choice(list(v)) for k, v in space.items()}
        if pick not in tried:
            tried.append(pick)
    rounds = 1
    while 3**rounds < len(tried):
        rounds += 1
    data = df.withColumn("__b", hash_bucket(key, seed, 1000)).persist()
    out = []
    try:
        check = data.where("__b >= 800")
        for r in range(rounds + 1):
            share = 800 // 3 ** (rounds - r)
            train = data.where(F.col("__b") < share)
            scores = []
            for params in tried:
                model = models.classifier_stages(family, columns, label, seed=seed, **fixed, **params).fit(train)
                score = rank_evaluator(label).evaluate(model.transform(check))
                scores.append((score, params))
                out.append((r, ", ".join(f"{k}={v}" for k, v in params.items()), score))
            scores.sort(key=lambda s: -s[0])
            tried = [p for _, p in scores[: max(1, len(scores) // 3)]]
    finally:
        data.unpersist()
    return out


def learning_search(
    df: DataFrame, key: str, family: str, columns: Sequence[str], space: search.Space, n: int = 30, label: str = "label", seed: int = 31, parallel: int = 4, **fixed
) -> list[tuple[int, dict, float, float]]:
    """[(trial, settings, share of the training rows, AUROC on a validation part)] of a Parzen search in brackets."""
    data = df.withColumn("__b", hash_bucket(key, seed, 1000)).persist()
    check = data.where("__b >= 800")

    def score(params: dict, share: float) -> float:
        model = models.classifier_stages(family, columns, label, seed=seed, **fixed, **params).fit(data.where(F.col("__b") < int(800 * share)))
        return rank_evaluator(label).evaluate(model.transform(check))

    try:
        return search.parzen_search(score, space, n, budgets=(0.2, 1.0), seed=seed, parallel=parallel)
    finally:
        data.unpersist()


def validation_curve(
    df: DataFrame, key: str, family: str, columns: Sequence[str], param: str, values: Sequence, label: str = "label", seed: int = 31, top: int = 5, **fixed
) -> list[tuple[str, float, float]]:
    """(value, train accuracy, validation accuracy) of the ``top`` values by validation accuracy."""
    data = df.withColumn("__b", hash_bucket(key, seed, 1000)).persist()
    rows = []
    try:
        train, check = data.where("__b < 700"), data.where("__b >= 700")
        for v in values:
            model = models.classifier_stages(family, columns, label, seed=seed, **fixed, **{param: v}).fit(train)
            hit = F.avg((F.col("prediction") == F.col(label)).cast("double"))
            scored = model.transform(data).groupBy((F.col("__b") < 700).alias("in_train")).agg(hit.alias("a")).collect()
            by_part = {r["in_train"]: r["a"] for r in scored}
            rows.append((str(v), by_part[True], by_part[False]))
    finally:
        data.unpersist()
    return sorted(rows, key=lambda r: -r[2])[:top]


def compare(df: DataFrame, key: str, columns: Sequence[str], entries: Sequence[tuple[str, str, str | None, dict]], label: str = "label", seed: int = 31) -> list[tuple[str, str, float, float]]:
    """(model, scaling, train AUROC, test AUROC) by descending test AUROC."""
    data = df.withColumn("__b", hash_bucket(key, seed, 1000)).persist()
    rows = []
    try:
        train, test = data.where("__b < 700"), data.where("__b >= 700")
        for name, family, scaling, params in entries:
            model = models.classifier_stages(family, columns, label, scaling=scaling, seed=seed, **params).fit(train)
            judge = rank_evaluator(label)
            rows.append((name, scaling or "none", judge.evaluate(model.transform(train)), judge.evaluate(model.transform(test))))
    finally:
        data.unpersist()
    return sorted(rows, key=lambda r: (-r[3], r[0]))
