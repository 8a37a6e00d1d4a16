"""Exact rank metrics, confusion-based metrics, soft F1, attributions and permutation importance."""

from __future__ import annotations

import random
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.ordering import hash_order
from millrace.operators.running import numbered, running_totals


def average_ranks(df: DataFrame, score: str) -> DataFrame:
    """(score, n, average rank) per distinct score."""
    counts = df.groupBy(score).agg(F.count("*").alias("n"))
    run = running_totals(counts, score, ["n"])
    return run.select(score, "n", (F.col("n_run") - (F.col("n") - 1) / 2.0).alias("avg_rank"))


def auroc(df: DataFrame, score: str, label: str) -> DataFrame:
    """One row (auroc, somers_d, n_pos, n_neg); exact, tied scores count half.

    Works on counts per distinct score, so a hot score is one row.
    """
    y = F.col(label).cast("int")
    counts = df.select(F.col(score).cast("double").alias("s"), y.alias("y")).where("s IS NOT NULL AND y IS NOT NULL").groupBy("s").agg(
        F.sum("y").alias("pos"), F.sum(1 - F.col("y")).alias("neg")
    )
    run = running_totals(counts, "s", ["neg"])
    wins = F.sum(F.col("pos") * (F.col("neg_run") - F.col("neg") / 2.0))
    pairs = F.sum("pos").cast("double") * F.sum("neg")
    value = wins / F.nullif(pairs, F.lit(0.0))
    return run.agg(value.alias("auroc"), F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg")).select(
        "auroc", (2 * F.col("auroc") - 1).alias("somers_d"), "n_pos", "n_neg"
    )


def accuracy(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(F.avg((F.col(label) == F.col(prediction)).cast("double")).alias("accuracy"), F.count("*").alias("n"))


def confusion(df: DataFrame, label: str, prediction: str) -> DataFrame:
    return df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(F.count("*").alias("n"))


def class_scores(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Precision, recall and F1 per class from the confusion counts (0 when undefined)."""
    cells = confusion(df, label, prediction)
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)
    as_label = cells.groupBy(F.col("label").alias("class")).agg(F.sum(hit).alias("tp"), F.sum("n").alias("actual"))
    as_pred = cells.groupBy(F.col("prediction").alias("class")).agg(F.sum("n").alias("predicted"))
    both = as_label.join(as_pred, "class", "full").na.fill(0, ["tp", "actual", "predicted"])
    ratio = lambda a, b: F.coalesce(F.col(a) / F.nullif(b.cast("double"), F.lit(0.0)), F.lit(0.0))
    return both.select(
        "class",
        ratio("tp", F.col("predicted")).alias("precision"),
        ratio("tp", F.col("actual")).alias("recall"),
        F.coalesce(2.0 * F.col("tp") / F.nullif((F.col("actual") + F.col("predicted")).cast("double"), F.lit(0.0)), F.lit(0.0)).alias("f1"),
    )


def macro_f1(df: DataFrame, label: str, prediction: str) -> DataFrame:
    return class_scores(df, label, prediction).agg(F.avg("recall").alias("macro_recall"), F.avg("f1").alias("macro_f1"))


def soft_macro_f1(df: DataFrame, label: str, probabilities: dict, epsilon: float = 1e-7) -> DataFrame:
    """Macro F1 with probabilities in place of 0/1 predictions; one minus it is the loss."""
    aggs = []
    for i, (cls, p) in enumerate(probabilities.items()):
        y = (F.col(label) == cls).cast("double")
        aggs += [F.sum(y).alias(f"g{i}"), F.sum(p).alias(f"p{i}"), F.sum(y * p).alias(f"t{i}")]
    sums = df.agg(*aggs)
    scores = []
    for i in range(len(probabilities)):
        tp = F.col(f"t{i}") + epsilon
        precision, recall = tp / (F.col(f"p{i}") + epsilon), tp / (F.col(f"g{i}") + epsilon)
        scores.append(2 * precision * recall / (precision + recall + epsilon))
    mean = sum(scores[1:], scores[0]) / len(scores)
    return sums.select(mean.alias("soft_macro_f1"), (1 - mean).alias("loss"))


def vote(df: DataFrame, key: str, frames: Sequence[str], mode: str = "soft", weights: Sequence[float] | None = None) -> DataFrame:
    """Combine probability arrays held in the columns ``frames``.

    soft: weighted mean of the probabilities, then the first largest. hard: weighted majority of the
    single predictions, ties to the lowest class.
    """
    w = [float(x) for x in (weights or [1.0] * len(frames))]
    total = sum(w)
    if mode == "soft":
        parts = [_weighted(c, k / total) for c, k in zip(frames, w)]
    else:
        parts = [_ballot(c, k) for c, k in zip(frames, w)]
    merged = parts[0]
    for p in parts[1:]:
        merged = F.zip_with(merged, p, lambda a, b: a + b)
    scored = df.select(key, merged.alias("probability"))
    rounded = F.transform("probability", lambda x: F.round(x, 12))
    return scored.withColumn("prediction", (F.array_position(rounded, F.array_max(rounded)) - 1).cast("int"))


def _weighted(col: str, share: float) -> Column:
    return F.transform(F.col(col), lambda x: x * share)


def _ballot(col: str, weight: float) -> Column:
    top = F.array_position(F.col(col), F.array_max(col)) - 1
    return F.transform(F.col(col), lambda x, i: F.when(i == top, weight).otherwise(0.0))


def linear_attributions(df: DataFrame, key: Sequence[str], coefs: dict[str, float]) -> DataFrame:
    """Exact attributions of a linear score: coefficient × (value − column mean)."""
    means = df.agg(F.struct(*[F.avg(c).alias(c) for c in coefs]).alias("m")).scalar()
    return df.withColumn("__m", means).select(
        *key, *[(F.lit(float(w)) * (F.col(c) - F.col(f"__m.{c}"))).alias(f"phi_{c}") for c, w in coefs.items()]
    )


def sampled_attributions(
    df: DataFrame,
    key: str,
    features: Sequence[str],
    score: Callable[[DataFrame], DataFrame],
    background: DataFrame,
    samples: int = 8,
    seed: int = 0,
) -> DataFrame:
    """Permutation-sampled attributions of any score: they sum to score − mean background score.

    Each row is scored along ``samples`` feature orders, starting from one background row each. The
    sampled orders and background rows are small literals; the differences need one aggregate per row.
    ``score`` adds a column ``score``.
    """
    rnd = random.Random(seed)
    d = len(features)
    base = background.select(*features).orderBy(F.xxhash64(*features, F.lit(seed))).limit(samples).collect()
    orders = []
    for _ in base:
        order = list(range(d))
        rnd.shuffle(order)
        orders.append(order)
    plans = F.array(
        *[
            F.struct(
                F.array(*[F.lit(float(v)) for v in row]).alias("z"),
                F.array(*[F.lit(order.index(i)) for i in range(d)]).alias("rank"),
            )
            for row, order in zip(base, orders)
        ]
    )
    paths = df.select(key, *[F.col(f).cast("double").alias(f) for f in features]).withColumn("plan", F.explode(plans))
    paths = paths.withColumn("step", F.explode(F.sequence(F.lit(0), F.lit(d))))
    mixed = paths.select(
        key,
        "step",
        F.col("plan.rank").alias("rank"),
        *[F.when(F.get("plan.rank", F.lit(i)) < F.col("step"), F.col(f)).otherwise(F.get("plan.z", F.lit(i))).alias(f) for i, f in enumerate(features)],
    )
    scored = score(mixed)
    n = len(base)
    phis = []
    for i, f in enumerate(features):
        r = F.get("rank", F.lit(i))
        gain = F.when(F.col("step") == r + 1, F.col("score")).when(F.col("step") == r, -F.col("score")).otherwise(0.0)
        phis.append((F.sum(gain) / n).alias(f"phi_{f}"))
    first = (F.sum(F.when(F.col("step") == 0, F.col("score"))) / n).alias("base_score")
    return scored.groupBy(key).agg(*phis, first)


def attribution_summary(phis: DataFrame, features: Sequence[str]) -> DataFrame:
    """Mean absolute attribution per feature."""
    means = phis.agg(*[F.avg(F.abs(f"phi_{f}")).alias(f) for f in features])
    return means.unpivot([], list(features), "feature", "mean_abs")


def permuted_partners(df: DataFrame, key: str, cols: Sequence[str], seed: int) -> DataFrame:
    """(key, shuffled__<col>…): each row paired with the values of another row, by hash order."""
    left = numbered(df.select(key), key, name="__pos")
    hashed = df.select(*cols, key).withColumn("__h", hash_order([key], seed))
    right = numbered(hashed, "__h", [key], name="__pos").select("__pos", *[F.col(c).alias(f"shuffled__{c}") for c in cols])
    return left.join(right, "__pos").drop("__pos")


def permutation_importance(
    df: DataFrame, key: str, features: Sequence[str], label: str, score: Callable[[DataFrame], DataFrame], seed: int = 0
) -> list[tuple[str, float]]:
    """Drop of exact AUROC when one column is shuffled; largest first. ``score`` adds a column ``score``."""
    base = auroc(score(df), "score", label).first()["auroc"]
    paired = df.join(permuted_partners(df, key, features, seed), key).persist()
    try:
        drops = []
        for f in features:
            moved = paired.withColumn(f, F.col(f"shuffled__{f}"))
            drops.append((f, base - auroc(score(moved), "score", label).first()["auroc"]))
    finally:
        paired.unpersist()
    return sorted(drops, key=lambda x: (-x[1], x[0]))
