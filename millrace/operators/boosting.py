"""AdaBoost (SAMME) over shallow trees with instance weights."""

from __future__ import annotations

import math

from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.runtime import cut_lineage


class AdaBoost:
    """Each round fits a weighted tree, then lifts the weights of its mistakes.

    Stops early when a tree is perfect or no better than chance. The weight of a row follows from its
    mistakes so far, so only that column is carried between rounds and checkpointed every few rounds.
    """

    def __init__(self, features: str, label: str, rounds: int = 50, max_depth: int = 1, learning_rate: float = 1.0, seed: int = 0, cut_every: int = 5):
        self.features, self.label, self.rounds = features, label, rounds
        self.max_depth, self.learning_rate, self.seed, self.cut_every = max_depth, learning_rate, seed, cut_every

    def fit(self, df: DataFrame) -> "AdaBoost":
        state = df.select(self.features, self.label).withColumn("__w", F.lit(1.0))
        classes = df.select(self.label).distinct().count()
        self.models: list = []
        self.alphas: list[float] = []
        state = state.persist()
        previous: DataFrame | None = None
        for i in range(self.rounds):
            tree = DecisionTreeClassifier(
                featuresCol=self.features, labelCol=self.label, weightCol="__w", maxDepth=self.max_depth, seed=self.seed,
                predictionCol="__p", probabilityCol="__q", rawPredictionCol="__r",
            )
            model = tree.fit(state)
            if previous is not None:
                previous.unpersist()  # the fit has filled the new state
            scored = model.transform(state)
            miss = F.col("__p") != F.col(self.label)
            sums = scored.agg(F.sum(F.when(miss, F.col("__w")).otherwise(0.0)).alias("bad"), F.sum("__w").alias("all"), F.count("*").alias("n")).first()
            error = sums["bad"] / sums["all"]
            if error >= 1.0 - 1.0 / classes:
                break
            self.models.append(model)
            if error <= 0:
                self.alphas.append(1.0)
                break
            alpha = self.learning_rate * (math.log((1 - error) / error) + math.log(classes - 1))
            self.alphas.append(alpha)
            # rescale so that the mean weight stays one
            norm = sums["n"] / (sums["all"] + sums["bad"] * (math.exp(alpha) - 1))
            weight = F.col("__w") * F.when(miss, math.exp(alpha)).otherwise(1.0) * norm
            previous, state = state, scored.withColumn("__w", weight).drop("__p", "__q", "__r")
            if (i + 1) % self.cut_every == 0:
                state = cut_lineage(state)
            state = state.persist()
        for held in (previous, state):
            if held is not None:
                held.unpersist()
        self.classes = classes
        if not self.models:
            raise ValueError("no tree is better than chance")
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        """Add ``probability`` (alpha-weighted vote shares) and ``prediction``."""
        out = df
        votes = F.array_repeat(F.lit(0.0), self.classes)
        total = sum(self.alphas)
        names = []
        for i, model in enumerate(self.models):
            one = model.copy().setPredictionCol(f"__p{i}").setProbabilityCol("").setRawPredictionCol("")
            out = one.transform(out)
            names.append(f"__p{i}")
        shares = [
            sum((F.when(F.col(n) == c, a / total).otherwise(0.0) for n, a in zip(names, self.alphas)), F.lit(0.0))
            for c in range(self.classes)
        ]
        out = out.withColumn("probability", F.array(*shares)).drop(*names)
        return out.withColumn("prediction", (F.array_position("probability", F.array_max("probability")) - 1).cast("int"))
