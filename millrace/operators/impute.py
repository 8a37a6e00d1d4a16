"""Missing-value imputation: column statistics and chained equations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.quantiles import exact_quantiles
from millrace.runtime import cut_lineage


def fit_fill(df: DataFrame, cols: Sequence[str], strategy: str = "mean") -> dict:
    """Fill value per column: mean, exact median, or most frequent value (smallest on ties)."""
    if strategy == "mean":
        row = df.agg(*[F.avg(c).alias(c) for c in cols]).first()
        return {c: row[c] for c in cols}
    if strategy == "median":
        return {c: q[0] for c, q in exact_quantiles(df, cols, [0.5]).items()}
    if strategy == "mode":
        tops = {c: df.where(F.col(c).isNotNull()).groupBy(c).count().orderBy(F.desc("count"), c).first() for c in cols}
        return {c: r[0] if r else None for c, r in tops.items()}
    raise ValueError(f"unknown strategy {strategy}")


def fill(df: DataFrame, values: dict) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in values.items()})


class ChainedImputer:
    """Chained equations with a regression tree per incomplete column.

    Starts from the means, visits columns from fewest to most missing, stops after ``max_iter``
    rounds or when the imputed values change by less than ``tol`` (mean absolute, in column deviations).
    """

    def __init__(self, cols: Sequence[str], max_iter: int = 10, tol: float = 1e-3, max_depth: int = 5, seed: int = 0):
        self.cols = list(cols)
        self.max_iter = max_iter
        self.tol = tol
        self.max_depth = max_depth
        self.seed = seed

    def fit_transform(self, df: DataFrame) -> DataFrame:
        stats = df.agg(
            *[F.avg(c).alias(f"m{i}") for i, c in enumerate(self.cols)],
            *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(self.cols)],
            *[F.count(F.when(F.col(c).isNull(), 1)).alias(f"k{i}") for i, c in enumerate(self.cols)],
        ).first()
        self.means = {c: stats[f"m{i}"] for i, c in enumerate(self.cols)}
        missing = {c: stats[f"k{i}"] for i, c in enumerate(self.cols)}
        spread = {c: stats[f"s{i}"] or 1.0 for i, c in enumerate(self.cols)}
        self.order = sorted((c for c in self.cols if missing[c]), key=lambda c: missing[c])
        self.rounds: list[dict] = []
        state = self._start(df)
        for _ in range(self.max_iter):
            before = {c: f"__old_{c}" for c in self.order}
            state = state.withColumns({before[c]: F.col(c) for c in self.order})
            models = {}
            for c in self.order:
                features = VectorAssembler(inputCols=[x for x in self.cols if x != c], outputCol="__x")
                tree = DecisionTreeRegressor(featuresCol="__x", labelCol=c, predictionCol="__p", maxDepth=self.max_depth, seed=self.seed)
                models[c] = tree.fit(features.transform(state.where(~F.col(f"__miss_{c}"))))
                state = self._step(state, c, models[c])
            self.rounds.append(models)
            state = cut_lineage(state)
            change = state.agg(
                *[F.avg(F.when(F.col(f"__miss_{c}"), F.abs(F.col(c) - F.col(before[c])) / spread[c])).alias(c) for c in self.order]
            ).first() if self.order else []
            state = state.drop(*before.values())
            if not self.order or max(change) < self.tol:
                break
        return state.drop(*[f"__miss_{c}" for c in self.cols])

    def transform(self, df: DataFrame) -> DataFrame:
        """Apply the fitted rounds to another frame; its missing values start from the training means."""
        state = self._start(df)
        for models in self.rounds:
            for c, model in models.items():
                state = self._step(state, c, model)
        return state.drop(*[f"__miss_{c}" for c in self.cols])

    def _start(self, df: DataFrame) -> DataFrame:
        flagged = df.withColumns({f"__miss_{c}": F.col(c).isNull() for c in self.cols})
        return flagged.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(self.means[c])) for c in self.cols})

    def _step(self, state: DataFrame, c: str, model) -> DataFrame:
        features = VectorAssembler(inputCols=[x for x in self.cols if x != c], outputCol="__x")
        guessed = model.transform(features.transform(state))
        return guessed.withColumn(c, F.when(F.col(f"__miss_{c}"), F.col("__p")).otherwise(F.col(c))).drop("__x", "__p")
