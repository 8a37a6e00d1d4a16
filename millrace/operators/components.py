"""Principal components of standardised columns with a fixed sign."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import arrays as V
from millrace.operators.scaling import fit_standard, scale


class Components:
    """Fitted loadings (columns × k, largest loading of each component positive) and variance shares."""

    def __init__(self, cols: Sequence[str], k: int, standardize: bool = True, ddof: int = 0):
        self.cols, self.k, self.standardize, self.ddof = list(cols), k, standardize, ddof

    def fit(self, df: DataFrame) -> "Components":
        self.params = fit_standard(df, self.cols, with_std=self.standardize, ddof=self.ddof)
        vectors = VectorAssembler(inputCols=self.cols, outputCol="__x").transform(scale(df, self.params))
        model = PCA(k=self.k, inputCol="__x", outputCol="__y").fit(vectors)
        loadings = model.pc.toArray()
        signs = np.sign(loadings[np.abs(loadings).round(9).argmax(axis=0), np.arange(self.k)])
        self.loadings = loadings * np.where(signs == 0, 1.0, signs)
        self.explained = [float(x) for x in model.explainedVariance]
        return self

    def transform(self, df: DataFrame, prefix: str = "pc") -> DataFrame:
        """Add one score column per component; the input columns keep their values."""
        z = [(F.col(c).cast("double") - m) / (w or 1.0) for c, (m, w) in self.params.items()]
        return df.withColumns({f"{prefix}{j + 1}": V.linear(list(self.loadings[:, j]), z) for j in range(self.k)})


def vector_column(df: DataFrame, vector: str) -> DataFrame:
    """MLlib vector to array."""
    return df.withColumn(vector, vector_to_array(vector))
