"""Kernel machine: whitened landmark features, and a support vector machine on them by Newton steps.

With landmarks L the features of x are k(x, L) K(L, L)^(-1/2), so that the inner product of two rows' features is the kernel
between them as far as the landmarks span it, and exactly if both are landmarks. The machine minimises the mean hinge loss,
rounded off within ``smooth`` of its corner, plus ``reg``/2 |w|²; rounding changes the objective by at most ``smooth``/4.
Each Newton step is one aggregate whose size is the square of the number of landmarks, whatever the number of rows; the
rounding is narrowed in stages, each of which begins where the one before has ended.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class KernelMachine:
    """Binary classifier on an array column; ``gamma`` > 0 is the RBF kernel's, else the kernel is (1 + x·y)^degree."""

    def __init__(self, vector: str, label: str = "label", gamma: float = 1.0, degree: int = 0, landmarks: int = 128, reg: float = 0.001, smooth: float = 0.01, seed: int = 0, max_iter: int = 200):
        self.vector, self.label, self.gamma, self.degree = vector, label, gamma, degree
        self.landmarks, self.reg, self.smooth, self.seed, self.max_iter = landmarks, reg, smooth, seed, max_iter

    def _kernel(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        if self.degree:
            return (1 + x @ y.T) ** self.degree
        gap = (x * x).sum(1)[:, None] + (y * y).sum(1)[None] - 2 * x @ y.T
        return np.exp(-self.gamma * np.maximum(gap, 0))

    def features(self, x: np.ndarray) -> np.ndarray:
        return self._kernel(x, self.points) @ self.whiten

    def fit(self, df: DataFrame) -> "KernelMachine":
        """Rows with a null label or vector are left out. The landmarks are the rows with the least hashes of their values."""
        rows = df.select(F.col(self.vector).cast("array<double>").alias("x"), F.col(self.label).cast("double").alias("y")).where("x IS NOT NULL AND y IS NOT NULL").persist()
        try:
            picked = rows.select("x").distinct().orderBy(F.xxhash64("x", F.lit(self.seed)), "x").limit(self.landmarks).collect()
            self.points = np.array([r["x"] for r in picked])
            values, turn = np.linalg.eigh(self._kernel(self.points, self.points))
            some = values > 1e-10 * values.max()
            self.whiten = turn[:, some] / np.sqrt(values[some])
            self._solve(rows, rows.count())
        finally:
            rows.unpersist()
        return self

    def _solve(self, rows: DataFrame, n: int) -> None:
        d = self.whiten.shape[1]
        w = np.zeros(d + 1)
        width = 0.5
        self.steps = 0
        while True:
            width = max(width, self.smooth)
            value, step, share = np.inf, np.zeros(d + 1), 1.0
            while self.steps < self.max_iter:
                self.steps += 1
                tried = w + share * step
                loss, g, h = self._pass(rows, n, tried, width)
                now = loss + self.reg / 2 * (tried[:d] ** 2).sum()
                if now > value + 1e-14 * abs(value):
                    share /= 2
                    if share < 1e-9:
                        break
                    continue
                w, value, share = tried, now, 1.0
                g = g + self.reg * np.append(w[:d], 0)
                h = h + np.diag(np.append(np.full(d, self.reg), 1e-3 if h[d, d] < 1e-3 else 0.0))  # no row may be near the corner
                step = -np.linalg.lstsq(h, g, rcond=None)[0]
                if -(g @ step) < 1e-10 * max(1.0, value):
                    break
            if width == self.smooth:
                break
            width /= 5
        self.weights, self.intercept, self.objective = w[:d], float(w[d]), float(value)

    def _pass(self, rows: DataFrame, n: int, w: np.ndarray, width: float) -> tuple[float, np.ndarray, np.ndarray]:
        """Mean loss, its gradient and its second derivatives at w (the intercept last)."""
        machine, d = self, len(w)
        upper = np.triu_indices(d)

        def run(batches):
            total = np.zeros(1 + d + len(upper[0]))
            for batch in batches:
                for i in range(0, batch.num_rows, 4096):
                    part = batch.slice(i, 4096)
                    x = part.column(0).flatten().to_numpy().reshape(part.num_rows, -1)
                    y = np.where(part.column(1).to_numpy() > 0, 1.0, -1.0)
                    z = np.concatenate([machine.features(x), np.ones((len(x), 1))], 1)
                    r = 1 - y * (z @ w)  # how far a row is from being right by a margin of one
                    near, wrong = np.abs(r) < width, r >= width
                    total[0] += ((r[near] + width) ** 2).sum() / (4 * width) + r[wrong].sum()
                    slope = np.where(near, (r + width) / (2 * width), wrong.astype(float))
                    total[1 : 1 + d] -= (slope * y) @ z
                    total[1 + d :] += (z[near].T @ z[near] / (2 * width))[upper]
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["at", "v"])

        sums = np.zeros(1 + d + len(upper[0]))
        for at, v in rows.mapInArrow(run, "at long, v double").groupBy("at").agg(F.sum("v")).collect():
            sums[at] = v
        sums /= n
        h = np.zeros((d, d))
        h[upper] = sums[1 + d :]
        return float(sums[0]), sums[1 : 1 + d], h + np.triu(h, 1).T

    def decision(self, vector: Column) -> Column:
        machine = self

        @F.pandas_udf("double")
        def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for v in batches:
                x = np.stack(v.to_numpy()).astype(float) if len(v) else np.zeros((0, machine.points.shape[1]))
                yield pd.Series(machine.features(x) @ machine.weights + machine.intercept)

        return score(vector.cast("array<double>"))

    def transform(self, df: DataFrame, out: str = "margin") -> DataFrame:
        return df.withColumn(out, self.decision(F.col(self.vector)))
