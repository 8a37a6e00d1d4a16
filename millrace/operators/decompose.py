"""Principal components of an array column without its Gramian on the driver.

Few columns: every task reduces its rows to the triangular factor of a QR decomposition, factors are merged in a tree of
tasks, and the last task decomposes what is left. Many columns: a random block of directions is turned into the leading
ones by passes that multiply it with the centred rows and back. The driver holds columns x (components + a few) numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.runtime import cut_lineage

_CHUNK = 8192  # rows that are decomposed together
_FAN = 8  # factors that a task merges


def _rows(df: DataFrame, vector: str) -> DataFrame:
    return df.select(F.col(vector).cast("array<double>").alias("x")).where("x IS NOT NULL")


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for batch in batches:
        for i in range(0, batch.num_rows, _CHUNK):
            part = batch.slice(i, _CHUNK)
            yield part.column(0).flatten().to_numpy().reshape(part.num_rows, -1)


def _by_column(rows: DataFrame, columns: int, width: int, add) -> np.ndarray:
    """[column, width] sums of what ``add(chunk)`` gives, merged per column."""

    def run(batches):
        total = np.zeros((columns, width))
        for x in _chunks(batches):
            total += add(x)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(columns)), *[pa.array(total[:, j].copy()) for j in range(width)]], ["at", *[f"c{j}" for j in range(width)]])

    schema = ", ".join(["at long", *[f"c{j} double" for j in range(width)]])
    out = np.zeros((columns, width))
    for at, *sums in rows.mapInArrow(run, schema).groupBy("at").agg(*[F.sum(f"c{j}") for j in range(width)]).collect():
        out[at] = sums
    return out


class Decomposition:
    """``loadings`` [column, component] with the largest entry of each positive, ``variances``, ``shares`` of the whole variance."""

    def __init__(self, vector: str, mean: np.ndarray, loadings: np.ndarray, variances: np.ndarray, whole: float):
        side = np.sign(loadings[np.abs(loadings).argmax(0), np.arange(loadings.shape[1])])
        self.vector, self.mean, self.loadings, self.variances = vector, mean, loadings * np.where(side == 0, 1, side), variances
        self.shares = variances / whole if whole else variances * 0

    def transform(self, df: DataFrame, out: str = "scores") -> DataFrame:
        """Adds the scores of the centred rows as an array."""
        mean, loadings = self.mean, self.loadings

        @F.pandas_udf("array<double>")
        def project(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for v in batches:
                yield pd.Series([None if x is None else (np.asarray(x, float) - mean) @ loadings for x in v], dtype=object)

        return df.withColumn(out, project(F.col(self.vector).cast("array<double>")))


def _mean(rows: DataFrame) -> tuple[int, np.ndarray]:
    first = rows.first()
    if first is None:
        raise ValueError("no rows to decompose")
    n = rows.count()
    return n, _by_column(rows, len(first["x"]), 1, lambda x: x.sum(0)[:, None])[:, 0] / n


def tall(df: DataFrame, vector: str, k: int) -> Decomposition:
    """Components of many rows with few columns (a factor of columns x columns fits a task)."""
    rows = _rows(df, vector)
    n, mean = _mean(rows)

    def reduce(batches):
        r = np.zeros((0, len(mean)))
        for x in _chunks(batches):
            r = np.linalg.qr(np.concatenate([r, x - mean]), mode="r")
        yield pa.RecordBatch.from_arrays([pa.array([r.tobytes()], pa.binary())], ["r"])

    opened = lambda data: np.frombuffer(data, float).reshape(-1, len(mean))

    def merge(table: pa.Table) -> pa.Table:
        r = np.linalg.qr(np.concatenate([opened(x) for x in table.column("r").to_pylist()]), mode="r")
        return pa.table({"r": pa.array([r.tobytes()], pa.binary())})

    def finish(table: pa.Table) -> pa.Table:
        r = np.linalg.qr(np.concatenate([opened(x) for x in table.column("r").to_pylist()]), mode="r")
        _, s, v = np.linalg.svd(r)
        s = np.append(s, np.zeros(len(v) - len(s)))
        return pa.table({"value": pa.array(s[:k]), "whole": pa.array(np.full(len(s[:k]), (s * s).sum())), "loading": pa.array([x.tolist() for x in v[:k]], pa.list_(pa.float64()))})

    factors = cut_lineage(rows.mapInArrow(reduce, "r binary").withColumn("at", F.monotonically_increasing_id()))
    while (left := factors.count()) > _FAN:
        groups = -(-left // _FAN)
        merged = factors.withColumn("to", F.pmod(F.xxhash64("at"), F.lit(groups))).groupBy("to").applyInArrow(merge, "r binary")
        factors = cut_lineage(merged.withColumn("at", F.monotonically_increasing_id()))
    last = factors.withColumn("all", F.lit("all")).groupBy("all").applyInArrow(finish, "value double, whole double, loading array<double>").collect()
    found = sorted(last, key=lambda r: -r["value"])
    scale = max(n - 1, 1)
    return Decomposition(vector, mean, np.array([r["loading"] for r in found]).T, np.array([r["value"] ** 2 / scale for r in found]), found[0]["whole"] / scale)


def wide(df: DataFrame, vector: str, k: int, extra: int = 8, tol: float = 1e-9, max_iter: int = 200, seed: int = 0) -> Decomposition:
    """Components of rows with many columns, to a residual of ``tol`` relative to the first; a pass per iteration."""
    rows = _rows(df, vector).persist()
    try:
        n, mean = _mean(rows)
        d = len(mean)
        k = min(k, d)
        size = min(d, k + extra)
        whole = float(_by_column(rows, d, 1, lambda x: ((x - mean) ** 2).sum(0)[:, None]).sum())
        q = np.linalg.qr(np.random.default_rng(seed).normal(size=(d, size)))[0]
        for _ in range(max_iter):
            back = _by_column(rows, d, size, lambda x: (x - mean).T @ ((x - mean) @ q))  # noqa: B023
            inner = q.T @ back
            values, turn = np.linalg.eigh((inner + inner.T) / 2)
            values, turn = values[::-1], turn[:, ::-1]
            leading = q @ turn
            left = np.linalg.norm(back @ turn[:, :k] - leading[:, :k] * values[:k], axis=0)
            if left.max() <= tol * max(values[0], 1e-300):
                break
            q = np.linalg.qr(back @ turn)[0]
    finally:
        rows.unpersist()
    scale = max(n - 1, 1)
    return Decomposition(vector, mean, leading[:, :k], np.maximum(values[:k], 0) / scale, whole / scale)
