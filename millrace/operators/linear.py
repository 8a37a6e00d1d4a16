"""Logistic regressions of many settings and folds, fitted together.

Every iteration is one pass over the rows and one aggregate, whatever the number of models: tasks return the loss, the
gradient and the second derivatives of all models, the driver takes a proximal Newton step for each of them. The driver's
work is that of small dense matrices, one per model; it grows with settings and columns, not with rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass
class Fit:
    """One model: trained on all rows but those of fold ``out`` (-1: on all)."""

    reg: float
    alpha: float
    out: int
    coefficients: np.ndarray | None = None
    intercept: float = 0.0
    converged: bool = False


def _moments(df: DataFrame, columns: Sequence[str], label: str) -> dict[int, tuple]:
    """Per fold rows, positives, means and sums of squared deviations of the columns."""
    y = F.col(label).cast("double")
    aggs = [F.count("*").alias("n"), F.sum(y).alias("pos")]
    for i, c in enumerate(columns):
        aggs += [F.avg(F.col(c).cast("double")).alias(f"m{i}"), F.var_pop(F.col(c).cast("double")).alias(f"v{i}")]
    d = len(columns)
    return {r["fold"]: (r["n"], r["pos"], np.array([r[f"m{i}"] for i in range(d)]), np.array([r[f"v{i}"] for i in range(d)]) * r["n"]) for r in df.groupBy("fold").agg(*aggs).collect()}


def _merged(parts: Sequence[tuple]) -> tuple[int, float, np.ndarray, np.ndarray]:
    n = sum(p[0] for p in parts)
    mean = sum(p[0] * p[2] for p in parts) / n
    spread = sum(p[3] + p[0] * (p[2] - mean) ** 2 for p in parts)
    return n, sum(p[1] for p in parts), mean, spread


class LogisticGrid:
    """Binary logistic regression with elastic-net penalty, the objective of Spark's own: mean log loss plus ``reg`` times
    (alpha |b| + (1 - alpha)/2 b²) of the coefficients of standardised columns; the intercept is free.

    ``df`` has a column ``fold``; with ``folds`` every setting is fitted once without each fold, otherwise on all rows. Rows
    with a null label or column are to be removed before.
    """

    def __init__(self, columns: Sequence[str], label: str, settings: Sequence[tuple[float, float]], folds: int = 0, max_iter: int = 60, tol: float = 1e-10):
        self.columns, self.label, self.folds, self.max_iter, self.tol = list(columns), label, folds, max_iter, tol
        outs = range(folds) if folds else [-1]
        self.fits = [Fit(float(r), float(a), f) for r, a in settings for f in outs]

    def fit(self, df: DataFrame) -> "LogisticGrid":
        d = len(self.columns)
        parts = _moments(df, self.columns, self.label)
        _, _, centre, spread = _merged(list(parts.values()))
        n_all = sum(p[0] for p in parts.values())
        unit = np.sqrt(spread / max(n_all - 1, 1))
        unit[unit <= 1e-12 * np.abs(centre)] = 1.0
        # each model's own standardisation, in terms of columns that are standardised over all rows
        frames = []
        for m in self.fits:
            n, pos, mean, dev = _merged([p for f, p in parts.items() if f != m.out])
            own = np.sqrt(dev / max(n - 1, 1))
            own[own <= 1e-12 * np.abs(mean)] = np.inf  # a constant column has no coefficient
            frames.append((n, pos, (mean - centre) / unit, own / unit))
        rows = df.select(F.col("fold").cast("int").alias("fold"), F.col(self.label).cast("double").alias("y"), F.array(*[F.col(c).cast("double") for c in self.columns]).alias("x")).persist()
        try:
            self._solve(rows, d, centre, unit, frames)
        finally:
            rows.unpersist()
        for m, b, (_, _, mean, own) in zip(self.fits, self._b, frames, strict=True):
            m.coefficients = b[:d] / own / unit
            m.intercept = float(b[d] - (b[:d] / own) @ mean - m.coefficients @ centre)
        return self

    def _solve(self, rows, d, centre, unit, frames):
        k = len(self.fits)
        reg = np.array([m.reg for m in self.fits])
        alpha = np.array([m.alpha for m in self.fits])
        start = [np.log(max(f[1], 0.5) / max(f[0] - f[1], 0.5)) for f in frames]
        self._b = np.zeros((k, d + 1))
        self._b[:, d] = start
        value = np.full(k, np.inf)
        step, share = np.zeros((k, d + 1)), np.ones(k)
        open_ = list(range(k))
        for _ in range(self.max_iter):
            tried = self._b[open_] + share[open_, None] * step[open_]
            stats = self._pass(rows, d, centre, unit, open_, tried, frames)
            still = []
            for i, b, (loss, g, h) in zip(open_, tried, stats, strict=True):
                now = loss + reg[i] * (alpha[i] * np.abs(b[:d]).sum() + (1 - alpha[i]) / 2 * (b[:d] ** 2).sum())
                if now > value[i] + 1e-13 * abs(value[i]):
                    share[i] /= 2
                    if share[i] > 1e-8:
                        still.append(i)
                    continue
                self._b[i], value[i], share[i] = b, now, 1.0
                ridge = reg[i] * (1 - alpha[i])
                g = g + np.append(ridge * b[:d], 0.0)
                h = h + np.diag(np.append(np.full(d, ridge), 0.0)) + 1e-14 * np.eye(d + 1)
                step[i] = _newton_step(g, h, b, reg[i] * alpha[i])
                if np.abs(step[i]).max() > self.tol:
                    still.append(i)
                else:
                    self.fits[i].converged = True
            open_ = still
            if not open_:
                break

    def _pass(self, rows, d, centre, unit, open_, tried, frames):
        """(mean loss, gradient, second derivatives) of each open model in its own standardised columns."""
        fits = self.fits
        outs = np.array([fits[i].out for i in open_])
        raw = np.zeros((len(open_), d + 1))  # coefficients for the columns that the tasks see
        for r, i, b in zip(raw, open_, tried, strict=True):
            _, _, mean, own = frames[i]
            r[:d] = b[:d] / own
            r[d] = b[d] - (r[:d] * mean).sum()
        pairs = np.array([(i, j) for i in range(d + 1) for j in range(i, d + 1)])
        width = 1 + d + 1 + len(pairs)

        def run(batches):
            total = np.zeros((len(raw), width))
            for batch in batches:
                if not batch.num_rows:
                    continue
                fold, y = batch.column(0).to_numpy(), batch.column(1).to_numpy()
                x = batch.column(2).flatten().to_numpy().reshape(len(y), d)
                x = np.concatenate([(x - centre) / unit, np.ones((len(y), 1))], 1)
                for f in np.unique(fold):
                    at = np.flatnonzero(fold == f)
                    for lo in range(0, len(at), 8192):
                        rows_, use = at[lo : lo + 8192], np.flatnonzero(outs != f)
                        u, t = x[rows_], y[rows_][:, None]
                        margin = u @ raw[use].T
                        small = np.exp(-np.abs(margin))  # one exponential for chances and losses
                        p = np.where(margin < 0, small, 1.0) / (1 + small)
                        total[use, 0] += _log_sums(1 + small) + np.maximum(margin, 0).sum(0) - (t.T @ margin)[0]
                        total[use, 1 : d + 2] += (p - t).T @ u
                        total[use, d + 2 :] += (p * (1 - p)).T @ (u[:, pairs[:, 0]] * u[:, pairs[:, 1]])
            at = np.arange(total.size)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total.reshape(-1))], ["at", "v"])

        sums = np.zeros(len(raw) * width)
        for at, v in rows.mapInArrow(run, "at long, v double").groupBy("at").agg(F.sum("v")).collect():
            sums[at] = v
        out = []
        for i, s in zip(open_, sums.reshape(-1, width), strict=True):
            n, _, mean, own = frames[i]
            h = np.zeros((d + 1, d + 1))
            h[pairs[:, 0], pairs[:, 1]] = h[pairs[:, 1], pairs[:, 0]] = s[d + 2 :]
            turn = np.eye(d + 1)
            turn[:d, :d] = np.diag(1 / own)
            turn[:d, d] = -mean / own
            out.append((s[0] / n, turn @ s[1 : d + 2] / n, turn @ h @ turn.T / n))
        return out

    def scores(self, df: DataFrame, keep: Sequence[str]) -> DataFrame:
        """The columns ``keep``, and ``scores``: the probability of each setting's model without the row's own fold."""
        per = max(self.folds, 1)
        w = np.stack([m.coefficients for m in self.fits]).reshape(-1, per, len(self.columns))
        b = np.array([m.intercept for m in self.fits]).reshape(-1, per)
        d, folds, n = len(self.columns), self.folds, len(keep)

        def run(batches):
            for batch in batches:
                x = batch.column(n + 1).flatten().to_numpy().reshape(batch.num_rows, d)
                at = batch.column(n).to_numpy() if folds else np.zeros(batch.num_rows, int)
                out = np.zeros((batch.num_rows, len(w)))
                for f in np.unique(at):
                    mine = at == f
                    out[mine] = 1 / (1 + np.exp(-np.clip(x[mine] @ w[:, f].T + b[:, f], -700, 700)))
                ends = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * len(w))
                yield pa.RecordBatch.from_arrays([*batch.columns[:n], pa.ListArray.from_arrays(ends, pa.array(out.reshape(-1)))], [*keep, "scores"])

        rows = df.select(*keep, F.col("fold").cast("int").alias("__fold"), F.array(*[F.col(c).cast("double") for c in self.columns]).alias("__x"))
        schema = df.select(*keep).schema.add("scores", T.ArrayType(T.DoubleType()))
        return rows.mapInArrow(run, schema)


def _log_sums(x: np.ndarray) -> np.ndarray:
    """Column sums of the logarithms of numbers from 1 to 2; products of 512 of them are far from the largest double."""
    whole = len(x) // 512 * 512
    parts = np.multiply.reduce(x[:whole].reshape(-1, 512, x.shape[1]), axis=1)
    return np.log(parts).sum(0) + np.log(x[whole:]).sum(0)


def _newton_step(g: np.ndarray, h: np.ndarray, b: np.ndarray, lasso: float) -> np.ndarray:
    """Least point of the quadratic model plus ``lasso`` |b| (not of the intercept, which is last), less ``b``."""
    d = len(b) - 1
    if lasso == 0:
        return -np.linalg.lstsq(h, g, rcond=None)[0]
    step = np.zeros(d + 1)
    slope = g.copy()  # of the quadratic model at b + step
    for _ in range(10_000):
        most = 0.0
        for j in range(d + 1):
            if h[j, j] <= 1e-13:
                continue
            at = b[j] + step[j] - slope[j] / h[j, j]
            if j < d:
                at = np.sign(at) * max(abs(at) - lasso / h[j, j], 0.0)
            move = at - b[j] - step[j]
            if move:
                step[j] += move
                slope += h[:, j] * move
                most = max(most, abs(move))
        if most < 1e-13:
            break
    return step


def fold_aurocs(scored: DataFrame, label: str, models: int, bucket_rows: int = 4_000_000) -> list[dict[int, float]]:
    """Per setting the exact AUROC of every fold, all in one go; ``scored`` has ``fold``, the label and ``scores``.

    Tasks send the distinct scores of a fold, a setting and a class as one sorted list. Above ``bucket_rows`` rows the scores
    of a setting are cut at about equal shares, and pairs of different parts are counted from the sizes of these.
    """
    rows = scored.select(F.col("fold").cast("int").alias("fold"), F.col(label).cast("int").alias("y"), "scores").where("fold IS NOT NULL AND y IS NOT NULL")
    buckets = -(-rows.count() // bucket_rows)
    cuts = _score_cuts(rows, models, buckets) if buckets > 1 else np.zeros((models, 0))

    def lists(batches):
        for fold, y, scores in _slices(batches, models):
            for f in np.unique(fold):
                for positive in (0, 1):
                    mine = scores[(fold == f) & (y == positive)]
                    out = []
                    for m in range(models):
                        some, n = np.unique(mine[:, m], return_counts=True)
                        ends = np.r_[0, np.searchsorted(some, cuts[m], "left"), len(some)]
                        out += [(m, b, some[i:j].tobytes(), n[i:j].astype(np.int64).tobytes() if n[i:j].max() > 1 else b"") for b, (i, j) in enumerate(zip(ends[:-1], ends[1:], strict=True)) if i < j]
                    if out:
                        m, b, some, n = zip(*out, strict=True)
                        yield pa.RecordBatch.from_arrays([pa.array([int(f)] * len(out), pa.int32()), pa.array(m, pa.int32()), pa.array(b, pa.int32()), pa.array([positive] * len(out), pa.int32()), pa.array(some, pa.binary()), pa.array(n, pa.binary())], ["fold", "m", "bucket", "y", "some", "n"])

    def wins(table: pa.Table) -> pa.Table:
        sides = []
        for positive in (0, 1):
            own = [(np.frombuffer(x), n) for y, x, n in zip(*(table.column(c).to_pylist() for c in ("y", "some", "n")), strict=True) if y == positive]
            sides.append((np.concatenate([np.zeros(0), *(x for x, _ in own)]), np.concatenate([np.zeros(0, np.int64), *(np.frombuffer(n, np.int64) if n else np.ones(len(x), np.int64) for x, n in own)])))
        (neg, neg_n), (pos, pos_n) = sides
        order = np.argsort(neg)
        neg, below = neg[order], np.r_[0, np.cumsum(neg_n[order])]
        twice = int((pos_n * (below[np.searchsorted(neg, pos, "left")] + below[np.searchsorted(neg, pos, "right")])).sum())
        return table.select(["fold", "m", "bucket"]).slice(0, 1).append_column("pos", pa.array([int(pos_n.sum())])).append_column("neg", pa.array([int(neg_n.sum())])).append_column("twice", pa.array([twice]))

    sent = rows.mapInArrow(lists, "fold int, m int, bucket int, y int, some binary, n binary")
    found: dict[tuple[int, int], list] = {}
    for r in sent.groupBy("fold", "m", "bucket").applyInArrow(wins, "fold int, m int, bucket int, pos long, neg long, twice long").collect():
        found.setdefault((r["m"], r["fold"]), []).append((r["bucket"], r["pos"], r["neg"], r["twice"]))
    out: list[dict[int, float]] = [{} for _ in range(models)]
    for (m, fold), parts in found.items():
        below = pos = total = 0
        for _, p, n, twice in sorted(parts):
            total += twice + 2 * p * below
            below, pos = below + n, pos + p
        if pos and below:
            out[m][fold] = total / 2 / (pos * below)
    return out


def _slices(batches, models: int, size: int = 1 << 16):
    """(folds, labels, matrix of scores) of about ``size`` rows each."""
    held, n = [], 0
    for batch in batches:
        held, n = [*held, batch], n + batch.num_rows
        if n >= size:
            yield _matrices(held, models)
            held, n = [], 0
    if n:
        yield _matrices(held, models)


def _matrices(held, models: int):
    fold, y = (np.concatenate([b.column(c).to_numpy() for b in held]) for c in (0, 1))
    return fold, y, np.concatenate([b.column(2).flatten().to_numpy(zero_copy_only=False) for b in held]).reshape(-1, models)


def _score_cuts(rows: DataFrame, models: int, buckets: int) -> np.ndarray:
    """Per setting about where its scores are cut into ``buckets`` equal shares: medians of what slices of the rows tell."""

    def shares(batches):
        for _, _, scores in _slices(batches, models):
            at = (np.arange(1, buckets) * len(scores)) // buckets
            yield pa.RecordBatch.from_arrays([pa.array([np.sort(scores, axis=0)[at].T.tobytes()], pa.binary())], ["at"])

    found = [np.frombuffer(r["at"]).reshape(models, buckets - 1) for r in rows.mapInArrow(shares, "at binary").collect()]
    return np.sort(np.median(found, axis=0), axis=1)
