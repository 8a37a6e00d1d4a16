"""Exact nearest neighbours, block against block.

Points and queries are assigned to the nearest of a few pivots, and the rows of a cell are packed into matrices of bounded
size. The distance of two pivots and the radii of their cells bound the distance of everything in them (triangle
inequality), so only cells that can hold one of the k nearest meet. A task holds one matrix of queries and one of points:
products of the two find the candidates, whose distances are then taken exactly. It keeps k candidates per query; a last
top-k merges them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_SLACK = 1e-9
_TILE = 1 << 21  # distances that are held at once
_CELL = 4  # blocks of points that a cell or a matrix holds


def _distances(block: np.ndarray, q: np.ndarray, p: int) -> np.ndarray:
    diff = block - q
    return np.abs(diff).sum(axis=1) if p == 1 else np.sqrt((diff * diff).sum(axis=1))


def _rough(queries: np.ndarray, points: np.ndarray) -> tuple[np.ndarray, float]:
    """All squares of distances of two matrices, and a bound of their rounding errors."""
    a, b = (queries * queries).sum(1), (points * points).sum(1)
    out = queries @ points.T
    out *= -2
    out += a[:, None]
    out += b[None, :]
    return out, 1e-14 * (a.max(initial=0) + b.max(initial=0)) * max(1, queries.shape[1])


class _Steps:
    """Lower bounds of sums of absolute differences by matrix products.

    A coordinate is cut at ``levels`` and written as its share in each part. The difference of two values is the sum of what
    they differ by in the parts; its square over the width of a part is no more than that, and sums of squares are products.
    """

    def __init__(self, points: np.ndarray):
        parts = max(1, min(16, 1024 // points.shape[1]))
        some = np.nan_to_num(points[:: max(1, len(points) // 1024)], posinf=0, neginf=0)
        levels = np.quantile(some, np.linspace(0, 1, parts + 1), axis=0)
        self.low, self.width = levels[:-1], np.diff(levels, axis=0)
        self.scale = np.divide(1, np.sqrt(self.width), out=np.zeros_like(self.width), where=self.width > 0)
        self.points, self.sizes = self._shares(points)

    def _shares(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        parts = [np.clip(rows - a, 0, w) * s for a, w, s in zip(self.low, self.width, self.scale, strict=True)]
        out = np.concatenate(parts, axis=1, dtype=np.float32)
        return out, np.einsum("ij,ij->i", out, out)

    def least(self, queries: np.ndarray) -> tuple[np.ndarray, float]:
        """A matrix that no distance falls below by more than the second value, which is for rounding."""
        mine, sizes = self._shares(queries)
        out = mine @ self.points.T
        out *= -2
        out += sizes[:, None]
        out += self.sizes[None, :]
        return out, 1.2e-7 * (2 * mine.shape[1] + 64) * float(np.nanmax(sizes, initial=0) + np.nanmax(self.sizes, initial=0))


def _not_farther(least: np.ndarray, error: float, queries: np.ndarray, points: np.ndarray, need: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of a superset of the ``need`` points of least absolute differences: distances of those with the least bounds
    tell how far the others may be."""
    n = least.shape[1]
    if need >= n:
        return np.nonzero(np.ones(least.shape, bool))
    few = min(n, 2 * need + 8)
    to = np.argpartition(least, few - 1, axis=1)[:, :few]
    d = _distances(points[to.reshape(-1)], np.repeat(queries, few, axis=0), 1).reshape(to.shape)
    limit = np.partition(d, need - 1, axis=1)[:, need - 1]
    return np.nonzero(~(least > (limit * (1 + _SLACK) + error)[:, None]))  # what cannot be compared is looked at exactly


def _likely(rough: np.ndarray, error: float, need: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (row, column) of a superset of the ``need`` least of every row."""
    n = rough.shape[1]
    if need >= n:
        return np.nonzero(np.ones(rough.shape, bool))
    # the need-th least of the minima of parts is no less than the need-th least of all
    width = max(1, min(64, n // (4 * need)))
    parts = np.minimum.reduceat(rough, np.arange(0, n, width), axis=1) if width > 1 else rough
    limit = np.partition(parts, need - 1, axis=1)[:, need - 1 : need]
    return np.nonzero(~(rough > limit + 2 * error))  # what cannot be compared is looked at exactly


def _closest(qids: np.ndarray, queries: np.ndarray, pids: np.ndarray, points: np.ndarray, k: int, p: int, exclude_self: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(query id, point id, distance) of the ``k`` nearest points of every query, ties by point id."""
    need = k + int(np.unique(pids, return_counts=True)[1].max()) if exclude_self else k
    rows = max(1, _TILE // len(points))
    steps = _Steps(points) if p == 1 and need < len(points) else None
    for lo in range(0, len(queries), rows):
        mine = queries[lo : lo + rows]
        at, to = _likely(*_rough(mine, points), need) if steps is None else _not_farther(*steps.least(mine), mine, points, need)
        d = np.empty(len(at))
        for i in range(0, len(at), 1 << 15):
            part = slice(i, i + (1 << 15))
            d[part] = _distances(points[to[part]], mine[at[part]], p)
        keep = ~np.isnan(d)
        if exclude_self:
            keep &= pids[to] != qids[lo + at]
        at, to, d = at[keep], to[keep], d[keep]
        order = np.lexsort((pids[to], d, at))
        at, to, d = at[order], to[order], d[order]
        first = np.searchsorted(at, at, "left")
        top = np.arange(len(at)) - first < k
        yield qids[lo + at[top]], pids[to[top]], d[top]


def _packed(rows: DataFrame, by: list[str]) -> DataFrame:
    """One row per key: the ids and the vectors as bytes."""
    schema = ", ".join([f"{c} {dict(rows.dtypes)[c]}" for c in by])

    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by("id")
        ids = table.column("id").to_numpy().astype(np.int64)
        vectors = np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in table.column("v").chunks]).astype(float)
        keys = {c: table.column(c).slice(0, 1) for c in by}
        return pa.table({**keys, "ids": pa.array([ids.tobytes()], pa.binary()), "data": pa.array([vectors.tobytes()], pa.binary())})

    return rows.select(*by, "id", "v").groupBy(*by).applyInArrow(pack, f"{schema}, ids binary, data binary")


def nearest(
    queries: DataFrame,
    points: DataFrame,
    k: int,
    query_id: str,
    point_id: str,
    vector: str = "vector",
    by: str | None = None,
    p: int = 2,
    exclude_self: bool = False,
    max_pivots: int = 128,
    block: int = 4096,
) -> DataFrame:
    """(query_id, point_id, distance, rank) of the ``k`` nearest points, ties by point id.

    ``by`` restricts candidates to points of the query's own group. ``exclude_self`` skips the point
    whose id equals the query's.
    """
    spark = points.sparkSession
    as_double = F.col(vector).cast("array<double>").alias("v")
    group = F.col(by).cast("string").alias("g") if by else F.lit("").alias("g")
    pts = points.select(F.col(point_id).cast("long").alias("id"), group, as_double)
    qs = queries.select(F.col(query_id).cast("long").alias("id"), group, as_double)
    most = _CELL * block
    n_pivots = max(1, min(max_pivots, points.count() // most))
    chosen = pts.orderBy(F.xxhash64("id"), "id").limit(n_pivots).select("v").collect()
    pivots = np.array([r["v"] for r in chosen], dtype=float)
    if not len(pivots):
        raise ValueError("no points to search")

    def to_cell(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                vs = np.stack(pdf.v.to_numpy())
                d = np.stack([_distances(vs, c, p) for c in pivots], axis=1)
                yield pdf.assign(cell=d.argmin(axis=1).astype(np.int32), d=d.min(axis=1))

    celled = [x.mapInPandas(to_cell, "id long, g string, v array<double>, cell int, d double") for x in (qs, pts)]
    sizes = [x.groupBy("g", "cell").agg(F.count("*").alias("n"), F.max(F.nanvl("d", F.lit(0.0))).alias("radius")).collect() for x in celled]
    # queries of small tables are cut finer, so that all cores search
    least = math.ceil(sum(r["n"] for r in sizes[0]) / (2 * spark.sparkContext.defaultParallelism))
    pieces = [[max(1, math.ceil(r["n"] / size)) for r in found] for found, size in zip(sizes, (min(most, max(256, least)), most), strict=True)]
    here: dict[str, list[int]] = {}
    for i, r in enumerate(sizes[1]):
        here.setdefault(r["g"], []).append(i)
    apart = np.stack([_distances(pivots, c, p) for c in pivots])
    meet = []
    for r, n_query in zip(sizes[0], pieces[0], strict=True):
        mine = np.array(here.get(r["g"], []), int)
        if not len(mine):
            continue
        n, radius = (np.array([sizes[1][i][c] for i in mine], float) for c in ("n", "radius"))
        middle, reach = apart[r["cell"]][[sizes[1][i]["cell"] for i in mine]], radius + r["radius"]
        need = k + 1 if exclude_self else k
        far = np.argsort(middle + reach)
        enough = np.searchsorted(np.cumsum(n[far]), min(need, n.sum()))
        limit = (middle + reach)[far[enough]] * (1 + _SLACK) + _SLACK
        meet += [(r["g"], r["cell"], int(sizes[1][i]["cell"]), n_query, pieces[1][i]) for i in mine[middle - reach <= limit]]
    number = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    sides = []
    for x, found, cut, name in zip(celled, sizes, pieces, "qp", strict=True):
        cuts = F.broadcast(spark.createDataFrame([(r["g"], r["cell"], m) for r, m in zip(found, cut, strict=True)], "cut_g string, cut_cell int, m int"))
        dealt = x.join(cuts, F.col("g").eqNullSafe(F.col("cut_g")) & (F.col("cell") == F.col("cut_cell")))
        piece = F.pmod(F.xxhash64("id"), F.col("m")).cast("int").alias("own_piece")
        rows = _packed(dealt.select(F.col("g").alias("own_g"), F.col("cell").alias("own_cell"), piece, "id", "v"), ["own_g", "own_cell", "own_piece"])
        met = F.broadcast(spark.createDataFrame(meet, "g string, qcell int, pcell int, qpieces int, ppieces int"))
        paired = rows.join(met, F.col("own_g").eqNullSafe(F.col("g")) & (F.col("own_cell") == F.col(f"{name}cell")))
        other = "p" if name == "q" else "q"
        sides.append(paired.select("g", "qcell", "pcell", F.col("own_piece").alias(f"{name}piece"), number(f"{other}pieces").alias(f"{other}piece"), "ids", "data"))
    left, right = sides
    key = ["g", "qcell", "qpiece", "pcell", "ppiece"]

    def search(mine: pa.Table, theirs: pa.Table) -> pa.Table:
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        if mine.num_rows and theirs.num_rows:
            qids, pids = (np.frombuffer(t.column("ids")[0].as_py(), np.int64) for t in (mine, theirs))
            q, x = (np.frombuffer(t.column("data")[0].as_py()).reshape(len(ids), -1) for t, ids in ((mine, qids), (theirs, pids)))
            found += _closest(qids, q, pids, x, k, p, exclude_self)
        return pa.table([pa.array(np.concatenate(c)) for c in zip(*found, strict=True)], ["qid", "pid", "distance"])

    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(search, "qid long, pid long, distance double")
    rank = F.row_number().over(Window.partitionBy("qid").orderBy("distance", "pid"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select(
        F.col("qid").alias(query_id), F.col("pid").alias(point_id), "distance", "rank"
    )
