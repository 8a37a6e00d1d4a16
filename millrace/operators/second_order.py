"""Gradient boosting with second derivatives: histograms of gradients and curvatures, regularised leaf weights.

Columns become bins once; rows with equal bins become one row with their number, kept in blocks of a stored table with their
margin: no more rows than there are combinations of bins. A level of a tree is one pass, only over the smaller child of each
split: its sibling is the parent less it, and the sums of the last leaves are those of the split. Sums are of whole numbers
(gradients in steps of 2^-30), so trees do not depend on how the rows are partitioned. The driver gets at most 2^depth x
columns x bins sums per level and task, from at most ``TASKS`` tasks, whatever the number of rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.quantiles import exact_quantiles
from millrace.runtime import work_path

FINE = 1 << 30
BLOCK = 1 << 16  # rows
TASKS = 64  # whose sums the driver adds up; those of more tasks are added in a shuffle
_NAMES = ["n", "y", "bins", "margin"]
_SCHEMA = ", ".join(f"{x} binary" for x in _NAMES)
_HALVES = ["g_high", "g_low", "h_high", "h_low"]
_SUMS = ", ".join(f"{x} binary" for x in ["at", *_HALVES])


@dataclass
class Tree:
    """Nodes by number, 0 the root. Inner nodes send bins up to ``cut`` and, if ``missing_left``, missing values to the left."""

    column: list[int] = field(default_factory=lambda: [-1])
    cut: list[int] = field(default_factory=lambda: [0])
    missing_left: list[bool] = field(default_factory=lambda: [False])
    left: list[int] = field(default_factory=lambda: [-1])
    right: list[int] = field(default_factory=lambda: [-1])
    weight: list[float] = field(default_factory=lambda: [0.0])
    gain: list[float] = field(default_factory=lambda: [0.0])

    def split(self, node: int, gain: float, column: int, cut: int, missing_left: bool) -> tuple[int, int]:
        for side in (self.left, self.right):
            side[node] = len(self.column)
            for values, empty in ((self.column, -1), (self.cut, 0), (self.missing_left, False), (self.left, -1), (self.right, -1), (self.weight, 0.0), (self.gain, 0.0)):
                values.append(empty)
        self.column[node], self.cut[node], self.missing_left[node], self.gain[node] = column, cut, missing_left, gain
        return self.left[node], self.right[node]

    def leaves(self, bins: np.ndarray, missing: int) -> np.ndarray:
        """The node in which each row of ``bins`` [column, row] ends."""
        column, cut, left, right = (np.array(x) for x in (self.column, self.cut, self.left, self.right))
        side = np.array(self.missing_left)
        at = np.zeros(bins.shape[1], np.int64)
        rows = np.arange(bins.shape[1])
        while len(rows):
            node = at[rows]
            inner = column[node] >= 0
            rows, node = rows[inner], node[inner]
            b = bins[column[node], rows]
            at[rows] = np.where(np.where(b == missing, side[node], b <= cut[node]), left[node], right[node])
        return at


class Finder:
    """The node in which each row ends, by sets of leaves as bits: those a column's bin allows, met over all columns."""

    def __init__(self, tree: Tree, columns: int, missing: int):
        self.tree, self.missing = tree, missing
        self.ends = np.flatnonzero(np.array(tree.column) < 0)
        if len(self.ends) > 64:
            return
        self.allowed = np.zeros((columns, missing + 1), np.uint64)
        path = {0: np.ones((columns, missing + 1), bool)}
        for node, (c, cut, side) in enumerate(zip(tree.column, tree.cut, tree.missing_left, strict=True)):
            if c < 0:
                continue
            left = np.arange(missing + 1) <= cut
            left[missing] = side
            for child, may in ((tree.left[node], left), (tree.right[node], ~left)):
                path[child] = path[node].copy()
                path[child][c] &= may
        for bit, end in enumerate(self.ends):
            self.allowed |= path[end].astype(np.uint64) << np.uint64(bit)
        self.asked = sorted({c for c in tree.column if c >= 0})

    def __call__(self, bins: np.ndarray) -> np.ndarray:
        if len(self.ends) > 64:
            return self.tree.leaves(bins, self.missing)
        if not self.asked:
            return np.zeros(bins.shape[1], np.int64)
        left = self.allowed[self.asked[0]][bins[self.asked[0]]]
        for c in self.asked[1:]:
            left &= self.allowed[c][bins[c]]
        return self.ends[np.bitwise_count(left - np.uint64(1))]


class SecondOrderBoosting:
    """Binary classifier. ``columns`` may have nulls and NaN: each split learns the side they go to. Rows without a label
    are left out of the fit."""

    def __init__(
        self, columns: Sequence[str], label: str = "label", trees: int = 100, depth: int = 6, eta: float = 0.3, reg: float = 1.0, gamma: float = 0.0,
        min_weight: float = 1.0, column_share: float = 1.0, bins: int = 256, seed: int = 31, store_every: int = 10,
    ):
        self.columns, self.label, self.number, self.depth, self.eta = list(columns), label, trees, depth, eta
        self.reg, self.gamma, self.min_weight, self.column_share = reg, gamma, min_weight, column_share
        self.bins, self.seed, self.store_every = bins, seed, store_every

    def fit(self, df: DataFrame) -> "SecondOrderBoosting":
        value = [F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")).alias(f"x{i}") for i, c in enumerate(self.columns)]
        data = df.where(F.col(self.label).isNotNull()).select(F.col(self.label).cast("int").alias("y"), *value)
        names = [f"x{i}" for i in range(len(self.columns))]
        found = exact_quantiles(data, names, [i / self.bins for i in range(1, self.bins)])
        low = data.agg(*[F.min(n) for n in names]).first()
        # a cut at the least value would send nothing to the left
        self.edges = [np.array(sorted({q for q in found[n] if q is not None and q > m})) for n, m in zip(names, low, strict=True)]
        self.missing = max((len(e) for e in self.edges), default=0) + 1
        edges, missing = self.edges, self.missing
        narrow = np.uint8 if missing < 256 else np.uint16

        def binned_rows(batches: Iterator[pa.RecordBatch]):
            for batch in batches:
                bins = binned([batch.column(c + 1).to_numpy(zero_copy_only=False) for c in range(len(edges))], edges, missing).astype(narrow)
                rows = np.ascontiguousarray(bins.T)
                ends = np.arange(len(rows) + 1, dtype=np.int32) * len(edges) * rows.itemsize
                packed = pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(ends), pa.py_buffer(rows)])
                yield pa.RecordBatch.from_arrays([batch.column(0), packed], ["y", "bins"])

        def block(batches: Iterator[pa.RecordBatch]):
            for batch in batches:
                for i in range(0, batch.num_rows, BLOCK):
                    part = batch.slice(i, BLOCK)
                    bins = np.frombuffer(b"".join(part.column(0).to_pylist()), narrow).reshape(part.num_rows, len(edges)).T
                    n, y = (part.column(c).to_numpy().astype(np.int64) for c in (1, 2))
                    yield pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in (n.tobytes(), y.tobytes(), bins.tobytes(), np.zeros(len(y)).tobytes())], _NAMES)

        self.trees: list[Tree] = []
        self._narrow, self._pending = narrow, []
        alike = data.mapInArrow(binned_rows, "y int, bins binary").groupBy("bins").agg(F.count("*").alias("n"), F.sum(F.col("y").cast("long")).alias("y"))
        blocks = self._stored(alike.mapInArrow(block, _SCHEMA))
        rng = np.random.default_rng(self.seed)
        d = len(self.columns)
        for t in range(self.number):
            used = np.sort(rng.choice(d, max(1, math.ceil(self.column_share * d)), replace=False))
            tree = self._grow(blocks, used)
            self.trees.append(tree)
            self._pending.append(tree)
            if (t + 1) % self.store_every == 0 and t + 1 < self.number:
                blocks = self._advanced(blocks)
        self._pending = []
        return self

    def _stored(self, blocks: DataFrame) -> DataFrame:
        path = work_path(blocks.sparkSession, "boosting_blocks")
        blocks.write.option("compression", "none").parquet(path)
        out = blocks.sparkSession.read.schema(_SCHEMA).parquet(path)
        self._tasks = out.rdd.getNumPartitions()
        return out

    def _opened(self):
        """A function from a row of the table to numbers of rows, labels summed up, bins and margins with all trees so far."""
        d, narrow, missing = len(self.columns), self._narrow, self.missing
        pending = [(np.array(tree.weight), Finder(tree, d, missing)) for tree in self._pending]

        def opened(row) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
            n, y = (np.frombuffer(x, np.int64) for x in row[:2])
            bins = np.frombuffer(row[2], narrow).reshape(d, len(y))
            margin = np.frombuffer(row[3], float).copy()
            for weight, finder in pending:
                margin += weight[finder(bins)]
            return n, y, bins, margin

        return opened

    def _advanced(self, blocks: DataFrame) -> DataFrame:
        """The table with the margins after all trees so far."""
        opened = self._opened()

        def run(batches):
            for batch in batches:
                rows = [[c[r].as_py() for c in batch.columns] for r in range(batch.num_rows)]
                for row in rows:
                    yield pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in (*row[:3], opened(row)[3].tobytes())], _NAMES)

        out = self._stored(blocks.mapInArrow(run, _SCHEMA))
        self._pending = []
        return out

    def _histograms(self, blocks: DataFrame, tree: Tree, nodes: list[int], used: np.ndarray) -> np.ndarray:
        """[node, column, bin, (gradient, curvature)] of the given nodes of a tree that is being grown."""
        opened, finder = self._opened(), Finder(tree, len(self.columns), self.missing)
        slot = np.full(len(tree.column), -1)
        slot[nodes] = np.arange(len(nodes))
        shape = (len(nodes), len(used), self.missing + 1)
        size = int(np.prod(shape))

        def run(batches):
            total = np.zeros((2, size), np.int64)
            for batch in batches:
                for r in range(batch.num_rows):
                    n, y, bins, margin = opened([c[r].as_py() for c in batch.columns])
                    at = slot[finder(bins)]
                    rows = np.flatnonzero(at >= 0)
                    p = 1 / (1 + np.exp(-margin[rows]))
                    n = n[rows]
                    g = n * np.rint(p * FINE).astype(np.int64) - y[rows] * FINE
                    h = n * np.rint(p * (1 - p) * FINE).astype(np.int64)
                    few = n.sum() < 1 << 22
                    for k, c in enumerate(used):
                        cell = (at[rows] * shape[1] + k) * shape[2] + bins[c, rows]
                        for sums, v in zip(total, (g, h), strict=True):
                            if few:
                                sums += np.bincount(cell, v, size).astype(np.int64)  # exact: below 2^53 in a block
                            else:
                                sums += (np.bincount(cell, v >> 26, size).astype(np.int64) << 26) + np.bincount(cell, v & (1 << 26) - 1, size).astype(np.int64)
            some = np.flatnonzero(total[1])
            # sums of up to 2^33 rows fit into a long; their halves are added up, so that more rows do not matter
            halves = [half for v in total[:, some] for half in (v >> 32, v & (1 << 32) - 1)]
            yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in (some, *halves)], ["at", *_HALVES])

        sums = np.zeros((4, size), np.int64)
        for part in self._added(blocks.mapInArrow(run, _SUMS), size).collect():
            at, *halves = (np.frombuffer(x, np.int64) for x in part)
            for total, half in zip(sums, halves, strict=True):
                total[at] += half
        out = np.stack([sums[0] * 2.0**32 + sums[1], sums[2] * 2.0**32 + sums[3]], 1) / FINE
        return out.reshape(*shape, 2)

    def _added(self, sums: DataFrame, size: int) -> DataFrame:
        """Sums of more than ``TASKS`` tasks are added up for groups of tasks."""
        if self._tasks <= TASKS:
            return sums

        def add(batches):
            total = np.zeros((4, size), np.int64)
            for batch in batches:
                for r in range(batch.num_rows):
                    at, *halves = (np.frombuffer(c[r].as_py(), np.int64) for c in batch.columns)
                    for one, half in zip(total, halves, strict=True):
                        one[at] += half
            some = np.flatnonzero(total.any(0))
            yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in (some, *total[:, some])], ["at", *_HALVES])

        return sums.repartition(max(1, math.isqrt(self._tasks))).mapInArrow(add, _SUMS)

    def _grow(self, blocks: DataFrame, used: np.ndarray) -> Tree:
        tree = Tree()
        known = {0: self._histograms(blocks, tree, [0], used)[0]}
        open_ = [0]
        for level in range(self.depth + 1):
            split = []
            for node in open_:
                sums = known.pop(node)
                g, h = sums[0].sum(0)
                tree.weight[node] = -self.eta * g / (h + self.reg)
                best = self._best(sums, g, h) if level < self.depth else None
                if best is not None:
                    gain, k, cut, side, lighter, left = best
                    pair = tree.split(node, gain, int(used[k]), cut, side)
                    split.append((pair, sums, lighter))
                    for child, (cg, ch) in zip(pair, (left, np.array([g, h]) - left), strict=True):
                        tree.weight[child] = -self.eta * cg / (ch + self.reg)
            if not split or level == self.depth - 1:
                break
            asked = [pair[lighter] for pair, _, lighter in split]
            found = self._histograms(blocks, tree, asked, used)
            open_ = []
            for (pair, sums, lighter), own in zip(split, found, strict=True):
                known[pair[lighter]], known[pair[1 - lighter]] = own, sums - own
                open_ += pair
        return tree

    def _best(self, sums: np.ndarray, g: float, h: float) -> tuple[float, int, int, bool, int, np.ndarray] | None:
        """(gain, column, cut, missing to the left, side with less curvature, sums of the left) of the best split, or None."""
        known, lost = sums[:, : self.missing], sums[:, self.missing]
        below = np.cumsum(known, axis=1)
        score = lambda a, b: a * a / (b + self.reg)
        best = None
        for side in (False, True):
            left = below + lost[:, None] if side else below
            right = np.array([g, h]) - left
            gain = (score(left[..., 0], left[..., 1]) + score(right[..., 0], right[..., 1]) - score(g, h)) / 2 - self.gamma
            gain[(left[..., 1] < self.min_weight) | (right[..., 1] < self.min_weight)] = -np.inf
            k, cut = np.unravel_index(int(gain.argmax()), gain.shape)
            if gain[k, cut] > 1e-9 and (best is None or gain[k, cut] > best[0] + 1e-12):
                best = (float(gain[k, cut]), int(k), int(cut), side, int(left[k, cut, 1] > right[k, cut, 1]), left[k, cut])
        return best

    def margins(self, values: Sequence[np.ndarray]) -> np.ndarray:
        bins = binned(values, self.edges, self.missing)
        out = np.zeros(bins.shape[1])
        for tree in self.trees:
            out += np.array(tree.weight)[tree.leaves(bins, self.missing)]
        return out

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds ``probability`` (array) and ``prediction``."""
        model = self

        @F.pandas_udf("double")
        def margin(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
            for columns in batches:
                yield pd.Series(model.margins([c.to_numpy(dtype=float, na_value=np.nan) for c in columns]))

        p = 1 / (1 + F.exp(-F.col("__margin")))
        out = df.withColumn("__margin", margin(*[F.col(c).cast("double") for c in self.columns]))
        return out.withColumn("probability", F.array(1 - p, p)).withColumn("prediction", (F.col("__margin") > 0).cast("int")).drop("__margin")

    def importances(self) -> list[tuple[str, float]]:
        """Share of each column in the gain of all splits, largest first."""
        total = dict.fromkeys(self.columns, 0.0)
        for tree in self.trees:
            for c, g in zip(tree.column, tree.gain, strict=True):
                if c >= 0:
                    total[self.columns[c]] += g
        whole = sum(total.values()) or 1.0
        return sorted(((c, g / whole) for c, g in total.items()), key=lambda x: (-x[1], x[0]))


def binned(values: Sequence[np.ndarray], edges: Sequence[np.ndarray], missing: int) -> np.ndarray:
    """[column, row]: how many edges are not above the value, ``missing`` for none."""
    out = np.empty((len(edges), len(values[0]) if len(values) else 0), np.int64)
    for row, v, e in zip(out, values, edges, strict=True):
        v = np.asarray(v, float)
        row[:] = np.where(np.isnan(v), missing, np.searchsorted(e, v, "right"))
    return out
