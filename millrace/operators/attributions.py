"""Exact attributions of tree models against a bounded background.

A leaf is a box: a range per column of its path. Take a row and a background row, and let some columns come from the row and
the others from the background. The leaf is reached if the row is inside the box in all columns in which the background row
is not, and the other way round; how much each column adds to that, averaged over all orders of the columns, follows from
the numbers of columns of both kinds. So per leaf and per set of columns in which a row is outside, the attributions are a
fixed table, made once from the background; a row adds up one entry per leaf, and no order of columns is ever sampled.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass
class Box:
    """A leaf: the value it adds to the score, and of each column on its path the range (low, high] and whether missing
    values pass."""

    value: float
    columns: list[int]
    low: np.ndarray
    high: np.ndarray
    missing: np.ndarray

    def outside(self, x: np.ndarray) -> np.ndarray:
        """Per row a bit for each column of the path in which it is outside."""
        bits = np.zeros(len(x), np.int64)
        for j, c in enumerate(self.columns):
            v = x[:, c]
            inside = np.where(np.isnan(v), self.missing[j], (v > self.low[j]) & (v <= self.high[j]))
            bits |= (~inside).astype(np.int64) << j
        return bits

    def table(self, background: np.ndarray) -> np.ndarray:
        """[columns in which a row is outside, column of the path]: mean attributions over the background."""
        p = len(self.columns)
        others = Counter(self.outside(background).tolist())
        out = np.zeros((1 << p, p))
        for mine in range(1 << p):
            b = mine.bit_count()
            for theirs, n in others.items():
                if mine & theirs:
                    continue  # a column in which neither is inside
                a = theirs.bit_count()
                for j in range(p):
                    if theirs >> j & 1:
                        out[mine, j] += n * factorial(a - 1) * factorial(b) / factorial(a + b)
                    elif mine >> j & 1:
                        out[mine, j] -= n * factorial(a) * factorial(b - 1) / factorial(a + b)
        return out * self.value / len(background)


def _boxes(root, split_of) -> Iterator[Box]:
    """``split_of``: a node to its value, or to (column, cut, missing goes left, left, right)."""
    todo = [(root, {})]
    while todo:
        node, path = todo.pop()
        found = split_of(node)
        if not isinstance(found, tuple):
            columns = sorted(path)
            ranges = np.array([path[c] for c in columns], float).reshape(-1, 3)
            yield Box(float(found), columns, ranges[:, 0], ranges[:, 1], ranges[:, 2] > 0)
            continue
        column, cut, missing_left, left, right = found
        low, high, passes = path.get(column, (-np.inf, np.inf, 1))
        todo.append((left, path | {column: (low, min(high, cut), passes and missing_left)}))
        todo.append((right, path | {column: (max(low, cut), high, passes and not missing_left)}))


def spark_boxes(model) -> list[Box]:
    """Leaves of a fitted tree, forest (probability of class 1) or boosted model (margin) of Spark."""

    def chance(node):
        stats = list(node.impurityStats().stats())
        return stats[1] / sum(stats)

    def split_of(value, weight):
        def run(node):
            if node.subtreeDepth() == 0:
                return weight * value(node)
            split = node.split()
            return split.featureIndex(), split.threshold(), False, node.leftChild(), node.rightChild()

        return run

    name = type(model).__name__
    if name == "DecisionTreeClassificationModel":
        parts = [(model, 1.0)]
    else:
        weights = model.treeWeights
        whole = sum(weights) if name == "RandomForestClassificationModel" else 1.0
        parts = [(t, w / whole) for t, w in zip(model.trees, weights, strict=True)]
    value = (lambda node: node.prediction()) if name == "GBTClassificationModel" else chance
    return [b for tree, w in parts for b in _boxes(tree._call_java("rootNode"), split_of(value, w))]


def boosting_boxes(model) -> list[Box]:
    """Leaves of a ``SecondOrderBoosting`` model (margin)."""
    out = []
    for tree in model.trees:

        def split_of(node, tree=tree):
            column = tree.column[node]
            if column < 0:
                return tree.weight[node]
            edges, cut = model.edges[column], tree.cut[node]
            # values below the edge go left; behind the last one are missing values only
            return column, np.nextafter(edges[cut], -np.inf) if cut < len(edges) else np.inf, tree.missing_left[node], tree.left[node], tree.right[node]

        out += _boxes(0, split_of)
    return out


def tree_attributions(df: DataFrame, key: str, features: Sequence[str], boxes: Sequence[Box], background: DataFrame, rows: int = 100, seed: int = 0) -> DataFrame:
    """(key, ``phi_<column>``..., ``base_score``): the attributions of a row add up to its score less the base score.

    The background is ``rows`` rows of ``background`` by a hash of their values, or all if there are fewer; the base score is
    the mean score of these. Nulls are missing values.
    """
    value = [F.col(f).cast("double") for f in features]
    sample = background.select(*[v.alias(f"x{i}") for i, v in enumerate(value)])
    picked = sample.orderBy(F.xxhash64(*sample.columns, F.lit(seed)), *sample.columns).limit(rows).collect()
    if not picked:
        raise ValueError("no background rows")
    z = np.array([[np.nan if v is None else v for v in r] for r in picked])
    boxes = [b for b in boxes if b.value]
    tables = [b.table(z) for b in boxes]
    base = float(sum(b.value * (b.outside(z) == 0).mean() for b in boxes))
    d = len(features)

    def run(batches):
        for batch in batches:
            x = np.stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns[1:]], 1)
            phi = np.zeros((len(x), d))
            for box, table in zip(boxes, tables, strict=True):
                if box.columns:
                    phi[:, box.columns] += table[box.outside(x)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(phi[:, j]) for j in range(d)], pa.array(np.full(len(x), base))], names)

    names = [key, *[f"phi_{f}" for f in features], "base_score"]
    schema = df.select(key).schema
    for n in names[1:]:
        schema = schema.add(n, T.DoubleType())
    return df.select(key, *[v.alias(f"x{i}") for i, v in enumerate(value)]).mapInArrow(run, schema)
