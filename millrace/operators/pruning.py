"""Cost-complexity pruning of one decision tree: the weakest-link sequence, and all pruned trees scored in one pass.

A row that passes a node is right or wrong under every pruned tree in which that node is a leaf. Each node is a leaf for
one range of the penalty: from where its own subtree is cut to where one of its ancestors is. So one pass that counts rows
per node and label gives the accuracy of every tree of the sequence, however many there are.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import DecisionTreeClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass
class Nodes:
    """A binary tree as arrays, parents before children; ``column`` is -1 at leaves, rows with x <= cut go left."""

    column: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray

    @staticmethod
    def of(model: DecisionTreeClassificationModel) -> "Nodes":
        """Splits of a fitted tree on continuous columns."""
        column, cut, left, right = [], [], [], []
        todo = [(model._call_java("rootNode"), None, None)]
        while todo:
            node, side, parent = todo.pop()
            at = len(column)
            if parent is not None:
                side[parent] = at
            for values, empty in ((column, -1), (cut, 0.0), (left, -1), (right, -1)):
                values.append(empty)
            if node.subtreeDepth() > 0:
                split = node.split()
                column[at], cut[at] = split.featureIndex(), split.threshold()
                todo += [(node.rightChild(), right, at), (node.leftChild(), left, at)]
        return Nodes(np.array(column), np.array(cut), np.array(left), np.array(right))

    def ends(self, x: np.ndarray) -> np.ndarray:
        """The leaf of every row of ``x`` [row, column]."""
        at = np.zeros(len(x), np.int64)
        rows = np.arange(len(x))
        while len(rows):
            rows = rows[self.column[at[rows]] >= 0]
            node = at[rows]
            at[rows] = np.where(x[rows, self.column[node]] <= self.cut[node], self.left[node], self.right[node])
        return at

    def summed(self, leaves: np.ndarray) -> np.ndarray:
        """Values of leaves added up at all their ancestors."""
        out = leaves.copy()
        for i in range(len(self.column) - 1, -1, -1):
            if self.column[i] >= 0:
                out[i] = out[self.left[i]] + out[self.right[i]]
        return out


def leaf_counts(df: DataFrame, nodes: Nodes, features: str, label: str, classes: int, part: str) -> dict:
    """{part: [node, class] rows} of all leaves, in one pass and one aggregate."""
    rows = df.select(F.col(part).cast("string").alias("part"), F.col(label).cast("int").alias("y"), vector_to_array(features).alias("x")).where("y IS NOT NULL")

    def run(batches: Iterator[pa.RecordBatch]):
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column(2).flatten().to_numpy().reshape(batch.num_rows, -1)
            cell = nodes.ends(x) * classes + batch.column(1).to_numpy()
            names = batch.column(0).to_numpy(zero_copy_only=False)
            for name in set(names.tolist()):
                counts = total.setdefault(name, np.zeros(len(nodes.column) * classes, np.int64))
                counts += np.bincount(cell[names == name], minlength=len(counts))
        for name, counts in total.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at), pa.array(counts[at])], ["part", "at", "n"])

    out: dict = {}
    for name, at, n in rows.mapInArrow(run, "part string, at long, n long").groupBy("part", "at").agg(F.sum("n")).collect():
        out.setdefault(name, np.zeros(len(nodes.column) * classes, np.int64))[at] = n
    return {name: counts.reshape(-1, classes) for name, counts in out.items()}


def gini(counts: np.ndarray) -> np.ndarray:
    """Impurity of each node times its share of the rows."""
    n = counts.sum(1)
    with np.errstate(invalid="ignore", divide="ignore"):
        pure = 1 - ((counts / n[:, None]) ** 2).sum(1)
    return np.where(n > 0, pure * n, 0.0) / counts[0].sum()


def weakest_links(nodes: Nodes, risk: np.ndarray) -> tuple[list[float], list[float], np.ndarray]:
    """Penalties per leaf at which the tree shrinks, the risk of the tree from each of them on, and for every node the step
    at which it becomes a leaf (-1: it is one from the start; one more than the last: it never is one).

    A step collapses all nodes whose subtree saves least risk per leaf, as often as that stays so at the same penalty.
    """
    never = np.iinfo(np.int64).max
    leaf = nodes.column < 0
    steps = np.where(leaf, -1, never)
    alphas, risks = [0.0], [float(_cut_sums(nodes, leaf, risk)[0][0])]
    while not leaf[0]:
        total, number = _cut_sums(nodes, leaf, risk)
        at = np.flatnonzero(_alive(nodes, leaf) & ~leaf)
        saved = (risk[at] - total[at]) / (number[at] - 1)
        if saved.min() > alphas[-1] + 1e-12:
            alphas.append(float(saved.min()))
            risks.append(0.0)
        weakest = at[saved <= alphas[-1] + 1e-12]
        leaf[weakest] = True
        steps[weakest] = len(alphas) - 1
        risks[-1] = float(_cut_sums(nodes, leaf, risk)[0][0])
    return alphas, risks, np.where(steps == never, len(alphas), steps)


def _cut_sums(nodes: Nodes, leaf: np.ndarray, risk: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Risk and number of the leaves below each node, where ``leaf`` nodes count as leaves."""
    total, number = risk.copy(), np.ones(len(risk))
    for i in range(len(leaf) - 1, -1, -1):
        if not leaf[i]:
            total[i] = total[nodes.left[i]] + total[nodes.right[i]]
            number[i] = number[nodes.left[i]] + number[nodes.right[i]]
    return total, number


def _alive(nodes: Nodes, leaf: np.ndarray) -> np.ndarray:
    """Nodes that no leaf above them has cut off."""
    out = np.zeros(len(leaf), bool)
    out[0] = True
    for i in range(len(leaf)):
        if out[i] and not leaf[i]:
            out[nodes.left[i]] = out[nodes.right[i]] = True
    return out


def sequence(nodes: Nodes, steps: np.ndarray, number: int) -> list[np.ndarray]:
    """Per step the leaves of the pruned tree."""
    out = []
    for s in range(number):
        leaf = steps <= s
        out.append(np.flatnonzero(_alive(nodes, leaf) & leaf))
    return out


def pruning_path(df: DataFrame, model: DecisionTreeClassificationModel, features: str, label: str, part: str, train: str) -> list[tuple]:
    """[(alpha, leaves, risk, {part: accuracy})] of every tree of the weakest-link sequence.

    ``part`` names the rows' part, the sequence is that of the rows of part ``train``; a leaf predicts their most frequent
    class, the lowest of ties.
    """
    nodes = Nodes.of(model)
    parts = {p: nodes.summed(c) for p, c in leaf_counts(df, nodes, features, label, model.numClasses, part).items()}
    mine = parts[train]
    alphas, risks, steps = weakest_links(nodes, gini(mine))
    told = mine.argmax(1)
    out = []
    for alpha, risk, leaves in zip(alphas, risks, sequence(nodes, steps, len(alphas)), strict=True):
        right = {p: float(c[leaves, told[leaves]].sum() / c[0].sum()) for p, c in parts.items()}
        out.append((alpha, len(leaves), risk, right))
    return out


def best_alphas(path: Sequence[tuple], part: str, top: int = 5) -> list[tuple]:
    """The ``top`` trees by accuracy on ``part``, smaller trees first among equals."""
    return sorted(path, key=lambda r: (-r[3][part], r[1]))[:top]
