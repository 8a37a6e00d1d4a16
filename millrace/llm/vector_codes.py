"""Product codes of vectors, with codebooks fitted on metric trees from an anchors hierarchy.

Vectors become integers and are cut into parts; each part has a codebook, which rounds of nearest-entry assignment and
averaging improve. A task takes a block of vectors at a time and builds one metric tree per part, from the middle out: some
sqrt(n) anchors, each taking the points that are nearer to it than to the anchors before, are merged in pairs up to a
root, and the points of each anchor are divided in the same way below. A ball keeps its centre and radius and the sum and
number of its points. The blocks and their trees are written once and read in every round.

A round walks each tree with the list of entries that may be nearest to some point of a ball: a child inherits its
parent's list, and an entry goes off the list if another one is nearer to every point of the ball. A ball with one entry
left is wholly owned by it and adds its cached sum and number; at leaves the points choose among what is left. Distances
are integers, the test of a ball has a margin for rounding, so that results are those of comparing every point with every
entry.

The driver holds the codebooks, and a row per part and entry of each round, whatever the number of vectors.
"""

from __future__ import annotations

import hashlib
import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.joins import bounded
from millrace.runtime import work_path

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
BLOCK = 8192  # vectors that share trees
LEAF = 16  # points of a ball that is not divided


class Tree:
    """A metric tree over integer points; ``order`` has the points such that each ball is a range of it."""

    FIELDS = ("points", "weights", "low", "high", "left", "right", "centre", "radius", "sums", "sizes")

    def __init__(self, **arrays):
        for f in self.FIELDS:
            setattr(self, f, arrays[f])

    @staticmethod
    def build(points: np.ndarray, weights: np.ndarray) -> tuple["Tree", np.ndarray]:
        """The tree, and the order in which it has the points."""
        x = points.astype(float)
        nodes: list[list] = []  # [low, high, left, right]
        order: list[np.ndarray] = []
        placed = 0

        def leaf(at: np.ndarray) -> int:
            nonlocal placed
            order.append(at)
            nodes.append([placed, placed + len(at), -1, -1])
            placed += len(at)
            return len(nodes) - 1

        def divide(at: np.ndarray) -> int:
            if len(at) <= LEAF:
                return leaf(at)
            owned = anchors(x, at)
            if len(owned) == 1:
                return leaf(at)  # all points are equal
            return merge(owned)

        def merge(owned: list[np.ndarray]) -> int:
            """Anchors with the smallest common ball first; their points are laid out in the order of that binary tree."""
            plan = pairs(np.stack([x[o].mean(0) for o in owned]), np.array([len(o) for o in owned], float), x, owned)

            def lay(k: int) -> int:
                if k < len(owned):
                    return divide(owned[k])
                a, b = plan[k - len(owned)]
                left = lay(a)
                right = lay(b)
                nodes.append([nodes[left][0], nodes[right][1], left, right])
                return len(nodes) - 1

            return lay(len(owned) + len(plan) - 1)

        if len(x):
            divide(np.arange(len(x)))
        order = np.concatenate(order) if order else np.zeros(0, np.int64)
        low, high, left, right = np.array(nodes, np.int32).reshape(-1, 4).T
        points, weights = points[order], weights[order]
        total = np.concatenate([np.zeros((1, points.shape[1]), np.int64), np.cumsum(points * weights[:, None], axis=0)])
        number = np.concatenate([[0], np.cumsum(weights)])
        each = np.concatenate([np.zeros((1, points.shape[1])), np.cumsum(points, axis=0, dtype=float)])
        centre = (each[high] - each[low]) / np.maximum(high - low, 1)[:, None]
        radius = np.array([np.sqrt(((points[a:b] - c) ** 2).sum(1).max()) for a, b, c in zip(low, high, centre, strict=True)])
        tree = Tree(points=points, weights=weights, low=low, high=high, left=left, right=right, centre=centre, radius=radius, sums=total[high] - total[low], sizes=number[high] - number[low])
        return tree, order

    def assign(self, book: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray | None]]:
        """(balls, entries, None) that are wholly owned and (points, entries, points) of leaves, level by level."""
        if not len(self.low):
            return
        entries = book.astype(float)
        scale = max(float(abs(self.points).max()), float(abs(entries).max()))
        between = np.sqrt(((entries[:, None] - entries[None]) ** 2).sum(2))
        node = np.array([len(self.low) - 1])
        may = np.ones((1, len(book)), bool)
        while len(node):
            c = self.centre[node]
            d = ((c[:, None] - entries[None]) ** 2).sum(2)
            best = np.where(may, d, np.inf).argmin(1)
            lead = d - d[np.arange(len(node)), best][:, None]
            slack = 1e-9 * (d + 1) + 1e-14 * scale * np.sqrt(d)
            may &= lead <= 2 * self.radius[node][:, None] * between[best] * (1 + 1e-9) + slack
            one = may.sum(1) == 1
            yield node[one], best[one], None
            rest, may = node[~one], may[~one]
            end = self.left[rest] < 0
            if end.any():
                size = self.high[rest[end]] - self.low[rest[end]]
                at = np.arange(size.sum()) + np.repeat(self.low[rest[end]] - np.cumsum(size) + size, size)
                yield at, nearest(self.points[at], book, np.repeat(may[end], size, axis=0))[0], at
            node = np.concatenate([self.left[rest[~end]], self.right[rest[~end]]])
            may = np.concatenate([may[~end], may[~end]])

    def totals(self, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sum and number of the points that each entry is nearest to."""
        sums, sizes = np.zeros(book.shape, np.int64), np.zeros(len(book), np.int64)
        for at, entry, points in self.assign(book):
            np.add.at(sums, entry, self.sums[at] if points is None else self.points[at] * self.weights[at][:, None])
            np.add.at(sizes, entry, self.sizes[at] if points is None else self.weights[at])
        return sums, sizes

    def codes(self, book: np.ndarray) -> np.ndarray:
        """Nearest entry of every point."""
        out = np.zeros(len(self.points), np.int64)
        for at, entry, points in self.assign(book):
            if points is not None:
                out[at] = entry
            else:
                size = self.high[at] - self.low[at]
                out[np.arange(size.sum()) + np.repeat(self.low[at] - np.cumsum(size) + size, size)] = np.repeat(entry, size)
        return out


def nearest(points: np.ndarray, book: np.ndarray, may: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry of those that may be, the lower of ties, and its squared distance, in whole numbers."""
    out, far = np.zeros(len(points), np.int64), np.zeros(len(points), np.int64)
    for i in range(0, len(points), 4096):
        p = points[i : i + 4096]
        d = np.zeros((len(p), len(book)), np.int64)
        for k in range(points.shape[1]):
            d += (p[:, k : k + 1] - book[None, :, k]) ** 2
        if may is not None:
            d = np.where(may[i : i + 4096], d, np.iinfo(np.int64).max)
        at = d.argmin(1)
        out[i : i + 4096], far[i : i + 4096] = at, d[np.arange(len(p)), at]
    return out, far


def anchors(x: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    """Points divided over about sqrt(n) anchors. Each new anchor is the point farthest from its own one, and asks only
    points that are more than half as far from theirs as the two anchors are from each other."""
    p = x[at]
    wanted = max(2, int(np.sqrt(len(at))))
    own = np.zeros(len(at), np.int64)
    far = ((p - p[0]) ** 2).sum(1)
    spots = [p[0]]
    while len(spots) < wanted:
        k = int(far.argmax())
        if far[k] == 0:
            break
        new = p[k]
        apart = ((np.stack(spots) - new) ** 2).sum(1)
        ask = np.flatnonzero(4 * far > apart[own])
        d = ((p[ask] - new) ** 2).sum(1)
        less = d < far[ask]
        own[ask[less]], far[ask[less]] = len(spots), d[less]
        spots.append(new)
    order = np.argsort(own, kind="stable")
    cuts = np.cumsum(np.bincount(own, minlength=len(spots)))[:-1]
    return [o for o in np.split(at[order], cuts) if len(o)]


def pairs(centre: np.ndarray, size: np.ndarray, x: np.ndarray, owned: list[np.ndarray]) -> list[tuple[int, int]]:
    """Which two balls to merge, smallest common ball first: given ones are 0..n-1, merged ones follow."""
    n = len(owned)
    c, r, m = np.zeros((2 * n - 1, centre.shape[1])), np.zeros(2 * n - 1), np.zeros(2 * n - 1)
    c[:n], m[:n] = centre, size
    r[:n] = [np.sqrt(((x[o] - a) ** 2).sum(1).max()) for o, a in zip(owned, centre, strict=True)]
    common = np.full((2 * n - 1, 2 * n - 1), np.inf)  # radius of the ball around two balls

    def around(a: int, others: np.ndarray) -> np.ndarray:
        gap = np.sqrt(((c[others] - c[a]) ** 2).sum(1))
        return np.maximum((gap + r[others] + r[a]) / 2, np.maximum(r[others], r[a]))

    for a in range(1, n):
        common[a, :a] = common[:a, a] = around(a, np.arange(a))
    least = common.min(1)
    alive = np.arange(2 * n - 1) < n
    plan = []
    for k in range(n, 2 * n - 1):
        a = int(least.argmin())
        b = int(common[a].argmin())
        plan.append((a, b))
        m[k], r[k] = m[a] + m[b], common[a, b]
        c[k] = (c[a] * m[a] + c[b] * m[b]) / m[k]
        gone = [a, b]
        alive[gone], least[gone] = False, np.inf
        common[gone], common[:, gone] = np.inf, np.inf
        others = np.flatnonzero(alive)
        alive[k] = True
        if len(others):
            common[k, others] = common[others, k] = around(k, others)
            least[others], least[k] = common[others].min(1), common[k].min()
    return plan


def parts_of(vectors: np.ndarray, parts: int) -> np.ndarray:
    """[part, vector, place] as whole numbers, with zeros behind a length that the parts do not divide."""
    n, length = vectors.shape
    width = -(-length // parts)
    limit = float(int((2**61 / max(length, 1)) ** 0.5))
    whole = np.zeros((n, parts * width), np.int64)
    with np.errstate(over="ignore"):
        whole[:, :length] = np.clip(np.floor(vectors * float(SCALE)), -limit, limit)
    return whole.reshape(n, parts, width).transpose(1, 0, 2)


def packed(vectors: np.ndarray, parts: int) -> bytes:
    """The trees of a block, and of each part which point of its tree every vector has."""
    out = {}
    for k, x in enumerate(parts_of(vectors, parts)):
        points, at, n = np.unique(x, axis=0, return_inverse=True, return_counts=True)
        tree, order = Tree.build(points, n)
        place = np.empty(len(order), np.int32)
        place[order] = np.arange(len(order))
        out[f"{k}:at"] = place[at.reshape(-1)]
        narrow = np.int16 if abs(points).max() < 1 << 15 else np.int64
        for f in Tree.FIELDS:
            value = getattr(tree, f)
            out[f"{k}:{f}"] = value.astype(narrow) if f == "points" else value.astype(np.int32) if f in ("weights", "sizes") else value
    file = io.BytesIO()
    np.savez(file, **out)
    return file.getvalue()


def opened(blob: bytes, parts: int) -> Iterator[tuple[Tree, np.ndarray]]:
    with np.load(io.BytesIO(blob)) as arrays:
        for k in range(parts):
            fields = {f: arrays[f"{k}:{f}"] for f in Tree.FIELDS}
            for f in ("points", "weights", "sizes"):
                fields[f] = fields[f].astype(np.int64)
            yield Tree(**fields), arrays[f"{k}:at"]


def blocks(kept: DataFrame, id_type: str, label_type: str, parts: int, block: int) -> DataFrame:
    """(ids, labels, trees) of each block, written to the shared folder."""

    def build(batches):
        held: list[pa.RecordBatch] = []

        def row(table: pa.Table) -> pa.RecordBatch:
            lists = [table.column(c).combine_chunks() for c in (0, 1)]
            vectors = table.column(2).combine_chunks()
            matrix = vectors.flatten().to_numpy().reshape(table.num_rows, -1)
            ends = pa.array([0, table.num_rows], pa.int32())
            return pa.RecordBatch.from_arrays([*[pa.ListArray.from_arrays(ends, x) for x in lists], pa.array([packed(matrix, parts)], pa.binary())], ["ids", "labels", "trees"])

        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= block:
                table = pa.Table.from_batches(held)
                whole = table.num_rows // block * block
                for i in range(0, whole, block):
                    yield row(table.slice(i, block))
                held = table.slice(whole).to_batches()
        if any(b.num_rows for b in held):
            yield row(pa.Table.from_batches(held))

    path = work_path(kept.sparkSession, "vector_trees")
    kept.mapInArrow(build, f"ids array<{id_type}>, labels array<{label_type}>, trees binary").write.parquet(path)
    return kept.sparkSession.read.parquet(path)


def improved(trees: DataFrame, books: np.ndarray) -> np.ndarray:
    """Every entry replaced by the floored mean of the parts that are nearest to it; entries without any stay."""
    parts, entries, width = books.shape

    def count(batches):
        sums, sizes = np.zeros(books.shape, np.int64), np.zeros(books.shape[:2], np.int64)
        for batch in batches:
            for blob in batch.column(0):
                for k, (tree, _) in enumerate(opened(blob.as_py(), parts)):
                    s, n = tree.totals(books[k])
                    sums[k] += s
                    sizes[k] += n
        part, entry = np.nonzero(sizes)
        flat = pa.array(sums[part, entry].reshape(-1))
        ends = pa.array(np.arange(len(part) + 1, dtype=np.int32) * width)
        yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(entry), pa.array(sizes[part, entry]), pa.ListArray.from_arrays(ends, flat)], ["part", "entry", "n", "sums"])

    found = trees.select("trees").mapInArrow(count, "part long, entry long, n long, sums array<long>")
    total = lambda c: F.sum(c.cast("decimal(38,0)"))
    rows = found.groupBy("part", "entry").agg(total(F.col("n")), *[total(F.get("sums", F.lit(i))) for i in range(width)]).collect()
    out = books.copy()
    for part, entry, n, *sums in rows:
        out[part, entry] = [int(s) // int(n) for s in sums]
    return out


def encode(
    df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, block: int = BLOCK
) -> DataFrame:
    """One row per kept vector: the id, ``code``, ``error``, ``label_error``, ``codebooks_sha256``.

    Kept are vectors without a null or non-finite component that are as long as the one with the smallest id and are not
    empty. The codebooks start with the ``entries`` vectors of the smallest ids (a null id comes last, equal ids in the
    order of their vectors), or all if there are fewer. Components are ``floor(256 x)``, up to about 2^30 by the root of the
    length (x of a million or more), so that errors fit into a long; a ``label_error`` that does not is null. Rows with
    equal ids stay rows of their own. Other columns are not read and may have any name. Without vectors there are no rows.
    """
    spark = df.sparkSession
    kinds = dict(df.dtypes)
    vector = F.col(vector_col).cast("array<double>")
    kept = df.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), vector.alias("vector")).where(F.col("vector").isNotNull() & (F.size("vector") > 0))
    kept = kept.where(F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    first = kept.select("id", "vector").orderBy(F.asc_nulls_last("id"), "vector").limit(entries).collect()
    result = f"{id_col} {kinds[id_col]}, code string, error long, label_error long, codebooks_sha256 string"
    if not first:
        return spark.createDataFrame([], result)
    length = len(first[0].vector)
    kept = kept.where(F.size("vector") == length)
    start = kept.select("id", "vector").orderBy(F.asc_nulls_last("id"), "vector").limit(entries).collect()
    books = parts_of(np.array([r.vector for r in start]), parts)
    trees = blocks(kept, kinds[id_col], kinds[label_col], parts, block)
    for _ in range(rounds):
        books = improved(trees, books)

    def code(batches):
        for batch in batches:
            for r in range(batch.num_rows):
                ids, labels = (batch.column(c).slice(r, 1).flatten() for c in (0, 1))
                codes, error = np.zeros((len(ids), parts), np.uint8), np.zeros(len(ids), np.int64)
                for k, (tree, at) in enumerate(opened(batch.column(2)[r].as_py(), parts)):
                    entry = tree.codes(books[k])
                    far = ((tree.points - books[k][entry]) ** 2).sum(1)
                    codes[:, k] = entry[at]
                    error += far[at]
                yield pa.RecordBatch.from_arrays([ids, labels, pa.array([c.tobytes().hex() for c in codes]), pa.array(error)], ["id", "label", "code", "error"])

    path = work_path(spark, "vector_codes")
    trees.mapInArrow(code, f"id {kinds[id_col]}, label {kinds[label_col]}, code string, error long").write.parquet(path)
    coded = spark.read.parquet(path)
    totals = coded.groupBy("label").agg(F.try_sum("error").alias("label_error")).withColumnRenamed("label", "of")
    small = bounded(totals, 10_000)  # few labels are broadcast; many are joined, and AQE splits a hot one
    joined = coded.join(totals if small is None else small, F.col("label").eqNullSafe(F.col("of")))
    digest = hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()
    return joined.select(F.col("id").alias(id_col), "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
