"""N-gram Jaccard join with a count-vector R-tree.

1. Shingle hashes, without those that a bounded sample shows to be common, are dealt into groups by their value. If two
   sets of sizes a and b reach the similarity they differ in at most 15/185 (a + b) elements (for 85 %), so with more
   groups than that some group is the same in both, and it has two elements or more unless a set has very many smaller
   groups (such sets give all their groups). Group contents are therefore join keys that lose no link, and hardly any
   texts but near copies share them.
2. Texts that share keys, directly or through others, form families. A family is indexed in blocks: the counts of each
   text's shingles in ``DIMENSIONS`` groups are a point, points are packed into an R-tree's leaves, and the summed minima
   of counts, of leaf corners first, then of points, bound the overlap from above. What passes is verified on the sets.
3. Links join texts to components; pairs within a component found earlier are not looked at again. A large family is first
   linked block by block and with its hub block, then dealt out by the components found, and only blocks of different
   components meet.

Sets are told apart by a 64-bit hash of their shingles' 64-bit hashes; texts with equal sets are one node throughout. Join
keys, and the vertices that stand for nodes until families are known, are the upper 48 bits of such hashes: two that are
taken for one by chance make a family larger, and its links are verified on the sets.
A null or wordless text has no shingles and no links. Null ids never name a component unless all its ids are null.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.chunks import release
from millrace.llm.components import components
from millrace.llm.words import STEPS, U, Words, mix, slices
from millrace.runtime import cut_lineage, work_path

DIMENSIONS, LEAF, BLOCK = 128, 16, 2 << 20  # a block is so many bytes of sets
BITS = 25
SAMPLE = 16 << 20  # bytes of text that are looked at for common shingles


def shingles(w: Words, k: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; a text with fewer words is one shingle."""
    h = w.hashes()
    n = len(h) - k + 1
    total = np.zeros(max(n, 0), U)
    for j in range(k if n > 0 else 0):
        total += h[j : n + j] * STEPS[j]
    total = mix(total)
    out = []
    for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist(), strict=True):
        if b - a >= k:
            out.append(np.unique(total[a : b - k + 1]))
        elif b > a:
            out.append(mix((h[a:b] * STEPS[: b - a]).sum(keepdims=True, dtype=U) + U(b - a)))
        else:
            out.append(np.zeros(0, U))
    return out


def signature(s: np.ndarray) -> np.uint64:
    return mix(mix(s).sum(keepdims=True, dtype=U) + U(len(s)))[0] if len(s) else U(0)


class Levels:
    """Classes of set sizes and the number of groups for each."""

    def __init__(self, percent: int):
        self.percent = percent
        self.low = [1]
        while self.low[-1] < 1 << 40:
            self.low.append(max(self.low[-1] + 1, self.low[-1] * 27 // 20))

    def of(self, n: int) -> int:
        return int(np.searchsorted(self.low, n, "right")) - 1

    def groups(self, level: int) -> tuple[int, int]:
        """Groups, and how many of them may differ between linked sets of which the smaller one is of this level.

        Spare groups beyond those make up for small ones; the lower the similarity, the smaller groups are.
        """
        a = self.low[level + 1] - 1
        total = a + a * 100 // self.percent
        most = total * (100 - self.percent) // (100 + self.percent)
        return (1, 0) if most == 0 else (most + 3 + most * 2 * (100 - self.percent) // 100, most)

    def keys(self, s: np.ndarray, common: np.ndarray) -> np.ndarray:
        """Join keys of a set; two linked sets have one in common, whatever ``common`` (sorted) holds.

        Leaving common shingles out makes sets differ in no more elements. The steps below give more and more keys, each
        step those of the one before as well, and a set goes on until one of them is bound to hold a group that agrees
        with any linked set; of two sets the one that stops first vouches for both.
        """
        rare = s
        if len(common):
            rare = s[common[np.minimum(np.searchsorted(common, s), len(common) - 1)] != s]
        n, keys = len(s), {}
        for elements, least, space in ((rare, 2, 1), (s, 2, 2), (rare, 1, 1), (s, 1, 2), (s, 0, 2)):
            keys[space], enough = self._keys(elements, n, least, space)
            if enough:
                break
        return np.concatenate(list(keys.values()))

    def _keys(self, s: np.ndarray, n: int, least: int, space: int) -> tuple[np.ndarray, bool]:
        """Keys of the groups of at least ``least`` elements; whether one of them must agree with any linked set."""
        own, out, enough = self.of(n), [np.zeros(0, U)], True
        for level in {own, self.of(-(-n * self.percent // 100))}:  # as the smaller set, and as partner of a smaller one
            g, most = self.groups(level)
            group = (((s >> U(32)) * U(g)) >> U(32)).astype(np.int64)
            start = np.flatnonzero(np.diff(group, prepend=-1))
            size = np.zeros(g, np.int64)
            total = np.zeros(g, U)
            if len(start):
                size[group[start]] = np.diff(np.append(start, len(s)))
                total[group[start]] = np.add.reduceat(mix(s ^ U(0x9E3779B97F4A7C15)), start)
            take = np.flatnonzero(size >= least)
            enough &= g - len(take) < g - most
            out.append(mix(total[take] + mix(take.astype(U) * U(4096) + U(4 * level + space))))
        return np.concatenate(out), enough


def _six(x: np.ndarray) -> bytes:
    """Numbers below 2^48 in six bytes each."""
    return x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _from_six(rows: list[bytes]) -> np.ndarray:
    data = np.frombuffer(b"".join(rows), np.uint8).reshape(-1, 6)
    return np.concatenate([data, np.zeros((len(data), 2), np.uint8)], 1).view("<u8").reshape(-1).astype(U)


def _rising(x: np.ndarray) -> bytes:
    """Ascending numbers below 2^48, by their steps if these are short."""
    steps = np.diff(x, prepend=x[:1])
    if len(x) and steps.max() < 1 << 32:
        return b"s" + _six(x[:1]) + steps[1:].astype("<u4").tobytes()
    return b"x" + _six(x)


def _from_rising(rows: list[bytes]) -> np.ndarray:
    out = [np.zeros(0, U)]
    for row in rows:
        if row[:1] == b"s":
            out.append(np.cumsum(np.concatenate([_from_six([row[1:7]]), np.frombuffer(row[7:], "<u4").astype(U)]), dtype=U))
        else:
            out.append(_from_six([row[1:]]))
    return np.concatenate(out)


def _stars(keys: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each key its least node; and the distinct edges from there to its other nodes."""
    order = np.lexsort((nodes, keys))
    keys, nodes = keys[order], nodes[order]
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    start = np.flatnonzero(new)
    least = nodes[start][np.cumsum(new) - 1] if len(keys) else nodes
    edges = np.unique(np.stack([least, nodes], 1)[least != nodes], axis=0)
    return keys[start], nodes[start], edges[:, 0], edges[:, 1]


def common_shingles(docs: DataFrame, k: int, size: int) -> np.ndarray:
    """Shingles that two different sets of a sample of about SAMPLE bytes share; they only decide which keys are used."""
    texts = docs.where(F.pmod(F.xxhash64("id", "text"), F.lit(max(1, size // SAMPLE))) == 0).select("text")

    def run(batches):
        for batch in batches:
            for _, _, w in slices(batch.column(0), lower=True):
                sets = [s for s in shingles(w, k) if len(s)]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.zeros(0, U), *sets]).view(np.int64)), pa.array(np.repeat(np.array([signature(s) for s in sets], U), [len(s) for s in sets]).view(np.int64))], ["shingle", "node"])

    shared = texts.mapInArrow(run, "shingle long, node long").groupBy("shingle").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo < hi").select("shingle")
    return np.sort(shared.toArrow().column(0).to_numpy().view(U))


def candidates(docs: DataFrame, k: int, levels: Levels, buckets: int, size: int) -> DataFrame:
    """Edges (a, b) of vertices, the upper 48 bits of set signatures, that hold together all sets with a key in common."""
    shared = docs.sparkSession.sparkContext.broadcast(common_shingles(docs, k, size))  # of about SAMPLE bytes of text

    def rows(keys, nodes, a, b):
        """Keys and edges by bucket; each bucket's in one row."""
        of_key, of_edge = (((x >> U(16)) * U(buckets)) >> U(32) for x in (keys, mix(a) >> U(16)))
        o, p = np.argsort(of_key, kind="stable"), np.argsort(of_edge, kind="stable")
        keys, nodes, of_key, a, b, of_edge = keys[o], nodes[o], of_key[o], a[p], b[p], of_edge[p]
        which = np.union1d(of_key, of_edge)
        ends = [np.searchsorted(x, which, side) for x in (of_key, of_edge) for side in ("left", "right")]
        cut = lambda x, i, packed: pa.array([packed(x[s:e]) for s, e in zip(ends[i], ends[i + 1], strict=True)], pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(which.astype(np.int32)), cut(keys, 0, _rising), cut(nodes, 0, _six), cut(a, 2, _six), cut(b, 2, _six)], ["bucket", "keys", "nodes", "a", "b"])

    def local(batches):
        """A key goes out once per batch, with the least of its nodes; edges to the others are made here."""
        held, size = [], 0

        def flush():
            keys, nodes = (np.concatenate(x) for x in zip(*held, strict=True))
            return rows(*_stars(keys, nodes))

        for batch in batches:
            for _, _, w in slices(batch.column(0), lower=True):
                seen = {}
                for s in shingles(w, k):
                    if len(s) and (node := signature(s)) not in seen:
                        seen[node] = levels.keys(s, shared.value)
                for node, keys in seen.items():
                    held.append((keys >> U(16), np.full(len(keys), node >> U(16), U)))
                    size += len(keys)
                if size > 1_000_000:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    def reduce(table: pa.Table) -> pa.Table:
        keys, (nodes, a, b) = _from_rising(table.column("keys").to_pylist()), (_from_six(table.column(c).to_pylist()) for c in ("nodes", "a", "b"))
        _, _, x, y = _stars(keys, nodes)
        edges = np.unique(np.stack([np.concatenate([a, x]), np.concatenate([b, y])], 1), axis=0)
        return pa.table({"a": pa.array(edges[:, 0].view(np.int64)), "b": pa.array(edges[:, 1].view(np.int64))})

    sent = docs.select("text").mapInArrow(local, "bucket int, keys binary, nodes binary, a binary, b binary")
    return sent.groupBy("bucket").applyInArrow(reduce, "a long, b long").distinct()


def _bitmap(nodes: DataFrame) -> bytes:
    """Slots of a bitmap of 2^25 bits that the vertices take: 4 MB however many there are."""
    slot = f"(node & {(1 << BITS) - 1})"
    bits = nodes.selectExpr(f"{slot} >> 6 AS k", f"shiftleft(1L, int({slot} & 63)) AS b").groupBy("k").agg(F.bit_or("b").alias("b")).toArrow().to_pandas()
    full = np.zeros(1 << (BITS - 6), np.int64)
    full[bits["k"].to_numpy(np.int64)] = bits["b"].to_numpy(np.int64)
    return full.tobytes()


def members(docs: DataFrame, k: int, nodes: DataFrame) -> DataFrame:
    """Per document: id, n_shingles, node; and the set of those that the bitmap of ``nodes`` cannot rule out."""
    known = docs.sparkSession.sparkContext.broadcast(_bitmap(nodes))
    kind = dict(docs.dtypes)["id"]

    def run(batches):
        bits = np.frombuffer(known.value, U)
        for batch in batches:
            sent: set[int] = set()
            for i, j, w in slices(batch.column(1), lower=True):
                sets = shingles(w, k)
                node = np.array([signature(s) for s in sets], U)
                slot = (node >> U(16)) & U((1 << BITS) - 1)
                hit = (bits[(slot >> U(6)).astype(np.int64)] >> (slot & U(63))) & U(1)
                body = []
                for s, x, h in zip(sets, node.tolist(), hit.tolist(), strict=True):
                    body.append(s.tobytes() if h and len(s) and x not in sent else None)
                    sent.add(x)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array([len(s) for s in sets], pa.int64()), pa.array(node.view(np.int64)), pa.array(body, pa.binary())], ["id", "n_shingles", "node", "body"])

    return docs.select("id", "text").mapInArrow(run, f"id {kind}, n_shingles long, node long, body binary")


class Points:
    """Sets of a task with their count vectors in the leaves of an R-tree."""

    def __init__(self, bodies: list[bytes]):
        self.sets = [np.frombuffer(b, U) for b in bodies]
        self.size = np.array([len(s) for s in self.sets])
        counts = np.zeros((len(bodies), DIMENSIONS), np.int32)
        for row, s in enumerate(self.sets):
            counts[row] = np.bincount(((s >> U(20)) & U(DIMENSIONS - 1)).astype(np.int64), minlength=DIMENSIONS)
        self.counts = counts

    def leaves(self, rows: np.ndarray) -> list[np.ndarray]:
        """Rows packed into leaves: cut by size, then by the count that varies most."""
        rows = rows[np.argsort(self.size[rows], kind="stable")]
        out, slab = [], LEAF * 8
        for i in range(0, len(rows), slab):
            part = rows[i : i + slab]
            wide = int(np.argmax(self.counts[part].var(0)))
            part = part[np.argsort(self.counts[part, wide], kind="stable")]
            out += [part[j : j + LEAF] for j in range(0, len(part), LEAF)]
        return out

    def links(self, left: np.ndarray, right: np.ndarray | None, group: np.ndarray, percent: int) -> list[tuple[int, int]]:
        """A spanning set of the links among ``left``, or between ``left`` and ``right``. ``group``: known components."""
        up = {int(g): int(g) for g in np.unique(group)}

        def find(x):
            while up[x] != x:
                up[x] = up[up[x]]
                x = up[x]
            return x

        mine = self.leaves(left)
        theirs = mine if right is None else self.leaves(right)
        corner = [self.counts[x].max(0) for x in theirs]
        out = []
        for i, a in enumerate(mine):
            top = self.counts[a].max(0)
            for j in range(i if right is None else 0, len(theirs)):
                b = theirs[j]
                least = self.size[a].min() + self.size[b].min()
                if np.minimum(top, corner[j]).sum() * (100 + percent) < percent * least:
                    continue
                for x in a.tolist():
                    near = b[b != x] if right is None and i == j else b
                    bound = np.minimum(self.counts[x], self.counts[near]).sum(1)
                    for y in near[bound * (100 + percent) >= percent * (self.size[x] + self.size[near])].tolist():
                        p, q = find(int(group[x])), find(int(group[y]))
                        if p == q:
                            continue
                        both = len(np.intersect1d(self.sets[x], self.sets[y], assume_unique=True))
                        if 100 * both >= percent * (self.size[x] + self.size[y] - both):
                            up[q] = p
                            out.append((x, y))
        return out


def _link(percent: int):
    """Task: rows (task, pair, side, node, known, body) to edges (a, b). Side 0 is linked within itself and with side 1;
    a pair that only joins two sides has its first on side 2."""

    def run(table: pa.Table) -> pa.Table:
        a, b = [], []
        table = table.sort_by([("pair", "ascending"), ("side", "ascending"), ("node", "ascending")])
        pair = np.array(table.column("pair").to_pylist(), object)
        node, known, side = (table.column(c).to_numpy() for c in ("node", "known", "side"))
        bodies = table.column("body").to_pylist()
        cuts = np.append(np.flatnonzero(np.append(True, pair[1:] != pair[:-1])), len(pair))
        for s, e in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            if e - s < 2:
                continue
            points, sides = Points(bodies[s:e]), side[s:e]
            one, two, first = (np.flatnonzero(sides == x) for x in (0, 1, 2))
            group = known[s:e]
            found = points.links(one, None, group, percent) if len(one) > 1 else []
            if len(two) and (len(one) or len(first)):
                group = _merged(group, found)
                found = found + points.links(one if len(one) else first, two, group, percent)
            a += [int(node[s + x]) for x, _ in found]
            b += [int(node[s + y]) for _, y in found]
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def _merged(group: np.ndarray, found: list[tuple[int, int]]) -> np.ndarray:
    group = group.copy()
    for x, y in found:
        group[group == group[y]] = group[x]
    return group


def join(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 4, percent: int = 85) -> DataFrame:
    """One row per document: id, n_shingles, component_id (least id reachable by links, its own included).

    Two documents link when 100 * intersection >= percent * union of their sets of k-word shingles, A-Z lower-cased.
    """
    spark = df.sparkSession
    docs = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(8, size // (2 << 20))
    edges = candidates(docs, k, Levels(percent), buckets, size)  # the components cut the lineage
    family = cut_lineage(components(edges))
    del edges  # their keys are the largest shuffle, and none of it is read again
    release(spark)
    path = work_path(spark, "sets")
    members(docs, k, family).write.parquet(path)
    stored = spark.read.parquet(path)
    sets = stored.where("body IS NOT NULL").groupBy("node").agg(F.first("body").alias("body"))
    found = cut_lineage(family.withColumnRenamed("node", "vertex").join(sets.withColumn("vertex", F.shiftrightunsigned("node", 16)), "vertex").drop("vertex"))
    counted = found.groupBy("root").agg(F.sum(F.length("body")).alias("m"))
    placed = found.join(counted, "root").withColumn("blocks", F.ceil(F.col("m") / BLOCK).cast("long")).withColumn("block", F.pmod(F.xxhash64("node"), "blocks"))
    tasks = max(1, min(4096, size // (4 << 20)))
    # each block by itself, and with the family's hub block
    hub = placed.where("block = 0 AND blocks > 1").select("node", "root", "body", F.explode(F.sequence(F.lit(1), F.col("blocks") - 1)).alias("block"), F.lit(1).alias("side"))
    first = placed.select("node", "root", "body", "block", F.lit(0).alias("side")).unionByName(hub.select("node", "root", "body", F.col("block").cast("long"), "side"))
    rows = first.select(F.pmod(F.xxhash64("root", "block"), F.lit(tasks)).alias("task"), F.concat_ws(":", "root", "block").alias("pair"), "side", "node", F.col("node").alias("known"), "body")
    links = cut_lineage(rows.groupBy("task").applyInArrow(_link(percent), "a long, b long"))
    # large families again, in blocks of one component each; blocks that are wholly of the same component never meet
    large = placed.where("blocks > 1").select("node", "root", "body")
    known = components(links).select("node", F.col("root").alias("known"))
    large = large.join(known, "node", "left").withColumn("known", F.coalesce("known", "node"))
    amount = large.groupBy("root", "known").agg(F.sum(F.length("body")).alias("c"))
    small = amount.where(F.col("c") < BLOCK // 2).groupBy("root").agg(F.sum("c").alias("rest"))
    plan = amount.join(small, "root", "left").select("root", "known", "c", F.ceil(F.coalesce("rest", F.lit(0)) / BLOCK).cast("long").alias("mixed"))
    pure = F.col("c") >= BLOCK // 2
    large = large.join(plan, ["root", "known"]).select(
        "node", "root", "known", "body", pure.alias("pure"),
        F.when(pure, F.concat_ws("/", "known", F.pmod(F.xxhash64("node"), F.ceil(F.col("c") / BLOCK).cast("long")))).otherwise(F.concat_ws("/", F.lit("m"), F.pmod(F.xxhash64("known"), F.greatest("mixed", F.lit(1))))).alias("block"),
    )
    large = cut_lineage(large)
    blocks = large.select("root", "block", F.when(F.col("pure"), F.col("known")).alias("whole")).distinct()
    other = blocks.select(F.col("root").alias("r2"), F.col("block").alias("b2"), F.col("whole").alias("w2"))
    meet = blocks.join(other, (F.col("root") == F.col("r2")) & (F.col("block") <= F.col("b2")))
    meet = meet.where("NOT (whole <=> w2 AND whole IS NOT NULL)").select("root", "block", "b2", F.concat_ws(":", "root", "block", "b2").alias("pair"))
    same = F.col("block") == F.col("b2")
    left = meet.select("root", "block", "pair", F.when(same, 0).otherwise(2).alias("side"))
    right = meet.where(~same).select("root", F.col("b2").alias("block"), "pair", F.lit(1).alias("side"))
    again = large.join(left.unionByName(right), ["root", "block"]).select(F.pmod(F.xxhash64("pair"), F.lit(tasks * 4)).alias("task"), "pair", "side", "node", "known", "body")
    more = again.groupBy("task").applyInArrow(_link(percent), "a long, b long")
    all_links = cut_lineage(links.unionByName(more))
    final = components(all_links).select("node", "root")
    out = stored.select("id", "n_shingles", "node").join(final, "node", "left").withColumn("root", F.coalesce("root", "node"))
    named = out.where("n_shingles > 0").groupBy("root").agg(F.min("id").alias("component_id"))
    out = out.join(named, "root", "left").select("id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"))
    return out.withColumnRenamed("id", id_col)
