"""Product codes on metric trees against comparing everything with everything."""

import hashlib
import math
import random
from collections import defaultdict

import numpy as np
import pytest

from millrace.llm import vector_codes
from millrace.llm.queries import queries

SMALL = "/root/testdata/sf0.001"


def brute(rows, parts=16, entries=64, rounds=2):
    """rows: (id, vector, label); plain integers throughout."""
    good = lambda v: v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v)
    kept = sorted((r for r in rows if good(r[1])), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return []
    kept = [r for r in kept if len(r[1]) == len(kept[0][1])]
    width = -(-len(kept[0][1]) // parts)
    whole = [[math.floor(256 * x) for x in v] + [0] * (width * parts - len(v)) for _, v, _ in kept]
    cut = [[tuple(w[p * width : (p + 1) * width]) for p in range(parts)] for w in whole]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            mine = defaultdict(list)
            for c in cut:
                mine[nearest(c[p], books[p])[1]].append(c[p])
            books[p] = [tuple(sum(z) // len(mine[k]) for z in zip(*mine[k], strict=True)) if k in mine else e for k, e in enumerate(books[p])]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    out, labels = [], defaultdict(int)
    for (i, _, label), c in zip(kept, cut, strict=True):
        found = [nearest(c[p], books[p]) for p in range(parts)]
        error = sum(d for d, _ in found)
        labels[label] += error
        out.append((i, "".join(f"{k:02x}" for _, k in found), error, label))
    return sorted(((i, code, e, labels[label], digest) for i, code, e, label in out), key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<float>, label int, code string, id int")


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    df = queries()["op11_vector_codes"](spark, SMALL)
    assert [t for _, t in df.dtypes] == ["bigint", "string", "bigint", "bigint", "string"]
    assert got(df) == brute(rows)


@pytest.mark.parametrize("length", [16, 33])
def test_awkward_rows(spark, length):
    rnd = random.Random(length)
    f32 = lambda x: float(np.float32(x))
    some = [f32(rnd.gauss(0, 1)) for _ in range(length)]
    rows = [(i, [f32(rnd.choice([-1, 0, 0.5, 2]) + rnd.choice([0, 0, 1 / 256])) for _ in range(length)], rnd.choice([0, 1, None])) for i in range(10, 300)]
    rows += [(i, some, 3) for i in range(300, 700)]  # one vector of many rows
    rows += [(5, None, 0), (6, [], 0), (7, [None] * length, 1), (8, [float("nan")] * length, 1), (9, [float("inf")] + some[1:], None)]
    rows += [(50, some[:-1], 1), (20, some, 2), (20, some, 2), (None, some, 4), (800, [f32(900.25)] * length, 4), (801, [f32(-1e5)] * length, None)]
    assert got(vector_codes.encode(frame(spark, rows), block=100)) == brute(rows)
    assert got(vector_codes.encode(frame(spark, rows).repartition(3, "id", "vec_id"))) == brute(rows)


def test_few_or_no_vectors(spark):
    rows = [(3, [0.1, 0.2], None), (1, [1.0, -1.0], 2)]
    assert got(vector_codes.encode(frame(spark, rows))) == brute(rows)
    assert vector_codes.encode(frame(spark, [])).count() == 0
    assert vector_codes.encode(frame(spark, [(1, None, 1)])).count() == 0
    huge = vector_codes.encode(frame(spark, [(1, [3e38, -3e38], 1), (2, [0.0, 0.0], 1)])).collect()
    assert all(r.error == 0 for r in huge)


def test_tree_is_exact_and_skips_most_of_the_work(monkeypatch):
    rnd = np.random.default_rng(3)
    points = np.unique(np.concatenate([rnd.normal(c, 12, (1500, 4)) for c in rnd.uniform(-300, 300, (12, 4))]).astype(np.int64), axis=0)
    weights = rnd.integers(1, 9, len(points))
    tree, order = vector_codes.Tree.build(points, weights)
    assert sorted(order.tolist()) == list(range(len(points)))
    assert (tree.sums[-1] == (points * weights[:, None]).sum(0)).all() and tree.sizes[-1] == weights.sum()
    inner = np.flatnonzero(tree.left >= 0)
    assert (tree.sums[inner] == tree.sums[tree.left[inner]] + tree.sums[tree.right[inner]]).all()
    asked = []
    plain = vector_codes.nearest
    monkeypatch.setattr(vector_codes, "nearest", lambda p, b, m=None: asked.append(0 if m is None else int(m.sum())) or plain(p, b, m))
    for book in (points[:: len(points) // 60][:64], np.repeat(points[:7], 3, axis=0), points[:1], rnd.integers(-2000, 2000, (40, 4))):
        want = plain(tree.points, book)[0]
        assert (tree.codes(book) == want).all()
        sums, sizes = tree.totals(book)
        assert (sizes == np.bincount(want, tree.weights, len(book))).all()
        assert (sums == np.stack([np.bincount(want, tree.points[:, k] * tree.weights, len(book)) for k in range(4)], 1)).all()
    assert asked[0] < 0.2 * len(points) * 60


def test_far_from_the_origin():
    rnd = np.random.default_rng(4)
    points = np.unique(rnd.integers(0, 40, (3000, 4)) + (1 << 28), axis=0)
    tree, _ = vector_codes.Tree.build(points, np.ones(len(points), np.int64))
    book = points[::50][:64]
    assert (tree.codes(book) == vector_codes.nearest(tree.points, book)[0]).all()
