"""Operators that compare all documents, against plain Python."""

import hashlib
import math
import random
import re
import zlib

import awkward
import suffix_memory
import pytest
from pyspark.sql import functions as F

from millrace.llm import jaccard, phrases, suffix_tree
from millrace.llm.components import components
from millrace.llm.queries import queries
from millrace.llm.words import NULL_ID

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SMALL = "/root/testdata/sf0.001"


def words(text):
    return WORD.findall(text or "")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def brute_phrases(rows):
    first = {}
    for i, t in rows:
        w = words(t)
        rank = NULL_ID if i is None else i
        for p in range(len(w) - 12):
            key = tuple(w[p : p + 13])
            first[key] = min(rank, first.get(key, rank))
    out = []
    for i, t in rows:
        w = words(t)
        gone = set()
        for p in range(len(w) - 12):
            if first[tuple(w[p : p + 13])] < (NULL_ID if i is None else i):
                gone |= set(range(p, p + 13))
        out.append((str(i), len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out)


@pytest.mark.parametrize("hot", [2000, 3])
def test_repeated_phrases(spark, hot, monkeypatch):
    rnd = random.Random(6)
    vocab = awkward.vocabulary(40)
    passages = [" ".join(rnd.choice(vocab) for _ in range(n)) for n in (12, 13, 14, 30, 60)]
    more = ["\t".join(" ".join(rnd.choice(vocab) for _ in range(rnd.randint(0, 9))) + " " + rnd.choice(passages) for _ in range(rnd.randint(1, 4))) for _ in range(80)]
    more += [passages[3]] * 5 + ["a b " * 30, "b a " * 30]
    data = awkward.rows(more)
    rnd.shuffle(data)
    # the threshold is read where a bucket is reduced: patch it there
    real = phrases.anchors
    monkeypatch.setattr(phrases, "anchors", lambda docs, buckets: real(docs, buckets, hot))
    got = sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept) for r in phrases.remove(awkward.frame(spark, data), chunk_bytes=4000).collect())
    assert got == brute_phrases([x[:2] for x in data])
    assert sum(x[2] for x in got) > 500
    assert phrases.remove(awkward.frame(spark, [])).count() == 0


def test_repeated_phrases_query(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    want = [(i, n, g, hashlib.sha256(k.encode()).hexdigest()) for i, n, g, k in brute_phrases(docs)]
    got = sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in queries()["op4_repeated_phrases"](spark, SMALL).collect())
    assert got == want


def brute_join(rows, k=4, percent=85):
    sets = []
    for _, t in rows:
        w = words(lower(t))
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                up[find(i)] = find(j)
    ids = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            ids[find(i)] = min(d, ids.get(find(i), d))
    return sorted(((str(d), len(sets[i]), str(ids.get(find(i)) if sets[i] else d)) for i, (d, _) in enumerate(rows)))


def near_copies(rnd, vocab, groups, copies):
    out = []
    for _ in range(groups):
        base = [rnd.choice(vocab) for _ in range(rnd.choice([5, 9, 30, 120, 400]))]
        for _ in range(copies):
            ws = list(base)
            for _ in range(int(len(ws) * rnd.random() * 0.04)):
                ws[rnd.randrange(len(ws))] = rnd.choice(vocab)
            if rnd.random() < 0.3:
                ws = ws[: len(ws) - rnd.randint(0, max(1, len(ws) // 12))]
            out.append(" ".join(w.upper() if w.isascii() and rnd.random() < 0.1 else w for w in ws))
    return out


@pytest.mark.parametrize(("block", "k", "percent"), [(jaccard.BLOCK, 4, 85), (8_000, 4, 85), (8_000, 5, 80)])
def test_jaccard_join(spark, block, k, percent, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    rnd = random.Random(11)
    data = awkward.rows(near_copies(rnd, awkward.vocabulary(300), 14, 25))
    rnd.shuffle(data)
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in jaccard.join(awkward.frame(spark, data), k=k, percent=percent).collect())
    want = brute_join([x[:2] for x in data], k, percent)
    assert got == want
    assert len({x[2] for x in want}) < len(want) - 100
    assert jaccard.join(awkward.frame(spark, [])).count() == 0


def test_jaccard_join_query(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in queries()["op7_jaccard_join"](spark, SMALL).collect())
    assert got == brute_join(docs)


@pytest.mark.parametrize("percent", [85, 80])
def test_group_keys_lose_no_link(percent):
    import numpy as np

    rnd = np.random.default_rng(4)
    levels = jaccard.Levels(percent)
    for n in [*range(1, 40), 100, 127, 500, 5000]:
        for _ in range(20):
            a = np.unique(rnd.integers(0, 2**63, n).astype(np.uint64) * np.uint64(2))
            both = rnd.integers(math.ceil(percent / 100 * n), n + 1)
            extra = int(both * 100 / percent) - n  # the largest union
            b = np.unique(np.concatenate([rnd.permutation(a)[:both], rnd.integers(0, 2**63, max(0, rnd.integers(0, extra + 1))).astype(np.uint64) * np.uint64(2) + np.uint64(1)]))
            common = len(np.intersect1d(a, b))
            if 100 * common >= percent * (len(a) + len(b) - common):
                for share in (0, 0.1, 0.6, 1):
                    union = np.union1d(a, b)
                    common = np.sort(rnd.permutation(union)[: int(share * len(union))])
                    assert len(np.intersect1d(levels.keys(a, common), levels.keys(b, common)))


@pytest.mark.parametrize("hub", [10_000, 4])
def test_components(spark, hub, monkeypatch):
    monkeypatch.setattr("millrace.llm.components.HUB", hub)
    rnd = random.Random(1)
    edges = [(i, i + 1) for i in range(0, 60)] + [(1000, i) for i in range(1001, 1030)] + [(i, 2000) for i in range(1020, 1060)] + [(rnd.randint(100, 300), rnd.randint(100, 300)) for _ in range(120)] + [(500, 500), (-5, 7)]
    up = {}

    def find(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        if a != b:
            up[max(find(a), find(b))] = min(find(a), find(b))
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in list(up) if x != 500}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_suffix_tree_base_and_gain(spark):
    got = {r.doc_id: r for r in queries()["op10_suffix_tree"](spark, SMALL).collect()}
    docs = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in docs}
    counts = {}
    for i, t in docs:
        if not held[i]:
            for w in [*words(lower(t)), None]:
                counts[w] = counts.get(w, 0) + 1
    n, v = sum(counts.values()), len(counts)
    for i, t in docs:
        tokens = [*words(lower(t)), None]
        base = sum(math.log10((counts.get(w, 0) + 0.5) / (n + 0.5 * (v + 1))) for w in tokens)
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[i], len(tokens), sum(w in counts for w in tokens), n)
        assert r.base_score == pytest.approx(base, rel=1e-9)
    assert len(got) == len(docs)
    out = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)  # better than the word counts on texts it has not seen


def test_suffix_tree_is_a_distribution():
    import numpy as np

    from millrace.llm.words import U

    rnd = np.random.default_rng(2)
    symbols = suffix_memory.Symbols(np.array([suffix_tree.END, 5, 9], U))
    root = np.array([0.2, 0.3, 0.1, 0.4])
    one = [(c, x, int(n)) for c in range(4) for x, n in enumerate(rnd.integers(0, 900, 4)) if n]
    two = [(c, x, int(n)) for c in (0, 5, 15) for x, n in enumerate(rnd.integers(0, 900, 4)) if n]
    columns = lambda t: tuple(np.array(x) for x in zip(*t, strict=True))
    tree = suffix_memory.Tree(symbols, root, 10_000, columns(one), columns(two))
    assert np.allclose((10**tree.table).sum(1), 1) and len(tree.table) > 4
    h = np.array([5, 9, 5, 5, 77, int(suffix_tree.END)], U)
    got, other = tree.score(h, np.zeros(6, int))
    assert other.tolist() == [False] * 4 + [True, False] and np.isfinite(got).all()
    fresh, _ = tree.score(h[:1], np.zeros(1, int))
    assert fresh[0] == pytest.approx(np.log10(root[symbols.of(h[:1])[0]]))


def test_suffix_tree_edges(spark):
    data = awkward.rows(["A b", "zzz"])
    out = suffix_tree.score(awkward.frame(spark, data), F.col("doc_id") % 5 == 1, chunk_bytes=4000).collect()
    assert len(out) == len(data) and all(math.isfinite(r.score) and r.n_tokens >= 1 for r in out)
    assert all(r.score == 0 for r in suffix_tree.score(awkward.frame(spark, data), F.lit(True)).collect())
    assert suffix_tree.score(awkward.frame(spark, []), F.lit(False)).count() == 0


def test_suffix_tree_learns_contexts_of_rare_words(spark):
    """As the same model in memory over all words, and a rare passage that repeats is learnt."""
    import collections

    import numpy as np
    import pyarrow as pa

    from millrace.llm.words import U

    rnd = random.Random(4)
    common = [f"c{i}" for i in range(12)]
    passage = " ".join(f"rare{i}" for i in range(30))
    texts = [" ".join(rnd.choice(common[: 2 + i % 11]) for _ in range(rnd.randint(1, 90))) for i in range(150)]
    texts += [f"{rnd.choice(common)} {passage} {rnd.choice(common)}" for _ in range(20)] + ["", passage, f"c1 unknown {passage}"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    held = lambda i: i % 5 == 1 or i >= 171
    run = lambda **b: {r.doc_id: r for r in suffix_tree.score(df, F.expr("doc_id % 5 = 1 OR doc_id >= 171"), **b).collect()}
    got = run(depth=2, chunk_bytes=3000)
    h, doc = suffix_tree.tokens(pa.array(texts))
    train = np.array([not held(i) for i in range(len(texts))])[doc]
    found, n = np.unique(h[train], return_counts=True)
    symbols = suffix_memory.Symbols(found.astype(U))
    root = np.append(n + 0.5, 0.5) / (n.sum() + 0.5 * (len(found) + 1))
    s, one, two = suffix_memory._contexts(h, doc, symbols)
    tables = []
    for context in (one, two):
        pairs = collections.Counter((int(c), int(x)) for c, x, t in zip(context, s, train, strict=True) if t and c >= 0)
        total = collections.Counter()
        for (c, _), k in pairs.items():
            total[c] += k
        tables.append(tuple(np.array(x) for x in zip(*[(c, x, k) for (c, x), k in pairs.items() if total[c] >= 2], strict=True)))
    tree = suffix_memory.Tree(symbols, root, int(n.sum()), *tables)
    want = np.bincount(doc, tree.score(h, doc)[0], minlength=len(texts))
    assert len(tree.one) > 30 and len(tree.two) > 0
    assert [got[i].score for i in range(len(texts))] == pytest.approx(want.tolist(), rel=1e-9)
    deep, whole = run(chunk_bytes=3000), run(chunk_bytes=1 << 22)
    assert all(deep[i].score == pytest.approx(whole[i].score, rel=1e-9) for i in deep)
    assert deep[171].score > deep[171].base_score / 4  # no word of it makes up 0.6 % of the tokens


@pytest.mark.parametrize("depth", [1, 2, 3, 4])
def test_suffix_tree_at_any_depth(spark, depth):
    """As the same model in dictionaries, with passages that are learnt to the last word of the context."""
    rnd = random.Random(depth)
    vocab = [f"w{i}" for i in range(40)]
    passages = [[rnd.choice(vocab) for _ in range(25)] for _ in range(6)]
    texts = [[rnd.choice(vocab[: 3 + i % 37]) for _ in range(rnd.randint(0, 40))] for i in range(120)]
    texts += [[rnd.choice(vocab), *rnd.choice(passages), *rnd.choice(passages)] for _ in range(60)]
    held = [i % 5 == 1 for i in range(len(texts))]
    df = spark.createDataFrame([(i, " ".join(t), h) for i, (t, h) in enumerate(zip(texts, held, strict=True))], "doc_id long, text string, h boolean")
    rows = {r.doc_id: r.score for r in suffix_tree.score(df.repartition(3), F.col("h"), depth=depth, chunk_bytes=2500).collect()}
    assert [rows[i] for i in range(len(texts))] == pytest.approx(suffix_memory.plain_scores(texts, held, depth), rel=1e-9)
    if depth > 1:
        shallow = suffix_memory.plain_scores(texts, held, depth - 1)
        assert sum(rows[i] > shallow[i] + 1e-6 for i in range(len(texts))) > 20  # the last word of the context counts


def test_suffix_tree_query_at_its_depth(spark):
    """The registered query against dictionaries over the whole table."""
    docs = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    held = [zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in docs]
    want = suffix_memory.plain_scores([words(lower(t)) for _, t in docs], held)
    got = {r.doc_id: r.score for r in queries()["op10_suffix_tree"](spark, SMALL).collect()}
    assert [got[i] for i, _ in docs] == pytest.approx(want, rel=1e-9)
