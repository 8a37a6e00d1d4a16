"""Improbable-feature digests against plain Python."""

import base64
import hashlib
import random
from collections import Counter

import awkward
import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import digest
from millrace.llm.queries import queries
from millrace.llm.words import BASE, BYTES, U, mix

SMALL = "/root/testdata/sf0.001"
MASK = 2**64 - 1


def levels(data):
    out = []
    for i in range(len(data) - digest.WINDOW + 1):
        total = sum(int(digest.ENTROPY[n]) for n in Counter(data[i : i + digest.WINDOW]).values())
        out.append((digest.SCALE - total) * 1000 // digest.SCALE)
    return out


def plain_ranks(texts):
    counts = Counter(x for t in texts for x in levels(t.encode()))
    order = sorted(range(digest.LEVELS), key=lambda x: (counts[x], x))
    return {x: k for k, x in enumerate(order) if x >= digest.WEAK}


def plain_fingerprint(text, rank):
    data = text.encode()
    found = levels(data)
    votes = Counter()
    for i in range(max(len(found) - digest.SPAN + 1, min(len(found), 1))):
        span = [(rank[x], j) for j, x in enumerate(found[i : i + digest.SPAN], i) if x in rank]
        if span:
            votes[min(span)[1]] += 1
    chosen = [data[i : i + digest.WINDOW] for i in sorted(votes) if votes[i] >= digest.VOTES]
    if not chosen and data:
        chosen = [data[i : i + digest.SHORT] for i in range(max(1, len(data) - digest.SHORT + 1))]
    hashes = []
    for f in chosen:
        total, power = 0, 1
        for b in f:
            total = (total + int(BYTES[b]) * power) & MASK
            power = power * int(BASE) & MASK
        hashes.append(int(mix(np.array([(total + len(f)) & MASK], U))[0]))
    hashes = list(dict.fromkeys(hashes))
    filters = []
    for i in range(0, len(hashes), digest.FULL):
        bits = {h >> (11 * k) & (digest.BITS - 1) for h in hashes[i : i + digest.FULL] for k in range(digest.HASHES)}
        filters.append("".join("1" if k in bits else "0" for k in range(digest.BITS)))
    raw = b"".join(int(f, 2).to_bytes(digest.BITS // 8, "big") for f in filters)
    return f"{len(hashes)}:{base64.b64encode(raw).decode()}", filters, len(hashes)


def plain_likeness(a, b):
    a, b = sorted((a, b), key=lambda f: (f[2], base64.b64decode(f[0].split(":")[1])))
    if not a[2]:
        return 1.0 if not b[2] else 0.0
    total = 0.0
    for i, f in enumerate(a[1]):
        best = 0.0
        for g in b[1]:
            shared = sum(x == y == "1" for x, y in zip(f, g, strict=True))
            most, chance = min(f.count("1"), g.count("1")), f.count("1") * g.count("1") / digest.BITS
            best = max(best, 1.0 if shared == most else (shared - chance) / (most - chance))
        total += min(digest.FULL, a[2] - i * digest.FULL) * best
    return total / a[2]


def brute(texts):
    """texts in the order of the documents, next one behind each."""
    rank = plain_ranks(texts)
    prints = [plain_fingerprint(t, rank) for t in texts]
    out = []
    for k, t in enumerate(texts):
        n = (k + 1) % len(texts)
        half = len(t) // 2
        edited = t[: len(t) - half] + texts[n][:half]
        changed = plain_fingerprint(edited, rank)
        out.append((len(t), hashlib.sha256(edited.encode()).hexdigest(), prints[k][0], changed[0], plain_likeness(prints[k], changed), plain_likeness(prints[k], prints[n])))
    return out


def values(r):
    return r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, pytest.approx(r.near_edited, abs=1e-12), pytest.approx(r.near_next, abs=1e-12)


def test_query(spark):
    docs = sorted(map(tuple, spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()), reverse=True)
    got = {r.doc_id: r for r in queries()["op12_digest"](spark, SMALL).collect()}
    assert len(got) == len(docs)
    for (i, _), want in zip(docs, brute([t or "" for _, t in docs]), strict=True):
        assert values(got[i]) == want
    assert sum(r.near_edited > r.near_next for r in got.values()) > 0.95 * len(got)


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_awkward_rows(spark, parts, monkeypatch):
    more = ["é" * 15 + "日本語テキスト" * 9, "ab" * 200, "".join(map(chr, range(33, 127))) * 3, "q" * 31, "q" * 32, "same text of some length, long enough for windows " * 4]
    data = [r for r in awkward.rows(more, n=20) if r[0] is not None and r[0] != 7] + [(None, "a text without an id, and of some length as well", *[None] * 7)]
    df = awkward.frame(spark, data)
    monkeypatch.setattr(digest, "PIECE", 700)
    laid = digest.with_next
    monkeypatch.setattr(digest, "with_next", lambda *a: laid(*a, parts=parts))
    rows = digest.compare(df).collect()
    order = sorted(data, key=lambda r: -(2**63) if r[0] is None else r[0], reverse=True)
    want = brute([r[1] or "" for r in order])
    got = {}
    for r in rows:
        got.setdefault(r.doc_id, []).append(r)
    assert len(rows) == len(data)
    for r, w in zip(order, want, strict=True):
        if r[0] != 3:  # repeated rows: two of the three are followed by themselves
            assert [values(x) for x in got[r[0]]] == [w] * len(got[r[0]])
    assert sorted(round(x.near_next, 9) for x in got[3])[1:] == [1, 1] and len({x.fingerprint for x in got[3]}) == 1


def test_tied_ids_are_dealt_over_parts(spark, monkeypatch):
    texts = awkward.texts(60, seed=4)
    df = spark.createDataFrame([(5 if i % 3 else i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    laid = digest.with_next(df, "doc_id", "text", parts=12)
    parts = [r.part for r in laid.where("id = 5 AND NOT filler").select("part").distinct().collect()]
    assert len(parts) > 3
    rows = {r.n_chars: r for r in digest.compare(df).collect()}
    assert len(digest.compare(df).collect()) == len(texts) and len(rows) > 20
    assert sorted((r.id, r.text) for r in laid.where("NOT filler").collect()) == sorted((5 if i % 3 else i, t) for i, t in enumerate(texts))
    # every row but fillers is followed by a row that is not larger
    ranked = laid.withColumn("h", F.xxhash64("text")).toPandas()
    for _, g in ranked.groupby("part"):
        keys = list(zip(g.id, g.h, strict=True))[:-1]
        assert keys == sorted(keys, reverse=True) and g.filler.tolist() == [False] * (len(g) - 1) + [True]


def test_one_row_and_none(spark):
    df = spark.createDataFrame([(1, "a single document of more than a window, which is followed by itself")], "doc_id long, text string")
    r = digest.compare(df).first()
    assert r.near_next == 1.0
    assert digest.compare(df.limit(0)).count() == 0
    empty = spark.createDataFrame([(1, None), (2, "")], "doc_id int, text string")
    assert [(r.fingerprint, r.near_edited, r.near_next) for r in digest.compare(empty).collect()] == [("0:", 1.0, 1.0)] * 2


def test_likeness_bounds():
    rnd = random.Random(2)
    texts = [t for t in awkward.texts(40, seed=8, vocab=300)] + ["".join(rnd.choice("abcdefgh ") for _ in range(20000))]
    rank = np.arange(digest.LEVELS)
    prints = digest.fingerprint(texts, rank)
    for a in prints:
        back = digest.Fingerprint.parse(str(a))
        assert str(back) == str(a) and back.likeness(a) == 1.0
        assert all(0 <= a.likeness(b) <= 1 and a.likeness(b) == b.likeness(a) for b in prints)
    assert len(prints[-1].filters) > 2
