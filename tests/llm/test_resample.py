"""Importance resampling against plain counting."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import awkward
import numpy as np
from pyspark.sql import functions as F

from millrace.llm import resample
from millrace.llm.queries import queries

SMALL = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LAST = 2**63


def counted(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = words + [f"{a} {b}" for a, b in zip(words, words[1:])]
    return len(words), Counter(zlib.crc32(g.encode()) % 10000 for g in grams)


def brute(rows, target, percent=25):
    docs = [(i, *counted(t)) for i, t in rows]
    s, t = Counter(), Counter()
    for _, _, c in docs:
        s.update(c)
    for x in target:
        t.update(counted(x)[1])
    ns, nt = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (ns + 10000) / ((s[b] + 1) * (nt + 10000))))
    out = []
    for i, n, c in docs:
        total = sum(c.values())
        weight = sum(gain(b) * k for b, k in c.items()) // total if total else 0
        h = int(hashlib.sha256(f"7:{'null' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, total, weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n))
    enough = sorted((r for r in out if r[4] >= 20), key=lambda r: (-r[3], LAST if r[0] is None else r[0]))
    ranks = Counter()
    drawn = []
    for k, r in enumerate(enough[: percent * len(enough) // 100], 1):
        drawn.append((*r[:4], k))
        ranks[r] += 1
    rest = [(*r[:4], None) for r in (Counter(out) - ranks).elements()]
    return sorted(drawn + rest, key=str)


def got(df):
    return sorted(((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in df.collect()), key=str)


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    target = [r.text for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    df = queries()["op13_resample"](spark, SMALL)
    assert [t for n, t in df.dtypes if n != "doc_id"][:4] == ["bigint"] * 4
    assert got(df) == brute(rows, target)


def test_awkward_rows(spark):
    more = ["Aé b9-Z " * 30, "q" * 63 + " " + "r" * 64 + " " + "s" * 65 + " t " + "u" * 300 + " v" * 20, "\x00a\x7fb{c" * 12]
    data = awkward.rows(more)
    target = ["a b c", None, "", "word word word", more[0]]
    frame = spark.createDataFrame([(t,) for t in target], "text string")
    out = resample.draw(awkward.frame(spark, data), frame)
    assert got(out) == brute([r[:2] for r in data], target)
    none = resample.draw(awkward.frame(spark, data), frame.limit(0))
    assert got(none) == brute([r[:2] for r in data], [])
    assert resample.draw(awkward.frame(spark, []), frame).count() == 0


def test_same_at_any_partitioning(spark):
    df = spark.read.parquet(f"{SMALL}/documents.parquet")
    target = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    assert got(resample.draw(df.repartition(7, F.rand(3)), target)) == got(resample.draw(df.coalesce(1), target))


def test_planes_hold_counts_and_signed_gains():
    rnd = random.Random(5)
    doc = np.array([0] * 3000 + [2] * 40)
    bucket = np.array([rnd.choice([0, 63, 64, 9999, 17, 512]) for _ in range(3040)])
    gain = np.array([rnd.randint(-9000, 9000) for _ in range(10000)])
    planes, places = resample.gain_planes(gain)
    for b in (0, 63, 64, 9999):
        assert (((planes[:, b >> 6] >> np.uint64(b & 63)) & np.uint64(1)).astype(int) * places).sum() == gain[b]
    sums = resample.gain_sums(doc, bucket, 3, 10000, planes, places)
    assert sums.tolist() == [gain[bucket[:3000]].sum(), 0, gain[bucket[3000:]].sum()]
