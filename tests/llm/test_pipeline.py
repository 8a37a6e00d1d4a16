"""The pipeline against brute-force versions of its stages, and each stage on awkward rows."""

import re

import awkward
import corpus_pipeline
import numpy as np
from test_corpus import brute_join
from test_rows import base_rule, plain_cutoffs, planning_ids, rule_scores

from millrace.llm import bpe
from millrace.llm.queries import tokenizer_path

SMALL = "/root/testdata/sf0.001"


def windows(lines):
    """(first, number) of the least matches: three lines, or fewer with 50 words."""
    for n in (1, 2, 3):
        for p in range(len(lines) - n + 1):
            if n == 3 or sum(len(y) for _, y in lines[p : p + n]) >= 50:
                yield p, n


def brute_lines(docs):
    first, out = {}, []
    split = {i: [(k, tuple(x.split())) for k, x in enumerate(t.split("\n")) if x.split()] for i, t in docs}
    for i, _ in docs:
        ls = split[i]
        for p, n in windows(ls):
            run = tuple(y for _, y in ls[p : p + n])
            first[run] = min((i, p), first.get(run, (i, p)))
    for i, t in docs:
        ls = split[i]
        gone = {q for p, n in windows(ls) if first[tuple(y for _, y in ls[p : p + n])] < (i, p) for q in range(p, p + n)}
        if gone and len(gone) == len(ls):
            continue
        numbers = {ls[q][0] for q in gone}
        out.append((i, "\n".join(y for k, y in enumerate(t.split("\n")) if k not in numbers) if gone else t))
    return out


LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def numbered(text, numbers):
    words = re.findall("[^ \t-\r]+", text.translate(LOWER))
    return np.array([numbers.setdefault(w, len(numbers)) for w in words], int)


def overlaps(a, b):
    """Do 13 aligned words hold 11 equal ones, at any places of both texts?"""
    if min(len(a), len(b)) < 13:
        return False
    same = (a[:, None] == b[None, :]).astype(np.int8)
    return sum(same[k : len(a) - 12 + k, k : len(b) - 12 + k] for k in range(13)).max() >= 11


def test_pipeline(spark):
    table = lambda name: spark.read.parquet(f"{SMALL}/{name}.parquet")
    docs = [tuple(r) for r in table("documents").select("doc_id", "text", "lang").collect()]
    labels = [tuple(r) for r in table("labels").select("doc_id", "quality").collect()]
    cuts = plain_cutoffs(docs, labels, planning_ids(spark, [i for i, _ in labels]))
    left = [(i, t) for i, t, s in docs if not base_rule(t) and not any(rule_scores(t)[r] > c for r, c in cuts.get(s, {}).items())]
    left = brute_lines(left)
    groups = {i for i, _, c in brute_join(left, k=5, percent=80) if i == c}
    left = [(i, t) for i, t in left if str(i) in groups]
    numbers = {}
    items = [numbered(r.text or "", numbers) for r in table("benchmark").collect()]
    left = [(i, t) for i, t in left if not any(overlaps(numbered(t, numbers), x) for x in items)]
    tok = bpe.load(tokenizer_path("word_bpe_49k.json"))
    want = sorted((i, tok.encode(t, add_special_tokens=False).ids) for i, t in left)
    got = corpus_pipeline.run(spark, SMALL)
    assert sorted((r.doc_id, r.ids) for r in got.collect()) == want
    assert 0 < len(want) < len(docs)


def test_quality_stage_where_cutoffs_are_certified(spark, tmp_path):
    """Labels enough that every language gets cutoffs; what they reject goes, all else stays as it is."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    texts = [tuple(r) for r in docs.select("doc_id", "text", "lang").collect()]
    more = [(1000 * (k + 1) + i, t if i % 6 else t.replace(" ", "### "), s) for k in range(16) for i, t, s in texts if not base_rule(t) and rule_scores(t)["symbols"] < 0.02]
    labels = [(i, int(i % 1000 % 6 > 0)) for i, _, _ in more]
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    given = spark.createDataFrame([(*r, "s", len(r[1] or "")) for r in more], "doc_id long, text string, lang string, source string, n_chars long")
    cuts = plain_cutoffs(more, labels, planning_ids(spark, [i for i, _ in labels]))
    assert len(cuts) > 1
    want = sorted(i for i, t, s in more if not base_rule(t) and not any(rule_scores(t)[r] > c for r, c in cuts.get(s, {}).items()))
    out = corpus_pipeline.quality_rules(spark, given, str(tmp_path))
    assert out.columns == given.columns
    assert sorted(r.doc_id for r in out.collect()) == want and len(want) < sum(not base_rule(t) for _, t, _ in more)


def test_stages_on_awkward_rows(spark):
    names = ["doc_id", "text", "lang", "source", "n_chars"]
    for data in (awkward.rows(), []):
        docs = awkward.frame(spark, data).select(*names, "id", "key", "chunk", "email")
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SMALL)
            if name != corpus_pipeline.STAGES[-1][0]:
                assert out.columns == docs.columns
                assert out.count() <= len(data)
            else:
                assert out.count() == len(data)
