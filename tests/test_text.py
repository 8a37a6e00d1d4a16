"""Cleaning, tokens, phrases, collocations and sequences on hand-made rows."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millrace.functions import scalars as X
from millrace.functions import text as T
from millrace.operators import phrases, vocabulary


def _one(spark, expr, value):
    return spark.createDataFrame([(value,)], "t string").select(expr(F.col("t")).alias("o")).first()["o"]


def test_cleaning(spark):
    assert _one(spark, T.drop_lone_letters, "a b c dd e f") == "a c dd f"
    assert _one(spark, T.strip_tags, "<p>x</p> y<br/>") == "x y"
    assert _one(spark, T.strip_emoji, "hi \U0001f600\U0001f680 you") == "hi  you"
    assert _one(spark, T.clean_text, "<b>It's</b> 5 o'clock,\n a  new day") == "It o clock new day"


def test_tokens(spark):
    assert _one(spark, T.word_tokens, "The CAT, été 42!") == ["the", "cat", "été", "42"]
    assert _one(spark, T.simple_tokens, "A Été x9 incomprehensibilities ok") == ["ete", "ok"]
    assert _one(spark, T.word_tokens, "...") == []


def test_scalars(spark):
    assert _one(spark, X.parse_amount, "$5,000") == 5000
    assert _one(spark, X.parse_amount, "150,000km") == 150000
    assert _one(spark, X.parse_amount, "n/a") is None
    assert _one(spark, X.title_of, "Braund, Mr. Owen Harris") == "Mr"
    assert _one(spark, X.part_count, None) == 0 and _one(spark, X.part_count, "C23 C25") == 2
    assert _one(spark, X.first_letter, None) == "n"
    assert _one(spark, X.code_prefix, "A./5. 21171") == "a5" and _one(spark, X.code_prefix, "347082") == "0"
    assert _one(spark, X.is_numeric, "12") == 1 and _one(spark, X.is_numeric, "1a") == 0
    assert str(_one(spark, X.parse_minute, "8/4/2016 11:52")) == "2016-08-04 11:52:00"
    assert _one(spark, X.parse_minute, "not a date") is None


def test_phrase_match_overlaps_and_case(spark):
    df = spark.createDataFrame([(1, "The dog saw THE DOG house"), (2, "nothing here")], "id long, text string")
    listed = spark.createDataFrame([("the dog",), ("dog",), ("dog house",)], "phrase string")
    got = sorted((r["phrase"], r["start"], r["end"]) for r in phrases.phrase_match(df, "id", "text", listed, [1, 2]).collect())
    assert got == [("dog", 1, 2), ("dog", 4, 5), ("dog house", 4, 6), ("the dog", 0, 2), ("the dog", 3, 5)]


def test_join_bigrams_left_to_right(spark):
    df = spark.createDataFrame([(1, ["a", "a", "a", "b", "a", "a"]), (2, []), (3, ["b"])], "id long, t array<string>")
    accepted = spark.createDataFrame([("a", "a")], "a string, b string")
    got = {r["id"]: r["tokens"] for r in phrases.join_bigrams(df, "id", F.col("t"), accepted).collect()}
    assert got == {1: ["a_a", "a", "b", "a_a"], 2: [], 3: ["b"]}


def test_bigram_scores(spark):
    rows = [(i, ["new", "york", "is", f"w{i}"]) for i in range(8)]
    df = spark.createDataFrame(rows, "id long, t array<string>")
    got = {(r["a"], r["b"]): r["score"] for r in phrases.bigram_phrases(df, F.col("t"), min_count=2, threshold=0.5).collect()}
    # 11 words and 10 pairs; (8 - 2) / (8 * 8) * 21
    assert got == {("new", "york"): 6 / 64 * 21, ("york", "is"): 6 / 64 * 21}


def test_lexicon_both_paths_agree(spark, monkeypatch):
    df = spark.createDataFrame([(1, ["good", "good", "bad"]), (2, ["x"]), (3, ["good"])], "id long, t array<string>")
    lexicon = spark.createDataFrame([("good", 0.9, 0.5), ("bad", -1.0, 1.0)], "word string, polarity double, subjectivity double")
    small = sorted(map(tuple, phrases.lexicon_sentiment(df, "id", F.col("t"), lexicon).collect()))
    monkeypatch.setattr(phrases, "bounded", lambda f: None)
    large = sorted(map(tuple, phrases.lexicon_sentiment(df, "id", F.col("t"), lexicon).collect()))
    assert small == large
    assert [r[3] for r in small] == ["neutral", "neutral", "positive"]


def test_encode_sequences(spark):
    df = spark.createDataFrame([(1, ["b", "a", "zz", "b", "c"]), (2, ["zz"]), (3, [])], "id long, t array<string>")
    vocab = spark.createDataFrame([("a", 5, 1), ("b", 4, 2), ("c", 1, 3)], "term string, n long, idx long")
    pre = {r["id"]: r["sequence"] for r in vocabulary.encode_sequences(df, "id", F.col("t"), vocab, 3, "pre").collect()}
    post = {r["id"]: r["sequence"] for r in vocabulary.encode_sequences(df, "id", F.col("t"), vocab, 6, "post").collect()}
    assert pre == {1: [1, 2, 3], 2: [0, 0, 0], 3: [0, 0, 0]}
    assert post == {1: [2, 1, 2, 3, 0, 0], 2: [0] * 6, 3: [0] * 6}


def test_lookup_splits_hot_keys_without_loss(spark):
    left = spark.createDataFrame([(i, "the" if i % 3 else f"w{i}") for i in range(600)], "i long, term string")
    right = spark.createDataFrame([("the", 1)] + [(f"w{i}", i) for i in range(0, 600, 6)], "term string, idx int")
    counts = left.groupBy("term").count().withColumnRenamed("count", "n")
    assert vocabulary.lookup(left, right, "term", counts).count() == left.join(right, "term").count()


def test_document_vectors_zero_and_skip(spark):
    df = spark.createDataFrame([(1, ["a", "a", "x"]), (2, ["x"])], "id long, t array<string>")
    vectors = spark.createDataFrame([("a", [1.0, 2.0])], "word string, vector array<float>")
    skip = {r["id"]: r["vector"] for r in vocabulary.document_vectors(df, "id", F.col("t"), vectors, 2).collect()}
    zero = {r["id"]: r["vector"] for r in vocabulary.document_vectors(df, "id", F.col("t"), vectors, 2, "zero").collect()}
    assert skip == {1: [1.0, 2.0], 2: [0.0, 0.0]}
    assert zero[1] == [2 / 3, 4 / 3]


LEXICON = [("good", 0.7, 0.6, None, None), ("bad", -0.6, 0.9, None, None), ("very", None, None, 1.5, None), ("hardly", None, None, 0.5, True), ("not", None, None, None, True)]


def plain_sentiment(words, reach=3):
    table = {w: r for w, *r in LEXICON}
    scores, open_ = [], []
    for i, w in enumerate(words):
        if w not in table:
            continue
        polarity, subjectivity, intensity, negates = table[w]
        open_ = [m for m in open_ if m[0] >= i - reach]
        if polarity is None:
            open_.append((i, intensity or 1, bool(negates)))
            continue
        boost = 1.0
        for m in open_:
            boost *= m[1]
        turn = -0.5 if sum(m[2] for m in open_) % 2 else 1
        scores.append((max(-1, min(1, polarity * boost * turn)), min(1, subjectivity * boost)))
        open_ = []
    n = max(len(scores), 1)
    return round(sum(p for p, _ in scores) / n, 9), round(sum(s for _, s in scores) / n, 9)


def test_scoped_sentiment(spark, monkeypatch):
    rnd = random.Random(3)
    texts = ["not very good", "very very very good", "not not bad", "not a b c good", "not a b good", "hardly bad not", "", "plain words", None]
    texts += [" ".join(rnd.choice(["good", "bad", "very", "hardly", "not", "x", "y"]) for _ in range(rnd.randint(0, 40))) for _ in range(80)]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    lexicon = spark.createDataFrame(LEXICON, "word string, polarity double, subjectivity double, intensity double, negates boolean")
    want = {i: plain_sentiment((t or "").split()) for i, t in enumerate(texts)}
    for large in (False, True):
        if large:
            monkeypatch.setattr(phrases, "bounded", lambda f: None)
        got = phrases.scoped_sentiment(df, "id", T.word_tokens(F.col("text")), lexicon).collect()
        assert {r.id: (round(r.polarity, 9), round(r.subjectivity, 9)) for r in got} == want
    assert want[0][0] == round(0.7 * 1.5 * -0.5, 9) and want[1][0] == 1


def test_lemmas_by_rule(spark):
    texts = ["cats cat cat running run run", "studies study flies buses bus", "was sing thing cats s"]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    rules = [("ies", "y"), ("es", ""), ("s", ""), ("ning", ""), ("ing", "")]
    exceptions = spark.createDataFrame([("was", "be"), ("absent", "x")], "form string, lemma string")
    got = {(r.id, r.lemma): r.n for r in vocabulary.lemma_counts(df, "id", T.word_tokens(F.col("text")), rules, exceptions).collect()}
    # cats is as frequent as cat, flies has no fly, sing and thing have no shorter word, s is too short
    assert got == {(0, "cat"): 3, (0, "run"): 3, (1, "study"): 2, (1, "flies"): 1, (1, "bus"): 2, (2, "be"): 1, (2, "sing"): 1, (2, "thing"): 1, (2, "cat"): 1, (2, "s"): 1}


def test_most_frequent_runs(spark, monkeypatch):
    rnd = random.Random(9)
    texts = [" ".join(rnd.choice(["ab", "cd", "longer", "words", "x"]) for _ in range(rnd.randint(0, 25))) for _ in range(60)] + [None, ""]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    counts = {}
    for t in texts:
        ws = (t or "").split()
        for n in (1, 2, 3):
            for i in range(len(ws) - n + 1):
                if n > 1 or len(ws[i]) >= 5:
                    counts[n, " ".join(ws[i : i + n])] = counts.get((n, " ".join(ws[i : i + n])), 0) + 1
    for k in (1, 4, 500):
        want = [(n, p, c) for n in (1, 2, 3) for c, p in sorted((-c, p) for (m, p), c in counts.items() if m == n)[:k]]
        want = sorted((n, p, -c) for n, p, c in want)
        for few in (1000, 2):
            monkeypatch.setattr(phrases, "_FEW", few)
            assert sorted(map(tuple, phrases.most_frequent(df, T.word_tokens(F.col("text")), [1, 2, 3], k, 5).select("n", "phrase", "c").collect())) == want


def test_phrases_with_and_without_a_join(spark, monkeypatch):
    df = spark.createDataFrame([(1, "the cat sat, the CAT sat on the cat"), (2, "a cat"), (3, None), (4, "")], "id long, text string")
    sought = spark.createDataFrame([("the cat", "A"), ("cat", "B"), ("cat sat on", "A"), ("absent", "C")], "phrase string, label string")
    want = sorted([(1, "the cat", 0, 2), (1, "the cat", 3, 5), (1, "the cat", 7, 9), (1, "cat", 1, 2), (1, "cat", 4, 5), (1, "cat", 8, 9), (1, "cat sat on", 4, 7), (2, "cat", 1, 2)])
    for few in (1000, 2):
        monkeypatch.setattr(phrases, "_FEW", few)
        assert sorted(map(tuple, phrases.phrase_match(df, "id", "text", sought, [1, 2, 3]).collect())) == want
        assert {(r.phrase, r.label) for r in phrases.phrase_match(df, "id", "text", sought, [1, 2, 3], "label").collect()} == {("the cat", "A"), ("cat", "B"), ("cat sat on", "A")}


def test_phrases_over_many_slices(spark, monkeypatch):
    """Pieces of few tokens, empty and null texts: the same as by hand, and no run crosses a text."""
    monkeypatch.setattr(vocabulary, "_SLICE", 3)
    texts = ["a b c a b", "", None, "b c", "a b a b a b c", "c", "c a b"]
    df = spark.createDataFrame(list(enumerate(texts)), "k long, text string").coalesce(1)
    words = [(t or "").split() for t in texts]
    got = phrases.most_frequent(df, F.split("text", " "), [1, 2], 2).collect()
    for n in (1, 2):
        runs = Counter(" ".join(w[i : i + n]) for w in words for i in range(len(w) - n + 1))
        assert {(r["phrase"], r["c"]) for r in got if r["n"] == n and r["phrase"]} == set(sorted(runs.items(), key=lambda x: (-x[1], x[0]))[:2])
    sought = spark.createDataFrame([("a b",), ("c",), ("b c a",)], "phrase string")
    found = phrases.phrase_match(df, "k", "text", sought, [1, 2, 3]).collect()
    want = {(k, " ".join(w[i : i + n]), i, i + n) for k, w in enumerate(words) for n in (1, 2, 3) for i in range(len(w) - n + 1) if " ".join(w[i : i + n]) in ("a b", "c", "b c a")}
    assert {tuple(r) for r in found} == want and len(found) == len(want)


def test_join_bigrams_here_and_by_join(spark):
    """Overlapping pairs, repeated and null keys: both ways give the same."""
    rows = [(1, "a b a b c"), (2, "b a"), (3, ""), (4, None), (5, "x y"), (5, "x y"), (None, "a b"), (6, "c a b a")]
    df = spark.createDataFrame(rows, "k long, text string")
    tokens = F.filter(F.split("text", " "), lambda t: t != "")
    accepted = spark.createDataFrame([("a", "b"), ("b", "a"), ("c", "a")], "a string, b string")
    here = phrases.join_bigrams(df, "k", tokens, accepted)
    there = phrases._join_pairs(df, "k", tokens, accepted)
    key = lambda r: str((r["k"], r["tokens"]))
    assert sorted(map(key, here.collect())) == sorted(map(key, there.collect()))
    assert {r["k"]: r["tokens"] for r in here.collect()}[1] == ["a_b", "a_b", "c"]


def test_document_vectors_with_gaps_and_copies(spark, monkeypatch):
    """Several blocks of vectors, a word with two vectors, missing components, repeated and unknown words."""
    monkeypatch.setattr(vocabulary, "_VECTORS", 2)
    df = spark.createDataFrame([(1, "a b a"), (2, "c d"), (3, "zz"), (4, None), (1, "b")], "k long, text string")
    vectors = spark.createDataFrame([("a", [1.0, 2.0]), ("b", [3.0, None]), ("c", [1.0, 1.0]), ("c", [5.0, 1.0]), ("d", [0.0, None])], "word string, vector array<float>")
    out = vocabulary.document_vectors(df, "k", F.split("text", " "), vectors, 2)
    got = {r["k"]: r["vector"] for r in out.collect()}
    assert got[1] == [2.0, 1.0] and got[2] == [2.0, 2 / 3] and got[3] == [0.0, 0.0] and got[4] == [0.0, 0.0]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan  # vectors meet words in blocks, none is sent on per word


def test_lemma_counts_send_words_once(spark):
    df = spark.createDataFrame([(1, "cats cat cat dogs"), (2, "cat cats"), (1, "cats"), (3, None)], "k long, text string")
    none = spark.createDataFrame([], "form string, lemma string")
    out = vocabulary.lemma_counts(df, "k", F.split("text", " "), [("s", "")], none)
    assert {(r["k"], r["lemma"], r["n"]) for r in out.collect()} == {(1, "cat", 4), (1, "dogs", 1), (2, "cat", 2)}
    assert out._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") <= 2  # once, listed twice


def test_packed_texts_and_numbers():
    texts = pa.array(["", "é€", "a" * 300, "b"])
    assert vocabulary.unpacked_texts(*vocabulary.packed_texts(texts)).to_pylist() == texts.to_pylist()
    assert vocabulary.unpacked_texts(*vocabulary.packed_texts(texts.slice(0, 0))).to_pylist() == []
    for x in ([], [0, 255], [256], [1 << 40, 3]):
        assert vocabulary.unpacked(vocabulary.packed(np.array(x, np.int64))).tolist() == x


def test_document_vectors_over_blocks(spark, monkeypatch):
    """Words over several blocks, repeated and null keys, some words with two vectors; texts are sent in few rows."""
    monkeypatch.setattr(vocabulary, "_VECTORS", 4)
    rng = np.random.default_rng(9)
    texts = [(i // 2 if i % 7 else None, " ".join(f"wörd{k}" for k in rng.integers(0, 30, rng.integers(0, 12)))) for i in range(60)]
    given = [(f"wörd{k % 18}", [float(x) for x in rng.normal(size=3)]) for k in range(20)]
    df, vectors = spark.createDataFrame(texts, "k long, t string"), spark.createDataFrame(given, "word string, vector array<double>")
    out = vocabulary.document_vectors(df, "k", F.split("t", " "), vectors, 3)
    sums, known = {}, {}
    for k, t in texts:
        for w in t.split(" "):
            for word, v in given:
                if word == w:
                    sums[k], known[k] = sums.get(k, 0) + np.array(v), known.get(k, 0) + 1
    rows = out.collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = sums[r["k"]] / known[r["k"]] if r["k"] in known and r["k"] is not None else np.zeros(3)
        assert r["vector"] == pytest.approx(want)
    plan = out._jdf.queryExecution().toString()
    assert "letters" in plan  # slices as bytes, not a row per word of a text


def test_pair_counts_by_buckets(spark):
    """Against plain counts: pairs and words below the least count still count for V, and are not handed on."""
    rnd = random.Random(4)
    texts = [[f"w{min(rnd.randrange(40), rnd.randrange(40))}é" for _ in range(rnd.randrange(12))] for _ in range(300)] + [None, []]
    df = spark.createDataFrame([(t,) for t in texts], "t array<string>").repartition(5)
    words = Counter(w for t in texts if t for w in t)
    pairs = Counter(p for t in texts if t for p in zip(t, t[1:], strict=False))
    total = len(words) + len(pairs)
    want = {(a, b): (n, (n - 3) / words[a] / words[b] * total) for (a, b), n in pairs.items() if n >= 3 and (n - 3) / words[a] / words[b] * total > 0.5}
    out = phrases.bigram_phrases(df, F.col("t"), min_count=3, threshold=0.5)
    got = {(r["a"], r["b"]): (r["n_ab"], r["score"]) for r in out.collect()}
    assert set(got) == set(want) and len(want) > 5 and all(got[k] == pytest.approx(want[k]) for k in want)
    assert phrases.bigram_phrases(df.limit(0), F.col("t")).count() == 0
