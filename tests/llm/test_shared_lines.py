"""Line dedup and benchmark overlap against plain Python."""

import itertools
import random
import re

import awkward
import pytest

from millrace.llm import decontaminate, lines
from millrace.llm.queries import queries
from millrace.llm.words import NULL_ID

SMALL = "/root/testdata/sf0.001"

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_line_dedup(spark):
    rnd = random.Random(3)
    pool = [" ".join(rnd.choice(awkward.vocabulary()) for _ in range(rnd.randint(1, 4))) for _ in range(12)]
    more = ["\n".join(rnd.choice(["", " ", "", "  "]) + rnd.choice(pool + ["", "   "]) for _ in range(rnd.randint(1, 14))) for _ in range(120)]
    more += ["a\nb\nc\nd\na\nb\nc\nd", "a\nb\nc", "q\nq\nq\nq\nq\nq", more[0], more[0]]
    data = awkward.rows(more)
    df = awkward.frame(spark, data)
    key = {r.text: r.key_ for r in df.selectExpr("text", "xxhash64(coalesce(text, '')) AS key_").collect()}

    def split(text):
        return [(k, tuple(WORD.findall(x))) for k, x in enumerate((text or "").split("\n")) if WORD.search(x)]

    first = {}
    for x in data:
        ls = split(x[1])
        for i in range(len(ls) - 2):
            run = tuple(y for _, y in ls[i : i + 3])
            place = (NULL_ID if x[0] is None else x[0], key[x[1]], i)
            first[run] = min(place, first.get(run, place))
    want = []
    for x in data:
        ls = split(x[1])
        gone = set()
        for i in range(len(ls) - 2):
            if first[tuple(y for _, y in ls[i : i + 3])] < (NULL_ID if x[0] is None else x[0], key[x[1]], i):
                gone |= {i, i + 1, i + 2}
        numbers = {ls[i][0] for i in gone}
        text = x[1] if not gone else "\n".join(y for k, y in enumerate(x[1].split("\n")) if k not in numbers)
        want.append((str(x[0]), str(text), len(gone), len(ls) - len(gone)))
    out = lines.dedup(df)
    assert out.columns == [*df.columns, "n_lines_deleted", "n_lines_left"]
    got = [(str(r.doc_id), str(r.text), r.n_lines_deleted, r.n_lines_left) for r in out.collect()]
    assert sorted(got) == sorted(want)
    assert sum(x[2] for x in want) > 50
    assert lines.dedup(lines.dedup(df.limit(0))).count() == 0


def brute_dedup(rows, key, words):
    """rows: (id, text); whole windows of lines as dictionary keys."""

    def split(text):
        return [(k, tuple(WORD.findall(x))) for k, x in enumerate((text or "").split("\n")) if WORD.search(x)]

    def windows(ls):
        for n in (1, 2, 3):
            for p in range(len(ls) - n + 1):
                if n == 3 or sum(len(y) for _, y in ls[p : p + n]) >= words:
                    yield p, n, tuple(y for _, y in ls[p : p + n])

    first, out = {}, []
    place = lambda i, t, p: (NULL_ID if i is None else i, key[t], p)
    for i, t in rows:
        for p, _, run in windows(split(t)):
            first[run] = min(place(i, t, p), first.get(run, place(i, t, p)))
    for i, t in rows:
        ls = split(t)
        gone = {q for p, n, run in windows(ls) if first[run] < place(i, t, p) for q in range(p, p + n)}
        numbers = {ls[q][0] for q in gone}
        left = t if not gone else "\n".join(y for k, y in enumerate(t.split("\n")) if k not in numbers)
        out.append((str(i), str(left), len(gone), len(ls) - len(gone)))
    return sorted(out)


def keys_of(df):
    return {r.text: r.key_ for r in df.selectExpr("text", "xxhash64(coalesce(text, '')) AS key_").collect()}


@pytest.mark.parametrize("words", [5, 12, lines.WORDS])
def test_dedup_with_any_least_words(spark, words):
    """Few lines in many contexts, so that places often disagree with the first one of their fingerprint."""
    rnd = random.Random(words)
    pool = [" ".join(rnd.choice(awkward.vocabulary()) for _ in range(rnd.randint(1, 9))) for _ in range(9)]
    more = ["\n".join(rnd.choice(pool + [""]) for _ in range(rnd.randint(1, 9))) for _ in range(150)]
    data = awkward.rows(more)
    df = awkward.frame(spark, data)
    got = [(str(r.doc_id), str(r.text), r.n_lines_deleted, r.n_lines_left) for r in lines.dedup(df.repartition(5), words=words).collect()]
    assert sorted(got) == brute_dedup([x[:2] for x in data], keys_of(df), words)


def test_query_and_how_many_lines_it_writes(spark, monkeypatch):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    written = []
    plain = lines.later
    monkeypatch.setattr(lines, "later", lambda prints, place: written.append(prints.count()) or plain(prints, place))
    got = [(str(r.doc_id), str(r.text), r.n_lines_deleted, r.n_lines_left) for r in queries()["op8_line_dedup"](spark, SMALL).collect()]
    assert sorted(got) == brute_dedup([tuple(r) for r in docs.collect()], keys_of(docs), lines.WORDS)
    every = sum(1 for r in docs.collect() for x in (r.text or "").split("\n") if WORD.search(x))
    assert 0 < written[0] < 0.9 * every  # winnowing thins the lines


def test_clashing_columns(spark):
    names = ["id", "key", "at", "print", "own", "windows", "marks", "row", "own_id", "own_key", "__at", "__text_key", "b0", "x.y", "n_lines_left"]
    df = spark.createDataFrame([(i, "a\nb\nc", *range(len(names))) for i in range(3)], ["doc_id", "text", *names])
    out = lines.dedup(df)
    assert out.columns == ["doc_id", "text", *names[:-1], "n_lines_deleted", "n_lines_left"]
    assert sorted((r.doc_id, r.text, r["x.y"], r.n_lines_deleted) for r in out.collect()) == [(0, "a\nb\nc", 13, 0), (1, "", 13, 3), (2, "", 13, 3)]


def test_long_lines_and_pairs(spark):
    """Copies of one or two lines go if they have WORDS words, whatever stands around them."""
    say = lambda name, n: " ".join(f"{name}{k}" for k in range(n))
    one, less, a, b, half = say("one", 64), say("less", lines.WORDS - 1), say("a", 30), say("b", lines.WORDS - 30), say("h", 25)
    texts = [
        f"top\n{one}\nend", f"p\nq\n\n{one}\nr", one,  # in longer documents, and as a whole document
        f"{a}\n{b}", f"x\n{a}\n \n{b}\ny", f"{a}\nz\n{b}", f"{a}\n{b}",  # two lines of 50 words together
        less, less, f"{half}\nm", f"n\n{half}",  # too short
        f"s\n{one}\n{half}", f"t\n{one}\n{half}\nu",  # the line after a long one is part of the match
        f"{one} {one}\n{one} {one}",  # twice in one document
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.text, r.n_lines_deleted) for r in lines.dedup(df).collect()}
    changed = {1: ("p\nq\n\nr", 1), 2: ("", 1), 4: ("x\n \ny", 2), 6: ("", 2), 11: (f"s\n{half}", 1), 12: ("t\nu", 2), 13: (f"{one} {one}", 1)}
    assert got == {i: changed.get(i, (t, 0)) for i, t in enumerate(texts)}


def test_masks_find_two_substitutions():
    n = decontaminate.MIN_WORDS
    for lost in itertools.combinations(range(n), n - decontaminate.MIN_EQUAL):
        assert any(all(o + x not in lost for x in m) for m in decontaminate.MASKS for o in range(n - m[-1]))


def brute_overlap(text, item):
    words, other = (WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), x or "")) for x in (text, item))
    best = 0
    for shift in range(-len(other), len(words)):
        best = max(best, decontaminate.aligned([w.encode() for w in words], [w.encode() for w in other], shift)[0])
    return best


def test_benchmark_overlap(spark):
    rnd = random.Random(8)
    vocab = awkward.vocabulary(300)
    say = lambda n: [rnd.choice(vocab) for _ in range(n)]
    items = [(i, " ".join(say(n))) for i, n in enumerate([5, 12, 13, 14, 30, 60, 60])] + [(7, None), (8, ""), (9, " ".join(say(40))), (9, "x y"), (None, " ".join(say(20)))]
    more = []
    for _ in range(120):
        ws = (rnd.choice(items)[1] or "").split()
        a = rnd.randint(0, max(0, len(ws) - 13))
        ws = ws[a : a + rnd.randint(10, 40)]
        for _ in range(rnd.randint(0, 4)):
            if ws:
                ws[rnd.randrange(len(ws))] = rnd.choice(vocab)
        more.append(" ".join(say(rnd.randint(0, 20)) + [w.upper() if w.isascii() and rnd.random() < 0.2 else w for w in ws] + say(rnd.randint(0, 20))))
    data = awkward.rows(more)
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = {}
    for x in data:
        for i, t in items:
            if n := brute_overlap(x[1], t):
                want[x[0], i] = max(n, want.get((x[0], i), 0))
    got = {(r.doc_id, r.item_id): r.n_equal for r in decontaminate.overlaps(awkward.frame(spark, data), bench).collect()}
    assert got == want and len(want) > 30
    left = [r.doc_id for r in decontaminate.clean(awkward.frame(spark, data), bench).select("doc_id").collect()]
    assert sorted(map(str, left)) == sorted(str(x[0]) for x in data if x[0] not in {d for d, _ in want})
    assert decontaminate.overlaps(awkward.frame(spark, data), bench.limit(0)).count() == 0
    assert decontaminate.overlaps(awkward.frame(spark, data).limit(0), bench).count() == 0
