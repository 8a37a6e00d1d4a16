"""Operators that treat one document or page at a time, against plain Python."""

import base64
import hashlib
import io
import math
import random
import re
import struct
import unicodedata
from collections import Counter

import awkward
import pytest
from pyspark.sql import functions as F

from millrace.llm import bpe, chat, pii, quality, warc
from millrace.llm.queries import OK, queries, tokenizer_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SMALL = "/root/testdata/sf0.001"


def base_counts(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    found = Counter(grams)
    twice = {g for g in grams if found[g] > 1}
    covered = {i + j for i, g in enumerate(grams) if g in twice for j in range(5)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_quality_counts(spark):
    more = ["a b c d e a b c d e f", "same\nsame\n\nsame \n", "#*$%&|<> É ÀB", "x " * 4 + "y", "p q r s t u p q r s t u v p q"]
    data = awkward.rows(more)
    got = quality.features(awkward.frame(spark, data)).select("text", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words").collect()
    assert len(got) == len(data)
    for r in got:
        assert tuple(r)[1:] == base_counts(r.text), r.text


def test_binomial_tail(spark):
    cases = [(k, n, p) for n in (1, 7, 300, 4000) for k in (0, 1, 5, 30) for p in (0.004, 0.3) if k < n * p]
    for k, n, p in cases:
        want = sum(math.exp(math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log(1 - p)) for i in range(k + 1))
        got = spark.range(1).select(F.lit(k).cast("long").alias("k"), F.lit(n).cast("long").alias("n")).select(quality._binomial_tail("k", "n", p)).first()[0]
        assert got == pytest.approx(want, rel=1e-9)


def rule_scores(text):
    """The scores of all rules from plain counts."""
    text = text or ""
    words = WORD.findall(text)
    n, chars, symbols, dup_lines, repeats = base_counts(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return {
        "symbols": symbols / max(chars, 1),
        "capitals": sum(unicodedata.category(c) == "Lu" for c in text) / max(chars, 1),
        "marks": len(re.findall("[!?]", text)) / max(n, 1),
        "repeats": repeats / max(n, 1),
        "lines": dup_lines / max(len(lines), 1),
        "same_words": (n - len(set(words))) / max(n, 1),
    }


def base_rule(text):
    n, *_, repeats = base_counts(text)
    return n < 10 or 100 * repeats > 20 * n


def plain_cutoffs(docs, labels, planning, risk=0.05, delta=0.05, cost=20):
    """docs: (id, text, stratum), labels: (id, quality), planning: ids of the planning half."""
    truth = {}
    for i, q in labels:
        if q is not None:
            truth[i] = min(q, truth.get(i, 1))
    held = [(s, truth[i], i in planning, rule_scores(t)) for i, t, s in docs if i is not None and i in truth and not base_rule(t)]
    strata = {s for s, *_ in held}
    out = {}
    for s in strata:
        plan = []
        for r in quality.RULES:
            gains = [(sum(1 if not q else -cost for s_, q, p, x in held if s_ == s and p and x[r] > c), c) for c in quality.STEPS]
            gain, cut = max(gains)
            if gain > 0:
                plan.append((-gain, r, cut))
        plan.sort()
        good = [x for s_, q, p, x in held if s_ == s and q and not p]
        m = 0
        while m < len(plan):
            k = sum(any(x[r] > c for _, r, c in plan[: m + 1]) for x in good)
            n = len(good)
            tail = sum(math.comb(n, j) * risk**j * (1 - risk) ** (n - j) for j in range(k + 1)) if n and k < risk * n else 1
            if tail > delta / len(strata):
                break
            m += 1
        if m:
            out[s] = {r: c for _, r, c in plan[:m]}
    return out


def planning_ids(spark, ids):
    df = spark.createDataFrame([(i,) for i in ids], "id long")
    return {r.id for r in df.where("pmod(xxhash64(id), 2) = 0").collect()}


def test_cutoffs_limit_false_rejections(spark):
    rnd = random.Random(4)
    words = awkward.vocabulary(400)
    data, labels = [], []
    for i in range(3000):
        good = i % 3 > 0
        ws = [rnd.choice(words) for _ in range(40)]
        if not good:
            ws = [w + "###" for w in ws]
        elif i % 50 == 1:
            ws = [w + "!" for w in ws]  # good, and loud as some of the bad ones
        if i % 9 == 0:
            ws = [w.upper() + "!" for w in ws]
        data.append((i, " ".join(ws), ["en", "en", "fr", None, "few"][0 if i % 10 < 7 else 2 if i % 10 == 7 else 3 if i % 10 == 8 or i > 200 else 4]))
        labels.append((i, int(good)))
    labels += [(None, 1), (5, None), (9, None), (7, 0)]
    docs = quality.features(spark.createDataFrame(data, "doc_id long, text string, lang string"))
    cuts = quality.cutoffs(docs, spark.createDataFrame(labels, "doc_id long, quality int"))
    found = {r.stratum: r.cuts for r in cuts.collect()}
    want = plain_cutoffs(data, labels, planning_ids(spark, [d[0] for d in data]))
    assert found == want and "symbols" in found["en"] and {"en", "fr", None} <= set(found) and "few" not in found
    kept = {r.doc_id: r.kept for r in quality.judge(docs, cuts).collect()}
    for i, t, s in data:
        assert kept[i] == (not base_rule(t) and not any(rule_scores(t)[r] > c for r, c in want.get(s, {}).items()))
    bad_en = [i for i, _, s in data if i % 3 == 0 and s == "en"]
    assert not any(kept[i] for i in bad_en)
    good = [i for i, _, s in data if i % 3 and s == "en"]
    assert sum(not kept[i] for i in good) <= 0.05 * len(good)


def test_query_keeps_what_plain_cutoffs_keep(spark):
    table = lambda name: spark.read.parquet(f"/root/testdata/sf0.01/{name}.parquet")
    docs = [tuple(r) for r in table("documents").select("doc_id", "text", "lang").collect()]
    labels = [tuple(r) for r in table("labels").select("doc_id", "quality").collect()]
    cuts = plain_cutoffs(docs, labels, planning_ids(spark, [i for i, _ in labels]))
    got = {r.doc_id: r for r in queries()["op1_quality_rules"](spark, "/root/testdata/sf0.01").collect()}
    for i, t, s in docs:
        over = [r for r, c in cuts.get(s, {}).items() if rule_scores(t)[r] > c]
        assert (got[i].base_failed, got[i].kept, sorted(got[i].rejected_by)) == (base_rule(t), not base_rule(t) and not over, sorted(over))
    assert cuts  # the labels of this table certify some cutoff


def test_quality_edges(spark):
    docs = quality.features(awkward.frame(spark, awkward.rows()))
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    out = quality.judge(docs, quality.cutoffs(docs, none))
    assert out.count() == len(awkward.rows()) and out.where("kept = base_failed").count() == 0
    assert quality.judge(docs.limit(0), quality.cutoffs(docs.limit(0), none)).count() == 0


def luhn(s):
    d = [int(c) for c in s if c.isdigit()][::-1]
    return sum(x if i % 2 == 0 else 2 * x - 9 * (x > 4) for i, x in enumerate(d)) % 10 == 0


def base_spans(text):
    out = []
    digits = lambda s: re.sub(r"[^0-9]", "", s)
    for kind, pattern, ok in (
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(x) <= 255 for x in s.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda s: 13 <= len(digits(s)) <= 19 and luhn(s)),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 9 <= len(digits(s)) <= 15),
    ):
        out += [f"{kind}:{m.start()}:{m.end()}" for m in re.finditer(pattern, text or "") if ok(m[0])]
    return out


def test_personal_data(spark):
    rnd = random.Random(7)
    parts = ["a.b+c@d-e.fr", "x@y", "@", ".", "1.2.3.4", "300.1.1.1", "0001.0.255.00255.7", "4041894974608795", "4041-8949 7460 8795", "40418949746087951", "+1 (988) 555-2485", "+12", "+1 ((( 2", "é", "😀", " ", "\n", "-", "a_b%c", "1234", "+49 30 1234567", "z@q.w.e-r.t@u.v", "7" * 40, "٣٤٥"]
    more = ["".join(rnd.choice(parts) + rnd.choice(["", " ", "\n", "."]) for _ in range(rnd.randint(1, 60))) for _ in range(150)]
    more += ["a" * 40000, "1 " * 9000 + "4041894974608795", "9." * 9000, "u@v.w " * 3000, "a.a." * 4000 + "@b.c" + ".d" * 6000]
    data = awkward.rows(more)
    got = pii.find(awkward.frame(spark, data)).selectExpr("text", "transform(entities, x -> concat_ws(':', x.kind, x.start, x.end)) AS s", "email").collect()
    assert len(got) == len(data)
    for r in got:
        base = [x for x in r.s if x.split(":")[0] in pii.BASE]
        assert base == base_spans(r.text), (r.text or "")[:200]


def planted(rnd):
    """{kind: a function that writes one}."""
    pick = lambda chars, n: "".join(rnd.choice(chars) for _ in range(n))
    digits, hexes, letters = "0123456789", "0123456789abcdef", "abcdefghijklmnopqrstuvwxyz"
    both = letters + letters.upper() + digits

    def card():
        body = pick(digits, 15)
        last = next(d for d in digits if luhn(body + d))
        return rnd.choice([body + last, "-".join((body + last)[i : i + 4] for i in range(0, 16, 4))])

    def iban():
        country, body = rnd.choice(["DE", "FR", "GB"]), pick(digits, 18)
        for check in range(2, 99):
            plain = f"{country}{check:02d}{body}"
            if int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1:
                return plain

    name = lambda: rnd.choice(["token", "api_key", "SECRET", "client_secret", "password", "db_passwd", "access-token"])
    return {
        "email": lambda: f"{pick(letters, 6)}.{pick(letters, 4)}@{pick(letters, 7)}.{rnd.choice(['com', 'co.uk', 'de'])}",
        "ip": lambda: ".".join(str(rnd.randint(0, 255)) for _ in range(4)),
        "card": card,
        "phone": lambda: f"+{rnd.randint(1, 99)} {pick('123456789', 3)} {pick(digits, 3)} {pick(digits, 4)}",
        "iban": lambda: "account " + iban(),
        "ssn": lambda: f"social security {pick(digits, 3)}-{pick(digits, 2)}-{pick(digits, 4)}",
        "local_phone": lambda: f"call ({pick('23456789', 3)}) {pick('23456789', 3)}-{pick(digits, 4)}",
        "assigned": lambda: name() + rnd.choice([" = ", "=", ": ", '": ']) + '"' + rnd.choice([pick(hexes, 40), pick(both, 16), pick(both + "!$%*-_", 20)]) + '"',
        "bare_value": lambda: name() + rnd.choice(["=", ": ", " = "]) + pick(both, 12) + pick(digits, 8) + pick(letters, 8),
        "key_format": lambda: rnd.choice(["AKIA" + pick(letters.upper() + digits, 16), "ghp_" + pick(both, 36), "sk_live_" + pick(both, 24), "xoxb-" + pick(digits, 11) + "-" + pick(both, 24)]),
        "private_key": lambda: "-----BEGIN RSA PRIVATE KEY-----\n" + "\n".join(pick(both + "+/", 64) for _ in range(3)) + "\n-----END RSA PRIVATE KEY-----",
        "signed_token": lambda: "eyJ" + pick(both, 20) + ".eyJ" + pick(both + "-_", 40) + "." + pick(both + "-_", 43),
    }


def test_recall_of_every_kind(spark):
    rnd = random.Random(12)
    kinds = planted(rnd)
    assert set(kinds) == set(pii.PATTERNS)
    words = awkward.vocabulary(300)
    say = lambda: " ".join(rnd.choice(words) for _ in range(rnd.randint(3, 30)))
    rows = [(f"{kind}:{i}", f"{say()}{rnd.choice([' ', chr(10)])}{write()}{rnd.choice([' ', '.', ',', chr(10)])} {say()}") for kind, write in kinds.items() for i in range(60)]
    clean = [(f"clean:{i}", f"{say()} the token is a key: {say()}") for i in range(200)]
    found = {r.id: {x.kind for x in r.entities} for r in pii.find(spark.createDataFrame(rows + clean, "id string, text string")).collect()}
    for kind in kinds:
        caught = sum(kind in found[f"{kind}:{i}"] for i in range(60))
        assert caught >= 54, (kind, caught)
    assert sum(bool(found[f"clean:{i}"]) for i in range(200)) <= 2
    for i, t in rows:
        base = [x for x in pii.BASE if any(s.startswith(x + ":") for s in base_spans(t))]
        assert set(base) == found[i] & set(pii.BASE)


def test_secrets_of_the_table_are_found(spark):
    docs = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()]
    planted_in = {i for i, t in docs if re.search('token = "[0-9a-f]{40}"', t or "")}
    got = {r.doc_id: r.spans for r in queries()["op5_personal_data"](spark, "/root/testdata/sf0.01").collect()}
    assert len(planted_in) > 5 and all("assigned:" in got[i] for i in planted_in)
    for i, t in docs:
        for x in filter(lambda x: x.startswith("assigned:"), got[i].split(",")):
            a, b = map(int, x.split(":")[1:])
            assert t[a - 1] + t[b] in ("''", '""') and not re.search(r"\s", t[a:b])


def test_added_kinds_need_checksum_or_context(spark):
    cases = {
        "iban DE89 3704 0044 0532 0130 00 x": ["iban"],
        "iban DE88 3704 0044 0532 0130 00 x": [],
        "my ssn is 123-45-6789.": ["ssn"],
        "part 123-45-6789.": [],
        "call (555) 123-4567 now": ["local_phone"],
        "it is (555) 123-4567 now": [],
    }
    df = spark.createDataFrame([(t,) for t in cases], "text string")
    for r in pii.find(df).collect():
        assert [e.kind for e in r.entities] == cases[r.text], r.text


TOKENIZERS = ["word_bpe_49k.json", "byte_bpe_50k.json"]


@pytest.mark.parametrize("name", TOKENIZERS)
def test_pieces_cut_anywhere_join_exactly(name):
    """Every cut of awkward texts, and trees of small pieces."""
    path = tokenizer_path(name)
    tok = bpe.load(path)
    assert bpe.drops_space(path) == name.startswith("word")
    rnd = random.Random(7)
    bits = ["the", " ", "  ", "\n", "\t", "don't", "'s", "'", "ß", "é", "e\u0301", "\u0301", "漢字", "😀", "👩\u200d👩", "12", "3.5", "<|endoftext|>", "<|end", "oftext|>", "Σς", "a" * 40, "\x00", "...", "\u2028", "\xa0", "   \n \n", "hello world "]
    for size in (1, 2, 3, 5, 30, 120, 400):
        for _ in range(12):
            text = "".join(rnd.choice(bits) for _ in range(size))
            want = tok.encode(text, add_special_tokens=False).ids
            for piece in (3, 17, 100):
                parts, at = [], 0
                for x in bpe.equal_parts(text, piece):
                    parts.append(bpe.Piece.of(tok, x, at))
                    at += len(x)
                got = bpe.tree(tok, text, parts)
                assert got.ids.tolist() == want and (got.begin, got.end) == (0, len(text))
    text = "".join(rnd.choice(bits) for _ in range(60))
    whole = bpe.Piece.of(tok, text, 0)
    for c in range(len(text) + 1):
        got = bpe.join(tok, text, bpe.Piece.of(tok, text[:c], 0), bpe.Piece.of(tok, text[c:], c))
        for f in ("ids", "starts", "ends", "words"):
            assert getattr(got, f).tolist() == getattr(whole, f).tolist()


def test_windows_stay_small():
    """A join encodes a short window of a long text anew, not the text."""
    tok = bpe.load(tokenizer_path("word_bpe_49k.json"))
    rnd = random.Random(1)
    text = " ".join(rnd.choice(awkward.vocabulary(200)) for _ in range(20000))
    a, b = text[: len(text) // 2], text[len(text) // 2 :]
    parts = [bpe.Piece.of(tok, a, 0), bpe.Piece.of(tok, b, len(a))]
    seen = []

    class Watched:
        def encode(self, t, **k):
            seen.append(len(t))
            return tok.encode(t, **k)

    assert bpe.join(Watched(), text, *parts).ids.tolist() == tok.encode(text, add_special_tokens=False).ids
    assert 0 < sum(seen) < 1000


def test_bpe_query_and_its_long_documents(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    path = tokenizer_path("word_bpe_49k.json")
    tok = bpe.load(path)
    got = {r.doc_id: r for r in queries()["op9_bpe"](spark, folder).collect()}
    long = 0
    for i, t in docs:
        ids = tok.encode(t or "", add_special_tokens=False).ids
        digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
        assert tuple(got[i])[1:] == (len(ids), digest(" ".join(map(str, ids))), digest(tok.decode(ids, skip_special_tokens=False)))
        # more than one piece of one segment: these are joined up the tree
        rows = list(bpe.cut(t or "", 32_768, tok, True))
        long += len(rows) > 1 and {(r[0], r[1]) for r in rows} == {(0, 0)}
    assert len(got) == len(docs) and long > 0


@pytest.mark.parametrize("name", TOKENIZERS)
def test_bpe_equals_the_tokenizer(spark, name):
    path = tokenizer_path(name)
    tok = bpe.load(path)
    rnd = random.Random(2)
    pool = "aaaabcdefghinrstéßñ漢字😀12'’#.Éá ſΣς"
    more = ["".join(rnd.choice(pool) for _ in range(n)) for n in (40, 99, 400, 3000, 9000)]
    more += ["the" * 900, "ab" * 2500 + " " + "ba" * 700, "x<|endoftext|>" * 40 + "y" * 500, "'s" * 300, "á" * 400, "word " * 500 + "z" * 3000]
    data = awkward.rows(more)
    got = bpe.encode(awkward.frame(spark, data), path, piece=64).collect()
    assert len(got) == len(data)
    have = sorted((str(r.doc_id), r.ids, r.decoded) for r in got)
    want = []
    for x in data:
        ids = tok.encode(x[1] or "", add_special_tokens=False).ids
        want.append((str(x[0]), ids, tok.decode(ids, skip_special_tokens=False)))
    for a, b in zip(have, sorted(want), strict=True):
        assert a == b


def test_fragments_join_exactly():
    f = bpe.fragments(tokenizer_path("word_bpe_49k.json"))
    rnd = random.Random(5)
    for alphabet in ("ab", "the", "aeinorst", "a"):
        for n in (1, 2, 37, 500):
            word = "".join(rnd.choice(alphabet) for _ in range(n))
            for piece in (1, 3, 50):
                parts = [word[i : i + piece] for i in range(0, n, piece)]
                coded = [(*f.encode(p, k == len(parts) - 1), p, k == len(parts) - 1) for k, p in enumerate(parts)]
                assert f.tree(coded) == f.encode(word, True)[0]


def test_warc_round_trip(spark, tmp_path):
    rnd = random.Random(1)
    bodies = [b"", b"small", b"s" * 999, b"t" * 1000, b"t" * 1000, b"t" * 1000, "é漢".encode() * 900, b"\r\n\r\nWARC/1.1" * 200] + [bytes(rnd.choices(range(256), k=rnd.randint(0, 5000))) for _ in range(200)]
    data = [(f"r{i}", None if i == 3 else f"http://x/{i}\r\nbad: header", b, None) for i, b in enumerate(bodies)] + [("rev", "u", b"t" * 1000, "r5"), (None, None, None, None)]
    df = spark.createDataFrame(data, "record_id string, uri string, payload binary, refers_to string").repartition(3)
    paths = warc.write(df, tmp_path.as_uri(), archive_bytes=60_000)
    paths.write.parquet(str(tmp_path / "list"))
    paths = spark.read.parquet(str(tmp_path / "list"))
    assert paths.count() > 5 and paths.agg(F.sum("records")).first()[0] == len(data)
    got = {r.record_id: r for r in warc.read(paths, tmp_path.as_uri()).collect()}
    assert len(got) == len(data) and all(r.problem is None for r in got.values())
    for i, b in enumerate(bodies):
        r = got[f"r{i}"]
        assert (bytes(r.payload), r.payload_bytes, r.payload_digest, r.record_type) == (b, len(b), hashlib.sha1(b).hexdigest(), "response")
    assert (got["rev"].record_type, got["rev"].refers_to, got["rev"].payload, got["rev"].payload_bytes) == ("revisit", "r5", None, 1000)
    assert warc.read(warc.write(df.limit(0), tmp_path.as_uri()), tmp_path.as_uri()).count() == 0


def test_warc_validates():
    import zstandard

    good = warc.record("a", "u", b"hello", None)
    assert warc.parse(good)["problem"] is None
    assert "digest" in warc.parse(good.replace(b"hello", b"hellO"))["problem"]
    assert "length" in warc.parse(good + b"x")["problem"]
    assert "warc-date" in warc.parse(good.replace(b"WARC-Date", b"WARC-Dato"))["problem"]
    assert warc.parse(b"nonsense")["problem"]
    raw = warc.dictionary([good] * 3, 1000)
    packed = zstandard.ZstdCompressor().compress(raw)  # the dictionary may itself be compressed
    frames = b"".join(zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(raw)).compress(good) for _ in range(4))
    for d in (raw, packed):
        data = struct.pack("<II", warc.SKIPPABLE, len(d)) + d + frames
        assert list(warc.unpack(io.BytesIO(data).read, chunk=7)) == [good] * 4
    with pytest.raises(ValueError):
        list(warc.unpack(io.BytesIO(data[:-3]).read))
    assert base64.b32encode(hashlib.sha1(b"hello").digest()) in good


def test_warc_query_marks_revisits(spark):
    import duckdb

    pages = duckdb.sql(f"SELECT page_id, encode(coalesce(html, '')) AS b FROM '{SMALL}/pages.parquet'").fetchall()
    largest = {}
    for i, b in pages:
        largest[b] = max(i, largest.get(b, i))
    got = {r.page_id: r for r in queries()["op2_warc"](spark, SMALL).collect()}
    assert len(got) == len(pages)
    for i, b in pages:
        to = largest[b] if len(b) >= 1000 and largest[b] != i else None
        r = got[i]
        assert (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, r.problem) == (len(b), hashlib.sha1(b).hexdigest(), "response" if to is None else "revisit", to, None)


def test_revisits_edges(spark):
    data = [(1, b"x" * 1000), (2, b"x" * 1000), (2, b"x" * 1000), (None, b"x" * 1000), (None, b"y" * 1000), (None, b"y" * 1000), (4, b"s"), (5, b"s"), (6, None)]
    df = spark.createDataFrame(data, "page_id long, payload binary")
    got = [(str(r.page_id), r.refers_to) for r in warc.mark_revisits(df, "page_id", "payload").collect()]
    want = [("1", 2), ("2", None), ("2", None), ("None", 2), ("None", None), ("None", None), ("4", None), ("5", None), ("6", None)]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_chat_round_trip(spark):
    path = tokenizer_path("byte_bpe_50k.json")
    rnd = random.Random(9)
    pieces = ["hi", "</s>", "[INST]", "[/INST]", "<|turn|>", "<|end|>", "\\", "\n", "<", "|", "é😀", "", "<<SYS>>", "\\<|", "<|endoftext|>"]
    data = []
    for c in range(60):
        shared = c % 4
        for t in range(rnd.randint(1, 6)):
            text = f"shared {shared} {t}" if t < 2 and c % 2 else "".join(rnd.choice(pieces) for _ in range(rnd.randint(0, 8)))
            data.append((c, t, ["system", "user", "assistant"][t % 3], None if (c, t) == (8, 0) else text, 1))
    data += [(100, None, None, "no turn", 1), (100, 3, "assistant", "z", 1), (None, 0, "user", "no id", 1), (101, 0, "a<|end|>b", "tie b", 1), (101, 0, "assistant", "tie a", 1)]
    df = spark.createDataFrame(data, "conv_id long, turn long, role string, text string, ids int")
    packs = chat.pack(chat.conversations(df), path, pack_tokens=150, partitions=3)
    got = {r.conv_id: r for r in chat.read(packs, path).collect()}
    want = {}
    for c, t, role, text, _ in sorted(data, key=lambda x: (str(x[0]), x[1] is not None, x[1] or 0, x[2] or "", x[3] or "")):
        want.setdefault(c, []).append((role or "", text or ""))
    assert set(got) == set(want)
    for c, turns in want.items():
        assert [tuple(t) for t in got[c].turns] == turns
        assert got[c].loss == "".join(x for r, x in turns if r == "assistant")
    rows = packs.collect()
    assert len(rows) > 3
    for p in rows:
        seen = set()
        for x in p.nodes:
            path_ = [(a.start, a.end) for a in x.ancestors] + [(x.start, x.end)]
            order = [i for a, b in path_ for i in range(a, b)]
            assert [p.positions[i] for i in order] == list(range(len(order)))  # positions run on along each path
            assert x.start not in seen
            seen.add(x.start)
        tokens = sum(x.end - x.start for x in p.nodes)
        assert tokens == len(p.ids)
    shared = sum(len(p.ids) for p in rows)
    alone = chat.pack(chat.conversations(df), path, pack_tokens=1, partitions=3).select(F.sum(F.size("ids"))).first()[0]
    assert shared < alone
    assert chat.pack(chat.conversations(df.limit(0)), path).count() == 0


def test_very_long_conversation(spark, monkeypatch):
    """20,000 turns in segments: intervals stay few, positions run on, all comes back."""
    monkeypatch.setattr(chat, "SEGMENT_TURNS", 256)
    path = tokenizer_path("byte_bpe_50k.json")
    n = 20_000
    data = [(5, t, ["user", "assistant"][t % 2], f"turn {t} says") for t in range(n)] + [(6, t, ["user", "assistant"][t % 2], f"turn {t} says") for t in range(300)]
    df = spark.createDataFrame(data, "conv_id short, turn int, role string, text string").repartition(4)
    packs = chat.pack(chat.conversations(df), path).cache()
    assert packs.select(F.explode("nodes").alias("x")).agg(F.max(F.size("x.ancestors"))).first()[0] <= 2
    got = {r.conv_id: r for r in chat.digests(packs, path).collect()}
    for c, m in ((5, n), (6, 300)):
        turns = [(r, t) for i, _, r, t in data if i == c]
        assert got[c].n_turns == m and got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
    rows = packs.collect()
    assert sorted(x for p in rows for x in p.positions)[-1] == max(x for p in rows for x in p.positions) > 100_000
    # the 300 shared turns stand once: those of the longer conversation plus no more than the other's own last segment
    assert sum(len(p.nodes) for p in rows) <= n + 300 - 256 + 256


def test_long_shared_first_turn_is_emitted_once_per_pack(spark):
    path = tokenizer_path("byte_bpe_50k.json")
    first = " ".join(f"word{i}" for i in range(6000))
    data = [(c, t, "user" if t == 0 else "assistant", first if t == 0 else f"answer {c} " * 20) for c in range(200) for t in range(2)]
    df = spark.createDataFrame(data, "conv_id string, turn long, role string, text string")
    packs = chat.pack(chat.conversations(df), path, partitions=1).collect()
    shared = max(x.end - x.start for p in packs for x in p.nodes)
    assert shared > 10_000 and len(packs) < 6
    assert sum(x.end - x.start == shared for p in packs for x in p.nodes) == len(packs)
    assert sum(len(p.leaves) for p in packs) == 200


def test_ids_of_any_type(spark):
    path = tokenizer_path("byte_bpe_50k.json")
    for kind, ids in (("short", [1, 2]), ("int", [1, 2]), ("string", ["a", "b"]), ("double", [0.5, 1.5]), ("date", ["2020-01-01", "2021-01-01"])):
        df = spark.createDataFrame([(str(i), "user", f"of {i}") for i in ids], "c string, role string, text string").selectExpr(f"CAST(c AS {kind}) AS conv_id", "1 AS turn", "role", "text", "1 AS path", "2 AS segment")
        packs = chat.pack(chat.conversations(df), path)
        back = chat.read(packs, path)
        assert dict(back.dtypes)["conv_id"] == dict(df.dtypes)["conv_id"] and back.count() == 2 and chat.digests(packs, path).count() == 2


def test_chat_query(spark):
    import duckdb

    rows = duckdb.sql(f"SELECT conv_id, role, coalesce(text, '') FROM '{SMALL}/conversations.parquet' ORDER BY conv_id, turn").fetchall() + [(-1, "user", OK), (-1, "assistant", OK)]
    convs = {}
    for c, r, t in rows:
        convs.setdefault(c, []).append((r, t))
    got = {r.conv_id: r for r in queries()["op3_chat_tree"](spark, SMALL).collect()}
    assert set(got) == set(convs)
    for c, turns in convs.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        assert got[c].n_turns == len(turns) and got[c].loss_chars == len(loss)
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert got[c].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
        text = "".join(f"<|turn|>{chat.escape(r)}\n{chat.escape(t)}<|end|>\n" for r, t in turns)
        assert got[c].formatted_chars == len(text)
