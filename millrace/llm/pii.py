"""Personal data and secrets: regular expressions propose spans, checks confirm them, nearby words adjust the score.

Checks are the Luhn and modulo-97 sums, the parts of an address, numbers of digits, and for values that are assigned to a
name such as token or password the entropy of their characters.

DataFrame functions only. Positions come from splitting the text at the matches: the lengths of gaps and matches add up
to offsets in code points. Patterns are written so that the engine never looks at a run of characters twice: a match may
only begin where a run begins or where the last match ended (``\\G``), and repetitions give nothing back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BASE = ("email", "ip", "card", "phone")

_NAME = r"(?:token|key|secret|passw(?:or)?d|passwd|pwd|passphrase|credentials?)"

#: kind -> (pattern, characters without which it cannot match; an expression if it begins with a slash)
PATTERNS = {
    "email": (r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@"),
    "ip": (r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", "."),
    "card": (r"[0-9](?:[\x20-]?[0-9])++", None),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", "+"),
    "iban": (r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}+(?![A-Za-z0-9])", None),
    "ssn": (r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", "-"),
    "local_phone": (r"(?<![0-9+(.-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9])", None),
    "assigned": (rf"""(?i)(?<=["'])(?<={_NAME}["']?[\x20\t]{{0,4}}[=:]{{1,2}}>?[\x20\t]{{0,4}}["'])[^"'\s]{{6,}}+(?=["'])""", rf"/(?i){_NAME}"),
    "bare_value": (rf"(?i)(?<=[=:\x20\t])(?<={_NAME}[\x20\t]{{0,4}}[=:][\x20\t]{{0,4}})(?![=:\x20\t])[A-Za-z0-9+/_.~-]{{16,}}+", rf"/(?i){_NAME}"),
    "key_format": (r"(?<![A-Za-z0-9])(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,255}+|xox[abprs]-[A-Za-z0-9-]{10,}+|sk_(?:live|test)_[A-Za-z0-9]{16,}+|AIza[A-Za-z0-9_-]{35})(?![A-Za-z0-9])", r"/AKIA|gh[pousr]_|xox[abprs]-|sk_|AIza"),
    "private_key": (r"-----BEGIN (?:[A-Z0-9]+ ){0,3}PRIVATE KEY-----(?:[A-Za-z0-9+/=\s]*+-----END (?:[A-Z0-9]+ ){0,3}PRIVATE KEY-----)?", "PRIVATE KEY-----"),
    "signed_token": (r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{10,}+\.eyJ[A-Za-z0-9_-]{10,}+\.[A-Za-z0-9_-]{10,}+", "eyJ"),
}

#: kind -> (score of a confirmed span, words that raise it, words that lower it)
SCORES = {
    "email": (1.0, None, None),
    "ip": (0.9, r"\bip\b|address|host|server", r"version|release"),
    "card": (0.9, r"card|visa|master|credit|debit|pay", r"isbn|serial|order"),
    "phone": (0.9, r"phone|call|tel|mobile|fax", None),
    "iban": (0.9, r"iban|account|bank|konto|compte|cuenta", None),
    "ssn": (0.4, r"ssn|social|security|sozial", r"part|serial|order"),
    "local_phone": (0.4, r"phone|call|tel\b|mobile|fax|ruf", r"serial|order|isbn"),
}
SECRETS = ("assigned", "bare_value", "key_format", "private_key", "signed_token")
SCORES |= dict.fromkeys(SECRETS, (0.9, None, r"example|placeholder|changeme"))
RAISE, NEEDED, NEAR, BLOCK = 0.3, 0.6, 40, 512


def _running(a: str) -> str:
    """SQL for running sums within blocks of a long array, so that no long array is copied once per element."""
    return f"""flatten(transform(sequence(0, size({a}) - 1, {BLOCK}), b ->
        slice(aggregate(slice({a}, b + 1, {BLOCK}), array(0L), (r, y) -> concat(r, array(element_at(r, -1) + y))), 2, {BLOCK})))"""


def _luhn(match: Column) -> Column:
    digits = F.reverse(F.translate(match, " -", ""))
    total = F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda a, i: a + _luhn_digit(F.substring(digits, i, F.lit(1)).cast("int"), i))
    return F.when(F.length(digits).between(13, 19), total % 10 == 0).otherwise(False)


def _luhn_digit(d: Column, i: Column) -> Column:
    return F.when(i % 2 == 1, d).when(d > 4, 2 * d - 9).otherwise(2 * d)


def _mod97(match: Column) -> Column:
    """An account number is valid if, first four characters last and letters as 10 to 35, it leaves 1 modulo 97."""
    plain = F.translate(match, " ", "")
    turned = F.concat(F.substring(plain, 5, 40), F.substring(plain, 1, 4))

    def step(a, i):
        c = F.substring(turned, i, F.lit(1))
        return F.when(c.between("0", "9"), (a * 10 + F.ascii(c) - 48) % 97).otherwise((a * 100 + F.ascii(c) - 55) % 97)

    return F.length(plain).between(15, 34) & (F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), step) == 1)


def _ip(match: Column) -> Column:
    return F.forall(F.split(match, r"\."), lambda p: p.rlike(r"^0*+(?:[0-9]{0,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))


def _phone(match: Column) -> Column:
    return F.length(F.translate(match, "+ ().-", "")).between(9, 15)


def _entropy(match: Column) -> Column:
    """Bits per character."""
    size = F.length(match)
    share = lambda c: (size - F.length(F.replace(match, c, F.lit("")))) / size
    return F.aggregate(F.array_distinct(F.split(match, "")), F.lit(0.0), lambda a, c: a - F.when(c != "", share(c) * F.log2(share(c))).otherwise(0.0))


def _bare(match: Column) -> Column:
    return match.rlike("[0-9]") & match.rlike("[A-Za-z]") & (_entropy(match) >= 3)


CHECKS = {"assigned": lambda match: _entropy(match) >= 2.5, "bare_value": _bare, "ip": _ip, "card": _luhn, "phone": _phone, "iban": _mod97}


def _spans(df: DataFrame, kind: str) -> DataFrame:
    """Add column ``__kind``: confirmed spans as structs (s, e, m), e exclusive, m the matched text."""
    pattern, needs = PATTERNS[kind]
    there = F.col("__t").rlike(needs[1:]) if needs and needs[0] == "/" else F.contains("__t", F.lit(needs)) if needs else F.col("__t").rlike("[0-9]")
    lit = F.lit(pattern)
    df = df.withColumn("__m", F.when(there, F.regexp_extract_all("__t", lit, F.lit(0))).otherwise(F.array().cast("array<string>")))
    df = df.withColumn("__g", F.when(F.size("__m") > 0, F.split("__t", pattern, -1)))
    df = df.withColumn("__n", F.when(F.size("__m") > 0, F.flatten(F.transform("__m", lambda x, i: F.array(F.length(F.get("__g", i)).cast("long"), F.length(x).cast("long"))))))
    # sums within blocks, then what the blocks before add
    df = df.withColumn("__r", F.when(F.size("__n") > 0, F.expr(_running("__n"))))
    df = df.withColumn("__b", F.when(F.size("__n") > 0, F.expr(f"slice(aggregate(transform(sequence(0, size(__n) - 1, {BLOCK}), b -> __r[least(b + {BLOCK}, size(__n)) - 1]), array(0L), (r, y) -> concat(r, array(element_at(r, -1) + y))), 1, size(__n))")))
    at = f"__r[{{0}}] + __b[({{0}}) div {BLOCK}]"
    spans = F.expr(f"transform(__m, (x, i) -> named_struct('s', {at.format('2 * i')}, 'e', {at.format('2 * i + 1')}, 'm', x))")
    if check := CHECKS.get(kind):
        spans = F.filter(spans, lambda x: check(x["m"]))
    empty = F.array().cast("array<struct<s:bigint,e:bigint,m:string>>")
    return df.withColumn(f"__{kind}", F.when(F.size("__m") > 0, spans).otherwise(empty)).drop("__m", "__g", "__n", "__r", "__b")


def _score(kind: str):
    """Function from a span to its score: that of the kind, adjusted by words within NEAR characters of it."""
    start, up, down = SCORES[kind]

    def score(x):
        before = F.substring(F.col("__t"), F.greatest(x["s"] - NEAR + 1, F.lit(1)).cast("int"), F.least(x["s"], F.lit(NEAR)).cast("int"))
        near = F.lower(F.concat(before, F.lit(" "), F.substring(F.col("__t"), (x["e"] + 1).cast("int"), F.lit(NEAR))))
        out = F.lit(start)
        out = out + F.when(near.rlike(up), RAISE).otherwise(0.0) if up else out
        out = out - F.when(near.rlike(down), RAISE).otherwise(0.0) if down else out
        return F.round(F.greatest(F.lit(0.0), F.least(out, F.lit(1.0))), 2)

    return score


def _apart(base: str):
    return lambda x: ~F.exists(f"__{base}", lambda y: (x["s"] < y["e"]) & (y["s"] < x["e"]))


def _entities(kind: str) -> Column:
    spans, score = F.col(f"__{kind}"), _score(kind)
    if kind not in BASE + SECRETS:
        for base in BASE:
            spans = F.filter(spans, _apart(base))
    out = F.transform(spans, lambda x: F.struct(F.lit(kind).alias("kind"), x["s"].alias("start"), x["e"].alias("end"), score(x).alias("score")))
    out = out if kind in BASE else F.filter(out, lambda x: x["score"] >= NEEDED)
    return F.when(F.size(f"__{kind}") > 0, out).otherwise(F.array().cast("array<struct<kind:string,start:bigint,end:bigint,score:double>>"))


def find(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Add ``entities``: array of (kind, start, end, score) by kind, then start; offsets in code points, end exclusive.

    Confirmed spans of the kinds in BASE always stay. Spans of other kinds stay if their score, with the words within
    NEAR characters, reaches NEEDED and, but for secrets, they overlap no base span. A null text has none. Equal rows are treated alike.
    """
    df = df.withColumn("__t", F.coalesce(F.col(text_col), F.lit("")))
    for kind in PATTERNS:
        df = _spans(df, kind)
    return df.withColumn("entities", F.concat(*[_entities(kind) for kind in PATTERNS])).drop("__t", *[f"__{kind}" for kind in PATTERNS])
