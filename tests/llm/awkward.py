"""Small tables with everything that texts can do: nulls, empties, ties, repeats, long texts, clashing column names."""

import random

from pyspark.sql import types as T

SCHEMA = T.StructType(
    [T.StructField(n, t) for n, t in (("doc_id", T.LongType()), ("text", T.StringType()), ("lang", T.StringType()), ("source", T.StringType()), ("n_chars", T.LongType()), ("id", T.StringType()), ("key", T.LongType()), ("chunk", T.StringType()), ("email", T.StringType()))]
)


def vocabulary(n=60, seed=3):
    rnd = random.Random(seed)
    return ["".join(rnd.choice("aeioubcdrstlnéÑ") for _ in range(rnd.randint(1, 7))) for _ in range(n)]


def texts(n=60, seed=1, vocab=60):
    rnd = random.Random(seed)
    words = vocabulary(vocab)
    out = []
    for i in range(n):
        size = rnd.choice([1, 3, 8, 20, 60, 150])
        ws = [rnd.choice(words) for _ in range(size)]
        t = ws[0]
        for w in ws[1:]:
            t += rnd.choice([" ", " ", " ", " ", "\n", "  ", "\t", "\r\n", "\x0b", "\x1f", "\xa0"]) + w
        out.append(t)
    for i in range(n // 2):  # near copies
        ws = rnd.choice(out[:n]).split(" ")
        for _ in range(rnd.randint(0, 3)):
            ws[rnd.randrange(len(ws))] = rnd.choice(words)
        out.append(" ".join(ws))
    return out


def rows(more=(), n=60, seed=1):
    body = texts(n, seed) + list(more) + ["", " \n\t ", None, None, "x" * 5000, "word " * 3000]
    out = [(i, t, ["en", "fr", None][i % 3], "src0" if i % 3 else f"s{i}", len(t or ""), "i", i % 2, "c", "e") for i, t in enumerate(body)]
    out += [out[3], out[3]]  # repeated rows
    out += [(None, body[5], None, None, None, None, None, None, None), (None, None, None, None, None, None, None, None, None)]
    out += [(7, "another text with the id of another", "en", "src0", 3, "i", 1, "c", "e")]  # tied ids
    return out


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)
