"""Line dedup by winnowing over line hashes.

A line is its words in order; lines without a word do not count. A match has ``RUN`` lines, or fewer with ``WORDS`` words
or more, so a long line and a passage of two lines qualify by themselves. Every least match of that kind is a window, of
which winnowing selects the line with the least hash (the last of ties). Equal windows select the same line, so a selected
line is the fingerprint of all matches that go through it, and lines that no window selects are not written.

A fingerprint's row has its place and the hashes of the lines beside it. Fingerprints that stand at one place only are
dropped. Each other place is joined with the first place of its fingerprint, and the match is extended both ways for as
long as the lines agree. Windows that do not agree with the first place are joined once more, by all their lines, with the
first place that has them: together that is every window that is *later*, one that also begins at a smaller (id, hash of
the text, line). Later windows that touch are one match; its lines are deleted.

Order: null ids come last, rows with equal id and text are one document (each row gets the same result). Null texts have
no lines. All other columns pass through, whatever their names; earlier columns with the names of the two counts are
replaced. An empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.words import BASE, BASE_INVERSE, BYTES, NULL_ID, U, Words, mix, powers, slices, stream
from millrace.operators.vocabulary import lookup
from millrace.runtime import work_path

RUN = 3
WORDS = 50
SECOND = stream(3, 256)
#: windows by (first line, number of lines), the first line counted from the fingerprint
WINDOWS = [(-2, 3), (-1, 3), (0, 3), (-1, 2), (0, 2), (0, 1)]
BESIDE = [-2, -1, 1, 2]


class Lines:
    """Lines with a word of several texts: text number, and number of the line among all lines of its text."""

    def __init__(self, w: Words):
        breaks = np.flatnonzero(w.data == 10)
        before = np.searchsorted(breaks, w.start)  # line breaks before each word
        new = np.ones(len(w.start), bool)
        new[1:] = (before[1:] != before[:-1]) | (w.doc[1:] != w.doc[:-1])
        self.words, first = w, np.flatnonzero(new)
        self.from_, self.to = first, np.append(first[1:], len(new)) if len(first) else first
        self.doc = w.doc[first]
        self.number = before[first] - np.searchsorted(breaks, w.offsets[self.doc])
        self.first = np.searchsorted(self.doc, np.arange(len(w.offsets)))

    def hashes(self, table: np.ndarray = BYTES) -> np.ndarray:
        h = self.words.hashes(table)
        total = np.zeros(len(h) + 1, U)
        np.cumsum(h * powers(BASE, len(h)), out=total[1:])
        return mix((total[self.to] - total[self.from_]) * powers(BASE_INVERSE, len(h) + 1)[self.from_] + (self.to - self.from_).astype(U))


def selected(lines: Lines, hashes: np.ndarray, words: int | None) -> np.ndarray:
    """Per line a bit for each kind of window that selects it."""
    n = len(hashes)
    bits = np.zeros(n, np.int32)
    total = np.append(lines.from_, lines.to[-1:])  # words before each line
    for span in range(RUN, 0 if words is not None else RUN - 1, -1):
        first = np.arange(n - span + 1)
        first = first[lines.doc[first] == lines.doc[first + span - 1]] if len(first) else first
        if span < RUN:
            first = first[total[first + span] - total[first] >= words]
        least, where = np.full(len(first), np.iinfo(U).max, U), np.zeros(len(first), np.int64)
        for j in range(span):
            here = hashes[first + j] <= least
            least, where = np.where(here, hashes[first + j], least), np.where(here, j, where)
        for j in range(span):
            bits[first[where == j] + j] |= 1 << WINDOWS.index((-j, span))
    return bits


def _fingerprints(batches, words):
    names = ["id", "key", "at", "print", "own", *[f"b{j}" for j in range(len(BESIDE))], "windows"]
    for batch in batches:
        for i, _, w in slices(batch.column(1)):
            lines = Lines(w)
            if not len(lines.doc):
                continue
            hashes, bits = lines.hashes(), selected(lines, lines.hashes(), words)
            at = np.flatnonzero(bits)
            beside = []
            for j in BESIDE:
                there = np.clip(at + j, 0, len(hashes) - 1)
                beside.append(np.where((at + j == there) & (lines.doc[there] == lines.doc[at]), hashes[there], U(0)))
            rows = pa.array(i + lines.doc[at])
            numbers = [hashes[at], lines.hashes(SECOND)[at], *beside]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(rows), batch.column(2).take(rows), pa.array((at - lines.first[lines.doc[at]]).astype(np.int32)), *[pa.array(x.view(np.int64)) for x in numbers], pa.array(bits[at])], names
            )


def later(prints: DataFrame, place: Column) -> DataFrame:
    """(id, key, at, span) of every window that an equal one precedes."""
    spark = prints.sparkSession

    def kept(df: DataFrame, name: str) -> DataFrame:
        path = work_path(spark, name)
        df.write.parquet(path)
        return spark.read.parquet(path)

    lines = ["own", *[f"b{j}" for j in range(len(BESIDE))]]
    placed = prints.select("id", "key", "at", "print", "windows", *lines, place.alias("place"))
    first = placed.groupBy("print").agg(F.min(F.struct("place", *lines)).alias("first"), F.max("place").alias("last"), F.count("*").alias("n")).where("first.place < last")
    first = kept(first.select("print", "first", "n"), "repeated_prints")
    pairs = lookup(placed, first.select("print", "first"), "print", first.select("print", "n")).where("place > first.place")
    # how far the match goes to both sides
    same = [F.col(f"b{j}") == F.col(f"first.b{j}") for j in range(len(BESIDE))]
    left = F.when(same[1], F.when(same[0], 2).otherwise(1)).otherwise(0)
    right = F.when(same[2], F.when(same[3], 2).otherwise(1)).otherwise(0)
    beside = {j: F.col(f"b{k}") for k, j in enumerate(BESIDE)}
    found = []
    for k, (start, span) in enumerate(WINDOWS):
        agrees = (F.col("own") == F.col("first.own")) & (left >= -start) & (right >= start + span - 1)
        others = [beside[j] for j in range(start, start + span) if j]
        window = F.struct("print", "own", F.lit(k).alias("kind"), *[(others[n] if n < len(others) else F.lit(0).cast("long")).alias(f"x{n}") for n in range(RUN - 1)])
        here = F.struct((F.col("at") + start).alias("at"), F.lit(span).alias("span"), agrees.alias("agrees"), window.alias("window"))
        found.append(F.when(F.col("windows").bitwiseAND(1 << k) != 0, here))
    runs = kept(pairs.select("id", "key", F.explode(F.array_compact(F.array(*found))).alias("w"), "place").select("id", "key", "place", "w.*"), "joined_windows")
    rest = runs.where("NOT agrees")
    own = rest.groupBy("window").agg(F.min("place").alias("lo"), F.max("place").alias("hi"), F.count("*").alias("n")).where("lo < hi")
    own = kept(own.select("window", "lo", "n"), "repeated_windows")
    more = lookup(rest, own.select("window", "lo"), "window", own.select("window", "n")).where("place > lo")
    return runs.where("agrees").select("id", "key", "at", "span").unionByName(more.select("id", "key", "at", "span"))


def dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int | None = WORDS) -> DataFrame:
    """The rows of ``df`` with later repeated runs deleted from the text, plus ``n_lines_deleted`` and ``n_lines_left``.

    ``words``: a match of fewer than ``RUN`` lines needs so many; None: there are no such matches. Lines that stay keep their bytes and line breaks; a text that loses lines loses their line breaks as well.
    """
    df = df.drop("n_lines_deleted", "n_lines_left")
    kind = dict(df.dtypes)[id_col]
    names = [f"c{i}" for i in range(len(df.columns))]  # the caller's columns may have any names
    plain, where = df.toDF(*names), df.columns.index(text_col)
    own_id, text = names[df.columns.index(id_col)], F.coalesce(F.col(names[where]), F.lit(""))
    docs = plain.select(F.col(own_id).alias("id"), text.alias("text"), F.xxhash64(text).alias("key"))
    path = work_path(df.sparkSession, "line_prints")
    schema = f"id {kind}, key long, at int, print long, own long, " + ", ".join(f"b{j} long" for j in range(len(BESIDE))) + ", windows int"
    docs.mapInArrow(lambda batches: _fingerprints(batches, words), schema).write.parquet(path)
    prints = df.sparkSession.read.parquet(path)
    place = F.struct(F.coalesce("id", F.lit(NULL_ID)).alias("id"), "key", "at") if kind in ("bigint", "int") else F.struct(F.col("id").isNull().alias("n"), "id", "key", "at")
    marks = later(prints, place).groupBy("id", "key").agg(F.sort_array(F.collect_set(F.struct("at", "span"))).alias("marks"))  # at most a few per line
    joined = plain.withColumn("own_key", F.xxhash64(text)).join(marks, F.col(own_id).eqNullSafe(F.col("id")) & (F.col("own_key") == F.col("key")), "left").select(*names, "marks")
    schema = plain.schema.add("n_lines_deleted", "long").add("n_lines_left", "long")

    def cut(batches):
        for batch in batches:
            n = batch.num_rows
            texts, marks = batch.column(where), batch.column(len(names))
            deleted, left = np.zeros(n, np.int64), np.zeros(n, np.int64)
            changed, new = np.zeros(n, bool), []
            for i, j, w in slices(texts):
                lines = Lines(w)
                left[i:j] = np.diff(lines.first)
                for row in np.flatnonzero(marks.slice(i, j - i).is_valid().to_numpy(zero_copy_only=False)).tolist():
                    gone = extend(marks[i + row].as_py(), int(left[i + row]))
                    numbers = set(lines.number[lines.first[row] : lines.first[row + 1]][gone].tolist())
                    new.append("\n".join(x for k, x in enumerate(texts[i + row].as_py().split("\n")) if k not in numbers))
                    changed[i + row], deleted[i + row] = True, gone.sum()
            texts = pc.replace_with_mask(texts, pa.array(changed), pa.array(new, texts.type))
            columns = [texts if k == where else batch.column(k) for k in range(len(names))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(deleted), pa.array(left - deleted)], [*names, "n_lines_deleted", "n_lines_left"])

    return joined.mapInArrow(cut, schema).toDF(*df.columns, "n_lines_deleted", "n_lines_left")


def extend(runs: list[dict], n: int) -> np.ndarray:
    """Which of n lines later runs (first line ``at``, ``span`` lines) cover."""
    gone = np.zeros(n + 1, int)
    np.add.at(gone, [x["at"] for x in runs], 1)
    np.add.at(gone, [x["at"] + x["span"] for x in runs], -1)
    return np.cumsum(gone[:-1]) > 0
