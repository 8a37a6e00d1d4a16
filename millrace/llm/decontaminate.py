"""Benchmark decontamination with spaced seeds.

A mask looks at some of the words of a window and ignores the others. The two masks below are chosen so that any 13
aligned words with at most two substitutions agree with one of them somewhere. Mask hashes of the training texts pass a
bitmap of fixed size made from the test hashes, what is left is joined to the test hashes, and every alignment found is
verified word by word.

Nulls are empty texts; items of fewer than ``min_words`` words are too short to tell and match nothing; rows with equal
id and text are one text; words are compared with A-Z lower-cased.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.words import STEPS, U, Words, buffers, mix, slices

MASKS = ((0, 1, 2, 4, 6, 7), (0, 1, 3, 6, 7, 8))
MIN_WORDS, MIN_EQUAL = 13, 11
BITS = 25  # the bitmap has 2^25 bits, 4 MB, whatever the tables hold


def seeds(h: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all masks at all places, and the word number where each begins."""
    out, at = [np.zeros(0, U)], [np.zeros(0, np.int64)]
    for m, mask in enumerate(MASKS):
        n = len(h) - mask[-1]
        if n <= 0:
            continue
        total = np.full(n, m, U)
        for j, x in enumerate(mask):
            total += h[x : n + x] * STEPS[j]
        inside = np.flatnonzero(doc[:n] == doc[mask[-1] :])
        out.append(mix(total[inside]))
        at.append(inside)
    return np.concatenate(out), np.concatenate(at)


def _item_seeds(batches):
    for batch in batches:
        for i, _, w in slices(batch.column(1), lower=True):
            s, at = seeds(w.hashes(), w.doc)
            rows = i + w.doc[at]
            take = pa.array(rows)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(2).take(take), pa.array(s.view(np.int64)), pa.array((at - w.first[w.doc[at]]).astype(np.int32))], ["item", "item_key", "seed", "item_at"])


def bitmap(test: DataFrame) -> bytes:
    """Which slots of the bitmap the test hashes take: at most 2^25 / 64 rows reach the driver, however many hashes."""
    slot = f"(seed & {(1 << BITS) - 1})"
    bits = test.selectExpr(f"{slot} >> 6 AS k", f"shiftleft(1L, int({slot} & 63)) AS b").groupBy("k").agg(F.bit_or("b").alias("b")).toPandas()
    full = np.zeros(1 << (BITS - 6), np.int64)
    full[bits["k"].to_numpy(np.int64)] = bits["b"].to_numpy(np.int64)
    return full.tobytes()


def overlaps(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per (document, item) that overlap: id, item id, ``n_equal`` aligned equal words of the best alignment's
    contaminated part, ``start``/``end`` words of the document, ``item_share`` of the item's words.

    They overlap if ``MIN_WORDS`` aligned words hold at least ``MIN_EQUAL`` equal ones.
    """
    spark = docs.sparkSession
    kind, item_kind = dict(docs.dtypes)[id_col], dict(items.dtypes)[item_col]
    d = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("key", F.xxhash64("text"))
    t = items.select(F.col(item_col).alias("item"), F.coalesce(F.col(item_text), F.lit("")).alias("text")).withColumn("item_key", F.xxhash64("text")).distinct()
    test = t.mapInArrow(_item_seeds, f"item {item_kind}, item_key long, seed long, item_at int")
    known = spark.sparkContext.broadcast(bitmap(test))

    def probe(batches):
        bits = np.frombuffer(known.value, U)
        for batch in batches:
            for i, _, w in slices(batch.column(1), lower=True):
                s, at = seeds(w.hashes(), w.doc)
                slot = s & U((1 << BITS) - 1)
                hit = np.flatnonzero((bits[(slot >> U(6)).astype(np.int64)] >> (slot & U(63))) & U(1))
                rows = w.doc[at[hit]]
                take = pa.array(i + rows)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(2).take(take), pa.array(s[hit].view(np.int64)), pa.array((at[hit] - w.first[rows]).astype(np.int64))], ["id", "key", "seed", "at"])

    hits = d.mapInArrow(probe, f"id {kind}, key long, seed long, at long")
    lined = hits.join(test, "seed").select("id", "key", "item", "item_key", (F.col("at") - F.col("item_at")).alias("shift")).distinct()
    grouped = lined.groupBy("id", "key", "item", "item_key").agg(F.collect_list("shift").alias("shifts"))
    t = t.select(F.col("item").alias("__item"), F.col("item_key").alias("__key"), F.col("text").alias("item_text"))
    pairs = grouped.join(t, F.col("item").eqNullSafe(F.col("__item")) & (F.col("item_key") == F.col("__key"))).groupBy("id", "key").agg(F.collect_list(F.struct("item", "item_text", "shifts")).alias("found"))
    both = d.join(pairs.select(F.col("id").alias("__i"), F.col("key").alias("__k"), "found"), F.col("id").eqNullSafe(F.col("__i")) & (F.col("key") == F.col("__k"))).select("id", "text", "found")

    def verify(batches):
        for batch in batches:
            rows = {"at": [], "item": [], "n_equal": [], "start": [], "end": [], "item_share": []}
            for r in range(batch.num_rows):
                w = Words(*buffers(batch.column(1).slice(r, 1)), lower=True)
                words = [w.data[a:b].tobytes() for a, b in zip(w.start, w.end, strict=True)]
                for x in batch.column(2)[r].as_py():
                    v = Words(*buffers(pa.array([x["item_text"]])), lower=True)
                    item = [v.data[a:b].tobytes() for a, b in zip(v.start, v.end, strict=True)]
                    best = max((aligned(words, item, s) for s in x["shifts"]), key=lambda y: y[0], default=(0, 0, 0))
                    if best[0]:
                        for k, y in zip(rows, (r, x["item"], *best, round(best[0] / len(item), 4)), strict=True):
                            rows[k].append(y)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows["at"], pa.int64())), pa.array(rows["item"], batch.schema.field("found").type.value_type.field("item").type), pa.array(rows["n_equal"], pa.int64()), pa.array(rows["start"], pa.int64()), pa.array(rows["end"], pa.int64()), pa.array(rows["item_share"], pa.float64())], ["id", "item", "n_equal", "start", "end", "item_share"])

    out = both.mapInArrow(verify, f"id {kind}, item {item_kind}, n_equal long, start long, end long, item_share double")
    best = F.max(F.struct("n_equal", F.negative("start").alias("s"), "start", "end", "item_share"))
    out = out.groupBy("id", "item").agg(best.alias("x")).select("id", "item", "x.n_equal", "x.start", "x.end", "x.item_share")
    return out.withColumnsRenamed({"id": id_col, "item": item_col if item_col != id_col else f"item_{item_col}"})


def aligned(words: list[bytes], item: list[bytes], shift: int) -> tuple[int, int, int]:
    """(equal words, first word, end) of the part of this alignment that windows of MIN_WORDS with MIN_EQUAL equal cover."""
    i, j = max(0, -shift), min(len(item), len(words) - shift)
    if j - i < MIN_WORDS:
        return 0, 0, 0
    same = np.fromiter((item[k] == words[k + shift] for k in range(i, j)), bool, j - i)
    sums = np.convolve(same, np.ones(MIN_WORDS, int), "valid")
    good = np.flatnonzero(sums >= MIN_EQUAL)
    if not len(good):
        return 0, 0, 0
    cover = np.zeros(j - i + 1, int)
    np.add.at(cover, good, 1)
    np.add.at(cover, good + MIN_WORDS, -1)
    inside = np.cumsum(cover[:-1]) > 0
    return int((same & inside).sum()), int(i + shift + good[0]), int(i + shift + good[-1] + MIN_WORDS)


def clean(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """The rows of ``docs`` whose id overlaps no item; rows without an id stay if no row without an id overlaps."""
    bad = overlaps(docs, items, id_col, text_col, item_col).select(F.col(id_col).alias("__bad")).distinct()
    return docs.join(bad, F.col(id_col).eqNullSafe(F.col("__bad")), "left_anti")
