"""Importance resampling towards a target distribution, by bit-sliced aggregation.

Features of a text are its runs of one and two words, hashed into ``buckets``. How often each bucket occurs in the corpus
and in the target gives the bucket an integer gain. A document's bucket counts are kept as bit planes: plane j has a bit
for every bucket whose count has bit j, stored as the 64-bit words that are not empty. The gains are planes as well, in
two's complement. A document's weight is then exact integer arithmetic on whole words of bits: plane j AND gain plane k,
the number of bits left, times 2^j and the place value of plane k, the highest of which is negative.

Gumbel noise from a digest of the id turns weights into scores, whose highest are a draw without replacement.

Null texts have no words, weight 0, and are never drawn (too few words); texts that are equal have equal weights; rows with
equal ids have equal noise and are ranked one after the other, null ids (noise of ``null``) after all others. An empty
target or corpus is allowed: every gain then comes from the counts of the other side. Only the id and the text column are
read, so further columns may have any name.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.words import SLICE_BYTES, U, Words, buffers
from millrace.operators.running import numbered
from millrace.runtime import cut_lineage

BUCKETS = 10_000
LONG = 64  # bytes of a word beyond which its checksum is taken by itself


def _folded() -> np.ndarray:
    """A-Z in lower case, and a blank for every byte that is in no word."""
    byte = np.arange(256, dtype=np.uint8)
    byte[65:91] += 32
    word = ((byte >= 48) & (byte <= 57)) | ((byte >= 97) & (byte <= 122)) | (byte >= 128)
    return np.where(word, byte, 32).astype(np.uint8)


def _steps() -> np.ndarray:
    """What a byte does to a CRC-32 register."""
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, np.uint32(0xEDB88320) ^ (c >> 1), c >> 1)
    return c


FOLD, STEP = _folded(), _steps()


def _shifts() -> np.ndarray:
    """[n, k, v]: the register that has v as its byte k, after n zero bytes."""
    c = (np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]).astype(np.uint32)
    out = [c]
    for _ in range(LONG):
        c = STEP[c & 255] ^ (c >> 8)
        out.append(c)
    return np.stack(out)


SHIFT = _shifts()


def word_crcs(w: Words) -> np.ndarray:
    """CRC-32 of every word, all words of one length class a byte at a time."""
    size = w.end - w.start
    order = np.argsort(-np.minimum(size, LONG + 1), kind="stable")
    sizes, starts = size[order], w.start[order]
    c = np.full(len(size), 0xFFFFFFFF, np.uint32)
    counts = np.bincount(np.minimum(sizes, LONG + 1), minlength=LONG + 2) if len(size) else np.zeros(LONG + 2, int)
    longer = len(size) - np.cumsum(counts)  # words with more than k bytes come first
    for k in range(LONG):
        m = longer[k]
        if not m:
            break
        c[:m] = STEP[(c[:m] ^ w.data[starts[:m] + k]) & 255] ^ (c[:m] >> 8)
    out = np.empty_like(c)
    out[order] = ~c
    for i in np.flatnonzero(size > LONG).tolist():
        out[i] = zlib.crc32(w.data[w.start[i] : w.end[i]].tobytes())
    return out


def features(w: Words, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Text number and bucket of every run of one word and of two words of the same text."""
    crc = word_crcs(w)
    first = np.flatnonzero(w.doc[1:] == w.doc[:-1])
    second = first + 1
    blank = ~crc[first]
    c = ~(STEP[(blank ^ 32) & 255] ^ (blank >> 8))  # the first word and a blank
    size = w.end[second] - w.start[second]
    n = np.minimum(size, LONG)
    pair = SHIFT[n, 0, c & 255] ^ SHIFT[n, 1, (c >> 8) & 255] ^ SHIFT[n, 2, (c >> 16) & 255] ^ SHIFT[n, 3, c >> 24] ^ crc[second]
    for i in np.flatnonzero(size > LONG).tolist():
        pair[i] = zlib.crc32(w.data[w.start[second[i]] : w.end[second[i]]].tobytes(), int(c[i]))
    return np.concatenate([w.doc, w.doc[first]]), (np.concatenate([crc, pair]) % np.uint32(buckets)).astype(np.int64)


def slices(col) -> Iterator[tuple[int, int, Words]]:
    """(first row, end row, words) of slices of about SLICE_BYTES; a longer text is a slice of its own."""
    data, offsets = buffers(col)
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + SLICE_BYTES, "right")) - 1)
        yield i, j, Words(FOLD[data[offsets[i] : offsets[j]]], offsets[i : j + 1])
        i = j


def bucket_counts(df: DataFrame, text_col: str, buckets: int = BUCKETS) -> np.ndarray:
    """How often each bucket occurs in all texts: counted per task, added up by bucket, ``buckets`` numbers in the end."""

    def count(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, w in slices(batch.column(0)):
                total += np.bincount(features(w, buckets)[1], minlength=buckets)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], ["bucket", "n"])

    rows = df.select(text_col).mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(buckets, np.int64)
    for bucket, n in rows:
        out[bucket] = n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """1000 times the log of how much more frequent a bucket is in the target, counts lifted by one, rounded down."""
    k, s, t = len(corpus), int(corpus.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log(float(b + 1) * (s + k) / (float(a + 1) * (t + k)))) for a, b in zip(corpus.tolist(), target.tolist(), strict=True)], np.int64)


def gain_planes(gain: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Planes of the gains in two's complement, as 64-bit words, and the place value of each."""
    bits = int(max(gain.max(initial=0), -gain.min(initial=0))).bit_length() + 1
    padded = np.zeros(-(-len(gain) // 64) * 64, np.int64)
    padded[: len(gain)] = gain
    planes = [(U(1) << np.arange(64, dtype=U)) * ((padded >> k) & 1).astype(U).reshape(-1, 64) for k in range(bits)]
    places = np.left_shift(1, np.arange(bits, dtype=np.int64))
    places[-1] *= -1
    return np.stack([np.bitwise_or.reduce(p, axis=1) for p in planes]), places


def count_planes(doc: np.ndarray, bucket: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(j, text, place among the plane's words, word) of all words that are not empty in the texts' planes j."""
    cell, n = np.unique(doc * buckets + bucket, return_counts=True)
    doc, bucket = cell // buckets, cell % buckets
    word, bit = bucket >> 6, U(1) << (bucket & 63).astype(U)
    for j in range(int(n.max(initial=0)).bit_length()):
        at = np.flatnonzero((n >> j) & 1)
        if not len(at):
            continue
        d, w = doc[at], word[at]
        new = np.flatnonzero(np.concatenate([[True], (d[1:] != d[:-1]) | (w[1:] != w[:-1])]))
        yield j, d[new], w[new], np.bitwise_or.reduceat(bit[at], new)


def gain_sums(doc: np.ndarray, bucket: np.ndarray, texts: int, buckets: int, planes: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The exact sum of the gains of each text's features."""
    out = np.zeros(texts, np.int64)
    for j, d, word, bits in count_planes(doc, bucket, buckets):
        total = np.zeros(len(bits), np.int64)
        for plane, place in zip(planes, places, strict=True):
            total += np.bitwise_count(bits & plane[word]).astype(np.int64) * place
        first = np.flatnonzero(np.concatenate([[True], d[1:] != d[:-1]]))
        out[d[first]] += np.add.reduceat(total, first) << j
    return out


def noise(ids: pa.Array, seed: int) -> np.ndarray:
    """1000 times a Gumbel variate of each id, rounded down."""
    out = np.empty(len(ids), np.int64)
    for i, x in enumerate(ids.cast(pa.string()).fill_null("null").to_pylist()):
        h = int(hashlib.sha256(f"{seed}:{x}".encode()).hexdigest()[:8], 16)
        out[i] = math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
    return out


def draw(
    df: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text", percent: int = 25, min_words: int = 20, seed: int = 7, buckets: int = BUCKETS
) -> DataFrame:
    """One row per row of ``df``: the id, ``n_features``, ``weight``, ``score``, ``rank``, ``n_words`` (all long).

    ``rank`` numbers the ``percent`` of the texts of ``min_words`` words or more that have the highest scores, ties to
    the smaller id, and is null elsewhere. The driver holds two counts and one gain per bucket, whatever the input.
    """
    gain = gains(bucket_counts(df, text_col, buckets), bucket_counts(target, target_col, buckets))
    planes, places = gain_planes(gain)

    def score(batches):
        for batch in batches:
            n = batch.num_rows
            words, total = np.zeros(n, np.int64), np.zeros(n, np.int64)
            for i, j, w in slices(batch.column(1)):
                words[i:j] = np.diff(w.first)
                total[i:j] = gain_sums(*features(w, buckets), j - i, buckets, planes, places)
            runs = words + np.maximum(words - 1, 0)
            weight = np.where(runs > 0, total // np.maximum(runs, 1), 0)
            scores = weight + noise(batch.column(0), seed)
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, (words, runs, weight, scores))], ["id", "n_words", "n_features", "weight", "score"])

    kind = dict(df.dtypes)[id_col]
    pairs = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    scored = cut_lineage(pairs.mapInArrow(score, f"id {kind}, n_words long, n_features long, weight long, score long"))
    enough = F.col("n_words") >= min_words
    drawn = scored.where(enough).count() * percent // 100
    keyed = scored.where(enough).withColumns({"down": -F.col("score"), "null_id": F.col("id").isNull()})
    ranked = numbered(keyed, "down", ["null_id", "id"], name="place").withColumn("rank", F.when(F.col("place") <= drawn, F.col("place").cast("long")))
    columns = [F.col("id").alias(id_col), "n_features", "weight", "score", "rank", "n_words"]
    return ranked.select(*columns).unionByName(scored.where(~enough).withColumn("rank", F.lit(None).cast("long")).select(*columns))
