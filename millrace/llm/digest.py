"""Document fingerprints from improbable features, in chained Bloom filters.

A feature is a window of ``WINDOW`` bytes of the text. Its entropy, in thousandths of the most it can be, is rare or frequent
among all windows of the corpus; rarer is more telling. Every run of ``SPAN`` windows votes for its rarest one (the
leftmost of ties), and a window with ``VOTES`` votes or more is a feature of the document. Windows of little entropy never
are. A text without such a window, because it is too short or has windows of little entropy only, has all its windows of
``SHORT`` bytes as features, or the whole text if that is shorter. Features go in their order into Bloom filters of ``BITS`` bits, at most
``FULL`` to a filter, then the next one follows.

Two fingerprints are compared filter by filter, from the side with fewer features: the bits that two filters share, less
those that chance would give, of the most that they could share; the best partner of each filter counts, weighted by its
features. Equal texts have equal fingerprints and likeness 1; an empty text has the empty fingerprint, like only to itself.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.words import BASE, BASE_INVERSE, BYTES, U, buffers, mix, powers
from millrace.runtime import shuffle_width

WINDOW = 32
SPAN = 32
VOTES = 8
SHORT = 8  # bytes of the windows of texts that have no feature otherwise
WEAK = 100  # thousandths of entropy below which a window says nothing
LEVELS = 1001
BITS, HASHES, FULL = 2048, 5, 160
PIECE = 1 << 18  # bytes of texts that are looked at together; a longer text is looked at as a whole
NEVER = np.int64(1 << 62)

# c log2 c of a count, in 2^-24: whole numbers, so that sums do not depend on where a window stands
_C = np.arange(WINDOW + 1, dtype=float)
ENTROPY = np.round(_C * np.log2(np.maximum(_C, 1)) * (1 << 24)).astype(np.int64)
ADDED = np.diff(ENTROPY)  # by one more occurrence of a byte that is there 0, 1, 2, ... times
SCALE = int(ENTROPY[WINDOW])  # the most that WINDOW bytes can have


class Pieces:
    """Texts one after the other, ``WINDOW`` bytes that UTF-8 never has after each: starts, lengths, entropies of all windows."""

    def __init__(self, texts: list[bytes]):
        self.size = np.array([len(t) for t in texts], np.int64)
        gap = b"\xff" * WINDOW
        self.data = np.frombuffer(gap.join(texts) + gap, np.uint8)
        self.start = np.cumsum(self.size + WINDOW) - self.size - WINDOW
        self.windows = np.maximum(self.size - WINDOW + 1, 0)
        self.text = np.repeat(np.arange(len(texts)), self.windows)
        self.at = np.arange(self.windows.sum()) + np.repeat(self.start - np.cumsum(self.windows) + self.windows, self.windows)

    def entropy(self) -> np.ndarray:
        """Of every window, in thousandths."""
        x, n = self.data, len(self.data)
        before, after = np.zeros(n, np.uint8), np.zeros(n, np.uint8)  # equal bytes among the WINDOW - 1 on that side
        for a in range(0, n, 1 << 16):  # in parts that stay in the cache
            b = min(n, a + (1 << 16))
            for d in range(1, WINDOW):
                if b - d <= 0:
                    break
                lo = max(a, d)
                same = (x[lo:b] == x[lo - d : b - d]).view(np.uint8)
                before[lo:b] += same
                after[lo - d : b - d] += same
        into = np.concatenate([[0], np.cumsum(ADDED[before])])
        out = np.concatenate([[0], np.cumsum(ADDED[after])])
        first = np.repeat(self.start, self.windows)
        total = into[self.at + WINDOW] - into[first] - out[self.at] + out[first]
        return (SCALE - total) * 1000 // SCALE

    def hashes(self, at: np.ndarray, size: np.ndarray) -> np.ndarray:
        """64-bit hashes of byte ranges, wherever they stand."""
        n = len(self.data)
        total = np.zeros(n + 1, U)
        np.cumsum(BYTES[self.data] * powers(BASE, n), out=total[1:])
        return mix((total[at + size] - total[at]) * powers(BASE_INVERSE, n)[at] + size.astype(U))

    def chosen(self, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text number, place and length of the features, in order; ``rank`` of each entropy, NEVER for weak ones."""
        n = len(self.data)
        key = np.full(n + SPAN, NEVER, np.int64)
        key[self.at] = rank[self.entropy()]
        real = key < NEVER
        key[real] = (key[real] << 40) + np.flatnonzero(real)
        least, step = key, 1
        while step < SPAN:
            least = np.minimum(least[:-step], least[step:])
            step *= 2
        runs = np.maximum(self.windows - SPAN + 1, np.minimum(self.windows, 1))
        runs_at = np.arange(runs.sum()) + np.repeat(self.start - np.cumsum(runs) + runs, runs)
        won = least[runs_at]
        won = won[won < NEVER] & ((1 << 40) - 1)
        votes = np.bincount(won, minlength=n)
        at = np.flatnonzero(votes >= VOTES)
        text = np.searchsorted(self.start, at, "right") - 1
        # texts without one: all their short windows
        without = np.setdiff1d(np.flatnonzero(self.size), text)
        some = np.maximum(self.size[without] - SHORT + 1, 1)
        rest = np.arange(some.sum()) + np.repeat(self.start[without] - np.cumsum(some) + some, some)
        place = np.concatenate([at, rest])
        order = np.argsort(place, kind="stable")
        size = np.concatenate([np.full(len(at), WINDOW), np.repeat(np.minimum(self.size[without], SHORT), some)])[order]
        return np.concatenate([text, np.repeat(without, some)])[order], place[order], size

    def fingerprints(self, rank: np.ndarray) -> list["Fingerprint"]:
        text, at, size = self.chosen(rank)
        h = self.hashes(at, size)
        order = np.lexsort([h, text])  # a feature that a text repeats counts once, where it is first
        again = np.zeros(len(h), bool)
        again[order[1:]] = (h[order[1:]] == h[order[:-1]]) & (text[order[1:]] == text[order[:-1]])
        first = np.flatnonzero(~again)
        text, h = text[first], h[first]
        count = np.bincount(text, minlength=len(self.size))
        filters = -(-count // FULL)
        base = np.cumsum(filters) - filters
        nth = np.arange(len(h)) - np.repeat(np.cumsum(count) - count, count)
        row = base[text] + nth // FULL
        bits = np.zeros((int(filters.sum()), BITS), bool)
        for k in range(HASHES):
            bits[row, ((h >> U(11 * k)) & U(BITS - 1)).astype(np.int64)] = True
        packed = np.packbits(bits, axis=1).view(U) if len(bits) else np.zeros((0, BITS // 64), U)
        return [Fingerprint(int(c), packed[b : b + f]) for c, b, f in zip(count, base, filters, strict=True)]


class Fingerprint:
    """Filters of a text and the number of its features."""

    def __init__(self, features: int, filters: np.ndarray):
        self.features, self.filters = features, filters

    def __str__(self) -> str:
        return f"{self.features}:{base64.b64encode(self.filters.tobytes()).decode()}"

    @staticmethod
    def parse(text: str) -> "Fingerprint":
        features, filters = text.split(":")
        return Fingerprint(int(features), np.frombuffer(base64.b64decode(filters), U).reshape(-1, BITS // 64))

    def likeness(self, other: "Fingerprint") -> float:
        """From 0 (no more than chance) to 1 (equal, or all of the smaller one's bits in the other)."""
        a, b = sorted((self, other), key=lambda f: (f.features, f.filters.tobytes()))
        if not a.features:
            return 1.0 if not b.features else 0.0
        in_b = np.bitwise_count(b.filters).sum(1, dtype=np.int64)
        total = 0.0
        for i in range(len(a.filters)):
            weight = min(FULL, a.features - i * FULL)
            one, best = int(np.bitwise_count(a.filters[i]).sum()), 0.0
            for j in range(0, len(b.filters), 4096):
                shared = np.bitwise_count(b.filters[j : j + 4096] & a.filters[i]).sum(1, dtype=np.int64)
                most = np.minimum(in_b[j : j + 4096], one)
                chance = in_b[j : j + 4096] * one / BITS
                with np.errstate(divide="ignore", invalid="ignore"):
                    score = np.where(shared == most, 1.0, (shared - chance) / (most - chance))
                best = max(best, float(score.max()))
                if best >= 1:
                    break
            total += weight * max(0.0, best)
        return total / a.features


def pieces(texts: list[bytes]) -> Iterator[tuple[int, int, Pieces]]:
    i = 0
    while i < len(texts):
        j, n = i + 1, len(texts[i])
        while j < len(texts) and n + len(texts[j]) + WINDOW <= PIECE:
            n += len(texts[j]) + WINDOW
            j += 1
        yield i, j, Pieces(texts[i:j])
        i = j


def ranks(df: DataFrame, text_col: str) -> np.ndarray:
    """Place of each level of entropy by the number of windows in all texts, rarest first; weak ones never win.

    Tasks count, the driver gets one number per level.
    """

    def count(batches):
        total = np.zeros(LEVELS, np.int64)
        for batch in batches:
            data, offsets = buffers(batch.column(0))
            for _, _, p in pieces([data[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]):
                total += np.bincount(p.entropy(), minlength=LEVELS)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], ["level", "n"])

    counts = np.zeros(LEVELS, np.int64)
    for level, n in df.select(text_col).mapInArrow(count, "level long, n long").groupBy("level").agg(F.sum("n").alias("n")).collect():
        counts[level] = n
    out = np.empty(LEVELS, np.int64)
    out[np.lexsort([np.arange(LEVELS), counts])] = np.arange(LEVELS)
    out[:WEAK] = NEVER
    return out


def fingerprint(texts: list[str], rank: np.ndarray) -> list[Fingerprint]:
    encoded = [t.encode() for t in texts]
    return [f for _, _, p in pieces(encoded) for f in p.fingerprints(rank)]


def _part(edges: list[int], order: Column, tie: Column) -> Column:
    """Number of the range that a row falls into; the order of the ranges is that of (order, tie).

    ``edges`` are quantiles: one that occurs several times is an id with that many ranges' worth of rows, which its ties
    are dealt over.
    """
    if not edges:
        return F.lit(0)
    values = F.array(*[F.lit(e).cast("long") for e in edges])
    below = F.size(F.filter(values, lambda x: x < order))
    hot = sorted({e for e in edges if edges.count(e) > 1})
    same = F.when(order.isin(hot), F.size(F.filter(values, lambda x: x == order))) if hot else F.when(F.lit(False), 0)
    within = F.floor((tie.cast("double") / 2.0**64 + 0.5) * same)
    single = F.when(order.isin(sorted(set(edges) - set(hot))), 1).otherwise(0)
    return (below + F.coalesce(F.least(within + 1, same), single)).cast("int")


def with_next(df: DataFrame, id_col: str, text_col: str, parts: int | None = None) -> DataFrame:
    """(part, id, text, filler), sorted within partitions by part, filler, id and tie descending.

    Every part is a range of ids in one task. Its last row is a filler: the first row of the part that follows (of the
    first part after the last), so that each row's next one stands behind it.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = df.select(F.col(id_col).alias("id"), text.alias("text"), F.coalesce(F.col(id_col).cast("long"), F.lit(-(2**63))).alias("order"), F.xxhash64(text).alias("tie"))
    parts = parts or 4 * shuffle_width(df.sparkSession)
    asked = [i / parts for i in range(1, parts)]
    edges = sorted(df.agg(F.percentile_approx(F.coalesce(F.col(id_col).cast("long"), F.lit(-(2**63))), asked, 20 * parts).alias("e")).first()["e"] or [])
    rows = rows.withColumn("part", _part(edges, F.col("order"), F.col("tie")))
    # one row per part: where it begins
    heads = sorted(rows.groupBy("part").agg(F.max(F.struct("order", "tie")).alias("h")).select("part", "h.order", "h.tie").collect(), reverse=True)
    follows = [(p, o, t) for (p, _, _), (_, o, t) in zip(heads, heads[1:] + heads[:1], strict=True)]
    fillers = F.broadcast(df.sparkSession.createDataFrame(follows, "to int, order long, tie long"))
    extra = rows.join(fillers, ["order", "tie"]).select(F.col("to").alias("part"), "id", "text", "order", "tie").dropDuplicates(["part"])
    both = rows.select("part", "id", "text", "order", "tie").withColumn("filler", F.lit(False)).unionByName(extra.withColumn("filler", F.lit(True)))
    laid = both.repartition("part").sortWithinPartitions("part", "filler", F.desc("order"), F.desc("tie"))
    return laid.select("part", "id", "text", "filler")


def compare(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``df``: the id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The next document is the one with the next smaller id (of equal ids, texts in the order of a hash; a null id comes
    last), after the last one the first. The edited text has the last half of the text replaced by the beginning of the
    next one. Ids are integers; null texts are empty; only the two columns are read, so others may have any name.
    """
    rank = ranks(df, text_col)
    kind = dict(df.dtypes)[id_col]

    def run(batches):
        held: list = []  # (part, id scalar row, text, filler) of which the next row is not known yet
        size = 0
        for batch in batches:
            for i in range(batch.num_rows):
                text = batch.column(2)[i].as_py()
                held.append((batch.column(0)[i].as_py(), batch.column(1)[i].as_py(), text, batch.column(3)[i].as_py()))
                size += len(text)
                if size > PIECE and len(held) > 1:
                    yield block(held)
                    held, size = held[-1:], len(text)
        if len(held) > 1:
            yield block(held)

    def block(held):
        """All rows but the last, which is the first of the next block; fillers are next rows only."""
        mine = [k for k in range(len(held) - 1) if not held[k][3]]
        texts = [held[k][2] for k in range(len(held))]
        edited = []
        for k in mine:
            t = texts[k]
            half = len(t) // 2
            edited.append(t[: len(t) - half] + texts[k + 1][:half])
        prints = fingerprint(texts + edited, rank)
        own, changed = prints[: len(texts)], prints[len(texts) :]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([held[k][1] for k in mine], kinds),
                pa.array([len(texts[k]) for k in mine], pa.int64()),
                pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited], pa.string()),
                pa.array([str(own[k]) for k in mine], pa.string()),
                pa.array([str(f) for f in changed], pa.string()),
                pa.array([own[k].likeness(f) for k, f in zip(mine, changed, strict=True)], pa.float64()),
                pa.array([own[k].likeness(own[k + 1]) for k in mine], pa.float64()),
            ],
            ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
        )

    kinds = {"bigint": pa.int64(), "int": pa.int32(), "smallint": pa.int16(), "tinyint": pa.int8()}[kind]
    schema = f"id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return with_next(df, id_col, text_col).mapInArrow(run, schema).withColumnRenamed("id", id_col)
