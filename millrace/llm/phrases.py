"""Substring dedup with repeated-phrase automata.

Every window of ``WINDOW`` words is anchored at the least hash among its groups of ``SEED`` words. Anchors that stand in
one document only cannot belong to a passage that repeats; asking the corpus about each chunk's anchors leaves the
candidates. Their passages, a few words around the anchor, go to the shard of the anchor (for an anchor that is very
frequent, to the shard of each single window). A shard confirms which windows repeat, word by word, compiles them into
an Aho-Corasick automaton over word numbers, and streams the passages of all documents through it to locate every
occurrence and the first document of each. The chunks then mark the words that such windows of an earlier document cover.

Ids order documents, null ids come last; windows of rows with the same id never remove each other.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import gather
from millrace.llm.words import BASE, BASE_INVERSE, NULL_ID, STEPS, U, Words, buffers, ids, mix, powers, slices, windows, winnow

WINDOW, SEED = 13, 6
HOT = 2_000  # rows with an anchor from which on its windows are spread over all shards
PIECE = "shard int, chunk int, piece int, lo long, hi long, body binary"


class Anchors:
    """Windows of a slice of texts and their anchors."""

    def __init__(self, w):
        h = w.hashes()
        _, self.at = windows(h, WINDOW, w.doc)
        seeds, _ = windows(h, SEED)
        self.seed_at = winnow(seeds, WINDOW - SEED + 1)[self.at] if len(self.at) else self.at
        self.key = seeds[self.seed_at] if len(self.at) else np.zeros(0, U)
        self.h = h


def _anchor_rows(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (anchor, row) pairs of a chunk."""
    keys, rows = [np.zeros(0, U)], [np.zeros(0, np.int64)]
    for i, _, w in slices(table.column("text")):
        a = Anchors(w)
        keys.append(a.key)
        rows.append(i + w.doc[a.at])
    keys, rows = np.concatenate(keys), np.concatenate(rows)
    order = np.lexsort((rows, keys))
    keys, rows = keys[order], rows[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (rows[1:] != rows[:-1])
    return keys[new], rows[new]


def anchors(docs: DataFrame, buckets: int, hot: int = HOT) -> DataFrame:
    """Replies: for each of a chunk's anchors 0 if one row has it, 1 if several, 2 if ``hot`` or more."""

    def request(table: pa.Table) -> pa.Table:
        keys, n = np.unique(_anchor_rows(table)[0], return_counts=True)
        return gather.requests(table.column("chunk")[0].as_py(), keys, n.astype(np.uint32), buckets)

    def reduce(table: pa.Table) -> pa.Table:
        keys, n, sizes = gather.opened(table, np.uint32)
        _, at = np.unique(keys, return_inverse=True)
        total = np.bincount(at, n).astype(np.int64)
        level = np.where(total < 2, 0, np.where(total < hot, 1, 2)).astype(np.uint8)
        return gather.replies(table, level[at], sizes)

    return gather.ask(docs, request, reduce)


class Pieces:
    """The passages of a chunk whose anchors repeat: per occurrence ``row``, ``word`` (of its text), ``count`` of windows,
    ``shard`` key and ``piece`` number. Equal passages have one number; numbers depend on the chunk only.
    """

    def __init__(self, table: pa.Table, theirs: pa.Table):
        keys = np.unique(_anchor_rows(table)[0])
        level = gather.answers(theirs, np.uint8) if theirs.num_rows else np.zeros(len(keys), np.uint8)
        parts, self.where, self.slices = [], [], []
        for i, _, w in slices(table.column("text")):
            a = Anchors(w)
            self.slices.append(w)
            lv = level[np.searchsorted(keys, a.key)] if len(a.at) else np.zeros(0, np.uint8)
            take = np.flatnonzero(lv)
            if not len(take):
                continue
            at, seed, lv = a.at[take], a.seed_at[take], lv[take]
            new = np.ones(len(take), bool)
            new[1:] = (seed[1:] != seed[:-1]) | (at[1:] != at[:-1] + 1) | (lv[1:] == 2)
            start = np.flatnonzero(new)
            count = np.diff(np.append(start, len(take)))
            p = at[start]
            head = np.zeros(len(start), U)
            for k in range(WINDOW):  # of the first window; only hot anchors are dealt by it
                head += a.h[p + k] * STEPS[k]
            total = np.zeros(len(a.h) + 1, U)
            np.cumsum(a.h * powers(BASE, len(a.h)), out=total[1:])
            end = p + count + WINDOW - 1
            whole = mix((total[end] - total[p]) * powers(BASE_INVERSE, len(a.h))[p] + count.astype(U))
            row = i + w.doc[p]
            parts.append((row, p - w.first[w.doc[p]], count, np.where(lv[start] == 2, mix(head), a.key[take][start]), whole))
            self.where.append(np.stack([np.full(len(p), len(self.slices) - 1), w.start[p], w.end[end - 1]], 1))
        empty = (np.zeros(0, np.int64),) * 3 + (np.zeros(0, U),) * 2
        self.row, self.word, self.count, self.shard, whole = (np.concatenate(x) for x in zip(empty, *parts, strict=True))
        _, self.first, self.piece = np.unique(whole, return_index=True, return_inverse=True)
        self.where = np.concatenate([np.zeros((0, 3), np.int64), *self.where])

    def bodies(self) -> list[bytes]:
        """Words of each distinct passage, joined by a space."""
        return [b" ".join(self.slices[k].data[s:e].tobytes().split()) for k, s, e in self.where[self.first].tolist()]


def _of_runs(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start[i], start[i] + 1, ... count[i] numbers for each i."""
    ends = np.cumsum(count)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - (ends - count), count)


def locate(table: pa.Table) -> pa.Table:
    """A shard's passages to replies: for each the first document of each of its windows (NULL_ID: it does not repeat)."""
    import ahocorasick

    w = Words(*buffers(table.column("body").cast(pa.string())))
    _, number = np.unique(w.hashes(), return_inverse=True)
    lows, highs = table.column("lo").to_numpy(), table.column("hi").to_numpy()
    found, at = windows(w.hashes(), WINDOW, w.doc)
    order = np.argsort(found, kind="stable")
    start = np.flatnonzero(np.append(True, np.diff(found[order]) != 0)) if len(order) else order
    lo, hi = np.minimum.reduceat(lows[w.doc[at[order]]], start), np.maximum.reduceat(highs[w.doc[at[order]]], start)
    confirmed = np.flatnonzero(lo < hi)  # it stands in two documents
    automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
    number = number.tolist()
    for p, first in zip(at[order[start[confirmed]]].tolist(), lo[confirmed].tolist(), strict=True):
        automaton.add_word(tuple(number[p : p + WINDOW]), first)
    some = np.zeros(len(found), bool)  # passages without a confirmed window need not be streamed
    some[order] = np.repeat(lo < hi, np.diff(np.append(start, len(order))))
    rows = np.unique(w.doc[at[some]])
    out = []
    if len(automaton):
        automaton.make_automaton()
        for a, b in zip(w.first[rows].tolist(), w.first[rows + 1].tolist(), strict=True):
            firsts = [NULL_ID] * (b - a - WINDOW + 1)
            for end, first in automaton.iter(tuple(number[a:b])):
                firsts[end - WINDOW + 1] = first
            out.append(firsts)
    sizes = [len(x) for x in out]
    flat, ends = np.array([x for firsts in out for x in firsts], np.int64), np.cumsum(sizes)
    packed = pa.array([flat[e - n : e].tobytes() for e, n in zip(ends, sizes, strict=True)], pa.binary())
    return pa.table({"chunk": table.column("chunk").take(rows), "piece": table.column("piece").take(rows), "firsts": packed})


def remove(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", chunk_bytes: int = gather.CHUNK_BYTES) -> DataFrame:
    """One row per document: id, n_words, n_removed, ``kept`` (words that stay, joined by one space).

    A word goes if a window of WINDOW words that covers it also starts in a document with a smaller id.
    """
    docs, chunks = gather.chunked(df, id_col, text_col, chunk_bytes)
    buckets, shards = max(1, chunks // 4), 2 * chunks
    reply = anchors(docs, buckets)

    def send(table: pa.Table, theirs: pa.Table) -> pa.Table:
        p = Pieces(table, theirs)
        n = len(p.first)
        id_of = ids(table.column("id"))[p.row]
        lo, hi = np.full(n, NULL_ID), np.full(n, -(2**63))
        np.minimum.at(lo, p.piece, id_of)
        np.maximum.at(hi, p.piece, id_of)
        chunk = table.column("chunk")[0].as_py() if table.num_rows else 0
        shard = gather.bucket_of(mix(p.shard[p.first]), shards).astype(np.int32)
        return pa.table({"shard": pa.array(shard), "chunk": pa.array(np.full(n, chunk, np.int32)), "piece": pa.array(np.arange(n, dtype=np.int32)), "lo": pa.array(lo), "hi": pa.array(hi), "body": pa.array(p.bodies(), pa.binary())})

    located = gather.answered(docs, reply, send, PIECE).groupBy("shard").applyInArrow(locate, "chunk int, piece int, firsts binary")
    none = F.lit(None)
    both = reply.select("chunk", "bucket", "vals", none.cast("int").alias("piece")).unionByName(located.select("chunk", none.cast("int").alias("bucket"), F.col("firsts").alias("vals"), "piece"))
    kind = dict(docs.dtypes)["id"]

    def mark(table: pa.Table, theirs: pa.Table) -> pa.Table:
        known = theirs.filter(pc.is_valid(theirs.column("piece")))
        p = Pieces(table, theirs.filter(pc.is_null(theirs.column("piece"))).select(["chunk", "bucket", "vals"]))
        id_of = ids(table.column("id"))
        # the answers one after another, and where those of each piece begin
        firsts = np.frombuffer(b"".join(known.column("vals").to_pylist()), np.int64)
        sizes = pc.binary_length(known.column("vals")).to_numpy() // 8
        begin = np.full(len(p.first), -1)
        begin[known.column("piece").to_numpy()] = np.cumsum(sizes) - sizes
        has = np.flatnonzero(begin[p.piece] >= 0)
        count = p.count[has]
        later = firsts[_of_runs(begin[p.piece[has]], count)] < np.repeat(id_of[p.row[has]], count)
        words_of = np.concatenate([np.zeros(0, np.int64), *[np.diff(w.first) for w in p.slices]])
        base = np.concatenate([[0], np.cumsum(words_of)])
        at = _of_runs(base[p.row[has]] + p.word[has], count)[later]
        edge = np.bincount(at, minlength=base[-1] + WINDOW + 1) - np.bincount(at + WINDOW, minlength=base[-1] + WINDOW + 1)
        stays = np.cumsum(edge)[: base[-1]] == 0
        gone = np.concatenate([[0], np.cumsum(~stays)])
        n_removed = gone[base[1:]] - gone[base[:-1]]
        kept, row = [], 0
        for w in p.slices:
            for a, b in zip(w.offsets[:-1].tolist(), w.offsets[1:].tolist(), strict=True):
                text = w.data[a:b].tobytes().split()
                kept.append(b" ".join(compress(text, stays[base[row] : base[row + 1]].tolist()) if n_removed[row] else text))
                row += 1
        return pa.table({"id": table.column("id"), "n_words": pa.array(words_of), "n_removed": pa.array(n_removed), "kept": pa.array(kept, pa.binary()).cast(pa.string())})

    return gather.answered(docs, both, mark, f"id {kind}, n_words long, n_removed long, kept string").withColumnRenamed("id", id_col)
