"""BPE encoding and decoding of long texts by tree concatenation.

A text of up to ``piece`` characters is encoded as it is. A longer one is cut anywhere, also within a word, into equal pieces
that are encoded in separate tasks and then joined in pairs up a tree. At a join the text around the cut is encoded anew
in a window that grows until both sides agree: its first word is the one that the left side has there, and from some word
on, behind the cut, it has the words of the right side. Pre-tokenizers read from left to right and start afresh at each
word, so the joined tokens are those of the joined text; a window that has grown to both whole sides is that text.

A run without white space that is longer than ``piece`` would make such windows as long as itself. If the tokenizer
drops white space (which is tested, not assumed), such a run is a text of its own, whose words are cut anywhere and joined
as fragments: the window around the cut is doubled until the tokens beside its edges are what BPE makes of the two of them
together. A sequence of which every adjacent pair passes this test is the encoding of the word.

So the ids are exactly those of the tokenizer. Nulls count as empty texts, empty texts give no ids, equal rows stay
separate rows, further columns are dropped and may have any name, an empty table gives an empty table.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.chunks import packed, unpacked

@lru_cache(maxsize=2)
def load(path: str):
    import os

    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks already use all cores
    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    return tok


class Fragments:
    """BPE of parts of one word: only a word's last part carries the end-of-word suffix."""

    def __init__(self, path: str):
        from tokenizers.models import BPE

        model = json.load(open(path))["model"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        suffix = model.get("end_of_word_suffix") or ""
        self.cut = len(suffix)
        self.inner = BPE(model["vocab"], merges)
        self.final = BPE(model["vocab"], merges, end_of_word_suffix=suffix) if suffix else self.inner

    def encode(self, text: str, last: bool) -> tuple[list[int], list[int]]:
        """Token ids and the number of characters that each covers."""
        tokens = (self.final if last else self.inner).tokenize(text)
        sizes = [len(t.value) for t in tokens]
        if last and sizes:
            sizes[-1] -= self.cut
        return [t.id for t in tokens], sizes

    def agree(self, x: int, y: int, text: str, last: bool) -> bool:
        return self.encode(text, last)[0] == [x, y]

    def join(self, a: tuple, b: tuple) -> tuple:
        """The encoding of a's text followed by b's. Each is (ids, sizes, text, last)."""
        (ai, asz, at, _), (bi, bsz, bt, last) = a, b
        if not ai or not bi:
            return (ai + bi, asz + bsz, at + bt, last)
        width = 2
        while True:
            m, n = min(width, len(ai)), min(width, len(bi))
            left, right = sum(asz[len(asz) - m :]), sum(bsz[:n])
            ids, sizes = self.encode(at[len(at) - left :] + bt[:right], last and n == len(bi))
            ok = m == len(ai) or self.agree(ai[-m - 1], ids[0], at[len(at) - left - asz[-m - 1] :][: asz[-m - 1]] + (at[len(at) - left :] + bt[:right])[: sizes[0]], last and n == len(bi) and len(ids) == 1)
            if ok and n < len(bi):
                seam = (at[len(at) - left :] + bt[:right])[left + right - sizes[-1] :]
                ok = self.agree(ids[-1], bi[n], seam + bt[right : right + bsz[n]], last and n + 1 == len(bi))
            if ok:
                return (ai[: len(ai) - m] + ids + bi[n:], asz[: len(asz) - m] + sizes + bsz[n:], at + bt, last)
            width *= 2

    def tree(self, parts: list[tuple]) -> list[int]:
        while len(parts) > 1:
            parts = [self.join(*parts[i : i + 2]) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
        return parts[0][0]


@lru_cache(maxsize=2)
def fragments(path: str) -> Fragments:
    return Fragments(path)


class Piece:
    """Tokens of a part of a text: ids, places (in the whole text) where they begin and end, and which of them begin a word."""

    def __init__(self, begin: int, end: int, ids, starts, ends, words):
        self.begin, self.end = begin, end
        self.ids, self.starts, self.ends, self.words = (np.asarray(x) for x in (ids, starts, ends, words))

    @staticmethod
    def of(tok, text: str, begin: int) -> "Piece":
        e = tok.encode(text, add_special_tokens=False)
        spans = np.array(e.offsets, np.int64).reshape(-1, 2) + begin
        number = np.array([-1 - k if w is None else w for k, w in enumerate(e.word_ids)], np.int64)
        return Piece(begin, begin + len(text), np.array(e.ids, np.int32), spans[:, 0], spans[:, 1], np.diff(number, prepend=number[:1] - 1) != 0)

    def packed(self) -> bytes:
        """All but the text and its place, in few bytes."""
        parts = [packed(x) for x in (self.ids, np.diff(self.starts, prepend=self.begin), self.ends - self.starts, self.words)]
        return b"".join(len(x).to_bytes(4, "little") + x for x in parts)

    @staticmethod
    def unpacked(data: bytes, begin: int, end: int) -> "Piece":
        arrays = []
        while data:
            n = int.from_bytes(data[:4], "little")
            arrays.append(unpacked(data[4 : 4 + n]))
            data = data[4 + n :]
        ids, gaps, sizes, words = arrays
        starts = begin + np.cumsum(gaps)
        return Piece(begin, end, ids.astype(np.int32), starts, starts + sizes, words.astype(bool))

    def word(self, i: int) -> tuple:
        """Tokens and places of the word that begins with token i."""
        later = np.flatnonzero(self.words[i + 1 :])
        j = i + 1 + int(later[0]) if len(later) else len(self.ids)
        return self.ids[i:j].tolist(), int(self.starts[i]), int(self.ends[j - 1])


def join(tok, text: str, a: Piece, b: Piece, width: int = 64) -> Piece:
    """The encoding of the text of both pieces. ``width`` (characters beside the cut that a window has at first) is to be more
    than special tokens have."""
    cut = a.end
    while True:
        # from the end of a word of the left side to the end of a word of the right one
        firsts = np.flatnonzero(a.words & (a.starts <= cut - width))
        i = int(firsts[-1]) if len(firsts) else 0
        left = int(a.ends[i - 1]) if i else a.begin
        lasts = np.flatnonzero(np.append(b.words[1:], True) & (b.ends >= cut + width)) if len(b.ids) else ()
        right = int(b.ends[lasts[0]]) if len(lasts) else b.end
        whole_left, whole_right = i == 0, not len(lasts) or lasts[0] == len(b.ids) - 1
        if whole_right:
            right = b.end
        w = Piece.of(tok, text[left:right], left)
        settled = whole_left or (len(w.ids) > 0 and w.word(0) == a.word(i))
        if settled and whole_right:
            parts = [(a, 0, i), (w, 0, len(w.ids))]
        elif settled:
            # a word behind the cut that both have, and that the end of the window has not cut off
            mine = np.flatnonzero(w.words & (w.starts >= cut))[:-1]
            theirs = {int(b.starts[k]): k for k in np.flatnonzero(b.words & (b.starts < right)).tolist()}
            same = next(((k, theirs[s]) for k in mine.tolist() if (s := int(w.starts[k])) in theirs and w.word(k) == b.word(theirs[s])), None)
            parts = [(a, 0, i), (w, 0, same[0]), (b, same[1], len(b.ids))] if same else None
        else:
            parts = None
        if parts:
            glue = lambda f: np.concatenate([getattr(p, f)[x:y] for p, x, y in parts])  # noqa: B023, E731
            return Piece(a.begin, b.end, glue("ids"), glue("starts"), glue("ends"), glue("words"))
        width *= 2


def tree(tok, text: str, parts: list[Piece]) -> Piece:
    while len(parts) > 1:
        parts = [join(tok, text, *parts[i : i + 2]) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
    return parts[0]


@lru_cache(maxsize=2)
def drops_space(path: str) -> bool:
    """Does white space only part words, so that words can be encoded one by one? Decided by trying every kind of it."""
    tok = load(path)
    ids = lambda t: tok.encode(t, add_special_tokens=False).ids
    one, two = ids("ab"), ids("cd")
    return all(ids(f"ab{c}cd") == one + two and ids(f"{c}ab{c}{c}") == one and ids(f"ab{c} {c}cd") == one + two for c in " \t\n\v\f\r")


class WordCache:
    """Ids and decoded text of words between ASCII white space, where no token can span; each new word is encoded once."""

    def __init__(self, tok, most: int = 400_000):
        self.tok, self.most = tok, most
        self.clear()

    def clear(self):
        self.number, self.start, self.size, self.flat, self.text = {}, array("q"), array("q"), array("i"), []

    def learn(self, words: list[bytes]) -> None:
        for w, x in zip(words, self.tok.encode_batch_fast([w.decode() for w in words], add_special_tokens=False), strict=True):
            self.number[w] = len(self.text)
            self.start.append(len(self.flat))
            self.size.append(len(x.ids))
            self.flat.extend(x.ids)
            self.text.append(self.tok.decode(x.ids, skip_special_tokens=False))

    def code(self, texts: list[bytes], decode: bool) -> tuple[np.ndarray, np.ndarray, list]:
        """Offsets of the texts in the ids, ids, decoded texts. Without a decoder decoded words are joined by a space."""
        if len(self.text) > self.most:
            self.clear()
        words = [t.split() for t in texts]
        if new := list({w for ws in words for w in ws}.difference(self.number)):
            self.learn(new)
        number = self.number
        at = [[number[w] for w in ws] for ws in words]
        flat = np.array(list(chain.from_iterable(at)), np.int64)
        sizes = np.array(self.size, np.int64)[flat]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        offsets = ends[np.concatenate([[0], np.cumsum([len(x) for x in at])]).astype(np.int64)]
        ids = np.array(self.flat, np.int32)[np.arange(ends[-1]) + np.repeat(np.array(self.start, np.int64)[flat] - ends[:-1], sizes)]
        if not decode:
            return offsets, ids, [None] * len(texts)
        if self.tok.decoder is not None:
            return offsets, ids, [self.tok.decode(ids[a:b].tolist(), skip_special_tokens=False) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        text = self.text
        return offsets, ids, [" ".join([y for k in x if (y := text[k])]) for x in at]


def cut(text: str, piece: int, tok, alone: bool) -> Iterator[tuple[int, int, bool, str | None, list[int] | None]]:
    """(segment, run, last, piece, ids). Run 0: the next piece of a segment of the text. A higher number: a fragment of that
    over-long word. Or finished ids. ``alone``: white space parts words."""
    begin, segment, run = 0, 0, 0
    for m in re.finditer(rf"[^\x20\x09-\x0D]{{{piece + 1},}}", text) if alone else ():
        yield from ((segment, 0, True, x, None) for x in equal_parts(text[begin : m.start()], piece))
        for new, last, x, ids in unsplit(m.group(), piece, tok):
            run += new
            yield segment + 1, 0 if ids is not None else run, last, x, ids
        begin, segment = m.end(), segment + 2
    yield from ((segment, 0, True, x, None) for x in equal_parts(text[begin:], piece))


def equal_parts(text: str, piece: int) -> list[str]:
    n = -(-len(text) // piece)
    return [text[len(text) * k // n : len(text) * (k + 1) // n] for k in range(n)]


def unsplit(text: str, piece: int, tok) -> Iterator[tuple[int, bool, str | None, list[int] | None]]:
    """(1 where a new over-long word begins, last, piece, ids) of text without white space."""
    special = {t.content: i for i, t in tok.get_added_tokens_decoder().items()}
    pattern = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
    for part in pattern.split(text) if pattern else [text]:
        if part in special:
            yield 0, True, None, [special[part]]
            continue
        normal = tok.normalizer.normalize_str(part) if tok.normalizer else part
        done: list[int] = []
        for word, _ in tok.pre_tokenizer.pre_tokenize_str(normal):
            if len(word) <= piece:
                done += [t.id for t in tok.model.tokenize(word)]
                continue
            if done:
                yield 0, True, None, done
                done = []
            for i in range(0, len(word), piece):
                yield int(i == 0), i + piece >= len(word), word[i : i + piece], None
        if done:
            yield 0, True, None, done


def encode(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", piece: int = 32_768, decode: bool = True) -> DataFrame:
    """One row per input row: the id column, ``ids`` array<int>, and ``decoded`` (decode(ids, skip_special_tokens=False)).

    ``piece``: characters that one task encodes at once. Texts up to it are encoded where they are read; pieces of longer
    ones are spread over all tasks.
    """
    key_type = dict(df.dtypes)[id_col]
    docs = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    schema = f"id {key_type}, ids array<int>, decoded string"
    long = F.length("text") > piece

    def done(tok, keys, ids) -> pa.RecordBatch:
        texts = [tok.decode(x, skip_special_tokens=False) for x in ids] if decode else [None] * len(ids)
        return pa.RecordBatch.from_arrays([keys, pa.array(ids, pa.list_(pa.int32())), pa.array(texts, pa.string())], ["id", "ids", "decoded"])

    def whole(batches):
        tok = load(path)
        cache = WordCache(tok) if drops_space(path) else None
        for batch in batches:
            for i in range(0, batch.num_rows, 1000):
                part = batch.slice(i, 1000)
                if cache is None:
                    yield done(tok, part.column(0), [e.ids for e in tok.encode_batch_fast(part.column(1).to_pylist(), add_special_tokens=False)])
                    continue
                offsets, ids, texts = cache.code(part.column(1).cast(pa.binary()).to_pylist(), decode)
                coded = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([part.column(0), coded, pa.array(texts, pa.string())], ["id", "ids", "decoded"])

    def cutting(batches):
        tok = load(path)
        for batch in batches:
            for r in range(batch.num_rows):
                rows = [(k, *x) for k, x in enumerate(cut(batch.column(1)[r].as_py(), piece, tok, drops_space(path)))]
                for i in range(0, len(rows), 64):
                    part, segment, run, last, text, ids = map(list, zip(*rows[i : i + 64], strict=True))
                    n = len(part)
                    repeat = lambda c: pa.concat_arrays([batch.column(c).slice(r, 1)] * n)  # noqa: B023, E731
                    done_ids = [None if x is None else packed(np.array(x, np.int32)) for x in ids]
                    columns = [pa.array(part, pa.int64()), pa.array(segment, pa.int32()), pa.array(run, pa.int32()), pa.array(last, pa.bool_()), pa.array(text, pa.string()), pa.array(done_ids, pa.binary())]
                    yield pa.RecordBatch.from_arrays([repeat(0), repeat(2), repeat(3), *columns], names)

    def pieces(batches):
        tok = load(path)
        for batch in batches:
            for i in range(0, batch.num_rows, 64):
                rows = batch.slice(i, 64)
                out = []
                for x in rows.select(["run", "last", "text", "data"]).to_pylist():
                    if x["data"] is not None:
                        out.append(x["data"])
                    elif x["run"] == 0:
                        out.append(Piece.of(tok, x["text"], 0).packed())
                    else:
                        out.append(packed(np.array(fragments(path).encode(x["text"], x["last"])[0], np.int32)))
                yield pa.RecordBatch.from_arrays([*rows.columns[:8], pa.array(out, pa.binary())], names)

    def merge(table: pa.Table) -> pa.Table:
        tok, ids = load(path), []
        rows = sorted(table.select(["part", "segment", "run", "last", "text", "data"]).to_pylist(), key=lambda x: x["part"])
        for _, same in groupby(rows, lambda x: (x["segment"], x["run"], x["text"] is None)):
            same = list(same)
            if same[0]["text"] is None:
                ids += [unpacked(x["data"]).astype(np.int32) for x in same]
            elif same[0]["run"]:
                f, open_ = fragments(path), []
                for x in same:
                    own = unpacked(x["data"]).tolist()
                    values = [len(tok.id_to_token(i)) for i in own]
                    if x["last"] and values:
                        values[-1] -= f.cut
                    open_.append((own, values, x["text"], x["last"]))
                ids.append(np.array(f.tree(open_), np.int32))
            else:
                text, parts = "".join(x["text"] for x in same), []
                for x in same:
                    at = parts[-1].end if parts else 0
                    p = Piece.unpacked(x["data"], 0, len(x["text"]))
                    parts.append(Piece(at, at + len(x["text"]), p.ids, p.starts + at, p.ends + at, p.words))
                ids.append(tree(tok, text, parts).ids)
        whole_ids = np.concatenate(ids).tolist() if ids else []
        copies = table.column("copies")[0].as_py()
        return pa.Table.from_batches([done(tok, pa.concat_arrays([table.column("id").combine_chunks().slice(0, 1)] * copies), [whole_ids] * copies)])

    # equal rows are counted, so that the pieces of one are never mixed up with those of the other
    longs = docs.where(long).groupBy("id", F.sha2("text", 256).alias("key")).agg(F.first("text").alias("text"), F.count("*").alias("copies")).select("id", "text", "key", "copies")
    names = ["id", "key", "copies", "part", "segment", "run", "last", "text", "data"]
    parts = f"id {key_type}, key string, copies long, part long, segment int, run int, last boolean, text string, data binary"
    spread = longs.mapInArrow(cutting, parts).repartition("id", "key", "part")
    joined = spread.mapInArrow(pieces, parts).groupBy("id", "key").applyInArrow(merge, schema)
    out = docs.where(~long).mapInArrow(whole, schema).unionByName(joined)
    return out.withColumnRenamed("id", id_col)
