"""Term counts, vocabularies, lemma lookup, integer sequences and document vectors."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.joins import bounded
from millrace.operators.running import numbered
from millrace.runtime import cut_lineage, shuffle_width

_HOT = 64
_SLICE = 1 << 20  # tokens that are looked at together
_VECTORS = 1 << 18  # word vectors that a task holds
_SHARE = 8  # shuffle partitions for each copy of the vectors
_CODEC = pa.Codec("zstd")


def token_slices(batches: Iterator[pa.RecordBatch], column: int, size: int = 0) -> Iterator[tuple[pa.RecordBatch, pa.DictionaryArray, np.ndarray]]:
    """Pieces of whole rows with about ``size`` tokens: the rows, their tokens in one array, and the row of each token."""
    size = size or _SLICE
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.list_value_length(batch.column(column)), 0).to_numpy())
        lo = 0
        while lo < batch.num_rows:
            before = ends[lo - 1] if lo else 0
            hi = max(lo + 1, int(np.searchsorted(ends, before + size, "right")))
            rows = batch.slice(lo, hi - lo)
            words = rows.column(column).flatten().dictionary_encode()
            yield rows, words, np.repeat(np.arange(hi - lo), np.diff(ends[lo:hi], prepend=before))
            lo = hi


def row_terms(df: DataFrame, key: str, tokens: Column) -> DataFrame:
    """(key, term, n): the words of every row, counted where they are; rows with equal keys are not added up."""
    keyed = df.select(F.col(key).alias("key"), tokens.alias("t"))

    def count(batches):
        for rows, words, row in token_slices(batches, 1):
            texts = words.dictionary.cast(pa.string())
            both, n = np.unique(row * max(1, len(texts)) + words.indices.to_numpy(), return_counts=True)
            at, word = both // max(1, len(texts)), both % max(1, len(texts))
            yield pa.RecordBatch.from_arrays([rows.column(0).take(pa.array(at)), texts.take(pa.array(word)), pa.array(n.astype(np.int64))], ["key", "term", "n"])

    return keyed.mapInArrow(count, f"key {keyed.schema['key'].dataType.simpleString()}, term string, n long").withColumnRenamed("key", key)


def packed(x: np.ndarray) -> bytes:
    """A compressed array; whole numbers in as few bytes as hold them."""
    if x.dtype.kind == "i":
        x = x.astype(np.min_scalar_type(int(x.max(initial=0))))
    raw = x.tobytes()
    return x.dtype.char.encode() + len(raw).to_bytes(8, "big") + _CODEC.compress(raw, asbytes=True)


def unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(_CODEC.decompress(data[9:], int.from_bytes(data[1:9], "big"), asbytes=True), data[:1].decode())


def packed_texts(texts: pa.StringArray) -> tuple[bytes, bytes]:
    """Lengths and letters of texts that are not null."""
    joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(texts)], pa.int32()), texts.cast(pa.binary())), b"")[0].as_py() if len(texts) else b""
    return packed(pc.binary_length(texts).to_numpy().astype(np.int64)), packed(np.frombuffer(joined, np.uint8))


def unpacked_texts(sizes: bytes, letters: bytes) -> pa.StringArray:
    ends = np.cumsum(np.r_[0, unpacked(sizes).astype(np.int64)]).astype(np.int32)
    return pa.StringArray.from_buffers(len(ends) - 1, pa.py_buffer(ends), pa.py_buffer(unpacked(letters)))


def lookup(left: DataFrame, right: DataFrame, key: str, counts: DataFrame, how: str = "inner") -> DataFrame:
    """Join long rows to a table with one row per key, frequent keys apart from the rest.

    ``counts`` (key, n) is the key frequency of ``left``. Rows of its 64 most frequent keys meet a
    broadcast of at most 64 rows, so no shuffle task receives a hot key; the others join normally.
    """
    hot = counts.orderBy(F.desc("n"), key).limit(_HOT).select(key)
    hot_right = F.broadcast(hot.join(right, key, how if how == "left" else "inner").limit(_HOT))
    frequent = left.join(hot_right, key)
    rare = left.join(F.broadcast(hot), key, "left_anti").join(right.hint("shuffle_hash"), key, how)
    return frequent.unionByName(rare)


def document_terms(df: DataFrame, key: str, tokens: Column) -> DataFrame:
    """Bag of words in long form: (key, term, n)."""
    return df.select(key, F.explode(tokens).alias("term")).groupBy(key, "term").agg(F.count("*").alias("n"))


def term_counts(df: DataFrame, tokens: Column, min_count: int = 1) -> DataFrame:
    return df.select(F.explode(tokens).alias("term")).groupBy("term").agg(F.count("*").alias("n")).where(F.col("n") >= min_count)


def term_frequency(df: DataFrame, tokens: Column, stopwords: list[str], k: int) -> DataFrame:
    """The ``k`` most frequent terms that are no stop words."""
    return term_counts(df, tokens).where(~F.col("term").isin(stopwords)).orderBy(F.desc("n"), "term").limit(k)


def ranked_vocabulary(df: DataFrame, tokens: Column, min_count: int = 1) -> DataFrame:
    """(term, n, idx): index 1 is the most frequent term, ties alphabetical; 0 is left for padding."""
    counts = term_counts(df, tokens, min_count).withColumn("__neg", -F.col("n"))
    return numbered(counts, "__neg", ["term"], name="idx").drop("__neg")


def rule_lemmas(counts: DataFrame, rules: list[tuple[str, str]], exceptions: DataFrame, shortest: int = 2) -> DataFrame:
    """(form, lemma) of every term of ``counts`` (term, n) whose lemma is another word.

    ``exceptions`` (form, lemma) decide first. Otherwise the first of the rules (ending, replacement) counts whose result has
    ``shortest`` letters or more and is a word of the vocabulary that is at least as frequent as the form. The work is per
    distinct term: a handful of candidates each, joined with the vocabulary.
    """
    guess = F.array_compact(
        F.array(*[F.when(F.col("term").endswith(a) & (F.length("term") - len(a) + len(b) >= shortest), F.struct(F.lit(i).alias("rule"), F.concat(F.substr("term", F.lit(1), F.length("term") - len(a)), F.lit(b)).alias("lemma"))) for i, (a, b) in enumerate(rules)])
    )
    listed = counts.join(exceptions.select(F.col("form").alias("term")), "term", "left_anti")
    tried = listed.select(F.col("term").alias("form"), F.col("n").alias("own"), F.inline(guess))
    known = tried.join(counts.select(F.col("term").alias("lemma"), "n"), "lemma").where("n >= own AND lemma <> form")
    ruled = known.groupBy("form").agg(F.min(F.struct("rule", "lemma")).alias("best")).select("form", "best.lemma")
    return ruled.unionByName(exceptions.select("form", "lemma"))


def lemma_counts(df: DataFrame, key: str, tokens: Column, rules: list[tuple[str, str]], exceptions: DataFrame) -> DataFrame:
    """(key, lemma, n): the bag of words with every form under its lemma; the vocabulary is that of the texts."""
    counts = cut_lineage(term_counts(df, tokens).withColumnRenamed("term", "form"))
    lemmas = cut_lineage(rule_lemmas(counts.withColumnRenamed("form", "term"), rules, exceptions))
    terms = row_terms(df, key, tokens).withColumnRenamed("term", "form")  # sent once, under their lemmas
    small = bounded(lemmas)
    found = lookup(terms, lemmas, "form", counts, "left") if small is None else terms.join(small, "form", "left")
    return found.groupBy(key, F.coalesce("lemma", "form").alias("lemma")).agg(F.sum("n").alias("n"))


def lemmatize(df: DataFrame, key: str, tokens: Column, lemmas: DataFrame) -> DataFrame:
    """(key, pos, form, lemma): the table's lemma, or the form itself."""
    long = df.select(key, F.posexplode(tokens).alias("pos", "form"))
    small = bounded(lemmas)
    found = lookup(long, lemmas, "form", long.groupBy("form").agg(F.count("*").alias("n")), "left") if small is None else long.join(small, "form", "left")
    return found.select(key, "pos", "form", F.coalesce("lemma", "form").alias("lemma"))


def encode_sequences(df: DataFrame, key: str, tokens: Column, vocabulary: DataFrame, maxlen: int, pad: str = "pre") -> DataFrame:
    """Fixed-length integer sequences; unknown words are dropped, 0 fills up.

    ``pre`` pads and cuts at the front, ``post`` at the end. The sort is within one document.
    """
    long = df.select(key, F.posexplode(tokens).alias("pos", "term"))
    joined = lookup(long, vocabulary.select("term", F.col("idx").cast("int").alias("idx")), "term", vocabulary.select("term", "n"))
    seq = F.transform(F.array_sort(F.collect_list(F.struct("pos", "idx"))), lambda s: s["idx"])
    lists = df.select(key).join(joined.groupBy(key).agg(seq.alias("s")), key, "left")
    s = F.coalesce("s", F.array().cast("array<int>"))
    zeros = F.array_repeat(F.lit(0), F.greatest(F.lit(maxlen) - F.size(s), F.lit(0)))
    if pad == "pre":
        cut = F.slice(s, F.greatest(F.size(s) - maxlen + 1, F.lit(1)), F.lit(maxlen))
        fixed = F.concat(zeros, cut)
    else:
        fixed = F.concat(F.slice(s, 1, maxlen), zeros)
    return lists.select(key, fixed.alias("sequence"))


def blend_vectors(vocabulary: DataFrame, trained: DataFrame, pretrained: DataFrame) -> DataFrame:
    """(word, vector): the pre-trained vector where one exists, else the trained one."""
    a = trained.select("word", F.col("vector").alias("__t"))
    b = pretrained.select("word", F.col("vector").alias("__p"))
    both = vocabulary.select("word").join(a, "word", "left").join(b, "word", "left")
    return both.select("word", F.coalesce("__p", "__t").alias("vector"))


def embedding_matrix(vocabulary: DataFrame, vectors: DataFrame, size: int) -> DataFrame:
    """(idx, vector) for every vocabulary index; words without a vector get zeros."""
    joined = vocabulary.select("term", "idx").join(vectors.select(F.col("word").alias("term"), "vector"), "term", "left")
    zeros = F.array_repeat(F.lit(0.0).cast("float"), size)
    return joined.select("idx", F.coalesce("vector", zeros).alias("vector"))


def document_vectors(df: DataFrame, key: str, tokens: Column, vectors: DataFrame, size: int, oov: str = "skip") -> DataFrame:
    """Mean of the word vectors per document.

    ``skip`` averages over known words, ``zero`` counts unknown words as zero vectors. Documents without known words get the
    zero vector.

    The vectors are dealt over blocks of ``_VECTORS`` by word and meet the words of a part of the documents there, so what is
    sent on is one sum per document and block, not a vector per word. Texts are sent in slices, each word once, as bytes.
    """
    kind = dict(vectors.dtypes)["vector"] if dict(vectors.dtypes)["vector"] == "array<float>" else "array<double>"
    own = vectors.select("word", F.col("vector").cast(kind).alias("v"))
    blocks = max(1, math.ceil(own.count() / _VECTORS))
    # every part gets a copy of the vectors, so there are no more parts than the cores need or the texts fill
    parts = max(1, math.ceil(2 * df.sparkSession.sparkContext.defaultParallelism / blocks), shuffle_width(df.sparkSession) // (_SHARE * blocks))
    keyed = df.select(F.col(key).alias("key"), tokens.alias("t"), F.pmod(F.xxhash64(key), F.lit(parts)).cast("int").alias("part"))
    key_type = keyed.schema["key"].dataType.simpleString()

    def send(batches):
        """A row per slice of the texts and block: the keys, and as bytes the row, the word and the number of each entry, and the words."""
        for rows, words, row in token_slices(batches, 1):
            texts, n_texts = words.dictionary.cast(pa.string()), max(1, len(words.dictionary))
            both, n = np.unique(row * n_texts + words.indices.to_numpy(), return_counts=True)
            row, word = both // n_texts, both % n_texts
            block = (pd.util.hash_array(texts.to_numpy(zero_copy_only=False), categorize=False) % np.uint64(blocks)).astype(np.int64) if len(texts) else np.zeros(0, np.int64)
            for b in np.unique(block[word]):
                mine = block[word] == b
                some, at = np.unique(word[mine], return_inverse=True)
                there, of = np.unique(row[mine], return_inverse=True)
                data = [packed(x) for x in (of.astype(np.int64), at.astype(np.int64), n[mine].astype(np.int64))]
                keys = pa.ListArray.from_arrays(pa.array([0, len(there)], pa.int32()), rows.column(0).take(pa.array(there)))
                columns = [pa.array([int(b)], pa.int32()), rows.column(2).slice(0, 1), keys, *(pa.array([x], pa.binary()) for x in (*data, *packed_texts(texts.take(pa.array(some)))))]
                yield pa.RecordBatch.from_arrays(columns, ["block", "part", "keys", "of", "at", "n", "sizes", "letters"])

    def deal(batches):
        for batch in batches:
            hashes = pd.util.hash_array(batch.column(0).to_numpy(zero_copy_only=False), categorize=False)
            block = pa.array((hashes % np.uint64(blocks)).astype(np.int32))
            for part in range(parts):
                yield pa.RecordBatch.from_arrays([block, pa.array(np.full(len(block), part, np.int32)), *batch.columns], ["block", "part", "word", "v"])

    left = keyed.mapInArrow(send, f"block int, part int, keys array<{key_type}>, of binary, at binary, n binary, sizes binary, letters binary")
    right = own.where("word IS NOT NULL").mapInArrow(deal, f"block int, part int, word string, v {kind}")

    def add(mine: pa.Table, theirs: pa.Table) -> pa.Table:
        keys, known, sums = [], [], []
        if mine.num_rows and theirs.num_rows:
            words = theirs.column("word").combine_chunks().dictionary_encode()
            at = words.indices.to_numpy()
            lists = theirs.column("v").combine_chunks()
            flat, length = lists.flatten(), pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
            row, place = np.repeat(np.arange(len(at)), length), np.arange(len(flat)) - np.repeat(np.cumsum(length) - length, length)
            use = (place < size) & pc.is_valid(flat).to_numpy(zero_copy_only=False)
            several = len(words.dictionary) < len(at)  # vectors of a word
            v, some = np.zeros((len(at), size), np.float32 if kind == "array<float>" and not several else float), np.zeros((len(at), size), bool)
            v[row[use], place[use]], some[row[use], place[use]] = flat.to_numpy(zero_copy_only=False)[use], True
            times = np.bincount(at)
            if not several:
                total, valid = np.empty_like(v), np.empty_like(some)
                total[at], valid[at] = v, some
            else:
                total, valid = np.zeros((len(words.dictionary), size)), np.zeros((len(words.dictionary), size), bool)
                np.add.at(total, at, v)
                np.logical_or.at(valid, at, some)
            for r in range(mine.num_rows):
                of, at, n, sizes, letters = (mine.column(c)[r].as_py() for c in ("of", "at", "n", "sizes", "letters"))
                place = pc.fill_null(pc.index_in(unpacked_texts(sizes, letters), value_set=words.dictionary), -1).to_numpy()[unpacked(at)]
                hit = place >= 0
                of, word, n = unpacked(of)[hit].astype(np.int64), place[hit], unpacked(n)[hit].astype(np.int64)
                own_keys = mine.column("keys")[r].values
                for lo in range(0, len(of), 1 << 16):  # sums of a row that is cut in two are added up later
                    part = slice(lo, lo + (1 << 16))
                    first = np.flatnonzero(np.diff(of[part], prepend=-1))
                    summed = np.add.reduceat(total[word[part]] * n[part, None].astype(float), first, axis=0)
                    there = np.logical_or.reduceat(valid[word[part]], first, axis=0)
                    keys.append(own_keys.take(pa.array(of[part][first])))
                    known.append(np.add.reduceat(n[part] * times[word[part]], first))
                    flat = pa.array(summed.reshape(-1), mask=~there.reshape(-1))
                    sums.append(pa.ListArray.from_arrays(pa.array(np.arange(len(first) + 1, dtype=np.int32) * size), flat))
        key_kind = mine.schema.field("keys").type.value_type
        return pa.table([pa.chunked_array(keys, key_kind), pa.chunked_array([pa.array(n.astype(np.int64)) for n in known], pa.int64()), pa.chunked_array(sums, pa.list_(pa.float64()))], ["key", "known", "s"])

    found = left.groupBy("block", "part").cogroup(right.groupBy("block", "part")).applyInArrow(add, f"key {key_type}, known long, s array<double>")
    sums = found.groupBy(F.col("key").alias(key)).agg(F.array(*[F.sum(F.get("s", F.lit(i))) for i in range(size)]).alias("sums"), F.sum("known").alias("known"))
    base = df.select(key, F.size(tokens).alias("words")).join(sums, key, "left")
    weight = F.col("known") if oov == "skip" else F.col("words")
    mean = F.transform("sums", lambda x: x / weight)
    return base.select(key, F.coalesce(mean, F.array_repeat(F.lit(0.0), size)).alias("vector"))
