"""Token chunks that are written once, and what they and the buckets of keys tell each other, in few bytes.

A chunk is a few MB of documents that stand together in the input. Its first row has its sorted distinct word hashes, the
others some of its documents each: ids, numbers of tokens, and every token as its number among these words. The table is
bucketed by chunk, so that rounds that join it with replies shuffle the replies only.
"""

from __future__ import annotations

import gc
import time
import uuid

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.gather import bucket_of
from millrace.llm.words import U
from millrace.runtime import work_path

REQUEST = "bucket int, chunk long, keys binary, vals binary"
REPLY = "chunk long, bucket int, vals binary"
PIECE = 1 << 17  # tokens of a row
COMPRESS, EXPAND = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def packed(x: np.ndarray) -> bytes:
    """Whole numbers byte plane by byte plane up to the last that is not empty, compressed."""
    x = x.astype(np.int64, copy=False)
    x = ((x << 1) ^ (x >> 63)).view(U)
    planes = -(-int(x.max(initial=0)).bit_length() // 8)
    data = b"".join((x >> U(8 * k)).astype(np.uint8).tobytes() for k in range(planes))
    return len(x).to_bytes(8, "little") + COMPRESS.compress(data)


def unpacked(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    planes = np.frombuffer(EXPAND.decompress(data[8:]), np.uint8).reshape(-1, n) if n else ()
    x = np.zeros(n, U)
    for k, plane in enumerate(planes):
        x |= plane.astype(U) << U(8 * k)
    return (x >> U(1)).view(np.int64) ^ -(x & U(1)).view(np.int64)


def distinct(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct hashes, and the place of each hash among them.

    Hashes are sorted with their own number in the low bits, which is several times faster than an indirect sort. Two
    hashes that differ in these bits only could then stand mixed; they are very rare and take the plain way.
    """
    n = len(h)
    low = U((1 << max(n - 1, 1).bit_length()) - 1)
    order = h & ~low
    order |= np.arange(n, dtype=U)
    order.sort()
    order = (order & low).view(np.int64)
    ranked = h[order]
    new = np.ones(n, bool)
    new[1:] = ranked[1:] != ranked[:-1]
    if np.any(new[1:] & ((ranked[1:] ^ ranked[:-1]) <= low)):
        return np.unique(h, return_inverse=True)
    at = np.empty(n, np.int64)
    at[order] = np.cumsum(new) - 1
    return ranked[new], at


def packed_keys(keys: np.ndarray) -> bytes:
    """Sorted distinct hashes as their differences."""
    return packed(np.diff(keys, prepend=U(0)).view(np.int64))


def unpacked_keys(data: bytes) -> np.ndarray:
    return np.cumsum(unpacked(data).view(U), dtype=U)


def requests(chunk: int, keys: np.ndarray, vals: list[np.ndarray], buckets: int, slot: int = 0) -> pa.Table:
    """Rows of a chunk's sorted distinct keys, one per bucket; ``vals`` are columns of numbers."""
    of = bucket_of(keys, buckets).astype(np.int64)
    cuts = np.flatnonzero(np.diff(of, prepend=-1))
    spans = list(zip(cuts, np.append(cuts[1:], len(keys)), strict=True)) if len(cuts) else []
    return pa.table(
        {
            "bucket": pa.array((of[cuts] + slot * buckets).astype(np.int32)),
            "chunk": pa.array(np.full(len(cuts), chunk, np.int64)),
            "keys": pa.array([packed_keys(keys[a:b]) for a, b in spans], pa.binary()),
            "vals": pa.array([packed(np.concatenate([v[a:b] for v in vals])) for a, b in spans], pa.binary()),
        }
    )


def opened(table: pa.Table, columns: int = 1) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """A bucket's keys, the columns of their values, and the number of keys of each of its rows."""
    keys = [unpacked_keys(x) for x in table.column("keys").to_pylist()]
    vals = [unpacked(x).reshape(columns, -1) for x in table.column("vals").to_pylist()]
    return np.concatenate(keys), [np.concatenate([v[c] for v in vals]) for c in range(columns)], np.array([len(k) for k in keys])


def replies(table: pa.Table, vals: np.ndarray, sizes: np.ndarray) -> pa.Table:
    """To every row of ``table`` the values of its keys."""
    parts = np.split(vals, np.cumsum(sizes)[:-1])
    return pa.table({"chunk": table.column("chunk"), "bucket": table.column("bucket"), "vals": pa.array([packed(v) for v in parts], pa.binary())})


def answers(table: pa.Table) -> np.ndarray:
    """What a chunk got for its sorted keys of one slot."""
    rows = table.sort_by("bucket").column("vals").to_pylist()
    return np.concatenate([unpacked(x) for x in rows]) if rows else np.zeros(0, np.int64)


def release(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of finished rounds, whose results are written: it does so once nothing on the
    driver refers to them, which it would otherwise only notice at some later collection of its memory. The first one
    here ends what Python held, the second one finds what that referred to."""
    gc.collect()
    for _ in range(2):
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.3)


def stored(df: DataFrame, id_col: str, text_col: str, held_out: Column, tokens, chunk_bytes: int) -> tuple[DataFrame, int]:
    """(chunk, piece, ids, held, sizes, data) bucketed by chunk, and about how many chunks there are.

    ``tokens``: texts to (hashes, text numbers). Null texts are empty. Piece 0 has the words, the others tokens.
    """
    spark = df.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    size = df.agg(F.sum(F.octet_length(text) + 64)).first()[0] or 0
    chunks = max(1, -(-size // chunk_bytes))
    kind = dict(df.dtypes)[id_col]

    def rows(held: list[pa.RecordBatch], chunk: int) -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        h, doc = tokens(table.column(1))
        words, at = distinct(h)
        sizes = np.bincount(doc, minlength=table.num_rows)
        piece = np.cumsum(sizes) // PIECE
        begin = np.flatnonzero(np.diff(piece, prepend=-1))
        ends = np.append(np.append(0, begin), table.num_rows).astype(np.int32)  # the row of words has no documents
        ends[1] = 0
        cuts = np.concatenate([[0], np.cumsum(sizes)])[ends[1:]]
        data = [packed_keys(words)] + [packed(at[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        lists = [pa.ListArray.from_arrays(pa.array(ends), x) for x in (table.column(0).combine_chunks(), table.column(2).combine_chunks(), pa.array(sizes))]
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(data), chunk)), pa.array(np.arange(len(data))), *lists, pa.array(data, pa.binary())], ["chunk", "piece", "ids", "held", "sizes", "data"])

    def cut(batches):
        held, n, chunk = [], 0, TaskContext.get().partitionId() << 32
        for batch in batches:
            ends = np.cumsum(batch.column(3).to_numpy())
            i = 0
            while i < batch.num_rows:
                before = int(ends[i - 1]) if i else 0
                j = max(i + 1, int(np.searchsorted(ends, before + chunk_bytes - n, "right")))
                held.append(batch.slice(i, j - i))
                n += int(ends[j - 1]) - before
                if n >= chunk_bytes or j < batch.num_rows:
                    yield rows(held, chunk)
                    held, n, chunk = [], 0, chunk + 1
                i = j
        if held:
            yield rows(held, chunk)

    docs = df.select(F.col(id_col).alias("id"), text.alias("text"), F.coalesce(held_out, F.lit(False)).alias("held"), (F.octet_length(text) + 64).cast("long").alias("size"))
    cut_up = docs.mapInArrow(cut, f"chunk long, piece long, ids array<{kind}>, held array<boolean>, sizes array<long>, data binary")
    name = f"token_chunks_{uuid.uuid4().hex}"
    width = min(chunks, max(1000, chunks // 16), 50_000)
    cut_up.write.bucketBy(width, "chunk").option("compression", "none").option("path", work_path(spark, "token_chunks")).saveAsTable(name)
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the name only: the files stay, and the frame knows their layout
    return table, chunks
