"""Documents in chunks that ask the whole corpus about their keys.

A chunk is a few MB of documents, chosen by a hash of their rows. It sends each of its distinct 64-bit keys once to the
bucket that the key falls into; the bucket adds up what all chunks say about a key and answers each of them. A key that
stands in a third of all documents is thus one entry per chunk, and no task holds more than a chunk or a bucket. Within
a chunk rows are ordered by id and text, so that every task that sees the chunk numbers them alike.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.words import U

CHUNK_BYTES = 4 << 20

REQUEST = "bucket int, chunk int, keys binary, vals binary"
REPLY = "chunk int, bucket int, vals binary"


def chunked(df: DataFrame, id_col: str, text_col: str, chunk_bytes: int = CHUNK_BYTES, **more: Column) -> tuple[DataFrame, int]:
    """(chunk, id, text, further columns) and the number of chunks; a null text is empty."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    size = df.agg(F.sum(F.octet_length(text) + 64)).first()[0] or 0
    chunks = max(1, -(-size // chunk_bytes))
    docs = df.select(F.pmod(F.xxhash64(id_col, text), F.lit(chunks)).cast("int").alias("chunk"), F.col(id_col).alias("id"), text.alias("text"), *[c.alias(n) for n, c in more.items()])
    return docs, chunks


def in_order(table: pa.Table) -> pa.Table:
    """A chunk's rows by id (null last), then text."""
    return table.take(pc.sort_indices(table, sort_keys=[("id", "ascending"), ("text", "ascending")], null_placement="at_end"))


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    return ((keys >> U(32)) * U(buckets)) >> U(32)


def requests(chunk: int, keys: np.ndarray, vals: np.ndarray, buckets: int) -> pa.Table:
    """Rows of a chunk's sorted distinct keys; buckets are ranges of keys, so the answers come back in the same order."""
    cuts = np.flatnonzero(np.diff(bucket_of(keys, buckets).astype(np.int64), prepend=-1)) if len(keys) else np.zeros(0, int)
    ends = np.append(cuts[1:], len(keys)) if len(cuts) else cuts
    return pa.table(
        {
            "bucket": pa.array(bucket_of(keys[cuts], buckets).astype(np.int32)),
            "chunk": pa.array(np.full(len(cuts), chunk, np.int32)),
            "keys": pa.array([keys[a:b].tobytes() for a, b in zip(cuts, ends, strict=True)], pa.binary()),
            "vals": pa.array([vals[a:b].tobytes() for a, b in zip(cuts, ends, strict=True)], pa.binary()),
        }
    )


def opened(table: pa.Table, dtype) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A bucket's keys and values, and the number of entries of each of its rows."""
    keys = np.frombuffer(b"".join(table.column("keys").to_pylist()), U)
    vals = np.frombuffer(b"".join(table.column("vals").to_pylist()), dtype)
    return keys, vals, pc.binary_length(table.column("keys")).to_numpy() // 8


def replies(table: pa.Table, vals: np.ndarray, sizes: np.ndarray) -> pa.Table:
    ends = np.cumsum(sizes)
    return pa.table({"chunk": table.column("chunk"), "bucket": table.column("bucket"), "vals": pa.array([vals[a:b].tobytes() for a, b in zip(ends - sizes, ends, strict=True)], pa.binary())})


def answers(table: pa.Table, dtype) -> np.ndarray:
    """What a chunk got for its sorted keys."""
    table = table.sort_by("bucket")
    return np.frombuffer(b"".join(table.column("vals").to_pylist()), dtype)


def ask(docs: DataFrame, request: Callable[[pa.Table], pa.Table], reduce: Callable[[pa.Table], pa.Table], schema: str = REPLY) -> DataFrame:
    """``request``: a chunk's ordered rows to REQUEST rows; ``reduce``: a bucket's REQUEST rows to REPLY rows."""
    asked = docs.groupBy("chunk").applyInArrow(lambda t: request(in_order(t)), REQUEST)
    return asked.groupBy("bucket").applyInArrow(reduce, schema)


def answered(docs: DataFrame, reply: DataFrame, use: Callable[[pa.Table, pa.Table], pa.Table], schema) -> DataFrame:
    """``use``: a chunk's ordered rows and its replies to output rows."""

    def run(mine: pa.Table, theirs: pa.Table) -> pa.Table:
        return use(in_order(mine), theirs)

    return docs.groupBy("chunk").cogroup(reply.groupBy("chunk")).applyInArrow(run, schema)
