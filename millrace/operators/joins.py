"""Keyed joins. Only sides with a proven row bound carry a broadcast hint; AQE decides the rest."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def hstack(frames: Sequence[DataFrame], key: Sequence[str]) -> DataFrame:
    """Column-wise concatenation on a carried key; never on generated row ids."""
    return reduce(lambda a, b: a.join(b, list(key)), frames)


def top_keys(df: DataFrame, key: str, k: int) -> DataFrame:
    """The ``k`` most frequent keys with their counts, ties in key order."""
    return df.groupBy(key).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.asc(key)).limit(k)


def restrict_to_top(df: DataFrame, key: str, k: int) -> DataFrame:
    """Rows whose key is among the ``k`` most frequent (the broadcast side holds ``k`` rows)."""
    return df.join(F.broadcast(top_keys(df, key, k).select(key)), key, "left_semi")


def union_tagged(frames: dict[str, DataFrame], tag: str = "source") -> DataFrame:
    """Union of frames with different columns, each row tagged with its frame's name."""
    parts = [df.withColumn(tag, F.lit(name)) for name, df in frames.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def bounded(df: DataFrame, limit: int = 100_000) -> DataFrame | None:
    """The frame marked for broadcast when it proves to hold at most ``limit`` rows, else None.

    At most ``limit`` + 1 rows are read for the proof, and the rows read are the ones broadcast.
    """
    rows = df.limit(limit + 1).collect()
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema)) if len(rows) <= limit else None


def bounded_or_shuffled(df: DataFrame, limit: int = 100_000) -> DataFrame:
    """A lookup side ready to join: broadcast when proven small, else shuffled by the key."""
    small = bounded(df, limit)
    return df.hint("shuffle_hash") if small is None else small
