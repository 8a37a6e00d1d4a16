"""Top-k reports, per-group firsts, positional splits and reproducible shuffles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.running import numbered

_GROUP_LIMIT = 1000  # Spark prunes row_number() <= n before the shuffle up to this n


def first_per_group(df: DataFrame, group: str, order: Sequence[str], n: int) -> DataFrame:
    """First ``n`` rows per group. Large ``n`` spreads each group over ranges of the order column."""
    if n <= _GROUP_LIMIT:
        window = Window.partitionBy(group).orderBy(*order)
        return df.withColumn("__rn", F.row_number().over(window)).where(F.col("__rn") <= n).drop("__rn")
    return numbered(df, order[0], order[1:], by=[group], name="__rn").where(F.col("__rn") <= n).drop("__rn")


def best_and_worst(df: DataFrame, score: str, key: str, n: int) -> DataFrame:
    """The ``n`` highest and ``n`` lowest rows of a ranking, tagged by side."""
    worst = df.orderBy(F.asc(score), F.asc(key)).limit(n).withColumn("side", F.lit("worst"))
    best = df.orderBy(F.desc(score), F.asc(key)).limit(n).withColumn("side", F.lit("best"))
    return best.unionByName(worst)


def hash_order(keys: Sequence[str], seed: int) -> Column:
    """Reproducible pseudo-random order value of a key, independent of partitioning."""
    return F.xxhash64(*[F.col(k) for k in keys], F.lit(seed))


def digest_order(keys: Sequence[str], seed: int) -> Column:
    """As ``hash_order``, by digits of an MD5 digest that SQL engines can compute as well."""
    digest = F.md5(F.concat_ws(":", *[F.col(k).cast("string") for k in keys], F.lit(str(seed))))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def shuffled(df: DataFrame, keys: Sequence[str], seed: int) -> DataFrame:
    """All rows with a distinct ``position`` 1..n in a reproducible random order."""
    keyed = df.withColumn("__h", digest_order(keys, seed))
    return numbered(keyed, "__h", list(keys), name="position").drop("__h")


def positional_split(df: DataFrame, order: str, share: float, ties: Sequence[str] = ()) -> DataFrame:
    """Tag the first ``share`` of the ordered table as train, the rest as test."""
    placed = numbered(df, order, list(ties), name="__pos")
    total = df.agg(F.count("*").alias("n")).scalar()
    part = F.when(F.col("__pos") <= F.floor(total * F.lit(share)), "train").otherwise("test")
    return placed.withColumn("part", part).drop("__pos")
