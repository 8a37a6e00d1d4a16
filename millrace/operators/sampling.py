"""Splits and class balancing by key hashes; results do not depend on partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import arrays as V
from millrace.operators.neighbours import nearest
from millrace.operators.ordering import first_per_group
from millrace.operators.running import numbered


def key_bucket(key: str, seed: int, buckets: int = 1000) -> Column:
    """Reproducible bucket of a key, by digits of an MD5 digest that SQL engines can compute as well."""
    digest = F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed))))
    return F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long"), F.lit(buckets))


def hash_bucket(key: str, seed: int, buckets: int = 1000) -> Column:
    """Bucket that is independent of ``key_bucket``: for folds and validation parts inside a train split."""
    return F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(buckets)).cast("int")


def tag_split(df: DataFrame, key: str, train_share: float, seed: int) -> DataFrame:
    part = F.when(key_bucket(key, seed) < int(round(train_share * 1000)), "train").otherwise("test")
    return df.withColumn("part", part)


def split_by_key(df: DataFrame, key: str, train_share: float, seed: int) -> tuple[DataFrame, DataFrame]:
    """Random train and test rows; the same key always lands on the same side."""
    tagged = tag_split(df, key, train_share, seed)
    return tagged.where("part = 'train'").drop("part"), tagged.where("part = 'test'").drop("part")


def undersample(df: DataFrame, label: str, key: str, seed: int, n: int | None = None) -> DataFrame:
    """At most ``n`` pseudo-random rows per class; by default the size of the smallest class."""
    if n is None:
        n = df.groupBy(label).agg(F.count("*").alias("n")).agg(F.min("n")).first()[0]
    placed = df.withColumn("__h", key_bucket(key, seed, 1_000_000))
    return first_per_group(placed, label, ["__h", key], n).drop("__h")


def smote(df: DataFrame, label: str, key: str, vector: str, k: int = 5, seed: int = 0) -> DataFrame:
    """Synthetic rows that lift every class to the size of the largest one.

    A new row lies between a class member and one of its ``k`` nearest members of the same class.
    Parents are used in turn, so the counts come out exactly; neighbour and position are seeded hashes.
    Output: (label, parent, neighbour, copy, vector).
    """
    sizes = {r[label]: r["n"] for r in df.groupBy(label).agg(F.count("*").alias("n")).collect()}
    target = max(sizes.values())
    small = [c for c, n in sizes.items() if n < target]
    if not small:
        shape = f"{label} {dict(df.dtypes)[label]}, parent {dict(df.dtypes)[key]}, neighbour long, copy int, {vector} array<double>"
        return df.sparkSession.createDataFrame([], shape)
    rare = df.where(F.col(label).isin(small)).select(F.col(key).alias("parent"), label, vector)
    links = nearest(
        rare.withColumnRenamed("parent", "q"), rare.withColumnRenamed("parent", "p"), k, "q", "p", vector, by=label, exclude_self=True
    )
    near = links.groupBy(F.col("q").alias("parent")).agg(
        F.array_sort(F.collect_list(F.struct("rank", "p"))).alias("near")  # k entries
    )
    # copies per parent: every member gets the floor, the first (target - n) mod n members one more
    floor_copies = F.create_map(*[x for c in small for x in (F.lit(c), F.lit((target - sizes[c]) // sizes[c]))])
    extra = F.create_map(*[x for c in small for x in (F.lit(c), F.lit((target - sizes[c]) % sizes[c]))])
    placed = numbered(rare, "parent", by=[label], name="__rn")
    copies = floor_copies[F.col(label)] + (F.col("__rn") <= extra[F.col(label)]).cast("int")
    wanted = (
        placed.withColumn("__c", copies).where("__c > 0")
        .select("parent", label, F.col(vector).cast("array<double>").alias("a"), F.explode(F.sequence(F.lit(1), F.col("__c"))).alias("copy"))
        .join(near, "parent")
    )
    pick = F.pmod(F.xxhash64("parent", "copy", F.lit(seed)), F.size("near")).cast("int")
    at = F.pmod(F.xxhash64("copy", "parent", F.lit(seed + 1)), F.lit(1_000_000)) / 1e6
    chosen = wanted.select("parent", label, "copy", "a", F.get("near", pick)["p"].alias("neighbour"), at.alias("at"))
    other = rare.select(F.col("parent").alias("neighbour"), F.col(vector).cast("array<double>").alias("b"))
    both = chosen.join(other, "neighbour")
    mixed = F.zip_with("a", V.subtract(F.col("b"), F.col("a")), lambda x, d: x + d * F.col("at"))
    return both.select(label, "parent", "neighbour", "copy", mixed.alias(vector))
