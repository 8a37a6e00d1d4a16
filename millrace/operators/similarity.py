"""Similarity search on vector tables and nearest-neighbour voting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import arrays as V
from millrace.operators.neighbours import nearest


def pair_cosine(pairs: DataFrame, vectors: DataFrame, key: str, vector: str, left: str, right: str) -> DataFrame:
    """Cosine for listed pairs of keys; NULL when a vector is zero."""
    v = vectors.select(F.col(key).alias("__k"), V.as_doubles(F.col(vector)).alias("__v"))
    a = v.withColumnsRenamed({"__k": left, "__v": "__a"})
    b = v.withColumnsRenamed({"__k": right, "__v": "__b"})
    return pairs.join(a, left).join(b, right).select(left, right, V.cosine(F.col("__a"), F.col("__b")).alias("cosine"))


def most_similar(vectors: DataFrame, key: str, vector: str, size: int, positive: list, negative: list, n: int) -> DataFrame:
    """Top ``n`` keys by cosine to the mean of signed unit vectors; the inputs themselves are left out."""
    units = vectors.select(key, V.unit(V.as_doubles(F.col(vector))).alias("__u"))
    sign = F.when(F.col(key).isin(positive), 1.0).otherwise(-1.0)
    inputs = units.where(F.col(key).isin(positive + negative)).select(V.scale(F.col("__u"), sign).alias("__u"))
    mean = inputs.agg(V.mean_vector(F.col("__u"), size).alias("q")).scalar()
    scored = units.where(~F.col(key).isin(positive + negative)).withColumn("__q", mean)
    return (
        scored.select(key, V.cosine(F.col("__u"), F.col("__q")).alias("cosine"))
        .where("cosine IS NOT NULL").orderBy(F.desc("cosine"), key).limit(n)
    )


def centred(vectors: DataFrame, vector: str, size: int) -> DataFrame:
    """Subtract the corpus mean vector."""
    mean = vectors.agg(V.mean_vector(V.as_doubles(F.col(vector)), size).alias("m")).scalar()
    moved = vectors.withColumn("__m", mean)
    return moved.withColumn(vector, V.subtract(V.as_doubles(F.col(vector)), F.col("__m"))).drop("__m")


def nearest_documents(vectors: DataFrame, key: str, vector: str, size: int, query: list[float], n: int = 1) -> DataFrame:
    """Documents of highest cosine to one query vector, both centred by the corpus mean."""
    mean = vectors.agg(V.mean_vector(V.as_doubles(F.col(vector)), size).alias("m")).scalar()
    moved = vectors.withColumn("__m", mean)
    q = V.subtract(F.array(*map(F.lit, query)), F.col("__m"))
    score = V.cosine(V.subtract(V.as_doubles(F.col(vector)), F.col("__m")), q)
    return moved.select(key, score.alias("cosine")).where("cosine IS NOT NULL").orderBy(F.desc("cosine"), key).limit(n)


def cosine_neighbours(vectors: DataFrame, key: str, vector: str, k: int, block: int = 4096) -> DataFrame:
    """The ``k`` other vectors of highest cosine for every non-zero vector (exact)."""
    units = vectors.select(key, V.unit(V.as_doubles(F.col(vector))).alias("u")).where(F.get("u", F.lit(0)).isNotNull())
    links = nearest(units.withColumnRenamed(key, "a"), units.withColumnRenamed(key, "b"), k, "a", "b", "u", exclude_self=True, block=block)
    return links.select("a", "b", "rank", (1 - F.pow("distance", F.lit(2.0)) / 2).alias("cosine"))


def knn_classify(
    train: DataFrame, test: DataFrame, key: str, vector: str, label: str, k: int, weights: str = "uniform", p: int = 2
) -> DataFrame:
    """(key, prediction, votes share of it): vote of the ``k`` nearest training rows, ties to the lowest class.

    ``distance`` weights votes by 1/distance; an exact hit then outvotes everything else.
    """
    links = nearest(test.withColumnRenamed(key, "q"), train.withColumnRenamed(key, "t"), k, "q", "t", vector, p=p)
    voted = links.join(train.select(F.col(key).alias("t"), label), "t")
    # an exact hit weighs so much that other votes vanish
    weight = F.lit(1.0) if weights == "uniform" else 1.0 / F.greatest("distance", F.lit(1e-12))
    votes = voted.groupBy("q", label).agg(F.sum(weight).alias("w"))
    best = votes.groupBy("q").agg(
        F.max_by(label, F.struct(F.round("w", 9), -F.col(label))).alias("prediction"),
        (F.max("w") / F.sum("w")).alias("probability"),
    )
    return best.withColumnRenamed("q", key)
