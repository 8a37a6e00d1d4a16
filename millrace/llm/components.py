"""Connected components of an edge table by alternating stars, cut at the shared checkpoint folder after every round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.runtime import cut_lineage


HUB = 10_000  # neighbours of a node that are not to meet in one task, a thousandth of all edges if that is more


def _star(edges: DataFrame, large: bool, total: int) -> DataFrame:
    """Every node's larger (or, with itself, smaller) neighbours are tied to its least neighbour.

    The least neighbours of hubs, of which there are two thousand at most, are broadcast; the others are joined by node.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if not large:
        both = both.where("b < a")
    least = both.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n")).select("a", F.least("a", "m").alias("m"), "n")
    near = both.where("b > a") if large else both.unionByName(least.select("a", F.col("a").alias("b")))
    many = max(HUB, total // 1000)
    hubs = least.where(F.col("n") > many).select("a", "m").collect() if total > many else []
    tied = near.join(least.select("a", "m"), "a")
    if hubs:
        known = F.broadcast(edges.sparkSession.createDataFrame(hubs, least.select("a", "m").schema))
        tied = near.join(known.select("a"), "a", "left_anti").join(least.select("a", "m"), "a").unionByName(near.join(known, "a"))
    return tied.where("b <> m").select(F.col("m").alias("a"), "b").distinct()


ROWS = 200_000  # edges in a partition of what is kept between rounds


def _kept(edges: DataFrame, before: int) -> DataFrame:
    """Written to the checkpoint folder, in partitions for as many edges as there were before: a star never adds any
    but those of a node to its own least neighbour. Few edges in many partitions would be many empty shuffle files."""
    return cut_lineage(edges.coalesce(1 + 2 * before // ROWS))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); the root is the least node of its component.

    Stops when a round changes nothing; the number of rounds grows with the log of the longest path.
    """
    edges = cut_lineage(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct())
    before = None
    while True:
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == before:
            break
        before = now
        edges = _kept(_star(_kept(_star(edges, True, now[0]), now[0]), False, now[0]), now[0])
    return edges.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(edges.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())
