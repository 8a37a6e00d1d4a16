"""Model-ready frames derived from the given tables, with the SQL that builds the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.plans.registry import table


def bucket_sql(key: str, seed: int, buckets: int = 1000) -> str:
    """The SQL of ``sampling.key_bucket``."""
    return f"CAST('0x' || substr(md5(CAST({key} AS VARCHAR) || ':{seed}'), 1, 8) AS BIGINT) % {buckets}"


# default risk per order: numeric and coded inputs, a noisy rule as label
RISK_SQL = """SELECT o_orderkey, o_totalprice / 1000 AS price, c_acctbal / 1000 AS balance,
    CAST(extract(year FROM o_orderdate) AS DOUBLE) AS year, CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) AS priority,
    o_orderpriority, o_orderstatus, c_mktsegment,
    CAST(o_totalprice / 500000 + c_acctbal / 20000 + CAST((o_orderkey * 7919) % 1000 AS DOUBLE) / 1500 > 1.1 AS INT) AS label
  FROM orders JOIN customer ON o_custkey = c_custkey"""

RISK_FEATURES = ["price", "balance", "year", "priority"]


def risk(spark, sf) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    customers = table(spark, sf, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    df = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    noise = ((F.col("o_orderkey") * 7919) % 1000).cast("double") / 1500
    return df.select(
        "o_orderkey",
        (F.col("o_totalprice") / 1000).alias("price"),
        (F.col("c_acctbal") / 1000).alias("balance"),
        F.year("o_orderdate").cast("double").alias("year"),
        F.substring("o_orderpriority", 1, 1).cast("double").alias("priority"),
        "o_orderpriority",
        "o_orderstatus",
        "c_mktsegment",
        (F.col("o_totalprice") / 500000 + F.col("c_acctbal") / 20000 + noise > 1.1).cast("int").alias("label"),
    )


# customers with derived gaps
GAPS_SQL = """SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_acctbal / 100 END AS age,
    CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE (c_acctbal + c_custkey % 100) / 50 END AS fare,
    CAST(c_nationkey AS DOUBLE) AS class, nullif(c_mktsegment, 'MACHINERY') AS port FROM customer"""


def gaps(spark, sf) -> DataFrame:
    k, b = F.col("c_custkey"), F.col("c_acctbal")
    return table(spark, sf, "customer").select(
        "c_custkey",
        F.when(k % 7 != 0, b / 100).alias("age"),
        F.when(k % 11 != 0, (b + k % 100) / 50).alias("fare"),
        F.col("c_nationkey").cast("double").alias("class"),
        F.nullif(F.col("c_mktsegment"), F.lit("MACHINERY")).alias("port"),
    )
