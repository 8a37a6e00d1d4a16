"""Counts, shares, pivots, describe tables and other profiles of the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import filters, profile
from millrace.operators.quantiles import exact_quantiles
from millrace.plans.registry import query, table
from millrace.plans.relational import _ROUTE_SQL, _ROUTES

_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("A1_value_counts", "SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1")
def _(spark, sf):
    return profile.value_counts(table(spark, sf, "orders"), "o_orderpriority")


@query(
    "A2_value_shares",
    """SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS n,
              round(CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM events), 6) AS share FROM events GROUP BY 1""",
)
def _(spark, sf):
    return profile.value_shares(table(spark, sf, "events").select(F.date_format("ts", "yyyy-MM-dd").alias("day")), "day")


@query(
    "A3_grouped_means",
    """SELECT l_returnflag, round(avg(l_quantity), 4) AS avg_quantity, round(avg(l_extendedprice), 3) AS avg_price,
              round(avg(l_discount), 6) AS avg_discount FROM lineitem GROUP BY 1""",
)
def _(spark, sf):
    table(spark, sf, "lineitem").createOrReplaceTempView("millrace_lineitem")
    return spark.sql(
        """SELECT l_returnflag, round(avg(l_quantity), 4) AS avg_quantity, round(avg(l_extendedprice), 3) AS avg_price,
                  round(avg(l_discount), 6) AS avg_discount FROM millrace_lineitem
           GROUP BY l_returnflag ORDER BY l_returnflag"""
    )


@query(
    "A4_topk_profile",
    """SELECT p_brand, count(*) AS n, round(avg(l_extendedprice), 4) AS mean_l_extendedprice, round(avg(l_quantity), 4) AS mean_l_quantity
       FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1 ORDER BY n DESC, p_brand LIMIT 10""",
)
def _(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_partkey", "l_extendedprice", "l_quantity")
    parts = table(spark, sf, "part").select("p_partkey", "p_brand")
    joined = lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
    return profile.topk_profile(joined, "p_brand", 10, ["l_extendedprice", "l_quantity"])


@query(
    "A5_bucket_mean",
    f"SELECT {_ROUTE_SQL.format('trim(text)')} AS bucket, count(*) AS n, round(avg(n_chars), 4) AS mean_chars FROM documents GROUP BY 1",
)
def _(spark, sf):
    bucket = filters.route_by_prefix(F.trim("text"), _ROUTES, "other")
    return table(spark, sf, "documents").groupBy(bucket.alias("bucket")).agg(
        F.count("*").alias("n"), F.round(F.avg("n_chars"), 4).alias("mean_chars")
    )


@query(
    "A6_by_hour",
    """WITH h AS (SELECT hour(ts) AS hour, count(*) AS n_rows, sum(value) AS total, avg(value) AS mean FROM events GROUP BY 1)
       SELECT CAST(row_number() OVER (ORDER BY mean DESC, hour DESC) AS INT) AS position, CAST(hour AS INT) AS hour, n_rows,
              round(total, 4) AS total, round(mean, 6) AS mean, printf('%02d:00: %.2f average comments per post', hour, mean) AS line
       FROM h""",
)
def _(spark, sf):
    return profile.by_hour(table(spark, sf, "events"), "ts", "value")


@query(
    "A7a_pivot_mean",
    """SELECT l_linestatus, round(avg(l_quantity), 4) AS l_quantity, round(avg(l_extendedprice), 3) AS l_extendedprice,
              round(avg(l_discount), 6) AS l_discount FROM lineitem GROUP BY 1""",
)
def _(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_linestatus").agg(
        F.round(F.avg("l_quantity"), 4).alias("l_quantity"),
        F.round(F.avg("l_extendedprice"), 3).alias("l_extendedprice"),
        F.round(F.avg("l_discount"), 6).alias("l_discount"),
    )


@query(
    "A7b_pivot_max",
    """SELECT l_linestatus, max(l_quantity) AS l_quantity, max(l_extendedprice) AS l_extendedprice FROM lineitem GROUP BY 1""",
)
def _(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_linestatus").agg(
        F.max("l_quantity").alias("l_quantity"), F.max("l_extendedprice").alias("l_extendedprice")
    )


@query(
    "A7c_crosstab_count",
    """SELECT l_returnflag, nullif(count(l_tax) FILTER (l_linestatus = 'O'), 0) AS "O", nullif(count(l_tax) FILTER (l_linestatus = 'F'), 0) AS "F",
              nullif(count(l_tax) FILTER (l_linestatus = 'X'), 0) AS "X" FROM lineitem GROUP BY 1""",
)
def _(spark, sf):
    return profile.crosstab_count(table(spark, sf, "lineitem"), "l_returnflag", "l_linestatus", "l_tax", ["O", "F", "X"])


@query("A8_distinct_count", "SELECT count(DISTINCT p_brand) AS n_brands, count(DISTINCT p_type) AS n_types, count(DISTINCT p_name) AS n_names FROM part")
def _(spark, sf):
    return table(spark, sf, "part").agg(
        F.countDistinct("p_brand").alias("n_brands"), F.countDistinct("p_type").alias("n_types"), F.countDistinct("p_name").alias("n_names")
    )


@query("A8_distinct_list", "SELECT DISTINCT p_brand FROM part")
def _(spark, sf):
    return table(spark, sf, "part").select("p_brand").distinct().orderBy("p_brand")


@query(
    "A9a_describe_numeric",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count({c}) AS n, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std,
            round(min({c}), 4) AS min, round(quantile_cont({c}, 0.25), 4) AS q25, round(quantile_cont({c}, 0.5), 4) AS q50,
            round(quantile_cont({c}, 0.75), 4) AS q75, round(max({c}), 4) AS max FROM lineitem"""
        for c in _NUM
    ),
)
def _(spark, sf):
    return profile.describe_numeric(table(spark, sf, "lineitem").select(*_NUM), _NUM)


@query(
    "A9b_describe_text",
    " UNION ALL ".join(
        f"""SELECT * FROM (SELECT '{c}' AS column_name, CAST(sum(k) OVER () AS BIGINT) AS n, count(*) OVER () AS n_unique, v AS top, k AS freq
            FROM (SELECT {c} AS v, count(*) AS k FROM orders GROUP BY 1) ORDER BY k DESC, v LIMIT 1)"""
        for c in ("o_orderstatus", "o_orderpriority")
    ),
)
def _(spark, sf):
    return profile.describe_text(table(spark, sf, "orders"), ["o_orderstatus", "o_orderpriority"])


@query(
    "A10_profile",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{t}' AS dtype, count(*) AS n_rows, count({c}) AS n_present FROM orders"
        for c, t in [("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"), ("o_totalprice", "double"), ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string")]
    ),
)
def _(spark, sf):
    return profile.profile(table(spark, sf, "orders"))


@query(
    "A11_null_shares",
    """SELECT 'c_custkey' AS column_name, CAST(0 AS DOUBLE) AS null_share FROM (SELECT count(*) FROM customer)
       UNION ALL SELECT 'age', round(avg(CASE WHEN c_custkey % 7 = 0 THEN 1.0 ELSE 0.0 END), 6) FROM customer
       UNION ALL SELECT 'port', round(avg(CASE WHEN c_mktsegment = 'MACHINERY' THEN 1.0 ELSE 0.0 END), 6) FROM customer""",
)
def _(spark, sf):
    df = table(spark, sf, "customer").select(
        "c_custkey",
        F.nullif(F.col("c_custkey") % 7, F.lit(0)).alias("age"),
        F.nullif(F.col("c_mktsegment"), F.lit("MACHINERY")).alias("port"),
    )
    return profile.null_shares(df)


@query(
    "A12_corr_matrix",
    " UNION ALL ".join(
        f"SELECT '{b}' AS col_a, '{a}' AS col_b, round(corr({b}, {a}), 6) AS r FROM lineitem"
        for i, a in enumerate(_NUM) for b in _NUM[i + 1 :]
    ),
)
def _(spark, sf):
    return profile.corr_matrix(table(spark, sf, "lineitem"), _NUM)


@query(
    "A13_histogram",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, CAST(g.bin AS INT) AS bin, coalesce(h.n, 0) AS n FROM range(10) g(bin) LEFT JOIN
            (SELECT CAST(least(9, floor(({c} - lo) / (hi - lo) * 10)) AS INT) AS bin, count(*) AS n
             FROM lineitem, (SELECT min({c}) AS lo, max({c}) AS hi FROM lineitem) GROUP BY 1) h ON g.bin = h.bin"""
        for c in _NUM
    ),
)
def _(spark, sf):
    return profile.histogram(table(spark, sf, "lineitem"), _NUM)


@query(
    "A14_density",
    """WITH s AS (SELECT count(value) AS n, stddev_samp(value) AS sd, avg(value) AS m, min(value) AS lo, max(value) AS hi,
                    quantile_cont(value, 0.75) - quantile_cont(value, 0.25) AS iqr FROM events),
            b AS (SELECT *, CAST(0.9 AS DOUBLE) * least(sd, iqr / CAST(1.34 AS DOUBLE)) * pow(n, CAST(-0.2 AS DOUBLE)) AS h FROM s)
       SELECT CAST(g AS INT) AS point, round(lo + (hi - lo) * g / 31, 6) AS x,
              round(sum(exp(-0.5 * pow((lo + (hi - lo) * g / 31 - value) / h, 2))) / (n * h * sqrt(2 * pi())), 8) AS density,
              round(m, 6) AS mean_marker
       FROM events, b, range(32) r(g) GROUP BY g, lo, hi, n, h, m""",
)
def _(spark, sf):
    return profile.density(table(spark, sf, "events"), "value", points=32)


@query(
    "A15_quantiles",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST({p} AS DOUBLE) AS p, round(quantile_cont({c}, {p}), 6) AS q FROM {t}"
        for c, t in (("c_acctbal", "customer"),) for p in (0.05, 0.25, 0.5, 0.75, 0.95)
    ),
)
def _(spark, sf):
    probs = [0.05, 0.25, 0.5, 0.75, 0.95]
    q = exact_quantiles(table(spark, sf, "customer"), ["c_acctbal"], probs)["c_acctbal"]
    rows = [("c_acctbal", p, v) for p, v in zip(probs, q)]
    return spark.createDataFrame(rows, "column_name string, p double, q double").withColumn("q", F.round("q", 6))


@query(
    "A19_series",
    """SELECT event_type, day, round(v, 4) AS new_value, n AS new_count,
              round(sum(v) OVER (PARTITION BY event_type ORDER BY day), 4) AS total_value,
              CAST(sum(n) OVER (PARTITION BY event_type ORDER BY day) AS BIGINT) AS total_count
       FROM (SELECT event_type, CAST(ts AS DATE) AS day, sum(value) AS v, count(*) AS n FROM events GROUP BY 1, 2)""",
)
def _(spark, sf):
    return profile.series(table(spark, sf, "events"), "event_type", F.to_date("ts"), "value")


_PRED_SQL = """SELECT l_orderkey, l_linenumber, CAST(l_quantity > 25 AS INT) AS a, CAST(l_discount > 0.05 AS INT) AS b,
               CAST(l_tax > 0.04 AS INT) AS c FROM lineitem"""


@query(
    "A20_disagreement",
    f"""SELECT CAST(sum(CAST(a <> b AS INT)) AS BIGINT) AS a_vs_b, CAST(sum(CAST(a <> c AS INT)) AS BIGINT) AS a_vs_c,
               CAST(sum(CAST(b <> c AS INT)) AS BIGINT) AS b_vs_c FROM ({_PRED_SQL})""",
)
def _(spark, sf):
    preds = table(spark, sf, "lineitem").selectExpr(
        "l_orderkey", "int(l_quantity > 25) AS a", "int(l_discount > 0.05) AS b", "int(l_tax > 0.04) AS c"
    )
    flags = profile.disagreement(preds, "l_orderkey", ["a", "b", "c"])
    return flags.agg(*[F.sum(c).alias(c) for c in flags.columns[1:]])


@query(
    "A21_class_baseline",
    """SELECT count(*) AS n_classes, round(max(s), 6) AS majority_share, round(min(s), 6) AS minority_share FROM (
         SELECT quality, CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM labels) AS s FROM labels GROUP BY 1)""",
)
def _(spark, sf):
    return profile.class_baseline(table(spark, sf, "labels"), "quality")
