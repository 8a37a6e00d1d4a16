"""Feature engineering on the given tables."""

from __future__ import annotations

import math

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from millrace.operators import components, decompose, encode, impute, joins, robust, sampling, scaling
from millrace.plans.frames import GAPS_SQL, gaps, risk, bucket_sql
from millrace.plans.registry import query, table

_LINES = ["l_quantity", "l_extendedprice", "l_discount"]


def _lines(spark, sf):
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *_LINES)


_MC_SQL = """(WITH m AS (SELECT median(c_acctbal) AS m FROM customer),
   u AS (SELECT c_acctbal - m AS a FROM customer, m WHERE c_acctbal >= m), l AS (SELECT m - c_acctbal AS b FROM customer, m WHERE c_acctbal <= m)
   SELECT median((a - b) / (a + b)) FROM u, l WHERE a + b > 0)"""


@query("FE1_medcouple", f"SELECT 'c_acctbal' AS column_name, round({_MC_SQL}, 6) AS medcouple")
def _(spark, sf):
    mc = robust.medcouple(table(spark, sf, "customer"), "c_acctbal")
    return spark.createDataFrame([("c_acctbal", mc)], "column_name string, medcouple double").withColumn(
        "medcouple", F.round("medcouple", 6)
    )


@query(
    "FE2_winsorize_adjusted",
    f"""WITH q AS (SELECT quantile_cont(c_acctbal, 0.25) AS q1, quantile_cont(c_acctbal, 0.75) AS q3, {_MC_SQL} AS mc FROM customer),
        f AS (SELECT q1 - CAST(1.5 AS DOUBLE) * exp(-3.5 * mc) * (q3 - q1) AS lo, q3 + CAST(1.5 AS DOUBLE) * exp(4 * mc) * (q3 - q1) AS hi FROM q)
        SELECT c_custkey, round(least(greatest(CASE WHEN c_custkey % 50 = 0 THEN c_acctbal * 9 ELSE c_acctbal END, lo), hi), 4) AS capped FROM customer, f""",
)
def _(spark, sf):
    df = table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    fences = robust.adjusted_fences(df, ["c_acctbal"])
    spoiled = df.withColumn("capped", F.when(F.col("c_custkey") % 50 == 0, F.col("c_acctbal") * 9).otherwise(F.col("c_acctbal")))
    capped = robust.winsorize_adjusted(spoiled, ["capped"], {"capped": fences["c_acctbal"]})
    return capped.select("c_custkey", F.round("capped", 4).alias("capped"))


@query(
    "FE3_string_index",
    """SELECT o_orderkey, CAST(i - 1 AS DOUBLE) AS priority_index FROM orders JOIN (SELECT o_orderpriority AS p,
         row_number() OVER (ORDER BY count(*) DESC, o_orderpriority) AS i FROM orders GROUP BY 1) ON o_orderpriority = p""",
)
def _(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    model = StringIndexer(inputCol="o_orderpriority", outputCol="priority_index", handleInvalid="keep").fit(df)
    return model.transform(df).select("o_orderkey", "priority_index")


@query(
    "FE4_one_hot",
    """WITH i AS (SELECT l_returnflag AS f, row_number() OVER (ORDER BY count(*) DESC, l_returnflag) AS i FROM lineitem GROUP BY 1)
       SELECT l_orderkey, l_linenumber, CAST(i = 1 AS DOUBLE) AS hot0, CAST(i = 2 AS DOUBLE) AS hot1 FROM lineitem JOIN i ON l_returnflag = f""",
)
def _(spark, sf):
    df = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    stages = [
        StringIndexer(inputCol="l_returnflag", outputCol="idx"),
        OneHotEncoder(inputCols=["idx"], outputCols=["hot"], dropLast=True),
    ]
    hot = vector_to_array("hot")
    return Pipeline(stages=stages).fit(df).transform(df).select(
        "l_orderkey", "l_linenumber", hot[0].alias("hot0"), hot[1].alias("hot1")
    )


@query(
    "FE5_dummies",
    """SELECT l_orderkey, l_linenumber, l_quantity, CAST(l_returnflag = 'A' AS INT) AS "l_returnflag_A", CAST(l_returnflag = 'N' AS INT) AS "l_returnflag_N",
              CAST(l_returnflag = 'R' AS INT) AS "l_returnflag_R", CAST(l_linestatus = 'F' AS INT) AS "l_linestatus_F", CAST(l_linestatus = 'O' AS INT) AS "l_linestatus_O"
       FROM lineitem""",
)
def _(spark, sf):
    df = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus")
    return encode.dummies(df, ["l_returnflag", "l_linestatus"])


@query(
    "FE6_assemble",
    """SELECT l_orderkey, l_linenumber, round(l_quantity, 6) AS x0, round(l_extendedprice, 6) AS x1, round(l_discount, 6) AS x2, 4 AS size
       FROM (SELECT * FROM lineitem)""",
)
def _(spark, sf):
    df = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax")
    stages = [
        VectorAssembler(inputCols=["l_quantity", "l_extendedprice"], outputCol="pair"),
        VectorAssembler(inputCols=["pair", "l_discount", "l_tax"], outputCol="x"),
    ]
    x = vector_to_array("x")
    return Pipeline(stages=stages).fit(df).transform(df).select(
        "l_orderkey", "l_linenumber", *[F.round(x[i], 6).alias(f"x{i}") for i in range(3)], F.size(x).alias("size")
    )


def _scaled(df, params, digits=6):
    return scaling.scale(df, params).select("l_orderkey", "l_linenumber", *[F.round(c, digits).alias(c) for c in params])


def _scaled_sql(expr):
    cols = ", ".join(f"round({expr.format(c=c)}, 6) AS {c}" for c in _LINES)
    stats = ", ".join(
        f"avg({c}) AS m_{c}, stddev_pop({c}) AS p_{c}, min({c}) AS lo_{c}, max({c}) AS hi_{c}, quantile_cont({c}, 0.25) AS a_{c}, quantile_cont({c}, 0.5) AS b_{c}, quantile_cont({c}, 0.75) AS c_{c}"
        for c in _LINES
    )
    return f"SELECT l_orderkey, l_linenumber, {cols} FROM lineitem, (SELECT {stats} FROM lineitem)"


@query("FE7_centre", _scaled_sql("{c} - m_{c}"))
def _(spark, sf):
    df = _lines(spark, sf)
    return _scaled(df, scaling.fit_standard(df, _LINES, with_std=False))


@query("FE8_z_score", _scaled_sql("({c} - m_{c}) / p_{c}"))
def _(spark, sf):
    df = _lines(spark, sf)
    return _scaled(df, scaling.fit_standard(df, _LINES, ddof=0))


@query("FE9_robust_scale", _scaled_sql("({c} - b_{c}) / (c_{c} - a_{c})"))
def _(spark, sf):
    df = _lines(spark, sf)
    return _scaled(df, scaling.fit_robust(df, _LINES))


@query("FE10_min_max", _scaled_sql("({c} - lo_{c}) / (hi_{c} - lo_{c})"))
def _(spark, sf):
    df = _lines(spark, sf)
    return _scaled(df, scaling.fit_min_max(df, _LINES))


@query(
    "FE11_min_max_matrix",
    """WITH b AS (SELECT CAST(min(list_min(embedding)) AS DOUBLE) AS lo, CAST(max(list_max(embedding)) AS DOUBLE) AS hi FROM embeddings)
       SELECT vec_id, CAST(i AS INT) AS i, round((CAST(embedding[i + 1] AS DOUBLE) - lo) / (hi - lo), 6) AS x FROM embeddings, b, range(64) r(i)""",
)
def _(spark, sf):
    scaled = scaling.min_max_matrix(table(spark, sf, "embeddings").select("vec_id", "embedding"), "embedding")
    return scaled.select("vec_id", F.posexplode("embedding").alias("i", "x")).withColumn("x", F.round("x", 6))


@query(
    "FE12_pca",
    """WITH s AS (SELECT avg(l_quantity) AS ma, stddev_pop(l_quantity) AS sa, avg(l_extendedprice) AS mb, stddev_pop(l_extendedprice) AS sb, sign(corr(l_quantity, l_extendedprice)) AS r FROM lineitem)
       SELECT l_orderkey, l_linenumber, round(((l_quantity - ma) / sa + r * (l_extendedprice - mb) / sb) / sqrt(CAST(2 AS DOUBLE)), 5) AS pc1 FROM lineitem, s""",
)
def _(spark, sf):
    df = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    fitted = components.Components(["l_quantity", "l_extendedprice"], 1).fit(df)
    return fitted.transform(df).select("l_orderkey", "l_linenumber", F.round("pc1", 5).alias("pc1"))


@query("FE12_pca_variance")
def _(spark, sf):
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    fitted = components.Components(cols, 3).fit(table(spark, sf, "lineitem").select(*cols))
    rows = [
        (j + 1, cols[i], float(fitted.loadings[i, j]), fitted.explained[j]) for j in range(3) for i in range(len(cols))
    ]
    return spark.createDataFrame(rows, "component int, column_name string, loading double, explained double")


@query("FE12_wide_components")
def _(spark, sf):
    found = decompose.wide(table(spark, sf, "embeddings"), "embedding", 4)
    rows = [(j + 1, float(v), float(s)) for j, (v, s) in enumerate(zip(found.variances, found.shares, strict=True))]
    return spark.createDataFrame(rows, "component int, variance double, share double")


@query("FE12_tall_components")
def _(spark, sf):
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    df = table(spark, sf, "lineitem").select(*cols)
    spread = df.agg(*[F.stddev_samp(c).alias(c) for c in cols]).first()
    scaled = df.select(F.array(*[F.col(c) / (spread[c] or 1.0) for c in cols]).alias("x"))
    found = decompose.tall(scaled, "x", 3)
    rows = [(j + 1, c, float(found.loadings[i, j]), float(found.shares[j])) for j in range(3) for i, c in enumerate(cols)]
    return spark.createDataFrame(rows, "component int, column_name string, loading double, explained double")


@query(
    "FE13_yeo_johnson",
    """SELECT c_custkey, round(CASE WHEN x >= 0 THEN (pow(x + 1, CAST(0.5 AS DOUBLE)) - 1) / 0.5
         ELSE -(pow(1 - x, CAST(1.5 AS DOUBLE)) - 1) / 1.5 END, 6) AS transformed FROM (SELECT c_custkey, c_acctbal / 1000 AS x FROM customer)""",
)
def _(spark, sf):
    x = F.col("c_acctbal") / 1000
    return table(spark, sf, "customer").select("c_custkey", F.round(robust.yeo_johnson(x, 0.5), 6).alias("transformed"))


@query("FE13_yeo_johnson_fit")
def _(spark, sf):
    df = table(spark, sf, "customer").select(
        "c_custkey", (F.col("c_acctbal") / 1000).alias("balance"), F.exp(F.col("c_acctbal") / 5000).alias("limit_bal")
    )
    powers = robust.fit_yeo_johnson(df, ["balance", "limit_bal"])
    out = robust.apply_yeo_johnson(df, powers)
    return out.withColumns({f"power_{c}": F.lit(p) for c, p in powers.items()})


_WOE_SQL = """SELECT o_orderpriority AS value, count(*) AS n, CAST(sum(y) AS DOUBLE) AS pos, ln(((sum(y) + CAST(1 AS DOUBLE)) / (ty + CAST(2 AS DOUBLE)))
      / ((count(*) - sum(y) + CAST(1 AS DOUBLE)) / (tn - ty + CAST(2 AS DOUBLE)))) AS woe
   FROM (SELECT o_orderpriority, CAST(o_orderstatus = 'F' AS INT) AS y FROM orders),
        (SELECT count(*) AS tn, sum(CAST(o_orderstatus = 'F' AS INT)) AS ty FROM orders) GROUP BY 1, tn, ty"""


@query("FE14_woe_fit", f"SELECT value, n, pos, round(woe, 6) AS woe FROM ({_WOE_SQL})")
def _(spark, sf):
    df = table(spark, sf, "orders").select("o_orderpriority", (F.col("o_orderstatus") == "F").cast("int").alias("y"))
    return encode.woe_fit(df, ["o_orderpriority"], "y").select("value", "n", "pos", F.round("woe", 6).alias("woe"))


@query(
    "FE14_woe_apply",
    f"""SELECT o_orderkey, round(coalesce(woe, 0), 6) AS priority_woe FROM (SELECT o_orderkey,
          CASE WHEN o_orderkey % 9 = 0 THEN 'unseen' WHEN o_orderkey % 9 = 1 THEN NULL ELSE o_orderpriority END AS p FROM orders)
        LEFT JOIN ({_WOE_SQL}) ON p = value""",
)
def _(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderpriority").alias("priority"), (F.col("o_orderstatus") == "F").cast("int").alias("y"))
    fitted = encode.woe_fit(df, ["priority"], "y")
    other = df.withColumn(
        "priority", F.when(F.col("o_orderkey") % 9 == 0, "unseen").when(F.col("o_orderkey") % 9 != 1, F.col("priority"))
    )
    coded = encode.woe_apply(other, fitted, ["priority"])
    return coded.select("o_orderkey", F.round("priority_woe", 6).alias("priority_woe"))


@query(
    "FE16_impute",
    f"""WITH g AS ({GAPS_SQL}), m AS (SELECT avg(age) AS mean_age, median(fare) AS median_fare FROM g),
        p AS (SELECT port AS mode_port FROM g WHERE port IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, port LIMIT 1)
        SELECT c_custkey, round(coalesce(age, mean_age), 6) AS age, round(coalesce(fare, median_fare), 6) AS fare, coalesce(port, mode_port) AS port FROM g, m, p""",
)
def _(spark, sf):
    df = gaps(spark, sf)
    values = {
        **impute.fit_fill(df, ["age"], "mean"),
        **impute.fit_fill(df, ["fare"], "median"),
        **impute.fit_fill(df, ["port"], "mode"),
    }
    return impute.fill(df, values).select("c_custkey", F.round("age", 6).alias("age"), F.round("fare", 6).alias("fare"), "port")


@query("FE17_impute_chained")
def _(spark, sf):
    df = gaps(spark, sf).drop("port")
    return impute.ChainedImputer(["age", "fare", "class"]).fit_transform(df)




@query(
    "FE18_split",
    f"SELECT o_orderkey, CASE WHEN {bucket_sql('o_orderkey', 31, 1000)} < 700 THEN 'train' ELSE 'test' END AS part FROM orders",
)
def _(spark, sf):
    return sampling.tag_split(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", 0.7, seed=31)


@query(
    "FE19_undersample",
    f"""SELECT doc_id, toxic FROM (SELECT doc_id, toxic, row_number() OVER (PARTITION BY toxic ORDER BY {bucket_sql('doc_id', 1, 1000000)}, doc_id) AS rn
        FROM labels) WHERE rn <= (SELECT min(n) FROM (SELECT count(*) AS n FROM labels GROUP BY toxic))""",
)
def _(spark, sf):
    return sampling.undersample(table(spark, sf, "labels").select("doc_id", "toxic"), "toxic", "doc_id", seed=1)


@query("FE20_smote")
def _(spark, sf):
    return sampling.smote(table(spark, sf, "embeddings"), "label", "vec_id", "embedding", k=5, seed=1)


@query(
    "FE20_smote_sizes",
    "SELECT label, max(count(*)) OVER () - count(*) AS n_new FROM embeddings GROUP BY label QUALIFY n_new > 0",
)
def _(spark, sf):
    made = sampling.smote(table(spark, sf, "embeddings"), "label", "vec_id", "embedding", k=5, seed=1)
    return made.groupBy("label").agg(F.count("*").alias("n_new"))


@query(
    "FE21_composed_stages",
    """WITH f AS (SELECT o_orderkey, o_totalprice, CAST(i - 1 AS DOUBLE) AS idx FROM orders JOIN (SELECT o_orderstatus AS s,
         row_number() OVER (ORDER BY count(*) DESC, o_orderstatus) AS i FROM orders GROUP BY 1) ON o_orderstatus = s),
       t AS (SELECT avg(o_totalprice) AS ma, stddev_samp(o_totalprice) AS sa, avg(idx) AS mb, stddev_samp(idx) AS sb FROM f)
       SELECT o_orderkey, round((o_totalprice - ma) / sa, 5) AS z_price, round((idx - mb) / sb, 5) AS z_status FROM f, t""",
)
def _(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    stages = [
        StringIndexer(inputCol="o_orderstatus", outputCol="status"),
        VectorAssembler(inputCols=["o_totalprice", "status"], outputCol="raw"),
        StandardScaler(inputCol="raw", outputCol="z", withMean=True, withStd=True),
    ]
    z = vector_to_array("z")
    return Pipeline(stages=stages).fit(df).transform(df).select(
        "o_orderkey", F.round(z[0], 5).alias("z_price"), F.round(z[1], 5).alias("z_status")
    )


@query(
    "FE22_feature_table",
    """SELECT c_custkey, c_mktsegment, c_nationkey, CASE WHEN c_acctbal < 3000 THEN 0 WHEN c_acctbal < 6000 THEN 1 ELSE 2 END AS balance_group,
              coalesce(n, 0) AS n_orders FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) ON c_custkey = o_custkey""",
)
def _(spark, sf):
    customers = table(spark, sf, "customer")
    codes = customers.select("c_custkey", "c_mktsegment", "c_nationkey")
    group = F.when(F.col("c_acctbal") < 3000, 0).when(F.col("c_acctbal") < 6000, 1).otherwise(2)
    groups = customers.select("c_custkey", group.alias("balance_group"))
    counts = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n_orders"))
    both = joins.hstack([codes, groups], ["c_custkey"]).join(counts, "c_custkey", "left")
    return both.withColumn("n_orders", F.coalesce("n_orders", F.lit(0)).cast("long"))
