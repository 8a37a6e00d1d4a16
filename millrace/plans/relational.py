"""Sources and sinks, projections, filters, joins, ordering, windows and unions on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import columns as C
from millrace.operators import filters, joins, ordering, profile
from millrace.plans.registry import query, table
from millrace.runtime import work_path
from millrace.sources import embedded, files

# --- sources and sinks ---------------------------------------------------------------------


@query("S1_read_delimited", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def _(spark, sf):
    df = table(spark, sf, "customer")
    path = work_path(spark, "customer_csv")
    files.write_delimited(df, path, encoding="ISO-8859-1")
    return files.read_delimited(spark, path, df.schema, encoding="ISO-8859-1")


@query("S2_read_tsv", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def _(spark, sf):
    df = table(spark, sf, "documents")
    path = work_path(spark, "documents_tsv")
    files.write_delimited(df, path, sep="\t")
    return files.read_delimited(spark, path, df.schema, sep="\t", multiline=True)


@query(
    "S3_read_json_records",
    "SELECT event_id, user_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events",
)
def _(spark, sf):
    df = table(spark, sf, "events").select("event_id", "user_id", F.from_json("props", "k BIGINT").alias("props"))
    path = work_path(spark, "events_json")
    files.write_json_records(df, path)
    read = files.read_json_records(spark, path, df.schema)
    return read.select("event_id", "user_id", F.col("props.k").alias("k"))


@query(
    "S4_header_and_cast",
    """SELECT o_orderkey, o_totalprice, o_orderpriority, CAST(year(o_orderdate) AS INT) AS order_year
       FROM orders""",
)
def _(spark, sf):
    df = table(spark, sf, "orders")
    path = work_path(spark, "orders_csv")
    files.write_delimited(df, path)
    raw = files.read_raw_rows(spark, path, df.columns)
    return raw.select(
        F.col("o_orderkey").cast("bigint").alias("o_orderkey"),
        F.col("o_totalprice").cast("double").alias("o_totalprice"),
        "o_orderpriority",
        F.year(F.col("o_orderdate").cast("timestamp_ntz")).alias("order_year"),
    )


@query("S5_read_uri", "SELECT s_nationkey, count(*) AS n, max(s_acctbal) AS max_balance FROM supplier GROUP BY 1")
def _(spark, sf):
    df = files.read_uri(spark, f"{sf}/supplier.parquet", "parquet")
    return df.groupBy("s_nationkey").agg(F.count("*").alias("n"), F.max("s_acctbal").alias("max_balance"))


@query(
    "S6_read_embeddings",
    """SELECT 'w' || vec_id AS word, CAST(len(embedding) AS INT) AS dims, embedding[1] AS first,
              round(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE))), 6) AS total
       FROM embeddings""",
)
def _(spark, sf):
    df = table(spark, sf, "embeddings").select(F.concat(F.lit("w"), "vec_id").alias("word"), F.col("embedding").alias("vector"))
    path = work_path(spark, "vectors_txt")
    files.write_embeddings(df, path)
    total = F.aggregate("vector", F.lit(0.0).cast("double"), lambda a, x: a + x)
    return files.read_embeddings(spark, path).select(
        "word", F.size("vector").alias("dims"), F.col("vector")[0].alias("first"), F.round(total, 6).alias("total")
    )


@query(
    "S7_write_embeddings",
    "SELECT 'w' || vec_id AS word, CAST(1 + len(embedding) AS INT) AS n_fields FROM embeddings",
)
def _(spark, sf):
    df = table(spark, sf, "embeddings").select(F.concat(F.lit("w"), "vec_id").alias("word"), F.col("embedding").alias("vector"))
    path = work_path(spark, "vectors_txt")
    files.write_embeddings(df, path)
    fields = F.split("value", " ")
    return spark.read.text(path).select(fields[0].alias("word"), F.size(fields).alias("n_fields"))


@query(
    "S8_catalog_table",
    "SELECT o_orderstatus, count(*) AS n, max(o_totalprice) AS top_price FROM orders GROUP BY 1",
)
def _(spark, sf):
    path = work_path(spark, "orders_table")
    name = "orders_" + path.split("work-")[1][:12]
    files.save_table(table(spark, sf, "orders"), name, path)
    return spark.sql(f"SELECT o_orderstatus, count(*) AS n, max(o_totalprice) AS top_price FROM {name} GROUP BY o_orderstatus")


@query("S9_write_csv", "SELECT s_suppkey, s_name, s_acctbal FROM supplier WHERE s_acctbal > 0")
def _(spark, sf):
    df = table(spark, sf, "supplier").where("s_acctbal > 0").select("s_suppkey", "s_name", "s_acctbal")
    path = work_path(spark, "supplier_csv")
    files.write_delimited(df, path)
    return files.read_delimited(spark, path, df.schema)


@query(
    "S10_embedded_json",
    """SELECT page_id, page_id * 3 AS movie_id, CAST(pos AS INT) AS pos,
              CASE WHEN pos = 0 THEN length(url) ELSE page_id % 11 END / CAST(2 AS DOUBLE) AS score,
              CASE WHEN pos = 0 THEN url ELSE 'page ' || page_id END AS review
       FROM pages, (VALUES (0), (1)) v(pos)""",
)
def _(spark, sf):
    # every landed page gets a script assignment built from its own columns
    script = F.format_string(
        'movieReview = {"movieId": %d, "verified": true, "cursor": undefined, "reviews": '
        '[{"review": "%s", "score": %.1f}, {"review": "page %d", "score": %.1f}]};',
        F.col("page_id") * 3,
        "url",
        F.length("url") / 2.0,
        "page_id",
        (F.col("page_id") % 11) / 2.0,
    )
    pages = table(spark, sf, "pages").select("page_id", F.concat_ws("\n", "html", script).alias("html"))
    schema = "movieId BIGINT, verified BOOLEAN, cursor STRING, reviews ARRAY<STRUCT<review: STRING, score: DOUBLE>>"
    rows = embedded.extract_embedded_json(pages, "page_id", "html", "movieReview", schema, "reviews")
    return rows.select("page_id", F.col("doc.movieId").alias("movie_id"), "pos", "record.score", "record.review")


@query("S12_list_files")
def _(spark, sf):
    return files.list_files(spark, sf, "*.parquet")


# --- projections ---------------------------------------------------------------------------


@query("P1_column_subset", "SELECT l_orderkey, l_extendedprice, l_discount FROM lineitem")
def _(spark, sf):
    return table(spark, sf, "lineitem").select("l_orderkey", "l_extendedprice", "l_discount")


@query(
    "P2_sanitize_columns",
    "SELECT o_orderkey AS o__orderkey, o_orderstatus AS o__orderstatus, o_totalprice AS o__totalprice FROM orders",
)
def _(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return C.sanitize_columns(C.sanitize_columns(df, "_", "."), ".", "__")


@query("P3_snake_case", "SELECT event_id, user_id, event_type, value AS event_value FROM events")
def _(spark, sf):
    df = table(spark, sf, "events").select("event_id", "user_id", "event_type", "value")
    return C.to_snake_case(df.toDF("eventId", "userId", "eventType", "value")).withColumnRenamed("value", "event_value")


@query(
    "P4_constant_columns",
    "SELECT c_custkey, 1 AS train_test, CAST(NULL AS INT) AS survived FROM customer",
)
def _(spark, sf):
    return table(spark, sf, "customer").select(
        "c_custkey", F.lit(1).alias("train_test"), F.lit(None).cast("int").alias("survived")
    )


@query("P5_drop_columns", "SELECT p_partkey, p_brand, p_size FROM part")
def _(spark, sf):
    return table(spark, sf, "part").drop("p_name", "p_type", "p_retailprice")


@query(
    "P6_cast_codes",
    """SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS cust_code,
              TRY_CAST(substr(o_orderpriority, 1, 1) AS INT) AS priority_level,
              TRY_CAST(o_orderstatus AS INT) AS status_level
       FROM orders""",
)
def _(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.col("o_custkey").cast("string").alias("cust_code"),
        F.substring("o_orderpriority", 1, 1).try_cast("int").alias("priority_level"),
        F.col("o_orderstatus").try_cast("int").alias("status_level"),
    )


@query(
    "P7_suffix_and_regex",
    "SELECT c_custkey, c_acctbal AS c_acctbal_woe, c_mktsegment AS c_mktsegment_woe FROM customer",
)
def _(spark, sf):
    df = table(spark, sf, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    return C.select_by_regex(C.suffix_columns(df, "_woe", keep=("c_custkey",)), "_woe$", keep=("c_custkey",))


@query("P8_unpack_vector", "SELECT vec_id, embedding[1] AS v0, embedding[6] AS v5 FROM embeddings")
def _(spark, sf):
    v = F.col("embedding")
    return table(spark, sf, "embeddings").select("vec_id", C.element(v, 0).alias("v0"), C.element(v, 5).alias("v5"))


@query(
    "P9_label_map",
    """SELECT event_id, event_type = 'click' AS is_click, event_type = 'error' AS is_error,
              CASE WHEN event_type = 'click' THEN '1,0' WHEN event_type = 'error' THEN '0,1' ELSE '0,0' END AS one_hot
       FROM events""",
)
def _(spark, sf):
    classes = ["click", "error"]
    cats = C.label_map(F.col("event_type"), classes)
    hot = F.array_join(C.one_hot_array(F.col("event_type"), classes).cast("array<string>"), ",")
    return table(spark, sf, "events").select(
        "event_id", cats["click"].alias("is_click"), cats["error"].alias("is_error"), hot.alias("one_hot")
    )


@query(
    "P10_typed_columns",
    """SELECT 'numeric' AS kind, column_name, n FROM (
         SELECT count(l_orderkey) AS l_orderkey, count(l_partkey) AS l_partkey, count(l_suppkey) AS l_suppkey,
                count(l_linenumber) AS l_linenumber, count(l_quantity) AS l_quantity, count(l_extendedprice) AS l_extendedprice,
                count(l_discount) AS l_discount, count(l_tax) AS l_tax FROM lineitem)
         UNPIVOT (n FOR column_name IN (l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax))
       UNION ALL
       SELECT 'categorical' AS kind, column_name, n FROM (
         SELECT count(l_returnflag) AS l_returnflag, count(l_linestatus) AS l_linestatus FROM lineitem)
         UNPIVOT (n FOR column_name IN (l_returnflag, l_linestatus))""",
)
def _(spark, sf):
    df = table(spark, sf, "lineitem")
    kinds = {c: "numeric" for c in C.numeric_columns(df)} | {c: "categorical" for c in C.categorical_columns(df)}
    counts = df.agg(*[F.count(c).alias(c) for c in kinds])
    return counts.select(
        F.inline(
            F.array(
                *[F.struct(F.lit(k).alias("kind"), F.lit(c).alias("column_name"), F.col(c).alias("n")) for c, k in kinds.items()]
            )
        )
    )


# --- filters -------------------------------------------------------------------------------


@query("F1_equal", "SELECT c_custkey, c_name FROM customer WHERE c_mktsegment = 'BUILDING'")
def _(spark, sf):
    return table(spark, sf, "customer").where(F.col("c_mktsegment") == "BUILDING").select("c_custkey", "c_name")


@query(
    "F2_between",
    "SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem WHERE l_extendedprice BETWEEN 1000 AND 35000",
)
def _(spark, sf):
    df = table(spark, sf, "lineitem").where(F.col("l_extendedprice").between(1000.0, 35000.0))
    return df.select("l_orderkey", "l_linenumber", "l_extendedprice")


@query("F3_out_of_range", "SELECT count(*) AS n_outside FROM orders WHERE year(o_orderdate) < 1996 OR year(o_orderdate) > 2000")
def _(spark, sf):
    df = table(spark, sf, "orders").select(F.year("o_orderdate").alias("y"))
    return filters.out_of_range_count(df, "y", 1996, 2000)


_ROUTES = {"th": "ask", "a": "show"}
_ROUTE_SQL = "CASE WHEN lower({0}) LIKE 'th%' THEN 'ask' WHEN lower({0}) LIKE 'a%' THEN 'show' ELSE 'other' END"


@query("F4_prefix_route", f"SELECT doc_id, {_ROUTE_SQL.format('trim(text)')} AS bucket FROM documents")
def _(spark, sf):
    bucket = filters.route_by_prefix(F.trim("text"), _ROUTES, "other")
    return table(spark, sf, "documents").select("doc_id", bucket.alias("bucket"))


@query("F5_is_null", "SELECT c_custkey FROM customer WHERE nullif(c_custkey % 7, 0) IS NULL")
def _(spark, sf):
    df = table(spark, sf, "customer").withColumn("age", F.nullif(F.col("c_custkey") % 7, F.lit(0)))
    return df.where(F.col("age").isNull()).select("c_custkey")


@query(
    "F6_drop_null",
    """SELECT c_custkey, nullif(c_custkey % 7, 0) AS age, nullif(c_mktsegment, 'MACHINERY') AS port FROM customer
       WHERE c_custkey % 7 <> 0 AND c_mktsegment <> 'MACHINERY'""",
)
def _(spark, sf):
    df = table(spark, sf, "customer").select(
        "c_custkey",
        F.nullif(F.col("c_custkey") % 7, F.lit(0)).alias("age"),
        F.nullif(F.col("c_mktsegment"), F.lit("MACHINERY")).alias("port"),
    )
    return df.dropna(subset=["age", "port"])


@query("F7_drop_duplicates", "SELECT DISTINCT l_returnflag, l_linestatus, l_quantity, l_linenumber FROM lineitem")
def _(spark, sf):
    return table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", "l_quantity", "l_linenumber").distinct()


@query("F8_dedupe_first", "SELECT min(doc_id) AS doc_id, text FROM documents GROUP BY text")
def _(spark, sf):
    return filters.dedupe_first(table(spark, sf, "documents").select("doc_id", "text"), ["text"], ["doc_id"])


@query(
    "F9_any_missing",
    """SELECT column_name, has_missing FROM (SELECT
         bool_or(c_custkey IS NULL) AS c_custkey, bool_or(c_name IS NULL) AS c_name, bool_or(c_nationkey IS NULL) AS c_nationkey,
         bool_or(nullif(c_custkey % 7, 0) IS NULL) AS age FROM customer)
       UNPIVOT (has_missing FOR column_name IN (c_custkey, c_name, c_nationkey, age))""",
)
def _(spark, sf):
    df = table(spark, sf, "customer").select(
        "c_custkey", "c_name", "c_nationkey", F.nullif(F.col("c_custkey") % 7, F.lit(0)).alias("age")
    )
    return filters.any_missing(df)


# --- joins ---------------------------------------------------------------------------------


@query(
    "J1_inner",
    """SELECT o_orderkey, c_name, c_mktsegment, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey""",
)
def _(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    customers = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", "c_name", "c_mktsegment", "o_totalprice"
    )


@query(
    "J2_left",
    """SELECT c_custkey, coalesce(n, 0) AS n_orders, latest FROM customer LEFT JOIN (
         SELECT o_custkey, count(*) AS n, max(o_totalprice) AS latest FROM orders
         WHERE o_orderpriority = '1-URGENT' GROUP BY 1) ON c_custkey = o_custkey""",
)
def _(spark, sf):
    urgent = (
        table(spark, sf, "orders").where("o_orderpriority = '1-URGENT'")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.count("*").alias("n"), F.max("o_totalprice").alias("latest"))
    )
    joined = table(spark, sf, "customer").select("c_custkey").join(urgent, "c_custkey", "left")
    return joined.select("c_custkey", F.coalesce("n", F.lit(0)).cast("long").alias("n_orders"), "latest")


@query(
    "J3_hstack",
    """SELECT l_orderkey, l_linenumber, max(l_quantity) AS quantity, min(l_returnflag) AS flag, max(l_tax) AS tax
       FROM lineitem GROUP BY 1, 2""",
)
def _(spark, sf):
    key = ["l_orderkey", "l_linenumber"]
    df = table(spark, sf, "lineitem")
    parts = [
        df.groupBy(*key).agg(F.max("l_quantity").alias("quantity")),
        df.groupBy(*key).agg(F.min("l_returnflag").alias("flag")),
        df.groupBy(*key).agg(F.max("l_tax").alias("tax")),
    ]
    return joins.hstack(parts, key)


@query(
    "J4_lookup",
    """SELECT c_custkey, n_name, r_name FROM customer JOIN nation ON c_nationkey = n_nationkey
       JOIN region ON n_regionkey = r_regionkey""",
)
def _(spark, sf):
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    dim = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "n_name", "r_name")
    customers = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    return customers.join(dim, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "n_name", "r_name")


@query(
    "J5_top_members",
    """WITH b AS (SELECT p_brand, count(*) AS n FROM part GROUP BY 1 ORDER BY n DESC, p_brand LIMIT 5)
       SELECT p_partkey, p_brand, p_retailprice FROM part WHERE p_brand IN (SELECT p_brand FROM b)""",
)
def _(spark, sf):
    parts = table(spark, sf, "part").select("p_partkey", "p_brand", "p_retailprice")
    return joins.restrict_to_top(parts, "p_brand", 5)


# --- windows -------------------------------------------------------------------------------


@query(
    "W1_share_of_total",
    """SELECT o_orderstatus, count(*) AS n, round(CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM orders), 3) AS share
       FROM orders GROUP BY 1""",
)
def _(spark, sf):
    return profile.value_shares(table(spark, sf, "orders"), "o_orderstatus", digits=3)


@query(
    "W2_first_per_class",
    """SELECT event_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS rn
       FROM events) WHERE rn <= 50""",
)
def _(spark, sf):
    df = table(spark, sf, "events").select("event_id", "event_type", "value")
    return ordering.first_per_group(df, "event_type", ["event_id"], 50)


@query(
    "W4_positional_split",
    """SELECT o_orderkey, CASE WHEN row_number() OVER (ORDER BY o_orderkey) <= floor((SELECT count(*) FROM orders) * CAST(0.9 AS DOUBLE))
         THEN 'train' ELSE 'test' END AS part FROM orders""",
)
def _(spark, sf):
    return ordering.positional_split(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", 0.9)


# --- sorting and top-k ---------------------------------------------------------------------


@query("T1_order_by", "SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders ORDER BY o_orderpriority, o_totalprice DESC, o_orderkey")
def _(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    return df.orderBy("o_orderpriority", F.desc("o_totalprice"), "o_orderkey")


@query("T2_head", "SELECT p_partkey, p_name, p_retailprice FROM part ORDER BY p_partkey LIMIT 5")
def _(spark, sf):
    return table(spark, sf, "part").select("p_partkey", "p_name", "p_retailprice").orderBy("p_partkey").limit(5)


@query(
    "T4_arg_extremes",
    """SELECT c_mktsegment, arg_max(c_custkey, (c_acctbal, -c_custkey)) AS richest, arg_min(c_custkey, (c_acctbal, c_custkey)) AS poorest
       FROM customer GROUP BY 1""",
)
def _(spark, sf):
    return table(spark, sf, "customer").groupBy("c_mktsegment").agg(
        F.max_by("c_custkey", F.struct("c_acctbal", -F.col("c_custkey"))).alias("richest"),
        F.min_by("c_custkey", F.struct("c_acctbal", "c_custkey")).alias("poorest"),
    )


@query(
    "T5_shuffle",
    "SELECT event_id, event_type, value, row_number() OVER (ORDER BY CAST('0x' || substr(md5(CAST(event_id AS VARCHAR) || ':7'), 1, 15) AS BIGINT), event_id) AS position FROM events",
)
def _(spark, sf):
    return ordering.shuffled(table(spark, sf, "events").select("event_id", "event_type", "value"), ["event_id"], seed=7)


# --- unions --------------------------------------------------------------------------------


@query(
    "U1_union_tagged",
    """SELECT c_custkey AS id, c_acctbal AS balance, c_mktsegment AS segment, 'train' AS train_test FROM customer
       UNION ALL SELECT s_suppkey, s_acctbal, NULL, 'test' FROM supplier""",
)
def _(spark, sf):
    customers = table(spark, sf, "customer").selectExpr("c_custkey AS id", "c_acctbal AS balance", "c_mktsegment AS segment")
    suppliers = table(spark, sf, "supplier").selectExpr("s_suppkey AS id", "s_acctbal AS balance")
    return joins.union_tagged({"train": customers, "test": suppliers}, "train_test")


@query(
    "U2_union_of_classes",
    """SELECT event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS rn
       FROM events) WHERE (event_type = 'click' AND rn <= 30) OR (event_type = 'error' AND rn <= 20)""",
)
def _(spark, sf):
    df = table(spark, sf, "events").select("event_id", "event_type")
    clicks = df.where("event_type = 'click'").orderBy("event_id").limit(30)
    errors = df.where("event_type = 'error'").orderBy("event_id").limit(20)
    return clicks.unionByName(errors)
