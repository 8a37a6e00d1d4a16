"""Scalar functions on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import arrays as V
from millrace.functions import scalars as X
from millrace.functions import text as T
from millrace.operators.quantiles import exact_quantiles
from millrace.plans.registry import query, table
from millrace.runtime import spread
from millrace.sources import embedded


@query(
    "X1_parse_amount",
    """SELECT l_orderkey, l_linenumber, CAST(floor(l_extendedprice) AS BIGINT) AS price,
              CAST(l_quantity * 1000 AS BIGINT) AS odometer, CAST(NULL AS BIGINT) AS unreadable FROM lineitem""",
)
def _(spark, sf):
    raw = spread(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity", "l_returnflag"), "l_orderkey").select(
        "l_orderkey",
        "l_linenumber",
        F.concat(F.lit("$"), F.format_number(F.floor("l_extendedprice"), 0)).alias("price"),
        F.concat(F.format_number(F.col("l_quantity") * 1000, 0), F.lit("km")).alias("odometer"),
        F.concat(F.lit("$"), "l_returnflag").alias("unreadable"),
    )
    return raw.select("l_orderkey", "l_linenumber", *[X.parse_amount(F.col(c)).alias(c) for c in ("price", "odometer", "unreadable")])


@query(
    "X2_lower_prefix_trim",
    "SELECT doc_id, lower(trim(text)) AS body, starts_with(lower(trim(text)), 'the') AS starts_the FROM documents",
)
def _(spark, sf):
    body = F.lower(F.trim("text"))
    return table(spark, sf, "documents").select("doc_id", body.alias("body"), body.startswith("the").alias("starts_the"))


@query(
    "X3_title_of",
    """SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN 'Mr' WHEN 1 THEN 'Mrs' ELSE 'Dr' END AS title FROM customer""",
)
def _(spark, sf):
    title = F.when(F.col("c_custkey") % 3 == 0, "Mr").when(F.col("c_custkey") % 3 == 1, "Mrs").otherwise("Dr")
    names = table(spark, sf, "customer").select("c_custkey", F.concat("c_name", F.lit(", "), title, F.lit(". Jo. A")).alias("name"))
    return names.select("c_custkey", X.title_of(F.col("name")).alias("title"))


_NAMES = "CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE p_name || repeat(' x', CAST(p_partkey % 3 AS INT)) END"


def _names(spark, sf):
    return table(spark, sf, "part").select("p_partkey", F.expr(_NAMES).alias("name"))


@query(
    "X4_part_count",
    f"SELECT p_partkey, CAST(CASE WHEN name IS NULL THEN 0 ELSE len(string_split(name, ' ')) END AS INT) AS n_parts FROM (SELECT p_partkey, {_NAMES} AS name FROM part)",
)
def _(spark, sf):
    return _names(spark, sf).select("p_partkey", X.part_count(F.col("name")).alias("n_parts"))


@query("X5_first_letter", f"SELECT p_partkey, coalesce(substr(name, 1, 1), 'n') AS letter FROM (SELECT p_partkey, {_NAMES} AS name FROM part)")
def _(spark, sf):
    return _names(spark, sf).select("p_partkey", X.first_letter(F.col("name")).alias("letter"))


_TICKET = "CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_custkey AS VARCHAR(20)) ELSE 'A./5. ' || o_orderpriority || ' ' || o_custkey END"


def _tickets(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", F.expr(_TICKET).alias("ticket"))


@query(
    "X6_is_numeric",
    f"SELECT o_orderkey, CAST(regexp_full_match(ticket, '[0-9]+') AS INT) AS numeric_ticket FROM (SELECT o_orderkey, {_TICKET} AS ticket FROM orders)",
)
def _(spark, sf):
    return _tickets(spark, sf).select("o_orderkey", X.is_numeric(F.col("ticket")).alias("numeric_ticket"))


@query(
    "X7_code_prefix",
    f"""SELECT o_orderkey, CASE WHEN contains(ticket, ' ') THEN
          lower(replace(replace(array_to_string(list_slice(string_split(ticket, ' '), 1, -2), ''), '.', ''), '/', '')) ELSE '0' END AS letters
        FROM (SELECT o_orderkey, {_TICKET} AS ticket FROM orders)""",
)
def _(spark, sf):
    return _tickets(spark, sf).select("o_orderkey", X.code_prefix(F.col("ticket")).alias("letters"))


@query("X8_strip_tags", "SELECT page_id, regexp_replace(html, '<[^>]+>', '', 'g') AS body FROM pages")
def _(spark, sf):
    return table(spark, sf, "pages").select("page_id", T.strip_tags(F.col("html")).alias("body"))


@query("X9_letters_only", "SELECT doc_id, regexp_replace(text, '[^a-zA-Z]', ' ', 'g') AS body FROM documents")
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", T.letters_only(F.col("text")).alias("body"))


@query("X10_drop_lone_letters", r"SELECT doc_id, regexp_replace(text, '\s+[a-zA-Z]\s+', ' ', 'g') AS body FROM documents")
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", T.drop_lone_letters(F.col("text")).alias("body"))


@query("X11_collapse_blanks", r"SELECT doc_id, regexp_replace(text, '\s+', ' ', 'g') AS body FROM documents")
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", T.collapse_blanks(F.col("text")).alias("body"))


@query(
    "X12_strip_emoji",
    r"""SELECT doc_id, regexp_replace(text || chr(128512) || ' ok ' || chr(127757) || chr(128640),
          '[\x{1F600}-\x{1F64F}\x{1F300}-\x{1F5FF}\x{1F680}-\x{1F6FF}\x{1F1E0}-\x{1F1FF}]+', '', 'g') AS body FROM documents""",
)
def _(spark, sf):
    marked = F.concat("text", F.lit("\U0001f600 ok \U0001f30d\U0001f680"))
    return table(spark, sf, "documents").select("doc_id", T.strip_emoji(marked).alias("body"))


CLEAN_SQL = r"regexp_replace(regexp_replace(regexp_replace(regexp_replace({0}, '<[^>]+>', '', 'g'), '[^a-zA-Z]', ' ', 'g'), '\s+[a-zA-Z]\s+', ' ', 'g'), '\s+', ' ', 'g')"


@query("X13_clean_text", f"SELECT doc_id, {CLEAN_SQL.format('text')} AS body FROM documents")
def _(spark, sf):
    return spread(table(spark, sf, "documents").select("doc_id", "text"), "doc_id").select("doc_id", T.clean_text(F.col("text")).alias("body"))


@query(
    "X14_capture_and_replace",
    r"""SELECT page_id, TRY_CAST(regexp_extract(html, 'track\((\d+)\);', 1) AS BIGINT) AS track_id,
              replace(regexp_extract(html, '<title>([^<]*)</title>', 1), '***', '') AS title FROM pages""",
)
def _(spark, sf):
    html = F.col("html")
    title = F.replace(embedded.page_title(html), F.lit("***"), F.lit(""))
    return table(spark, sf, "pages").select("page_id", embedded.script_argument(html, "track").alias("track_id"), title.alias("title"))


@query(
    "X15_parse_minute",
    "SELECT event_id, CAST(hour(ts) AS INT) AS hour, CAST(minute(ts) AS INT) AS minute, CAST(day(ts) AS INT) AS day FROM events",
)
def _(spark, sf):
    text = table(spark, sf, "events").select("event_id", F.date_format("ts", "M/d/yyyy H:mm").alias("created_at"))
    t = X.parse_minute(F.col("created_at"))
    return text.select("event_id", F.hour(t).alias("hour"), F.minute(t).alias("minute"), F.day(t).alias("day"))


@query("X16_parse_day", "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders")
def _(spark, sf):
    text = table(spark, sf, "orders").select("o_orderkey", F.date_format("o_orderdate", "M/d/yyyy").alias("d"))
    return text.select("o_orderkey", X.parse_day(F.col("d")).alias("day"))


@query("X17_score_to_class", "SELECT event_id, CAST(ceil((event_id % 11) / CAST(2 AS DOUBLE)) AS INT) - 1 AS sentiment FROM events")
def _(spark, sf):
    return table(spark, sf, "events").select("event_id", X.score_to_class((F.col("event_id") % 11) / F.lit(2.0)).alias("sentiment"))


@query("X18_log1p", "SELECT l_orderkey, l_linenumber, round(ln(1 + l_extendedprice), 6) AS log_price FROM lineitem")
def _(spark, sf):
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.round(F.log1p("l_extendedprice"), 6).alias("log_price"))


@query(
    "X19_round_exp_clip",
    """SELECT l_orderkey, l_linenumber, round(exp(l_discount), 6) AS e, least(greatest(l_quantity, 5), 45) AS clipped,
              round(l_extendedprice / 7, 4) AS seventh FROM lineitem""",
)
def _(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.round(F.exp("l_discount"), 6).alias("e"),
        X.clip(F.col("l_quantity"), 5.0, 45.0).alias("clipped"),
        F.round(F.col("l_extendedprice") / 7, 4).alias("seventh"),
    )


@query(
    "X20_format_text",
    "SELECT event_id, printf('%20s Ave rating: %.2f count: %5d', event_type, value, user_id) AS line FROM events",
)
def _(spark, sf):
    line = F.format_string("%20s Ave rating: %.2f count: %5d", "event_type", "value", "user_id")
    return table(spark, sf, "events").select("event_id", line.alias("line"))


@query(
    "X21_bin_by_edges",
    """SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN 'Missing' WHEN age <= 14 THEN 'Child' WHEN age < 18 THEN 'Teenager' ELSE 'Adult' END AS age_cat
       FROM (SELECT c_custkey, c_acctbal / 100 AS age FROM customer)""",
)
def _(spark, sf):
    age = F.when(F.col("c_custkey") % 7 != 0, F.col("c_acctbal") / 100)
    # fixed values: edges and names of the age bins
    edges, labels, closed = [14, 18], ["Child", "Teenager", "Adult"], [True, False]
    return table(spark, sf, "customer").select("c_custkey", X.bin_by_edges(age, edges, labels, closed, "Missing").alias("age_cat"))


@query(
    "X22_quantile_bins",
    """WITH q AS (SELECT quantile_cont(l_extendedprice, 0.25) AS a, quantile_cont(l_extendedprice, 0.5) AS b, quantile_cont(l_extendedprice, 0.75) AS c FROM lineitem)
       SELECT fare_cat, count(*) AS n, max(l_extendedprice) AS top FROM (SELECT l_extendedprice, CASE WHEN l_extendedprice <= a THEN 'Quartile 1'
         WHEN l_extendedprice <= b THEN 'Quartile 2' WHEN l_extendedprice <= c THEN 'Quartile 3' ELSE 'Quartile 4' END AS fare_cat FROM lineitem, q) GROUP BY 1""",
)
def _(spark, sf):
    df = table(spark, sf, "lineitem").select("l_extendedprice")
    edges = exact_quantiles(df, ["l_extendedprice"], [0.25, 0.5, 0.75])["l_extendedprice"]
    labels = [f"Quartile {i}" for i in (1, 2, 3, 4)]
    cat = X.bin_by_edges(F.col("l_extendedprice"), edges, labels, [True] * 3, "Missing")
    return df.groupBy(cat.alias("fare_cat")).agg(F.count("*").alias("n"), F.max("l_extendedprice").alias("top"))


@query(
    "X23_array_functions",
    """SELECT vec_id, embedding[3] AS third, CAST(len(embedding) AS INT) AS dims,
              array_to_string(list_transform(embedding[2:4], lambda x: CAST(round(CAST(x AS DOUBLE) * 1000, 0) AS INT)), ',') AS slice_1_3,
              CAST(list_position(embedding, list_max(embedding)) - 1 AS INT) AS arg_max FROM embeddings""",
)
def _(spark, sf):
    v = F.col("embedding")
    part = F.transform(F.slice(v, 2, 3), lambda x: F.round(x.cast("double") * 1000, 0).cast("int").cast("string"))
    return table(spark, sf, "embeddings").select(
        "vec_id",
        F.element_at(v, 3).alias("third"),
        F.size(v).alias("dims"),
        F.array_join(part, ",").alias("slice_1_3"),
        V.arg_max(v).alias("arg_max"),
    )
