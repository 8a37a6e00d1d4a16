"""Metrics, voting and attributions on rule-made scores, so that SQL can compute the same numbers."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import evaluate
from millrace.operators.sampling import tag_split
from millrace.plans.frames import RISK_SQL, bucket_sql, risk
from millrace.plans.registry import query, table

_SCORED_SQL = """SELECT round(least(1, l_quantity / 50) * 0.7 + l_discount * 3, 6) AS s, CAST(l_returnflag = 'R' OR l_quantity > 40 AS INT) AS y FROM lineitem"""


def _scored(spark, sf):
    score = F.round(F.least(F.lit(1.0), F.col("l_quantity") / 50) * 0.7 + F.col("l_discount") * 3, 6)
    y = ((F.col("l_returnflag") == "R") | (F.col("l_quantity") > 40)).cast("int")
    return table(spark, sf, "lineitem").select(score.alias("s"), y.alias("y"))


@query(
    "W3_average_ranks",
    """SELECT s, n, sum(n) OVER (ORDER BY s) - (n - 1) / CAST(2 AS DOUBLE) AS avg_rank FROM (SELECT l_extendedprice AS s, count(*) AS n FROM lineitem GROUP BY 1)""",
)
def _(spark, sf):
    return evaluate.average_ranks(table(spark, sf, "lineitem").select(F.col("l_extendedprice").alias("s")), "s")


_AUC = f"""WITH c AS (SELECT s, sum(y) AS pos, sum(1 - y) AS neg FROM ({_SCORED_SQL}) GROUP BY 1),
   r AS (SELECT *, sum(neg) OVER (ORDER BY s) AS run FROM c),
   a AS (SELECT sum(pos * (run - neg / CAST(2 AS DOUBLE))) / (CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE)) AS auc, CAST(sum(pos) AS BIGINT) AS n_pos, CAST(sum(neg) AS BIGINT) AS n_neg FROM r)"""


@query("E1_auroc", f"{_AUC} SELECT round(auc, 8) AS auroc, n_pos, n_neg FROM a")
def _(spark, sf):
    return evaluate.auroc(_scored(spark, sf), "s", "y").select(F.round("auroc", 8).alias("auroc"), "n_pos", "n_neg")


@query("E2_somers_d", f"{_AUC} SELECT round(2 * auc - 1, 8) AS somers_d FROM a")
def _(spark, sf):
    return evaluate.auroc(_scored(spark, sf), "s", "y").select(F.round("somers_d", 8).alias("somers_d"))


_SPLIT = bucket_sql("o_orderkey", 31) + " < 700"


@query(
    "E3_accuracy",
    f"""SELECT CASE WHEN {_SPLIT} THEN 'train' ELSE 'test' END AS part, round(avg(CAST(CAST(price > 300 AS INT) = label AS DOUBLE)), 9) AS accuracy, count(*) AS n
        FROM ({RISK_SQL}) GROUP BY 1""",
)
def _(spark, sf):
    ruled = risk(spark, sf).select("o_orderkey", "label", (F.col("price") > 300).cast("int").alias("p"))
    scored = tag_split(ruled, "o_orderkey", 0.7, seed=31)
    return evaluate.accuracy(scored, "label", "p", ["part"]).withColumn("accuracy", F.round("accuracy", 9))


_PRED = "CASE WHEN event_id % 4 = 0 THEN 'click' WHEN event_id % 9 = 0 THEN 'view' ELSE event_type END"


def _predicted(spark, sf):
    return table(spark, sf, "events").select("event_type", F.expr(_PRED).alias("p"))


@query("E4_confusion", f"SELECT event_type AS label, {_PRED} AS prediction, count(*) AS n FROM events GROUP BY 1, 2")
def _(spark, sf):
    return evaluate.confusion(_predicted(spark, sf), "event_type", "p")


_CELLS = f"""e AS (SELECT event_type AS y, {_PRED} AS p FROM events), c AS (SELECT y AS class, count(*) FILTER (y = p) AS tp, count(*) AS actual FROM e GROUP BY 1),
   q AS (SELECT p AS class, count(*) AS predicted FROM e GROUP BY 1),
   f AS (SELECT class, CAST(tp AS DOUBLE) / predicted AS precision, CAST(tp AS DOUBLE) / actual AS recall, CAST(2 * tp AS DOUBLE) / (actual + predicted) AS f1 FROM c JOIN q USING (class))"""


@query("E4_class_scores", f"WITH {_CELLS} SELECT class, round(precision, 8) AS precision, round(recall, 8) AS recall, round(f1, 8) AS f1 FROM f")
def _(spark, sf):
    out = evaluate.class_scores(_predicted(spark, sf), "event_type", "p")
    return out.withColumns({c: F.round(c, 8) for c in ("precision", "recall", "f1")})


@query("E4_macro_f1", f"WITH {_CELLS} SELECT round(avg(recall), 8) AS macro_recall, round(avg(f1), 8) AS macro_f1 FROM f")
def _(spark, sf):
    out = evaluate.macro_f1(_predicted(spark, sf), "event_type", "p")
    return out.withColumns({c: F.round(c, 8) for c in out.columns})


_CLASSES = ["click", "view", "error"]
_SOFT = [f"(CASE WHEN event_type = '{c}' THEN 0.6 ELSE 0.1 END + (event_id % {7 + i}) / CAST(50 AS DOUBLE))" for i, c in enumerate(_CLASSES)]


@query(
    "E5_soft_macro_f1",
    "SELECT round(avg(f1), 8) AS soft_macro_f1, round(1 - avg(f1), 8) AS loss FROM ("
    + "SELECT 2 * pr * rc / (pr + rc + 1e-7) AS f1 FROM ("
    + "SELECT tp / p AS pr, tp / g AS rc FROM ("
    + " UNION ALL ".join(
        f"SELECT sum(CASE WHEN event_type = '{c}' THEN p ELSE 0 END) + 1e-7 AS tp, sum(p) + 1e-7 AS p, sum(CASE WHEN event_type = '{c}' THEN CAST(1 AS DOUBLE) ELSE 0 END) + 1e-7 AS g FROM (SELECT event_type, {e} AS p FROM events)"
        for c, e in zip(_CLASSES, _SOFT)
    )
    + ")))",
)
def _(spark, sf):
    df = table(spark, sf, "events").select("event_type", "event_id")
    probs = {
        c: F.when(F.col("event_type") == c, 0.6).otherwise(0.1) + (F.col("event_id") % (7 + i)) / F.lit(50.0)
        for i, c in enumerate(_CLASSES)
    }
    out = evaluate.soft_macro_f1(df, "event_type", probs)
    return out.withColumns({c: F.round(c, 8) for c in out.columns})


_P = ["event_id % 10 / CAST(10 AS DOUBLE)", "event_id % 7 / CAST(7 AS DOUBLE)", "user_id % 13 / CAST(13 AS DOUBLE)"]
_WEIGHTS = [2.0, 1.0, 3.0]
_VOTE_SOFT = "(" + " + ".join(f"{w} * ({p})" for w, p in zip(_WEIGHTS, _P)) + f") / CAST({sum(_WEIGHTS)} AS DOUBLE)"
_VOTE_HARD = "(" + " + ".join(f"CASE WHEN round({p}, 12) > round(1 - {p}, 12) THEN CAST({w} AS DOUBLE) ELSE 0 END" for w, p in zip(_WEIGHTS, _P)) + ")"


def _ballots(spark, sf):
    e, u = F.col("event_id"), F.col("user_id")
    ps = [e % 10 / F.lit(10.0), e % 7 / F.lit(7.0), u % 13 / F.lit(13.0)]
    return table(spark, sf, "events").select(
        "event_id", *[F.array(F.round(1 - p, 12), F.round(p, 12)).alias(f"m{i}") for i, p in enumerate(ps)]
    )


@query(
    "M14_vote_soft",
    f"SELECT event_id, round({_VOTE_SOFT}, 6) AS pd, CAST(round({_VOTE_SOFT}, 9) > 0.5 AS INT) AS prediction FROM events",
)
def _(spark, sf):
    out = evaluate.vote(_ballots(spark, sf), "event_id", ["m0", "m1", "m2"], "soft", _WEIGHTS)
    return out.select("event_id", F.round(F.col("probability")[1], 6).alias("pd"), "prediction")


@query("M14_vote_hard", f"SELECT event_id, CAST({_VOTE_HARD} > 3 AS INT) AS prediction, {_VOTE_HARD} AS votes FROM events")
def _(spark, sf):
    out = evaluate.vote(_ballots(spark, sf), "event_id", ["m0", "m1", "m2"], "hard", _WEIGHTS)
    return out.select("event_id", "prediction", F.col("probability")[1].alias("votes"))


_GRID = [(1, 1, 1), (2, 1, 3), (1, 0, 2), (0, 1, 1)]


def _weight_sql(w):
    total = f"CAST({sum(w)} AS DOUBLE)"
    p = "(" + " + ".join(f"CAST({x} AS DOUBLE) * ({e})" for x, e in zip(w, _P)) + f") / {total}"
    return f"""SELECT '{"-".join(map(str, w))}' AS weights, round(avg(CAST((round({p}, 9) > 0.5) = (event_type IN ('click', 'view')) AS DOUBLE)), 9) AS accuracy FROM events"""


@query("E11_vote_weights", " UNION ALL ".join(_weight_sql(w) for w in _GRID))
def _(spark, sf):
    # every weighting of the same score table in one aggregate
    e, u = F.col("event_id"), F.col("user_id")
    ps = [e % 10 / F.lit(10.0), e % 7 / F.lit(7.0), u % 13 / F.lit(13.0)]
    y = F.col("event_type").isin("click", "view")
    aggs = []
    for w in _GRID:
        mean = sum((p * float(x) for x, p in zip(w, ps)), F.lit(0.0)) / float(sum(w))
        aggs.append(F.round(F.avg(((F.round(mean, 9) > 0.5) == y).cast("double")), 9).alias("-".join(map(str, w))))
    names = ["-".join(map(str, w)) for w in _GRID]
    return table(spark, sf, "events").agg(*aggs).unpivot([], names, "weights", "accuracy")


_COEFS = {"l_quantity": 0.02, "l_discount": -3.0, "l_tax": 1.5}


@query(
    "E12_linear_attributions",
    "SELECT l_orderkey, l_linenumber, "
    + ", ".join(f"round(CAST({w} AS DOUBLE) * ({c} - m_{c}), 6) AS phi_{c}" for c, w in _COEFS.items())
    + " FROM lineitem, (SELECT " + ", ".join(f"avg({c}) AS m_{c}" for c in _COEFS) + " FROM lineitem)",
)
def _(spark, sf):
    phis = evaluate.linear_attributions(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], _COEFS)
    return phis.withColumns({f"phi_{c}": F.round(f"phi_{c}", 6) for c in _COEFS})


@query(
    "E12_attribution_summary",
    " UNION ALL ".join(
        f"SELECT '{c}' AS feature, round(avg(abs(CAST({w} AS DOUBLE) * ({c} - (SELECT avg({c}) FROM lineitem)))), 6) AS mean_abs FROM lineitem"
        for c, w in _COEFS.items()
    ),
)
def _(spark, sf):
    phis = evaluate.linear_attributions(table(spark, sf, "lineitem"), [], _COEFS)
    return evaluate.attribution_summary(phis, list(_COEFS)).withColumn("mean_abs", F.round("mean_abs", 6))
