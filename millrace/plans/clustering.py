"""Cluster groups, silhouettes and stability on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import cluster, encode
from millrace.plans.registry import query, table

_CUTS = {2: [4500.0], 3: [2500.0, 6500.0], 4: [1500.0, 4500.0, 7500.0]}


def _group_sql(cuts):
    return "CASE " + " ".join(f"WHEN c_acctbal < {c} THEN {i}" for i, c in enumerate(cuts)) + f" ELSE {len(cuts)} END"


def _silhouette_sql(cuts):
    return f"""g AS (SELECT c_acctbal AS v, {_group_sql(cuts)} AS c FROM customer), u AS (SELECT v, c, count(*) AS n FROM g GROUP BY 1, 2), k AS (SELECT c, count(*) AS n FROM g GROUP BY 1),
      d AS (SELECT a.v, a.c, a.n, b.c AS o, sum(abs(a.v - b.v) * b.n) AS s FROM u a, u b GROUP BY 1, 2, 3, 4),
      m AS (SELECT v, d.c, d.n, min(CASE WHEN o <> d.c THEN s / k.n END) AS b, max(CASE WHEN o = d.c THEN s / nullif(k.n - 1, 0) END) AS a FROM d JOIN k ON k.c = d.o GROUP BY 1, 2, 3),
      sil AS (SELECT v, c, n, coalesce((b - a) / nullif(greatest(a, b), 0), 0) AS s FROM m)"""


@query("C1_kmeans_groups")
def _(spark, sf):
    df = table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    fitted = cluster.OneColumnKMeans("c_acctbal", 4).fit(df)
    return fitted.transform(df, "balance_group")


_RUN = "OVER (ORDER BY v)"


@query(
    "C1_kmeans_optimum",
    f"""WITH u AS (SELECT c_acctbal AS v, count(*) AS n FROM customer GROUP BY 1),
        r AS (SELECT v, row_number() {_RUN} AS i, sum(n) {_RUN} AS n, sum(n * (v - 4500)) {_RUN} AS s, sum(n * (v - 4500) * (v - 4500)) {_RUN} AS q FROM u),
        p AS (SELECT i, n, s, q FROM r UNION ALL SELECT 0, 0, 0, 0), e AS (SELECT max_by(i, n) AS i, max(n) AS n, max_by(s, n) AS s, max_by(q, n) AS q FROM p),
        c AS (SELECT a.i AS a, b.i AS b, (a.q - a.s * a.s / a.n) + (b.q - a.q - (b.s - a.s) * (b.s - a.s) / (b.n - a.n)) + (e.q - b.q - (e.s - b.s) * (e.s - b.s) / (e.n - b.n)) AS cost
          FROM p a, p b, e WHERE 0 < a.i AND a.i < b.i AND b.i < e.i),
        t AS (SELECT min_by(a, cost) AS a, min_by(b, cost) AS b FROM c)
        SELECT c_custkey, CASE WHEN i <= a THEN 0 WHEN i <= b THEN 1 ELSE 2 END AS balance_group FROM customer JOIN r ON c_acctbal = r.v, t""",
)
def _(spark, sf):
    df = table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    fitted = cluster.OneColumnKMeans("c_acctbal", 3, exact=True).fit(df)
    return fitted.transform(df, "balance_group").select("c_custkey", "balance_group")


@query("C2_best_k")
def _(spark, sf):
    df = table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    scores, best = cluster.best_k_stable(df, "c_custkey", "c_acctbal")
    rows = [(k, float(s), k == best) for k, s in scores]
    return spark.createDataFrame(rows, "k int, instability double, chosen boolean")


@query(
    "C3_silhouette",
    f"WITH {_silhouette_sql(_CUTS[3])} SELECT v AS value, c AS cluster, n, round(s, 6) AS silhouette FROM sil",
)
def _(spark, sf):
    df = table(spark, sf, "customer").select("c_acctbal", cluster.group_by_cuts(F.col("c_acctbal"), _CUTS[3]).alias("g"))
    return cluster.silhouette(df, "c_acctbal", "g").withColumn("silhouette", F.round("silhouette", 6))


@query(
    "C3_mean_silhouette",
    " UNION ALL ".join(
        f"SELECT * FROM (WITH {_silhouette_sql(c)} SELECT {k} AS k, round(sum(s * n) / sum(n), 6) AS mean_silhouette FROM sil)" for k, c in _CUTS.items()
    ),
)
def _(spark, sf):
    parts = []
    for k, cuts in _CUTS.items():
        df = table(spark, sf, "customer").select("c_acctbal", cluster.group_by_cuts(F.col("c_acctbal"), cuts).alias("g"))
        parts.append(cluster.mean_silhouette(df, "c_acctbal", "g").select(F.lit(k).alias("k"), F.round("mean_silhouette", 6).alias("mean_silhouette")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "C4_cluster_woe",
    f"""WITH g AS (SELECT c_custkey, {_group_sql(_CUTS[3])} AS g, CAST(c_mktsegment IN ('BUILDING', 'MACHINERY') AS INT) AS y FROM customer),
        w AS (SELECT g, ln(((sum(y) + CAST(1 AS DOUBLE)) / ((SELECT sum(y) FROM g) + CAST(2 AS DOUBLE))) / ((count(*) - sum(y) + CAST(1 AS DOUBLE)) / ((SELECT count(*) - sum(y) FROM g) + CAST(2 AS DOUBLE)))) AS woe FROM g GROUP BY 1)
        SELECT c_custkey, g.g AS grp, round(woe, 6) AS grp_woe FROM g JOIN w ON g.g = w.g""",
)
def _(spark, sf):
    df = table(spark, sf, "customer").select(
        "c_custkey",
        cluster.group_by_cuts(F.col("c_acctbal"), _CUTS[3]).alias("grp"),
        F.col("c_mktsegment").isin("BUILDING", "MACHINERY").cast("int").alias("y"),
    )
    coded = encode.woe_apply(df, encode.woe_fit(df, ["grp"], "y"), ["grp"])
    return coded.select("c_custkey", "grp", F.round("grp_woe", 6).alias("grp_woe"))
