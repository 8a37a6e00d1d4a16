"""Naive Bayes in aggregate form: Gaussian with variance smoothing, multinomial and Bernoulli over long term counts."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.vocabulary import lookup
from millrace.runtime import cut_lineage


class GaussianNB:
    """Class means and population variances; ``var_smoothing`` × the largest overall variance is added."""

    def __init__(self, features: Sequence[str], label: str, var_smoothing: float = 1e-9):
        self.features, self.label, self.var_smoothing = list(features), label, var_smoothing

    def fit(self, df: DataFrame) -> "GaussianNB":
        moments = [a for i, f in enumerate(self.features) for a in (F.avg(f).alias(f"m{i}"), F.var_pop(f).alias(f"v{i}"))]
        rows = df.groupBy(self.label).agg(F.count("*").alias("n"), *moments).orderBy(self.label).collect()
        total = sum(r["n"] for r in rows)
        # overall variance from the class moments: no second pass
        overall = []
        for i in range(len(self.features)):
            mean = sum(r["n"] * r[f"m{i}"] for r in rows) / total
            overall.append(sum(r["n"] * (r[f"v{i}"] + (r[f"m{i}"] - mean) ** 2) for r in rows) / total)
        extra = self.var_smoothing * max(overall)
        self.classes = [r[self.label] for r in rows]
        self.params = [
            (math.log(r["n"] / total), [(r[f"m{i}"], r[f"v{i}"] + extra) for i in range(len(self.features))]) for r in rows
        ]
        return self

    def _log_joint(self, prior: float, moments) -> Column:
        terms = F.lit(prior - 0.5 * sum(math.log(2 * math.pi * v) for _, v in moments))
        for f, (m, v) in zip(self.features, moments):
            terms = terms - (F.col(f) - m) ** 2 / (2 * v)
        return terms

    def transform(self, df: DataFrame) -> DataFrame:
        """Add ``probability`` (one entry per class, in class order) and ``prediction``."""
        joint = df.withColumn("__j", F.array(*[self._log_joint(p, m) for p, m in self.params]))
        shifted = F.transform("__j", lambda x: F.exp(x - F.array_max("__j")))
        weights = joint.withColumn("__w", shifted)
        total = F.aggregate("__w", F.lit(0.0), lambda a, x: a + x)
        prob = weights.withColumn("probability", F.transform("__w", lambda x: x / total))
        top = (F.array_position("probability", F.array_max("probability")) - 1).cast("int")
        labels = F.array(*map(F.lit, self.classes))
        return prob.withColumn("prediction", F.get(labels, top)).drop("__j", "__w")


def multinomial_scores(terms: DataFrame, labels: DataFrame, key: str, label: str, keys: DataFrame, smoothing: float = 1.0) -> DataFrame:
    """(key, log_odds, prediction) for 0/1 labels from long term counts (key, term, n).

    Trains on rows of ``terms`` with a label and scores every row of ``keys``; without a known term the prior decides.
    The vocabulary stays a distributed table, frequent terms are joined apart from the rest.
    """
    train = terms.join(labels.select(key, F.col(label).cast("int").alias("y")), key)
    table = train.groupBy("term").agg(F.sum(F.col("n") * F.col("y")).alias("n1"), F.sum(F.col("n") * (1 - F.col("y"))).alias("n0"))
    totals = table.agg(F.struct(F.count("*").alias("v"), F.sum("n1").alias("t1"), F.sum("n0").alias("t0")).alias("t")).scalar()
    a = float(smoothing)
    p1 = (F.col("n1") + a) / (F.col("t.t1") + a * F.col("t.v"))
    p0 = (F.col("n0") + a) / (F.col("t.t0") + a * F.col("t.v"))
    weights = table.withColumn("t", totals).select("term", F.log(p1 / p0).alias("w"))
    priors = labels.agg(F.avg(F.col(label).cast("double")).alias("p")).scalar()
    counts = table.select("term", (F.col("n1") + F.col("n0")).alias("n"))
    known = lookup(terms, weights, "term", counts).groupBy(key).agg(F.sum(F.col("n") * F.col("w")).alias("s"))
    return _decided(keys, known, key, F.log(F.col("p") / (1 - F.col("p"))), p=priors)


def bernoulli_scores(terms: DataFrame, labels: DataFrame, key: str, label: str, keys: DataFrame, smoothing: float = 1.0, min_docs: int = 5) -> DataFrame:
    """As ``multinomial_scores``, by presence and absence of the terms that at least ``min_docs`` labelled documents have.

    Absent terms enter through one constant, the sum over all terms, so a document meets only its own terms.
    """
    train = terms.select(key, "term").join(labels.select(key, F.col(label).cast("int").alias("y")), key)
    table = train.groupBy("term").agg(F.count("*").alias("n"), F.sum("y").alias("n1")).where(F.col("n") >= min_docs)
    y = F.col(label).cast("double")
    sizes = labels.agg(F.struct(F.sum(y).alias("n1"), F.sum(1 - y).alias("n0")).alias("t")).scalar()
    a = float(smoothing)
    p1 = (F.col("n1") + a) / (F.col("t.n1") + 2 * a)
    p0 = (F.col("n") - F.col("n1") + a) / (F.col("t.n0") + 2 * a)
    absent = F.log((1 - p1) / (1 - p0))
    weights = cut_lineage(table.withColumn("t", sizes).select("term", "n", F.log(p1 / p0).alias("present"), absent.alias("absent")))
    ratios = weights.select("term", (F.col("present") - F.col("absent")).alias("w"))
    known = lookup(terms.select(key, "term"), ratios, "term", weights.select("term", "n")).groupBy(key).agg(F.sum("w").alias("s"))
    base = weights.agg(F.coalesce(F.sum("absent"), F.lit(0.0))).scalar()
    return _decided(keys, known, key, F.col("base") + F.log(F.col("t.n1") / F.col("t.n0")), base=base, t=sizes)


def _decided(keys: DataFrame, known: DataFrame, key: str, prior: Column, **scalars: Column) -> DataFrame:
    odds = keys.select(key).join(known, key, "left").withColumns(scalars)
    odds = odds.select(key, (F.coalesce("s", F.lit(0.0)) + prior).alias("log_odds"))
    return odds.withColumn("prediction", (F.col("log_odds") > 0).cast("int"))
