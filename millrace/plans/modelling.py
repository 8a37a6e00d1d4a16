"""Supervised models trained and scored on the given tables."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml import classification as C
from pyspark.ml.feature import IDF, HashingTF, PolynomialExpansion, RegexTokenizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from millrace.functions import text as T
from millrace.operators import bayes, boosting, models, sampling, vocabulary
from millrace.operators.kernel import KernelMachine
from millrace.operators.linear import LogisticGrid
from millrace.operators.second_order import SecondOrderBoosting
from millrace.plans.frames import RISK_FEATURES, RISK_SQL, bucket_sql, risk
from millrace.plans.language import WORDS_SQL, docs
from millrace.plans.registry import QUERIES, query, table
from millrace.runtime import cut_lineage, work_path


def _parts(spark, sf):
    return sampling.split_by_key(risk(spark, sf), "o_orderkey", 0.7, seed=31)


def _score(spark, sf, family, scaling="standard", **params):
    train, test = _parts(spark, sf)
    model = models.classifier_stages(family, RISK_FEATURES, scaling=scaling, **params).fit(train)
    return models.score_batch(model, test, ["o_orderkey"]).withColumn("pd", F.round("pd", 6))


_SPLIT = bucket_sql("o_orderkey", 31) + " < 700"
_NB = f"""WITH r AS ({RISK_SQL}), t AS (SELECT * FROM r WHERE {_SPLIT}), e AS (SELECT 0.01 * greatest(var_pop(price), var_pop(balance)) AS e FROM t),
   c AS (SELECT label AS c, ln(CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM t)) AS prior, avg(price) AS mp, var_pop(price) AS vp, avg(balance) AS mb, var_pop(balance) AS vb FROM t GROUP BY 1),
   j AS (SELECT o_orderkey, c, prior - 0.5 * (ln(2 * pi() * (vp + e)) + ln(2 * pi() * (vb + e))) - pow(price - mp, 2) / (2 * (vp + e)) - pow(balance - mb, 2) / (2 * (vb + e)) AS lj
         FROM r, c, e WHERE NOT {_SPLIT}),
   d AS (SELECT o_orderkey, sum(CASE WHEN c = 1 THEN lj ELSE -lj END) AS d FROM j GROUP BY 1)
   SELECT o_orderkey, CAST(d > 0 AS INT) AS prediction, round(1 / (1 + exp(-d)), 6) AS pd FROM d"""


@query("M1_gaussian_nb", _NB)
def _(spark, sf):
    train, test = _parts(spark, sf)
    model = bayes.GaussianNB(["price", "balance"], "label", var_smoothing=0.01).fit(train)
    return models.score_batch(model, test, ["o_orderkey"]).withColumn("pd", F.round("pd", 6))


# a variance is lifted by 1e-9 of the column's own; scaling the columns changes nothing else
_NB4 = f"""WITH r AS ({RISK_SQL}), x AS (SELECT o_orderkey, label AS c, {_SPLIT} AS train, unnest(['price', 'balance', 'year', 'priority']) AS f, unnest([price, balance, year, priority]) AS v FROM r),
   e AS (SELECT f, 1e-9 * var_pop(v) AS e FROM x WHERE train GROUP BY 1), p AS (SELECT c, ln(CAST(count(*) AS DOUBLE) / sum(count(*)) OVER ()) AS prior FROM x WHERE train GROUP BY 1),
   m AS (SELECT c, f, avg(v) AS m, var_pop(v) + any_value(e) AS s FROM x JOIN e USING (f) WHERE train GROUP BY 1, 2),
   j AS (SELECT o_orderkey, m.c, sum(-0.5 * ln(2 * pi() * s) - pow(v - m, 2) / (2 * s)) AS l FROM x JOIN m USING (f) WHERE NOT train GROUP BY 1, 2),
   d AS (SELECT o_orderkey, sum(CASE WHEN c = 1 THEN l + prior ELSE -l - prior END) AS d FROM j JOIN p USING (c) GROUP BY 1)
   SELECT o_orderkey, CAST(d > 0 AS INT) AS prediction, round(1 / (1 + exp(-d)), 6) AS pd FROM d"""


@query("M1_gaussian_nb_mllib", _NB4)
def _(spark, sf):
    return _score(spark, sf, "naive_bayes")


@query(
    "M2_bernoulli_nb",
    f"""WITH w AS (SELECT DISTINCT doc_id, term FROM (SELECT doc_id, unnest({WORDS_SQL}) AS term FROM documents)),
        c AS (SELECT CAST(sum(quality) AS DOUBLE) AS n1, CAST(sum(1 - quality) AS DOUBLE) AS n0 FROM labels),
        t AS (SELECT term, CAST(sum(quality) AS DOUBLE) AS k1, CAST(sum(1 - quality) AS DOUBLE) AS k0 FROM w JOIN labels USING (doc_id) GROUP BY 1 HAVING count(*) >= 5),
        p AS (SELECT term, (k1 + 1) / (n1 + 2) AS p1, (k0 + 1) / (n0 + 2) AS p0 FROM t, c),
        r AS (SELECT term, ln(p1 / p0) AS present, ln((1 - p1) / (1 - p0)) AS absent FROM p),
        o AS (SELECT doc_id, sum(present - absent) AS s FROM w JOIN r USING (term) GROUP BY 1),
        d AS (SELECT doc_id, coalesce(s, 0) + (SELECT coalesce(sum(absent), 0) FROM r) + ln(n1 / n0) AS x FROM documents LEFT JOIN o USING (doc_id), c)
        SELECT doc_id, round(x, 5) AS log_odds, CAST(x > 0 AS INT) AS prediction FROM d""",
)
def _(spark, sf):
    terms = cut_lineage(vocabulary.document_terms(docs(spark, sf), "doc_id", T.word_tokens(F.col("text"))))
    labels = table(spark, sf, "labels").select("doc_id", "quality")
    out = bayes.bernoulli_scores(terms, labels, "doc_id", "quality", table(spark, sf, "documents").select("doc_id"))
    return out.withColumn("log_odds", F.round("log_odds", 5))


@query(
    "M3_multinomial_nb",
    f"""WITH w AS (SELECT doc_id, term, count(*) AS n FROM (SELECT doc_id, unnest({WORDS_SQL}) AS term FROM documents) GROUP BY 1, 2),
        t AS (SELECT term, sum(n * quality) AS n1, sum(n * (1 - quality)) AS n0 FROM w JOIN labels USING (doc_id) GROUP BY 1),
        s AS (SELECT count(*) AS v, CAST(sum(n1) AS DOUBLE) AS t1, CAST(sum(n0) AS DOUBLE) AS t0 FROM t), p AS (SELECT avg(quality) AS p FROM labels),
        o AS (SELECT doc_id, sum(n * ln(((CAST(n1 AS DOUBLE) + 1) / (t1 + v)) / ((CAST(n0 AS DOUBLE) + 1) / (t0 + v)))) AS s FROM w JOIN t USING (term), s GROUP BY 1),
        d AS (SELECT doc_id, coalesce(s, 0) + ln(p / (1 - p)) AS x FROM documents LEFT JOIN o USING (doc_id), p)
        SELECT doc_id, round(x, 5) AS log_odds, CAST(x > 0 AS INT) AS prediction FROM d""",
)
def _(spark, sf):
    # read twice, to train and to score
    terms = cut_lineage(vocabulary.document_terms(docs(spark, sf), "doc_id", T.word_tokens(F.col("text"))))
    labels = table(spark, sf, "labels").select("doc_id", "quality")
    out = bayes.multinomial_scores(terms, labels, "doc_id", "quality", table(spark, sf, "documents").select("doc_id"))
    return out.withColumn("log_odds", F.round("log_odds", 5))


@query("M4_logistic")
def _(spark, sf):
    return _score(spark, sf, "logistic", maxIter=20, regParam=0.001, elasticNetParam=0.5)


@query("M4_logistic_multinomial")
def _(spark, sf):
    df = models.with_vector(table(spark, sf, "embeddings"), "embedding")
    train, test = sampling.split_by_key(df, "vec_id", 0.7, seed=1)
    model = C.LogisticRegression(family="multinomial", maxIter=20, regParam=0.01).fit(train)
    return models.class_probabilities(model, test, ["vec_id"])


@query("M5_decision_tree")
def _(spark, sf):
    return _score(spark, sf, "tree", max_depth=5)


@query("M6_random_forest")
def _(spark, sf):
    return _score(spark, sf, "forest", n_estimators=20)


@query("A22_importances")
def _(spark, sf):
    train, _ = _parts(spark, sf)
    forest = models.classifier_stages("forest", RISK_FEATURES).fit(train)
    logit = models.classifier_stages("logistic", RISK_FEATURES).fit(train)
    rows = [("importance", c, v) for c, v in models.feature_importances(forest, RISK_FEATURES, 3)]
    rows += [("coefficient", c, v) for c, v in models.coefficient_table(logit, RISK_FEATURES)]
    return spark.createDataFrame(rows, "kind string, name string, value double")


def _two_class(spark, sf):
    df = table(spark, sf, "embeddings").withColumn("label", (F.col("label") >= 5).cast("int"))
    return df


@query("M7_linear_svm")
def _(spark, sf):
    df = models.with_vector(_two_class(spark, sf), "embedding", "x")
    train, test = sampling.split_by_key(df, "vec_id", 0.7, seed=1)
    model = models.fit_svm_probability(["x"], train, regParam=0.01)
    return models.score_batch(model, test, ["vec_id"])


@query("M8_kernel_svm_rbf")
def _(spark, sf):
    df = models.fourier_features(_two_class(spark, sf), "embedding", "z", 64, gamma=1.0, components=128, seed=3)
    df = models.with_vector(df, "z", "x")
    train, test = sampling.split_by_key(df, "vec_id", 0.7, seed=1)
    return models.score_batch(models.fit_svm_probability(["x"], train, regParam=0.001), test, ["vec_id"])


@query("M8_kernel_machine")
def _(spark, sf):
    df = _two_class(spark, sf)
    train, test = sampling.split_by_key(df, "vec_id", 0.7, seed=1)
    machine = KernelMachine("embedding", gamma=1.0, landmarks=128, reg=0.001, seed=3).fit(train)
    # a logistic fit on the margin gives the probability
    platt = LogisticGrid(["margin"], "label", [(0.0, 0.0)]).fit(machine.transform(train).withColumn("fold", F.lit(0)))
    scored = machine.transform(test).withColumn("pd", 1 / (1 + F.exp(-(F.col("margin") * float(platt.fits[0].coefficients[0]) + platt.fits[0].intercept))))
    return scored.select("vec_id", (F.col("pd") > 0.5).cast("int").alias("prediction"), F.round("pd", 6).alias("pd"))


@query("M8_kernel_svm_poly")
def _(spark, sf):
    train, test = _parts(spark, sf)
    stages = [
        VectorAssembler(inputCols=["price", "balance"], outputCol="pair"),
        PolynomialExpansion(inputCol="pair", outputCol="poly", degree=2),
    ]
    expand = Pipeline(stages=stages).fit(train)
    model = models.fit_svm_probability(["poly"], expand.transform(train))
    return models.score_batch(model, expand.transform(test), ["o_orderkey"]).withColumn("pd", F.round("pd", 6))


@query("M9_gradient_boosting")
def _(spark, sf):
    return _score(spark, sf, "boosted", n_estimators=20, max_depth=5)


@query("M9_boosting_one_vs_rest")
def _(spark, sf):
    df = table(spark, sf, "embeddings").withColumn("label", (F.col("label") % 3).cast("int"))
    df = models.with_vector(df, "embedding")
    train, test = sampling.split_by_key(df, "vec_id", 0.7, seed=1)
    model = C.OneVsRest(classifier=models.classifier("boosted", maxIter=20, maxDepth=5), parallelism=3).fit(train)
    return model.transform(test).select("vec_id", F.col("prediction").cast("int").alias("prediction"), vector_to_array("rawPrediction").alias("scores"))


@query("M10_boosting_deep")
def _(spark, sf):
    return _score(spark, sf, "boosted_deep", n_estimators=100)


@query("M10_boosting_second_order")
def _(spark, sf):
    train, test = _parts(spark, sf)
    return models.score_batch(SecondOrderBoosting(RISK_FEATURES).fit(train), test, ["o_orderkey"]).withColumn("pd", F.round("pd", 6))


@query("M11_ada_boost")
def _(spark, sf):
    train, test = _parts(spark, sf)
    assemble = VectorAssembler(inputCols=RISK_FEATURES, outputCol="features")
    model = boosting.AdaBoost("features", "label", rounds=50, max_depth=1).fit(assemble.transform(train))
    return models.score_batch(model, assemble.transform(test), ["o_orderkey"]).withColumn("pd", F.round("pd", 6))


@query("M13_perceptron_one_layer")
def _(spark, sf):
    return _score(spark, sf, "perceptron", scaling="min_max", layers=[4, 8, 2], maxIter=100)


@query("M13_perceptron_two_layers")
def _(spark, sf):
    return _score(spark, sf, "perceptron", scaling="min_max", layers=[4, 8, 4, 2], maxIter=100)


@query("M15_text_classifier")
def _(spark, sf):
    """Trained on the labelled documents, scores all. Terms are hashed into 2^18 columns: none is dropped, and the
    driver holds one weight per column however many terms there are."""
    df = docs(spark, sf).select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id", "left")
    stages = [
        RegexTokenizer(inputCol="text", outputCol="tokens", pattern=r"[^\p{L}\p{N}]+"),
        HashingTF(inputCol="tokens", outputCol="counts", numFeatures=1 << 18),
        IDF(inputCol="counts", outputCol="weighted", minDocFreq=2),
        C.LogisticRegression(featuresCol="weighted", labelCol="quality", maxIter=10, regParam=0.01),
    ]
    return models.score_batch(Pipeline(stages=stages).fit(df.where("quality IS NOT NULL")), df, ["doc_id"], extra=["quality"])


@query("M16_score_batch")
def _(spark, sf):
    train, _ = _parts(spark, sf)
    model = models.classifier_stages("logistic", RISK_FEATURES).fit(train)
    return models.score_batch(model, risk(spark, sf), ["o_orderkey"]).withColumn("pd", F.round("pd", 6))


# fixed values: the named settings of the scoring model
NAMED_SETTINGS = {"max_depth": 4, "n_estimators": 83, "learning_rate": 0.1, "max_features": 11}
CODES = {"o_orderstatus": ["F", "O", "P"], "c_mktsegment": ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]}


@query("M18_named_settings")
def _(spark, sf):
    """Label-first table: four numbers, and one column per order status and market segment."""
    codes = [(c, v) for c, vs in CODES.items() for v in vs]
    flags = [(F.col(c) == v).cast("double").alias(f"{c}_{v}") for c, v in codes]
    df = risk(spark, sf).select("label", *RISK_FEATURES, *flags, "o_orderkey")
    label, *rest = df.columns
    features = [c for c in rest if c != "o_orderkey"]
    train, test = sampling.split_by_key(df, "o_orderkey", 0.7, seed=31)
    model = models.classifier_stages("boosted", features, label, scaling=None, **NAMED_SETTINGS).fit(train)
    return models.score_batch(model, test, ["o_orderkey"]).withColumn("pd", F.round("pd", 6))


@query("S11_model_store")
def _(spark, sf):
    """Scores of a model that was saved and loaded again, next to those of the one in memory."""
    train, test = _parts(spark, sf)
    model = models.classifier_stages("logistic", RISK_FEATURES).fit(train)
    path = work_path(spark, "model")
    model.write().overwrite().save(path)
    again = PipelineModel.load(path)
    a = models.score_batch(model, test, ["o_orderkey"]).select("o_orderkey", F.col("pd").alias("pd_memory"))
    return models.score_batch(again, test, ["o_orderkey"]).select("o_orderkey", F.col("pd").alias("pd_loaded")).join(a, "o_orderkey")


@query("S11_loaded_is_saved", f"SELECT o_orderkey, TRUE AS same FROM orders WHERE NOT {_SPLIT}")
def _(spark, sf):
    """Of every scored row whether the loaded model agrees to the last digit."""
    both = QUERIES["S11_model_store"](spark, sf)
    return both.select("o_orderkey", (F.col("pd_loaded") == F.col("pd_memory")).alias("same"))
