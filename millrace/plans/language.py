"""Text operators on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import text as T
from millrace.operators import ordering, phrases, vocabulary
from millrace.plans.registry import query, table
from millrace.runtime import spread

WORDS_SQL = r"regexp_extract_all(lower(text), '[\p{L}\p{N}]+')"
SIMPLE_SQL = rf"list_filter(regexp_extract_all(translate(lower(text), '{T.ACCENTED}', '{T.PLAIN}'), '\p{{L}}+'), lambda t: length(t) BETWEEN 2 AND 15)"

_STOP = ["the", "of", "and", "la", "le", "der", "die", "und", "el", "de", "to", "in", "is", "on"]
_STOP_SQL = "(" + ", ".join(f"'{w}'" for w in _STOP) + ")"
_LEMMAS = [("thes", "the"), ("ands", "and"), ("ouen", "ou"), ("nder", "der"), ("elle", "el"), ("then", "the"), ("ers", "er")]
_LEXICON = [
    ("the", 0.1, 0.2), ("of", -0.2, 0.4), ("and", 0.9, 0.8), ("la", 0.7, 0.5), ("le", -0.9, 0.9),
    ("der", -0.8, 0.3), ("und", 0.6, 0.6), ("el", 1.0, 1.0), ("de", -0.6, 0.1), ("is", 0.0, 0.5),
]


# endings of English nouns, verbs and adjectives in the order in which they are tried, and irregular forms
_RULES = [
    ("ies", "y"), ("ches", "ch"), ("shes", "sh"), ("sses", "ss"), ("xes", "x"), ("zes", "z"), ("ves", "f"), ("men", "man"), ("es", "e"), ("s", ""),
    ("ied", "y"), ("ed", "e"), ("ed", ""), ("ing", "e"), ("ing", ""), ("iest", "y"), ("est", "e"), ("est", ""), ("ier", "y"), ("er", "e"), ("er", ""), ("ly", ""),
]
_IRREGULAR = [("was", "be"), ("is", "be"), ("are", "be"), ("were", "be"), ("an", "a"), ("des", "de"), ("les", "le")]
# (word, polarity, subjectivity, intensity, negates): scored words, words that strengthen or weaken the next one, negations
_SCOPED = [(w, p, s, None, None) for w, p, s in _LEXICON] + [("in", None, None, 1.3, None), ("to", None, None, 1.5, None), ("on", None, None, 0.6, None), ("a", None, None, None, True), ("that", None, None, 0.8, True)]
_REACH = 3


def _nullable(rows):
    one = lambda v: "NULL" if v is None else str(v).lower() if isinstance(v, bool) else repr(v)
    return ", ".join("(" + ", ".join(one(v) for v in r) + ")" for r in rows)


def _values(rows):
    return ", ".join("(" + ", ".join(f"CAST({v} AS DOUBLE)" if isinstance(v, float) else f"'{v}'" for v in r) + ")" for r in rows)


def docs(spark, sf):
    return spread(table(spark, sf, "documents").select("doc_id", "text"), "doc_id")


@query("A17_token_lengths", rf"SELECT doc_id, CAST(len(list_filter(regexp_split_to_array(text, '\s+'), lambda t: t <> '')) AS INT) AS n_tokens FROM documents")
def _(spark, sf):
    return docs(spark, sf).select("doc_id", F.size(T.space_tokens(F.col("text"))).alias("n_tokens"))


@query(
    "A17_longest_rows",
    rf"""SELECT doc_id, n_tokens, max(n_tokens) OVER () AS max_tokens FROM (SELECT doc_id, CAST(len({WORDS_SQL}) AS INT) AS n_tokens FROM documents)
         ORDER BY n_tokens DESC, doc_id LIMIT 20""",
)
def _(spark, sf):
    lengths = docs(spark, sf).select("doc_id", F.size(T.word_tokens(F.col("text"))).alias("n_tokens"))
    longest = lengths.agg(F.max("n_tokens").alias("m")).scalar()
    return lengths.orderBy(F.desc("n_tokens"), "doc_id").limit(20).withColumn("max_tokens", longest)


@query(
    "A18_term_frequency",
    f"SELECT term, count(*) AS n FROM (SELECT unnest({WORDS_SQL}) AS term FROM documents) WHERE term NOT IN {_STOP_SQL} GROUP BY 1 ORDER BY n DESC, term LIMIT 100",
)
def _(spark, sf):
    return vocabulary.term_frequency(docs(spark, sf), T.word_tokens(F.col("text")), _STOP, 100)


@query("N1_word_tokens", f"SELECT doc_id, array_to_string({WORDS_SQL}, ' ') AS tokens, CAST(len({WORDS_SQL}) AS INT) AS n FROM documents")
def _(spark, sf):
    t = T.word_tokens(F.col("text"))
    return docs(spark, sf).select("doc_id", F.array_join(t, " ").alias("tokens"), F.size(t).alias("n"))


@query("N2_simple_tokens", f"SELECT doc_id, array_to_string({SIMPLE_SQL}, ' ') AS tokens FROM documents")
def _(spark, sf):
    return docs(spark, sf).select("doc_id", F.array_join(T.simple_tokens(F.col("text")), " ").alias("tokens"))


@query(
    "N3_stop_words",
    f"""SELECT doc_id, CAST(len(t) - len(k) AS INT) AS n_stop, array_to_string(k, ' ') AS kept FROM (SELECT doc_id, t, list_filter(t, lambda w: w NOT IN {_STOP_SQL}) AS k
        FROM (SELECT doc_id, {WORDS_SQL} AS t FROM documents))""",
)
def _(spark, sf):
    t = docs(spark, sf).select("doc_id", T.word_tokens(F.col("text")).alias("t"))
    kept = t.withColumn("k", T.without(F.col("t"), _STOP))
    return kept.select("doc_id", (F.size("t") - F.size("k")).alias("n_stop"), F.array_join("k", " ").alias("kept"))


@query(
    "N4_lemma_lookup",
    f"""WITH l(form, lemma) AS (VALUES {_values(_LEMMAS)}), w AS (SELECT doc_id, unnest({WORDS_SQL}) AS form FROM documents)
        SELECT doc_id, coalesce(lemma, w.form) AS lemma, count(*) AS n FROM w LEFT JOIN l ON w.form = l.form GROUP BY 1, 2""",
)
def _(spark, sf):
    lemmas = spark.createDataFrame(_LEMMAS, "form string, lemma string")
    long = vocabulary.lemmatize(docs(spark, sf), "doc_id", T.word_tokens(F.col("text")), lemmas)
    return long.groupBy("doc_id", "lemma").agg(F.count("*").alias("n"))


@query(
    "N4_lemma_rules",
    f"""WITH r(rule, a, b) AS (VALUES {", ".join(f"({i}, '{a}', '{b}')" for i, (a, b) in enumerate(_RULES))}), x(form, lemma) AS (VALUES {_values(_IRREGULAR)}),
        w AS (SELECT doc_id, form, count(*) AS n FROM (SELECT doc_id, unnest({WORDS_SQL}) AS form FROM documents) GROUP BY 1, 2),
        v AS (SELECT form, sum(n) AS n FROM w GROUP BY 1),
        g AS (SELECT form, n, rule, left(form, length(form) - length(a)) || b AS lemma FROM v, r WHERE suffix(form, a) AND length(form) - length(a) + length(b) >= 2 AND form NOT IN (SELECT form FROM x)),
        k AS (SELECT g.form, min_by(g.lemma, rule) AS lemma FROM g JOIN v ON g.lemma = v.form WHERE v.n >= g.n AND g.lemma <> g.form GROUP BY 1 UNION ALL SELECT form, lemma FROM x)
        SELECT doc_id, coalesce(lemma, w.form) AS lemma, CAST(sum(n) AS BIGINT) AS n FROM w LEFT JOIN k ON w.form = k.form GROUP BY 1, 2""",
)
def _(spark, sf):
    exceptions = spark.createDataFrame(_IRREGULAR, "form string, lemma string")
    return vocabulary.lemma_counts(docs(spark, sf), "doc_id", T.word_tokens(F.col("text")), _RULES, exceptions)


@query("N5_bag_of_words", f"SELECT doc_id, term, count(*) AS n FROM (SELECT doc_id, unnest({WORDS_SQL}) AS term FROM documents) GROUP BY 1, 2")
def _(spark, sf):
    return vocabulary.document_terms(docs(spark, sf), "doc_id", T.word_tokens(F.col("text")))


# the list to match: the most frequent single words of five letters or more, pairs and triples
_GRAMS = f"""tok AS (SELECT doc_id, {WORDS_SQL} AS t FROM documents),
   gram AS (SELECT doc_id, n, i AS start, array_to_string(t[i + 1:i + n], ' ') AS phrase
            FROM (SELECT doc_id, t, n, unnest(range(0, len(t) - n + 1)) AS i FROM tok, (VALUES (1), (2), (3)) v(n))),
   top AS (SELECT n, phrase, row_number() OVER (PARTITION BY n ORDER BY count(*) DESC, phrase) AS r FROM gram
           WHERE n > 1 OR length(phrase) >= 5 GROUP BY 1, 2),
   ph AS (SELECT phrase FROM top WHERE r <= 10)"""
_MATCH = "SELECT doc_id, gram.phrase AS phrase, CAST(start AS INT) AS start, CAST(start + n AS INT) AS end FROM gram JOIN ph ON gram.phrase = ph.phrase"


def frequent_phrases(spark, sf, per_length=10):
    return phrases.most_frequent(docs(spark, sf), T.word_tokens(F.col("text")), [1, 2, 3], per_length, shortest=5).select("phrase")


@query("N6_phrase_match", f"WITH {_GRAMS} {_MATCH}")
def _(spark, sf):
    return phrases.phrase_match(docs(spark, sf), "doc_id", "text", frequent_phrases(spark, sf), [1, 2, 3])


@query("N7_items_per_document", f"WITH {_GRAMS} SELECT DISTINCT doc_id, phrase FROM ({_MATCH})")
def _(spark, sf):
    found = phrases.phrase_match(docs(spark, sf), "doc_id", "text", frequent_phrases(spark, sf), [1, 2, 3])
    return phrases.items_per_document(found, "doc_id")


_SCORES = f"""{_GRAMS}, sc AS (SELECT phrase, round(avg(quality), 9) AS mean_rating, count(*) AS n_docs FROM (SELECT DISTINCT doc_id, phrase FROM ({_MATCH})) m
   JOIN labels USING (doc_id) GROUP BY 1)"""


def _scores(spark, sf):
    found = phrases.phrase_match(docs(spark, sf), "doc_id", "text", frequent_phrases(spark, sf), [1, 2, 3])
    return phrases.phrase_scores(found, table(spark, sf, "labels"), "doc_id", "quality")


@query("A16_phrase_scores", f"WITH {_SCORES} SELECT * FROM sc")
def _(spark, sf):
    return _scores(spark, sf).orderBy("mean_rating", "phrase")


@query(
    "T3_best_and_worst",
    f"""WITH {_SCORES} SELECT * FROM (SELECT *, 'best' AS side FROM sc ORDER BY mean_rating DESC, phrase LIMIT 10)
        UNION ALL SELECT * FROM (SELECT *, 'worst' AS side FROM sc ORDER BY mean_rating, phrase LIMIT 10)""",
)
def _(spark, sf):
    return ordering.best_and_worst(_scores(spark, sf), "mean_rating", "phrase", 10)


_PATTERNS = {"EMAIL": r"[A-Za-z0-9._+-]+@[A-Za-z0-9-]+\.[A-Za-z]+", "DATE": r"\d{4}-\d{2}-\d{2}", "NUMBER": r"\d+"}


@query(
    "N8_entity_spans",
    f"WITH {_GRAMS} SELECT doc_id, 'TERM' AS label, phrase AS span FROM ({_MATCH}) UNION ALL "
    + " UNION ALL ".join(f"SELECT doc_id, '{k}', unnest(regexp_extract_all(text, '{p}')) FROM documents" for k, p in _PATTERNS.items()),
)
def _(spark, sf):
    gazetteer = frequent_phrases(spark, sf).withColumn("label", F.lit("TERM"))
    return phrases.entity_spans(docs(spark, sf), "doc_id", "text", gazetteer, [1, 2, 3], _PATTERNS)


@query(
    "N9_lexicon_sentiment",
    f"""WITH l(word, polarity, subjectivity) AS (VALUES {_values(_LEXICON)}),
        m AS (SELECT doc_id, avg(polarity) AS p, avg(subjectivity) AS s FROM (SELECT doc_id, unnest({WORDS_SQL}) AS word FROM documents) JOIN l USING (word) GROUP BY 1)
        SELECT doc_id, round(coalesce(p, 0), 9) AS polarity, round(coalesce(s, 0), 9) AS subjectivity,
          CASE WHEN coalesce(round(p, 9), 0) > 0.5 THEN 'positive' WHEN coalesce(round(p, 9), 0) < -0.5 THEN 'negative' ELSE 'neutral' END AS sentiment
        FROM documents LEFT JOIN m USING (doc_id)""",
)
def _(spark, sf):
    lexicon = spark.createDataFrame(_LEXICON, "word string, polarity double, subjectivity double")
    scored = phrases.lexicon_sentiment(docs(spark, sf), "doc_id", T.word_tokens(F.col("text")), lexicon)
    return scored.withColumns({"polarity": F.round("polarity", 9), "subjectivity": F.round("subjectivity", 9)})


@query(
    "N9_scoped_sentiment",
    f"""WITH l(word, polarity, subjectivity, intensity, negates) AS (VALUES {_nullable(_SCOPED)}), t AS (SELECT doc_id, {WORDS_SQL} AS t FROM documents),
        m AS (SELECT doc_id, pos, l.* FROM (SELECT doc_id, unnest(t) AS word, unnest(range(len(t))) AS pos FROM t) JOIN l USING (word)),
        s AS (SELECT *, coalesce(lag(pos) OVER (PARTITION BY doc_id ORDER BY pos), -1) AS prev FROM m WHERE polarity IS NOT NULL),
        b AS (SELECT s.doc_id, s.pos, any_value(s.polarity) AS p, any_value(s.subjectivity) AS s, product(coalesce(x.intensity, 1)) AS boost, count_if(x.negates) AS neg
              FROM s LEFT JOIN m x ON x.doc_id = s.doc_id AND x.polarity IS NULL AND x.pos > s.prev AND x.pos >= s.pos - {_REACH} AND x.pos < s.pos GROUP BY 1, 2),
        d AS (SELECT doc_id, avg(greatest(-1, least(1, p * boost * CASE WHEN neg % 2 = 1 THEN -0.5 ELSE 1 END))) AS p, avg(greatest(0, least(1, s * boost))) AS s FROM b GROUP BY 1)
        SELECT doc_id, round(coalesce(p, 0) + 1e-12, 9) AS polarity, round(coalesce(s, 0) + 1e-12, 9) AS subjectivity,
          CASE WHEN coalesce(round(p + 1e-12, 9), 0) > 0.5 THEN 'positive' WHEN coalesce(round(p + 1e-12, 9), 0) < -0.5 THEN 'negative' ELSE 'neutral' END AS sentiment
        FROM documents LEFT JOIN d USING (doc_id)""",
)
def _(spark, sf):
    lexicon = spark.createDataFrame(_SCOPED, "word string, polarity double, subjectivity double, intensity double, negates boolean")
    scored = phrases.scoped_sentiment(docs(spark, sf), "doc_id", T.word_tokens(F.col("text")), lexicon, reach=_REACH)
    # means of few decimals often end in a half; a little more settles them alike however the sums were rounded
    rounded = scored.withColumns({c: F.round(F.col(c) + 1e-12, 9) for c in ("polarity", "subjectivity")})
    side = F.when(F.col("polarity") > 0.5, "positive").when(F.col("polarity") < -0.5, "negative").otherwise("neutral")
    return rounded.withColumn("sentiment", side)


_BIGRAM = f"""tok AS (SELECT doc_id, {SIMPLE_SQL} AS t FROM documents), w AS (SELECT unnest(t) AS w FROM tok),
   wc AS (SELECT w, count(*) AS n FROM w GROUP BY 1),
   pc AS (SELECT a, b, count(*) AS n_ab FROM (SELECT t[i] AS a, t[i + 1] AS b FROM (SELECT t, unnest(range(1, len(t))) AS i FROM tok)) GROUP BY 1, 2),
   sc AS (SELECT pc.a, pc.b, n_ab, CAST(n_ab - 5 AS DOUBLE) / x.n / y.n * ((SELECT count(*) FROM wc) + (SELECT count(*) FROM pc)) AS score
          FROM pc JOIN wc x ON x.w = a JOIN wc y ON y.w = b WHERE n_ab >= 5)"""


@query("N10_bigram_phrases", f"WITH {_BIGRAM} SELECT a, b, n_ab, round(score, 4) AS score FROM sc WHERE score > 10")
def _(spark, sf):
    found = phrases.bigram_phrases(docs(spark, sf), T.simple_tokens(F.col("text")))
    return found.select("a", "b", "n_ab", F.round("score", 4).alias("score"))


@query(
    "N10_join_bigrams",
    f"""WITH {_BIGRAM}, lng AS (SELECT doc_id, pos, t[pos] AS a, t[pos + 1] AS b FROM (SELECT doc_id, t, unnest(range(1, len(t) + 1)) AS pos FROM tok)),
        h AS (SELECT doc_id, pos, pos - row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS run FROM lng JOIN sc ON lng.a = sc.a AND lng.b = sc.b WHERE score > 10),
        s AS (SELECT doc_id, pos FROM (SELECT doc_id, pos, row_number() OVER (PARTITION BY doc_id, run ORDER BY pos) AS r FROM h) WHERE r % 2 = 1),
        o AS (SELECT doc_id, string_agg(CASE WHEN s.pos IS NULL THEN a ELSE a || '_' || b END, ' ' ORDER BY lng.pos) AS tokens
              FROM lng LEFT JOIN s USING (doc_id, pos) WHERE (doc_id, lng.pos - 1) NOT IN (SELECT (doc_id, pos) FROM s) GROUP BY 1)
        SELECT doc_id, coalesce(tokens, '') AS tokens FROM documents LEFT JOIN o USING (doc_id)""",
)
def _(spark, sf):
    t = T.simple_tokens(F.col("text"))
    accepted = phrases.bigram_phrases(docs(spark, sf), t)
    out = phrases.join_bigrams(docs(spark, sf), "doc_id", t, accepted)
    return out.select("doc_id", F.array_join("tokens", " ").alias("tokens"))


@query(
    "N11_vocabulary",
    f"SELECT term, count(*) AS n FROM (SELECT unnest({SIMPLE_SQL}) AS term FROM documents) GROUP BY 1 HAVING count(*) >= 2",
)
def _(spark, sf):
    return vocabulary.term_counts(docs(spark, sf), T.simple_tokens(F.col("text")), min_count=2)


VOCAB_SQL = f"""voc AS (SELECT term, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, term) AS idx
   FROM (SELECT unnest({SIMPLE_SQL}) AS term FROM documents) GROUP BY 1 HAVING count(*) >= 2)"""


def ranked(spark, sf):
    return vocabulary.ranked_vocabulary(docs(spark, sf), T.simple_tokens(F.col("text")), min_count=2)


def _sequence_sql(pre: bool, n: int):
    fixed = (
        f"list_concat(list_resize([]::INT[], greatest({n} - len(s), 0), 0), s[greatest(len(s) - {n - 1}, 1):])"
        if pre
        else f"list_resize(s[1:{n}], {n}, 0)"
    )
    return f"""WITH {VOCAB_SQL}, lng AS (SELECT doc_id, unnest(t) AS term, generate_subscripts(t, 1) AS pos FROM (SELECT doc_id, {SIMPLE_SQL} AS t FROM documents)),
        q AS (SELECT doc_id, list(CAST(idx AS INT) ORDER BY pos) AS s FROM lng JOIN voc USING (term) GROUP BY 1),
        a AS (SELECT doc_id, coalesce(s, []::INT[]) AS s FROM documents LEFT JOIN q USING (doc_id))
        SELECT doc_id, array_to_string({fixed}, ',') AS sequence FROM a"""


@query("N19_encode_pre", _sequence_sql(True, 50))
def _(spark, sf):
    out = vocabulary.encode_sequences(docs(spark, sf), "doc_id", T.simple_tokens(F.col("text")), ranked(spark, sf), 50, "pre")
    return out.select("doc_id", F.array_join(F.col("sequence").cast("array<string>"), ",").alias("sequence"))


@query("N19_encode_post", _sequence_sql(False, 200))
def _(spark, sf):
    out = vocabulary.encode_sequences(docs(spark, sf), "doc_id", T.simple_tokens(F.col("text")), ranked(spark, sf), 200, "post")
    return out.select("doc_id", F.array_join(F.col("sequence").cast("array<string>"), ",").alias("sequence"))
