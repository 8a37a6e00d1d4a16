"""Quality rules with risk-controlled cutoffs, in DataFrame operations only.

Every rule is a score, higher meaning worse. The labelled rows of each stratum are split by a hash of the id. One half plans:
each rule gets the cutoff with the greatest gain, and the rules are put in the order of their gains. The other half, which
the plan has not seen, certifies: the combined cutoffs of the first rule, the first two rules, and so on are one fixed
sequence, in which an exact binomial test of "more than ``risk`` of the good texts would be rejected" is made of each up to
the first that it does not rule out. A fixed sequence needs no correction; over strata the error level is divided
(Bonferroni). With probability 1 - ``delta`` no stratum loses more than ``risk`` of its good texts. Strata without enough
labelled rows get no cutoff and lose nothing.

Nulls: a null text has no words (and fails the base rule), a null stratum is a stratum of its own, null labels are left
out, several labels of one id count as bad if one of them is. Without labels there are no cutoffs. Rows with equal ids are
judged one by one. Other columns pass through, except that columns with the names of the counts are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.runtime import cut_lineage

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
STEPS = [0.95, 0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1, 0.07, 0.05, 0.03, 0.02]

#: score name -> expression over the feature columns
RULES = {
    "symbols": "n_symbols / greatest(word_chars, 1)",
    "capitals": "n_capitals / greatest(word_chars, 1)",
    "marks": "n_marks / greatest(n_words, 1)",
    "repeats": "n_repeat_words / greatest(n_words, 1)",
    "lines": "n_dup_lines / greatest(n_lines, 1)",
    "same_words": "(n_words - n_distinct) / greatest(n_words, 1)",
}


def _count(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def features(df: DataFrame, text_col: str = "text", window: int = 5) -> DataFrame:
    """Add the counts that the rules use; all of them come from the whole text, row by row.

    n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_distinct, n_capitals, n_marks (long).
    """
    own = df.columns
    text = F.coalesce(F.col(text_col), F.lit(""))
    df = df.withColumn("__t", text).withColumn("__w", F.array_remove(F.split(F.translate("__t", SPACES, " " * len(SPACES)), " "), ""))
    df = df.withColumn("__l", F.filter(F.split("__t", "\n"), lambda x: F.trim(x, F.lit(SPACES)) != ""))
    last = F.size("__w") - window
    df = df.withColumn("__g", F.when(last >= 0, F.transform(F.sequence(F.lit(0), last), lambda i: F.concat_ws(" ", F.slice("__w", i + 1, window)))).otherwise(F.array().cast("array<string>")))
    # only texts with a repeated window pay for the sort that finds where it stands
    repeated = F.size(F.array_distinct("__g")) < F.size("__g")
    df = df.withColumn("__s", F.when(repeated, F.sort_array(F.transform("__g", lambda g, i: F.struct(g.alias("g"), i.alias("i"))))))
    near = F.expr("""sort_array(filter(transform(__s, (x, j) -> CASE
        WHEN j > 0 AND x.g = try_element_at(__s, j).g THEN x.i
        WHEN x.g = try_element_at(__s, j + 2).g THEN x.i END), x -> x IS NOT NULL))""")
    df = df.withColumn("__p", F.when(F.col("__s").isNotNull(), near))
    covered = F.expr(f"aggregate(transform(__p, (x, j) -> CASE WHEN j + 1 < size(__p) THEN least({window}, __p[j + 1] - x) ELSE {window} END), 0L, (a, x) -> a + x)")
    counts = {
        "n_words": F.size("__w"),
        "word_chars": F.length(F.translate("__t", SPACES, "")),
        "n_symbols": _count(F.col("__t"), SYMBOLS),
        "n_lines": F.size("__l"),
        "n_dup_lines": F.size("__l") - F.size(F.array_distinct("__l")),
        "n_repeat_words": F.coalesce(covered, F.lit(0)),
        "n_distinct": F.size(F.array_distinct("__w")),
        "n_capitals": F.length("__t") - F.length(F.regexp_replace("__t", r"\p{Lu}+", "")),
        "n_marks": _count(F.col("__t"), "!?"),
    }
    # a generator, since a filter on a count pushed below a projection would work the count out again, many times over
    out = F.inline(F.array(F.struct(*[c.cast("long").alias(n) for n, c in counts.items()])))
    return df.select(*[c for c in own if c not in counts], out)


def base_failed(least_words: int = 10, most_repeats: int = 20) -> Column:
    return (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > most_repeats * F.col("n_words"))


def _binomial_tail(k: str, n: str, p: float) -> Column:
    """P(X <= k) for X ~ Binomial(n, p), 1 where k is not below the mean; exact sums in log space."""
    log_pmf = f"aggregate(sequence(1L, greatest({k}, 1L)), 0D, (a, i) -> a + CASE WHEN i <= {k} THEN ln(({n} - i + 1) / i) ELSE 0D END) + {k} * ln({p}D) + ({n} - {k}) * ln(1 - {p}D)"
    ratio = f"""aggregate(sequence(0L, greatest({k} - 1, 0L)), named_struct('t', 1D, 's', 1D), (a, i) -> named_struct(
        't', CASE WHEN i < {k} THEN a.t * ({k} - i) / ({n} - {k} + i + 1) * (1 - {p}D) / {p}D ELSE 0D END,
        's', a.s + CASE WHEN i < {k} THEN a.t * ({k} - i) / ({n} - {k} + i + 1) * (1 - {p}D) / {p}D ELSE 0D END), a -> a.s)"""
    return F.expr(f"CASE WHEN {n} > 0 AND {k} < {p}D * {n} THEN least(1D, exp({log_pmf}) * {ratio}) ELSE 1D END")


def _scores() -> Column:
    return F.map_from_arrays(F.array(*map(F.lit, RULES)), F.array(*[F.expr(e) for e in RULES.values()]))


def _side(df: DataFrame, rows: int = 10_000) -> DataFrame:
    """A table with a row per stratum as the side of a join: broadcast if it proves to be small."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def plans(scored: DataFrame, cost: int) -> DataFrame:
    """(stratum, plan): rules with their cutoffs, the one with the greatest gain on the planning half first.

    The gain of a cutoff is the bad texts that it rejects less ``cost`` times the good ones; a rule takes its most lenient
    cutoff of greatest gain, and is left out without a gain.
    """
    over = lambda r, c, q: F.count_if((F.col("scores")[r] > c) & (F.col("good") == q))
    counts = scored.where("planning").groupBy("stratum").agg(*[F.array(*[F.struct((over(r, c, False) - cost * over(r, c, True)).alias("gain"), F.lit(c).alias("cut")) for c in STEPS]).alias(r) for r in RULES])
    # steps go from lenient to strict, so the greater cutoff of equal gains is the more lenient one
    best = F.array(*[F.struct((-F.array_max(r)["gain"]).alias("loss"), F.lit(r).alias("rule"), F.array_max(r)["cut"].alias("cut")) for r in RULES])
    return counts.select("stratum", F.sort_array(F.filter(best, lambda x: x["loss"] < 0)).alias("plan"))


def cutoffs(featured: DataFrame, labels: DataFrame, stratum: str = "lang", id_col: str = "doc_id", risk: float = 0.05, delta: float = 0.05, cost: int = 20) -> DataFrame:
    """Certified cutoffs: stratum, ``cuts`` map of rule -> cutoff, for strata with any.

    ``featured`` are texts with their counts, best stored, of which the counts alone are read; ``labels`` has the id and
    ``quality`` (1 good, 0 bad).
    """
    truth = labels.where("quality IS NOT NULL").groupBy(id_col).agg((F.min("quality") == 1).alias("good"))
    held = featured.where("NOT (" + _BASE + ")").select(F.col(id_col).alias("id"), F.col(stratum).alias("stratum"), _scores().alias("scores")).join(truth.withColumnRenamed(id_col, "id"), "id")
    scored = cut_lineage(held.select("stratum", "good", "scores", (F.pmod(F.xxhash64("id"), F.lit(2)) == 0).alias("planning")))
    plan = cut_lineage(plans(scored, cost).withColumnRenamed("stratum", "of"))
    strata = scored.select("stratum").distinct().count()
    rest = scored.where("NOT planning AND good")
    planned = rest.join(_side(plan), F.col("stratum").eqNullSafe(F.col("of")))
    first = F.array_position(F.transform("plan", lambda x: F.element_at("scores", x["rule"]) > x["cut"]), True)
    steps = len(RULES)
    lost = planned.select("of", "plan", first.alias("first")).groupBy("of").agg(F.any_value("plan").alias("plan"), F.count("*").alias("n"), F.array(*[F.count_if(F.col("first").between(1, m)) for m in range(1, steps + 1)]).alias("lost"))
    tests = lost.select("of", "plan", "n", F.posexplode("lost").alias("m", "k")).where("m < size(plan)").withColumn("fails", _binomial_tail("k", "n", risk) > delta / max(1, strata))
    failed = F.min(F.when(F.col("fails"), F.col("m")))
    certified = tests.groupBy("of").agg(F.any_value("plan").alias("plan"), F.coalesce(failed, F.max("m") + 1).alias("m")).where("m > 0")
    return certified.select(F.col("of").alias("stratum"), F.map_from_entries(F.transform(F.slice("plan", F.lit(1), F.col("m")), lambda x: F.struct(x["rule"], x["cut"]))).alias("cuts"))


_BASE = "n_words < 10 OR 100 * n_repeat_words > 20 * n_words"


def judge(featured: DataFrame, cuts: DataFrame, stratum: str = "lang") -> DataFrame:
    """Add ``base_failed``, ``rejected_by`` (array of rules) and ``kept``."""
    over = F.array_compact(F.array(*[F.when(F.expr(e) > F.element_at("__cuts", r), F.lit(r)) for r, e in RULES.items()]))
    cuts = cut_lineage(cuts.select(F.col("stratum").alias("__stratum"), F.col("cuts").alias("__cuts")))
    df = featured.join(_side(cuts), F.col(stratum).eqNullSafe(F.col("__stratum")), "left")
    df = df.withColumn("base_failed", base_failed()).withColumn("rejected_by", F.coalesce(over, F.array().cast("array<string>")))
    return df.withColumn("kept", ~F.col("base_failed") & (F.size("rejected_by") == 0)).drop("__stratum", "__cuts")
