"""The operators of this subpackage as registered queries on the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import bpe, chat, decontaminate, digest, jaccard, lines, phrases, pii, quality, resample, suffix_tree, vector_codes, warc
from millrace.runtime import cut_lineage, work_path

QUERIES: dict = {}
ORACLES: dict = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def stored(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """The rows as a written table in the shared folder: computed once, safe from lost executors."""
    path = work_path(df.sparkSession, name)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.parquet(path)


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


@query("op1_quality_rules")
def quality_rules(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    featured = cut_lineage(quality.features(docs).drop("text"))
    cuts = quality.cutoffs(featured, table(spark, sf, "labels"))
    judged = quality.judge(featured, cuts)
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rejected_by")


@query("op2_warc")
def warc_archives(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", "url", F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"))
    marked = warc.mark_revisits(pages, "page_id", "payload")
    rows = marked.select(_page_urn("page_id").alias("record_id"), F.col("url").alias("uri"), "payload", F.when(F.col("refers_to").isNotNull(), _page_urn("refers_to")).alias("refers_to"))
    folder = work_path(spark, "archives")
    paths = stored(warc.write(rows, folder), "archive_list")
    records = warc.read(paths, folder)
    number = lambda c: F.regexp_extract(c, r"^urn:page:(-?[0-9]+)$", 1)
    back = lambda c: F.when(number(c) != "", number(c).cast("long"))
    return records.select(back("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", back("refers_to").alias("refers_to"), "problem")


def _page_urn(c: str):
    return F.concat(F.lit("urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("null")))


OK = "</s>[INST] ok [/INST]"


@query("op3_chat_tree")
def chat_tree(spark, sf):
    rows = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.createDataFrame([(-1, 0, "user", OK), (-1, 1, "assistant", OK)], rows.schema)
    path = tokenizer_path("byte_bpe_50k.json")
    packs = stored(chat.pack(chat.conversations(rows.unionByName(added)), path), "packs")
    return chat.digests(packs, path)


@query("op4_repeated_phrases")
def repeated_phrases(spark, sf):
    out = phrases.remove(table(spark, sf, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op5_personal_data")
def personal_data(spark, sf):
    found = pii.find(table(spark, sf, "documents").select("doc_id", "text"))
    of = lambda kind: F.size(F.filter("entities", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    show = lambda xs: F.array_join(F.transform(xs, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    base = F.filter("entities", lambda x: x["kind"].isin(*pii.BASE))
    return found.select("doc_id", *[of(k) for k in pii.BASE], F.sha2(show(base), 256).alias("base_sha256"), show("entities").alias("spans"))


@query("op6_benchmark_overlap")
def benchmark_overlap(spark, sf):
    return decontaminate.overlaps(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query("op7_jaccard_join")
def jaccard_join(spark, sf):
    return jaccard.join(table(spark, sf, "documents").select("doc_id", "text"))


@query("op8_line_dedup")
def line_dedup(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return lines.dedup(docs).select("doc_id", "n_lines_deleted", "n_lines_left", F.sha2("text", 256).alias("text_sha256"), "text")


@query("op9_bpe")
def bpe_roundtrip(spark, sf):
    coded = bpe.encode(table(spark, sf, "documents").select("doc_id", "text"), tokenizer_path("word_bpe_49k.json"))
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op10_suffix_tree")
def suffix_tree_score(spark, sf):
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1
    return suffix_tree.score(table(spark, sf, "documents").select("doc_id", "text"), held_out)


@query("op11_vector_codes")
def product_codes(spark, sf):
    return vector_codes.encode(table(spark, sf, "embeddings").select("vec_id", "embedding", "label"))


@query("op12_digest")
def improbable_features(spark, sf):
    return digest.compare(table(spark, sf, "documents").select("doc_id", "text"))


@query("op13_resample")
def importance_resampling(spark, sf):
    return resample.draw(table(spark, sf, "documents").select("doc_id", "text"), table(spark, sf, "benchmark"))


def queries() -> dict:
    return dict(QUERIES)


def oracles() -> dict[str, str]:
    return dict(ORACLES)
