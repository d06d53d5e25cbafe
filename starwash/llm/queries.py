"""One registered query per operator, over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starwash.llm import (decontaminate, fingerprint, html_text, line_dedup, mixing, near_dedup, packing, pii, quality, resample, spelling,
                          toxicity, url_filter)
from starwash.llm.common import id_fold, table


def tokenizer_file(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), toxicity.training_rows())
    return toxicity.score(docs.select("doc_id", "text"), model).select(
        "doc_id", F.coalesce(id_fold("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "score", "predicted")


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.detect(docs, pii.train(docs)).select("doc_id", "base", "spans")
    counts = [F.size(F.filter("base", lambda s: s["kind"] == 0)), F.size(F.filter("base", lambda s: s["kind"] == 1)),
              F.size(F.filter("base", lambda s: s["kind"] == 2)), F.size(F.filter("base", lambda s: s["kind"] == 3))]
    return found.select("doc_id", *[n.cast("long").alias(f"n_{k}") for k, n in zip(pii.KINDS, counts)],
                        F.sha2(pii.spans_text("base"), 256).alias("base_sha256"), pii.spans_text("spans").alias("spans"))


#: (verdict, host, path); a rule fits its host and all subdomains, and paths that start with its path
URL_RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge(pages, url_filter.rule_table(spark, URL_RULES)).select("page_id", "host", "path", "rule", "verdict")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_file(), tokenizer_file("byte_bpe_50k.tiktoken"))


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"), quality.training_rows())
    return quality.score(docs.select("doc_id", "text"), model).select(
        "doc_id", F.coalesce(id_fold("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "score", "predicted")


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_text.main_text(pages, html_text.train(pages)).select("page_id", "url", "text", "n_chars")


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.mark(docs, table(spark, sf_dir, "benchmark")).select(
        "doc_id", "n_words", "n_hit", "n_items",
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op9_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprints(table(spark, sf_dir, "documents"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs).select("doc_id", "text", "n_lines", "n_removed")


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return spelling.spelling_variants(docs, typo_every=97)


def op12_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return resample.resample(docs, table(spark, sf_dir, "benchmark")).select("doc_id", "n_features", "weight", "score", "rank")


#: weights of the sources in code-point order, repeating
MIX_WEIGHTS = (5, 2, 1)


def op13_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.mix(table(spark, sf_dir, "documents"), MIX_WEIGHTS)
    return plan.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_pii": op2_pii,
    "op3_url_filter": op3_url_filter,
    "op4_packing": op4_packing,
    "op5_near_dedup": op5_near_dedup,
    "op6_quality": op6_quality,
    "op7_html_text": op7_html_text,
    "op8_decontaminate": op8_decontaminate,
    "op9_fingerprint": op9_fingerprint,
    "op10_line_dedup": op10_line_dedup,
    "op11_spelling": op11_spelling,
    "op12_resample": op12_resample,
    "op13_mixing": op13_mixing,
}
