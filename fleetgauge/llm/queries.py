"""The operators over the given tables: ``name -> f(spark, folder)``, and SQL where it can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetgauge.llm import (
    decontaminate,
    embedding_whitening,
    exact_dedup,
    hard_negatives,
    html_main_text,
    language_id,
    link_trust,
    mixing,
    quality_rules,
    secret_scan,
    simhash_anchor,
    suffix_dedup,
    toxicity,
)
from fleetgauge.llm.common import ship_package

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_main_text(spark: SparkSession, folder: str) -> DataFrame:
    ship_package(spark)
    pages = html_main_text.extract_text(table(spark, folder, "pages"))
    return pages.select("page_id", "url", "text", "n_chars")


def op2_link_trust(spark: SparkSession, folder: str) -> DataFrame:
    pages = link_trust.judge_urls(table(spark, folder, "pages"))
    return pages.select("page_id", "host", "path", "rule", "verdict")


def op3_language_id(spark: SparkSession, folder: str) -> DataFrame:
    ship_package(spark)
    docs = table(spark, folder, "documents")
    return language_id.identify(docs, language_id.train(docs))


def op4_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = secret_scan.scan_secrets(table(spark, folder, "documents").select("doc_id", "text"))
    count = lambda rank: F.size(F.filter(
        "secrets", lambda s: s["rank"] == rank)).cast("long")
    base = F.filter("secrets", lambda s: s["rank"] < 3)
    return found.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(secret_scan.spans_text(base), 256).alias("base_sha256"),
        secret_scan.spans_text(F.col("secrets")).alias("spans"))


def op5_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality_rules.judge_quality(
        table(spark, folder, "documents"), table(spark, folder, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                         "n_repeat_words", "base_failed", "kept", "ratio")


def op6_simhash(spark: SparkSession, folder: str) -> DataFrame:
    ship_package(spark)
    found = simhash_anchor.near_duplicates(table(spark, folder, "documents"))
    return found.withColumn("fingerprint", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")))


def op7_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.find_contamination(
        table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    ids = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"), "contaminated")


def op8_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    ship_package(spark)
    return suffix_dedup.digest(suffix_dedup.remove_repeats(table(spark, folder, "documents")))


def op9_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix_copies(table(spark, folder, "documents").select("doc_id", "text", "source"))
    return mixed.select("doc_id", "size", "source_size", "target",
                        (F.col("size") * F.col("copies")).alias("taken"))


def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    ship_package(spark)
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    scored = toxicity.score_toxicity(docs.select("doc_id", "text"), toxicity.train(docs, labels))
    return scored.select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op11_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, folder, "documents"))


def op12_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return embedding_whitening.whiten(table(spark, folder, "embeddings"))


def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, folder, "embeddings").withColumn("label", shifted)
    return hard_negatives.mine_negatives(rows, F.col("vec_id") % 100 == 0)


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_main_text, op2_link_trust, op3_language_id, op4_secret_scan, op5_quality_rules, op6_simhash,
    op7_decontaminate, op8_suffix_dedup, op9_mix_sources, op10_toxicity, op11_exact_dedup,
    op12_whitening, op13_hard_negatives)}
