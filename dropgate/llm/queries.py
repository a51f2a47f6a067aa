"""One query for each operator over its whole table, and the SQL that checks it where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, hard_negatives, html_extract, jaccard_join, language_id, packing, periodic_runs, pii, quality_rules, secret_scan, token_counts, topk_search, warc
from .common import table
from .sql import ORACLES  # noqa: F401


def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, verbatim or re-parameterised, with the item."""
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata and conversion records of every page."""
    return warc.derive(warc.responses(table(spark, sf_dir, "pages")))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from four of five folds."""
    return language_id.by_fold(table(spark, sf_dir, "documents"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and risk-controlled rules on every document."""
    return quality_rules.apply(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents linked by 3-word shingles at Jaccard similarity 0.9 or more."""
    return jaccard_join.groups(table(spark, sf_dir, "documents"), 3, 90)


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in a sequence of 512 to 8192 words and separators."""
    return packing.packed(packing.by_words(table(spark, sf_dir, "documents")), "n_tokens")


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document."""
    return secret_scan.report(table(spark, sf_dir, "documents"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document before and after redacting mail addresses and long numbers."""
    return token_counts.counts(token_counts.redactions(table(spark, sf_dir, "documents"))).drop("tree_tokens", "tree_chars")


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    return pii.report(table(spark, sf_dir, "documents"))


def op11_exact_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 best rows for every row whose vec_id is divisible by 50."""
    return topk_search.search(table(spark, sf_dir, "embeddings"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words in every document; every tenth one repeats a stretch."""
    return periodic_runs.report(periodic_runs.find(table(spark, sf_dir, "documents"), periodic_runs.planted))


def op13_hard_negative_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every anchor's positives; every seventh row has the next label."""
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"), moved)


QUERIES = {
    f.__name__: f
    for f in (
        op1_benchmark_decontamination, op2_warc, op3_language_id, op4_quality_rules, op5_ngram_jaccard_join, op6_best_fit_packing,
        op7_html_extraction, op8_secret_scan, op9_token_counts, op10_pii, op11_exact_topk_search, op12_periodic_runs, op13_hard_negative_mining,
    )
}
