"""The corpus pipeline: documents through five of the operators, each stage written as Parquet and read again.

Defined results: documents with a null or empty text fail the base quality rules (fewer than 20 words) and go.  Of documents that are near copies the
smallest doc_id stays, one without an id last, of equal ids the smallest hash of the text; of a repeated row one.  Rows are told apart by id and text, so
rows with the same or no id are judged each; a null lang is a stratum of its own; sources and n_chars may be null, n_chars is the length of the text that is left.
Empty tables give empty results; columns beyond those of documents are dropped, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dropgate.llm import decontaminate, jaccard_join, packing, quality_rules, secret_scan
from dropgate.llm.common import DOCUMENT_COLUMNS, discard, scratch, store, table

#: near duplicates: word n-grams and per cent of Jaccard similarity
NEAR_WORDS, NEAR_PERCENT = 5, 80


def filter_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail no quality rule stay; rows with the same id and text are judged alike."""
    return quality_rules.accepted(docs.select(*DOCUMENT_COLUMNS), table(spark, sf_dir, "labels"))


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates one row stays, that with the smallest doc_id; documents without words all stay."""
    return jaccard_join.first_of_each(docs.select(*DOCUMENT_COLUMNS), NEAR_WORDS, NEAR_PERCENT)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark")).select(*DOCUMENT_COLUMNS)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts give way to a mark; n_chars follows."""
    clean = secret_scan.redact(docs.select(*DOCUMENT_COLUMNS))
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where every document lies in the sequences."""
    return packing.packed(packing.by_words(docs), "n_tokens")


STAGES = [
    ("quality rules", filter_quality),
    ("n-gram Jaccard join", deduplicate),
    ("benchmark decontamination", remove_benchmark),
    ("secret scans", redact_secrets),
    ("best-fit packing", pack),
]

#: connected components and packing have no SQL; the tests hold the rows against a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``.

    A stage's scratch tables and its input go once its result is written; the scratch tables of the last one stay for its reader.
    """
    docs = table(spark, sf_dir, "documents").select(*DOCUMENT_COLUMNS)
    for at, (_, stage) in enumerate(STAGES[:-1]):
        with scratch(spark) as keep:
            out = keep(store(stage(spark, docs, sf_dir), f"stage{at}"))
        discard(docs)
        docs = out
    out = STAGES[-1][1](spark, docs, sf_dir)
    discard(docs)
    return out
