"""From documents to packed training sequences: quality, copies, near copies, secrets, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stationfield.llm import exact_dedup, ngram_join, packing, quality, secret_scan
from stationfield.llm.common import stored, table


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that the line model rejects."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def first_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that is equal but for white space."""
    return exact_dedup.drop_copies(docs)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near copies."""
    return ngram_join.keep_first(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked."""
    return secret_scan.redact_secrets(docs)


def packed_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document's ids lies in the sequences."""
    return packing.pack(docs)


STAGES = [
    ("quality_classifier", good_documents),
    ("exact_dedup", first_copies),
    ("ngram_jaccard_join", distinct_documents),
    ("secret_scan", without_secrets),
    ("packing", packed_pieces),
]

# Stages 1, 3 and 5 (a trained model, near copies, a tokenizer) have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
