"""From raw documents to packed training sequences, in four stages.

Each stage takes what the one before it kept, written as Parquet and read again.
All but the last return the columns of the documents, whatever their names.

In every stage a null text counts as empty and stays null, texts of any length are read
whole, and an empty table gives an empty one. Rows given several times are judged alike;
of those with words near-copy removal keeps one, of those without words one per doc_id. Of a group of
near copies the row with the least doc_id stays, of several such rows that with the least key of
doc_id and text. A null doc_id stays null.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadledger.llm import near_dedup, packing, quality, secret_scan
from loadledger.llm.queries import TOKENIZER
from loadledger.llm.tables import stage, table


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from the labelled ones among them."""
    model = quality.learn(docs, table(spark, sf_dir, "labels"))
    return quality.accepted(docs, model)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five words, a similarity of 0.8 or more."""
    return near_dedup.without_near_copies(docs)


def redacted_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their secrets replaced."""
    clean = secret_scan.without_secrets(docs, secret_scan.learn(docs))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        clean = clean.withColumn("n_chars", F.length("text").cast(kind))
    return clean


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents that are left, placed in sequences of 2048 tokens."""
    return packing.pack_documents(docs, public_tokenizers.path(TOKENIZER))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", good_documents),
    ("near_dedup", distinct_documents),
    ("secret_scan", redacted_documents),
    ("best_fit_packing", packed_sequences),
]

# Scores, signatures and sequences are not within reach of SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
    return docs
