"""From documents to packed training sequences in five stages.

A stage is ``(name, function)``; the function takes ``(spark, docs, sf_dir)`` and
returns what it keeps. All but the last return the columns of ``documents``; the
last returns pieces of packed sequences. Each works on whole texts and on every
row that its predecessor kept.

Nulls: a null text is judged, compared and packed as an empty text; a null
``doc_id`` is an id of its own kind, smaller than others in the exact stage and
never preferred in the near-duplicate stage. Extra columns pass through, whatever
their names. An empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from savormap.llm import exact, near, pack, pii, quality
from savormap.llm.common import documents, prepared
from savormap.storage import cut_lineage


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the quality classifier rejects."""
    spark = prepared(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.accepted(docs, quality.trained(documents(spark, sf_dir), labels))


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one of equal texts, the one with the largest id."""
    prepared(spark)
    return exact.without_copies(docs)


def different_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each class of near-duplicates, the one with the smallest id."""
    prepared(spark)
    return near.without_near_copies(docs)


def redacted_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by its kind."""
    prepared(spark)
    return pii.redact(docs)


def packed_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut documents into sequences whose lengths are powers of two."""
    prepared(spark)
    return pack.pack(docs)


STAGES = [
    ("quality_classifier", good_documents),
    ("exact_dedup", distinct_documents),
    ("minhash_near_dedup", different_documents),
    ("pii", redacted_documents),
    ("packing", packed_pieces),
]

#: The classifier and the tokenizer can't be said in SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; what a stage returns is stored and read by the next."""
    docs = documents(spark, sf_dir)
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
