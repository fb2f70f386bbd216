"""From raw documents to packed training sequences: five stages, each reading what the one before wrote.

Each stage is a function of (session, documents, folder of the tables). The first four return the documents they keep, with the
columns they came with; the last returns the pieces of the packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidegauge.llm import decontaminate, near_dup, quality_classifier, quality_rules
from tidegauge.llm.common import stored
from tidegauge.llm.queries import pack_documents, table


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality_classifier.keep_good(docs, table(spark, sf_dir, "labels"))


def within_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules of their language and source."""
    return quality_rules.keep_good(docs)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares four fifths of its five-word shingles."""
    return near_dup.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark item."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2048 tokens."""
    return pack_documents(docs)


STAGES = [
    ("quality_classifier", good_quality),
    ("quality_rules", within_rules),
    ("near_duplicates", without_near_duplicates),
    ("decontamination", without_benchmark),
    ("packing", packed),
]

#: SQL has no factorisation machine, MinHash or tokeniser; tests/llm compares single operators with brute force, not yet all five stages together.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
