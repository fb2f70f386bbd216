"""The text operators bound to the test tables, with the SQL that checks them where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import (
    centroid_clusters,
    decontaminate,
    fingerprints,
    language_id,
    masked_lm,
    near_dup,
    packing,
    quality_classifier,
    quality_rules,
    spelling,
    sql,
    token_count,
    toxicity,
    url_filter,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

#: Special strings of byte_bpe_50k; they are recognised inside texts, as the library does by default.
BYTE_BPE_SPECIAL = {"<|endoftext|>": 50256}


def query(name: str, sql: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


@query("op1_language_id")
def op1_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language_id.identify_held_out(table(spark, folder, "documents"))


@query("op7_token_counts")
def op7_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_count.count_tokens(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def pack_documents(docs: DataFrame) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, BYTE_BPE_SPECIAL)


@query("op10_packing")
def op10_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack_documents(table(spark, folder, "documents"))


@query("op2_quality_rules")
def op2_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.verdicts(table(spark, folder, "documents"))


#: (allowed, host, path)
URL_RULES = [(True, "org", "/"), (False, "example.org", "/es/"), (False, "example.org", "/en/1"), (True, "com", "/fr/"), (False, "com", "/de/")]


@query("op5_url_filter")
def op5_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    labelled = spark.createDataFrame(url_filter.LABELLED, "url string, blocked int")
    return url_filter.verdicts(table(spark, folder, "pages"), URL_RULES, labelled)


@query("op8_toxicity")
def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.score_held_out(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op9_quality_classifier")
def op9_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return quality_classifier.score_held_out(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op3_near_duplicates")
def op3_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, folder, "documents"), size=2)


@query("op6_decontamination")
def op6_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.find(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op4_masked_lm")
def op4_masked_lm(spark: SparkSession, folder: str) -> DataFrame:
    return masked_lm.score_corpus(table(spark, folder, "documents"))


@query("op11_spelling_variants", sql.SPELLING)
def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(table(spark, folder, "documents"))


@query("op12_fingerprints", sql.FINGERPRINTS)
def op12_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.fingerprint(table(spark, folder, "documents"))


@query("op13_centroid_clusters", sql.CENTROIDS)
def op13_centroid_clusters(spark: SparkSession, folder: str) -> DataFrame:
    return centroid_clusters.cluster(table(spark, folder, "embeddings"))
