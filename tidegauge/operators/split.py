"""Sampling, splits and class balance. Draws come from a hash of the key, so they repeat."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.numeric import ladder
from ..functions.text import hash_unit
from .skew import attach


def bernoulli(df: DataFrame, key: str, fraction: float, seed: int = 0) -> DataFrame:
    return df.filter(hash_unit(F.col(key), seed=seed) < fraction)


def stratified(df: DataFrame, key: str, label: str, fractions: Mapping[object, float], seed: int = 0) -> DataFrame:
    wanted = ladder([(F.col(label) == v, f) for v, f in fractions.items()], 0.0)
    return df.filter(hash_unit(F.col(key), seed=seed) < wanted)


def exact_per_class(df: DataFrame, key: str, label: str, n: int, seed: int = 0) -> DataFrame:
    """Exactly ``n`` rows of each class, or all of a class that has fewer."""
    order = W.partitionBy(label).orderBy("_u", key)
    ranked = df.withColumn("_u", hash_unit(F.col(key), seed=seed)).withColumn("_rn", F.row_number().over(order))
    return ranked.filter(F.col("_rn") <= n).drop("_u", "_rn")


def undersample(df: DataFrame, key: str, label: str, positive_share: float, seed: int = 0) -> DataFrame:
    """Thin the zeros until ones make up about ``positive_share``; all ones stay."""
    counts = df.agg(
        F.count(F.when(F.col(label) == 1, 1)).alias("pos"), F.count(F.when(F.col(label) == 0, 1)).alias("neg")
    ).first()
    wanted = counts["pos"] * (1 - positive_share) / positive_share
    if not counts["pos"] or not counts["neg"] or wanted >= counts["neg"]:
        return df
    return df.filter((F.col(label) == 1) | (hash_unit(F.col(key), seed=seed) < wanted / counts["neg"]))


def hash_split(df: DataFrame, key: str, shares: Mapping[str, float], seed: int = 0) -> DataFrame:
    """Add ``split``: names in order take consecutive slices of [0, 1)."""
    u, edge, steps = hash_unit(F.col(key), seed=seed), 0.0, []
    for name, share in shares.items():
        edge += share
        steps.append((u < edge, name))
    return df.withColumn("split", ladder(steps[:-1], steps[-1][1]))


def fold(df: DataFrame, key: str, k: int, seed: int = 0) -> DataFrame:
    return df.withColumn("fold", F.floor(hash_unit(F.col(key), seed=seed) * k).cast("int"))


def time_split(df: DataFrame, when: Column, valid_from: str, test_from: str) -> DataFrame:
    return df.withColumn(
        "split", ladder([(when < F.lit(valid_from).cast("timestamp_ntz"), "train"),
                         (when < F.lit(test_from).cast("timestamp_ntz"), "valid")], "test"),
    )


def expanding_folds(df: DataFrame, when: Column, edges: Sequence[str]) -> list[tuple[DataFrame, DataFrame]]:
    """Fold i trains on everything before edge i and validates up to edge i + 1."""
    at = [F.lit(e).cast("timestamp_ntz") for e in edges]
    return [
        (df.filter(when < at[i]), df.filter((when >= at[i]) & (when < at[i + 1]))) for i in range(len(at) - 1)
    ]


def split_ranges(df: DataFrame, when: str, split: str = "split") -> DataFrame:
    """Rows and time range of each split, and whether it starts after the one before it ended."""
    ranges = df.groupBy(split).agg(
        F.count(F.lit(1)).alias("n"), F.min(when).alias("first"), F.max(when).alias("last")
    )
    by_time = W.orderBy("first")  # one row per split
    before = F.lag("last").over(by_time)
    return ranges.withColumn("overlaps", F.coalesce(F.col("first") <= before, F.lit(False)).cast("int"))


def class_weights(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    """Balanced weights n / (classes * n_class) as a column, for any number of classes; null labels have none."""
    counts = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    whole = counts.agg(F.sum("_n").alias("n"), F.count(F.lit(1)).alias("k")).first()  # one row
    weights = counts.select(label, (F.lit(float(whole["n"] or 0)) / (F.lit(whole["k"]) * F.col("_n"))).alias(name))
    return attach(df, weights, [label])


def draw(df: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """``n`` rows in hash order."""
    return df.orderBy(hash_unit(F.col(key), seed=seed), key).limit(n)
