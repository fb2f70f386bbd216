"""Encoders fitted on training rows and applied to others."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import ratio
from .skew import attach


def fit_target_encoding(train: DataFrame, column: str, label: str, k: float = 100.0) -> tuple[DataFrame, float]:
    """Smoothed mean per category, and the overall mean for unseen and null categories."""
    overall = train.agg(F.avg(F.col(label).cast("double"))).first()[0]
    stats = train.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"), F.avg(F.col(label).cast("double")).alias("m"))
    smoothed = (F.col("m") * F.col("n") + F.lit(overall * k)) / (F.col("n") + F.lit(k))
    return stats.select(column, "n", smoothed.alias(column + "_te")), overall


def apply_target_encoding(df: DataFrame, column: str, table: DataFrame, overall: float) -> DataFrame:
    """Null and unseen categories match nothing and get the overall mean."""
    out = attach(df, table.drop("n"), [column])
    return out.withColumn(column + "_te", F.coalesce(column + "_te", F.lit(overall)))


def target_encode(train: DataFrame, other: DataFrame, columns: Sequence[str], label: str, k: float = 100.0) -> DataFrame:
    """Encode ``other`` with statistics of ``train`` only."""
    out = other
    for c in columns:
        table, overall = fit_target_encoding(train, c, label, k)
        out = apply_target_encoding(out, c, table, overall)
    return out


def frequency_encode(df: DataFrame, column: str) -> DataFrame:
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias(column + "_n"))
    return attach(df, counts, [column])


def capped_history(
    df: DataFrame, keys: Sequence[str], split: str, label: str, smoothing: float = 0.0,
) -> DataFrame:
    """Rate and volume of the entity's training rows only, attached to every row.

    Rows of other splits see the training history and nothing of each other.
    """
    hist = df.filter(F.col(split) == "train").groupBy(*keys).agg(
        F.count(F.lit(1)).alias("hist_n"), F.sum(F.col(label).cast("long")).alias("_p"))
    out = attach(df, hist, keys)
    rate = ratio(F.col("_p") + F.lit(smoothing / 2), F.col("hist_n") + F.lit(smoothing))
    return out.withColumn("hist_n", F.coalesce("hist_n", F.lit(0))).withColumn("hist_rate", rate).drop("_p")
