"""Set operations and overlap."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import ratio


def all_ids(df: DataFrame, *columns: str, name: str = "id") -> DataFrame:
    """Distinct values of several id columns together."""
    return df.select(F.explode(F.array(*columns)).alias(name)).filter(F.col(name).isNotNull()).distinct()


def only_in_first(a: DataFrame, b: DataFrame, on: str) -> DataFrame:
    return a.select(on).distinct().join(b.select(on).distinct(), on, "left_anti")


def overlap(a: DataFrame, b: DataFrame, on: str) -> DataFrame:
    """One row: size of the first list, shared entries and their share in percent."""
    first = a.select(on).distinct()
    hit = first.join(b.select(on).distinct().withColumn("_hit", F.lit(1)), on, "left")
    return hit.agg(
        F.count(F.lit(1)).alias("n_first"), F.count("_hit").alias("n_shared"),
        F.round(100 * ratio(F.count("_hit"), F.count(F.lit(1))), 6).alias("overlap_pct"),
    )
