"""De-duplication with a declared winner."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.numeric import ladder


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def distinct_report(df: DataFrame) -> DataFrame:
    """Rows before, rows after and rows removed.

    Rows are grouped by 128 bits of hash and the places of their nulls, so that wide or long rows are not shuffled whole.
    """
    gaps = F.concat_ws("", *[F.col(c).isNull().cast("string") for c in df.columns])
    keys = [F.xxhash64(gaps, *df.columns).alias("_a"), F.xxhash64(F.lit("second"), *df.columns, gaps).alias("_b")]
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows_before"),
        F.count(F.lit(1)).alias("rows_after"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("rows_removed"),
    )


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row per key under ``order``.

    The rank filter lets Spark keep one row per key and task before the shuffle, so a key
    with very many copies does not travel whole.
    """
    ranked = df.withColumn("_rn", F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("_rn") == 1).drop("_rn")


def duplicate_groups(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def keep_by_priority(
    df: DataFrame, keys: Sequence[str], kind: str, preferred: Sequence[str], then: Sequence[Column],
) -> DataFrame:
    """Only rows of a preferred kind; earlier in the list wins, then the given order."""
    rank = ladder([(F.col(kind) == v, i) for i, v in enumerate(preferred, 1)], len(preferred) + 1)
    return keep_first(df.filter(F.col(kind).isin(*preferred)), keys, [rank, *then])
