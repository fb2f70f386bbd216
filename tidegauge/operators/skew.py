"""Splitting hot keys.

A key with more rows than a task should hold is hot. Joins with per-key tables leave the splitting to adaptive
execution; entities that are walked in time order are cut into cells.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

ROWS_PER_TASK = 2_000_000
MAX_CUT = 100_000
CELL = "_cell"


def same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Null-safe equality on ``keys``; ``right`` carries them with a ``_r_`` prefix."""
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right["_r_" + k]) for k in keys])


def prefixed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.withColumnsRenamed({k: "_r_" + k for k in keys})


def cut_in_time(df: DataFrame, keys: Sequence[str], time: str, limit: int = ROWS_PER_TASK) -> tuple[DataFrame, bool]:
    """Add a time cell: 0 for ordinary keys, as many cells as needed for keys above ``limit`` rows.

    Returns the table and whether any key was cut; a cut table is written once, as its users read it several
    times. A narrow, map-side combined count finds the hot keys. The ``MAX_CUT`` largest are cut,
    which bounds the broadcast; with N rows every other key has fewer than N / MAX_CUT.
    """
    whole = df.withColumn(CELL, F.lit(0).cast("long"))
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.min(time).alias("_lo"), F.max(time).alias("_hi"))
    pieces = F.ceil(F.col("_n") / F.lit(limit))
    width = F.greatest(F.ceil((F.col("_hi") - F.col("_lo") + 1) / pieces), F.lit(1))
    large = per_key.filter(F.col("_n") > limit).orderBy(F.desc("_n"), *keys).limit(MAX_CUT)
    hot = cut_lineage(large.select(*keys, "_lo", width.alias("_width")))
    if hot.isEmpty():
        return whole, False
    right = prefixed(hot, keys)
    out = df.join(F.broadcast(right), same_keys(df, right, keys), "left")
    cell = F.coalesce(F.floor((F.col(time) - F.col("_lo")) / F.col("_width")).cast("long"), F.lit(0))
    return cut_lineage(out.select(*df.columns, cell.alias(CELL))), True


def attach(df: DataFrame, stats: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join of a table with one row per key.

    The table is written first, so both sides come from shuffles of their own and adaptive execution can split
    whatever partition of ``df`` is too large: of a hot key, of null keys, of keys the table doesn't know. An aggregate
    joined directly would have to share the partitioning of ``df``, and nothing could be split.
    """
    right = prefixed(cut_lineage(stats), keys)
    return df.join(right, same_keys(df, right, keys), "left").select(*df.columns, *[c for c in stats.columns if c not in keys])
