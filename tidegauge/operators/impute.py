"""Filling missing values without looking ahead."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Imputer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import Stat, rolling
from .joins import aggregate_back
from .quantiles import exact_quantiles


def medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    """Exact medians of all columns."""
    found = exact_quantiles(df, {f"c{i}": (c, 0.5) for i, c in enumerate(columns)})
    return {c: found[f"c{i}"] for i, c in enumerate(columns)}


def median_fill(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    known = {c: m for c, m in medians(df, columns).items() if m is not None}
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(m).cast(df.schema[c].dataType)) for c, m in known.items()}) if known else df


def three_tier(
    df: DataFrame, keys: Sequence[str], time: str, columns: Sequence[str], lookback: int,
) -> DataFrame:
    """Own value, else mean of the last ``lookback`` units of the same key, else overall median."""
    stats = {"_roll_" + c: Stat("avg", F.col(c).cast("double")) for c in columns}
    tier3 = medians(df, columns)
    out = rolling(df, keys, time, lookback, 0, stats)
    filled = {c: F.coalesce(F.col(c), F.col("_roll_" + c), F.lit(tier3[c])) for c in columns}
    return out.withColumns(filled).drop(*stats)


def unknown_fill(df: DataFrame, columns: Sequence[str], value: str = "UNK") -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit(value)) for c in columns})


def modes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Most frequent non-null value per column (ties: smallest value) as text."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    counts = (
        df.select(F.inline(pairs)).filter(F.col("value").isNotNull())
        .groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    )
    return counts.groupBy("column").agg(F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("value"))


def mode_fill(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    types = dict(df.dtypes)
    best = {r["column"]: r["value"] for r in modes(df, columns).collect()}
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v).cast(types[c])) for c, v in best.items()}) if best else df


def group_mean_fill(df: DataFrame, keys: Sequence[str], column: str, constant: float) -> DataFrame:
    """Own value, else mean of the group, else a constant."""
    out = aggregate_back(df, keys, {"_gm": F.avg(column)})
    return out.withColumn(column, F.coalesce(F.col(column), F.col("_gm"), F.lit(constant))).drop("_gm")


def first_event_fill(df: DataFrame, is_first: str, column: str) -> DataFrame:
    """Rows that open an entity's history take the mean over rows that do not."""
    mean = df.agg(F.avg(F.when(F.col(is_first) == 0, F.col(column)))).first()[0]
    return df.withColumn(column, F.when(F.col(is_first) == 1, F.lit(mean)).otherwise(F.col(column)))


def ml_impute(df: DataFrame, columns: Sequence[str], strategy: str = "median") -> DataFrame:
    outputs = [c + "_imputed" for c in columns]
    model = Imputer(strategy=strategy, inputCols=list(columns), outputCols=outputs, relativeError=1e-5).fit(df)
    return model.transform(df)
