"""Column selection, type repair, validation and drops."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import finite_or, not_finite
from ..functions.text import blank_to_null

NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double")


def select_present(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    have = set(df.columns)
    return df.select([c for c in columns if c in have])


def columns_of_type(df: DataFrame, *types: str) -> list[str]:
    return [name for name, dtype in df.dtypes if dtype in types]


def cast_columns(df: DataFrame, plan: Mapping[str, Sequence[str]]) -> DataFrame:
    """type -> columns; a value that does not fit becomes null."""
    return df.withColumns({c: F.col(c).try_cast(t) for t, cols in plan.items() for c in cols if c in df.columns})


def blanks_to_null(df: DataFrame) -> DataFrame:
    return df.withColumns({c: blank_to_null(F.col(c)) for c in columns_of_type(df, "string")})


def finite_columns(df: DataFrame, value: float = 0.0) -> DataFrame:
    return df.withColumns({c: finite_or(F.col(c), value) for c in columns_of_type(df, "float", "double")})


def non_finite_counts(df: DataFrame) -> DataFrame:
    cols = columns_of_type(df, "float", "double")
    return to_long(df, cols, {"n_not_finite": lambda c: F.count(F.when(not_finite(c), F.lit(1)))})


def is_missing(df: DataFrame, column: str) -> Column:
    """Null, or NaN where the type has one."""
    col = F.col(column)
    return col.isNull() | F.isnan(col) if dict(df.dtypes)[column] in ("float", "double") else col.isNull()


def to_long(
    df: DataFrame, columns: Sequence[str], measures: Mapping[str, Callable[[Column], Column]],
    keys: Sequence[str] = (),
) -> DataFrame:
    """All measures of all columns in one aggregate, then one row per column.

    One pass over the data however many columns are profiled.
    """
    exprs = [m(F.col(c)).alias(f"{i}_{n}") for i, c in enumerate(columns) for n, m in measures.items()]
    wide = df.groupBy(*keys).agg(*exprs) if keys else df.agg(*exprs)
    rows = [
        F.struct(F.lit(c).alias("column"), *[F.col(f"{i}_{n}").alias(n) for n in measures])
        for i, c in enumerate(columns)
    ]
    return wide.select(*keys, F.inline(F.array(*rows)))


def require(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(columns))


def require_report(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Missing count per required column and the rows before and after the filter, one pass."""
    complete = F.lit(True)
    for c in columns:
        complete = complete & ~is_missing(df, c)
    named = {c: F.count(F.when(is_missing(df, c), F.lit(1))).alias("_m_" + c) for c in columns}
    wide = df.agg(
        F.count(F.lit(1)).alias("_before"), F.count(F.when(complete, F.lit(1))).alias("_after"), *named.values()
    )
    rows = [
        F.struct(F.lit(c).alias("column"), F.col("_m_" + c).alias("n_missing"),
                 F.col("_before").alias("rows_before"), F.col("_after").alias("rows_after"))
        for c in columns
    ]
    return wide.select(F.inline(F.array(*rows)))


def null_shares(df: DataFrame) -> dict[str, float]:
    """Share of missing values per column; one pass, one row to the driver."""
    cols = df.columns
    row = df.agg(*[F.avg(is_missing(df, c).cast("double")).alias(f"c{i}") for i, c in enumerate(cols)]).first()
    return {c: (row[i] or 0.0) for i, c in enumerate(cols)}


def drop_sparse(df: DataFrame, max_share: float, keep: Sequence[str] = ()) -> DataFrame:
    shares = null_shares(df)
    return df.drop(*[c for c, s in shares.items() if s > max_share and c not in keep])


def drop_leaky(df: DataFrame, explicit: Sequence[str] = (), keywords: Sequence[str] = ()) -> DataFrame:
    hit = [c for c in df.columns if c in explicit or any(k.lower() in c.lower() for k in keywords)]
    return df.drop(*hit)


def drop_by_suffix(df: DataFrame, *suffixes: str) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.endswith(suffixes)])


def strip_suffix(df: DataFrame, suffix: str) -> DataFrame:
    return df.withColumnsRenamed({c: c[: -len(suffix)] for c in df.columns if c.endswith(suffix)})


def top_values(df: DataFrame, column: str, n: int) -> list[str]:
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return [r[0] for r in counts.orderBy(F.desc("n"), column).limit(n).collect()]


def top_value_indicators(df: DataFrame, column: str, n: int) -> DataFrame:
    """One 0/1 column for each of the ``n`` most frequent values (ties by value)."""
    hits = {
        f"{column}_top{i}": F.coalesce((F.col(column) == v).cast("int"), F.lit(0))
        for i, v in enumerate(top_values(df, column, n), 1)
    }
    return df.withColumns(hits)


def zscore(df: DataFrame, columns: Sequence[str], suffix: str = "_z") -> DataFrame:
    """Standardise; constant columns are left out."""
    row = df.agg(*[f(c).alias(f"{n}{i}") for i, c in enumerate(columns)
                   for n, f in (("m", F.avg), ("s", F.stddev_samp))]).first()
    scaled = {}
    for i, c in enumerate(columns):
        mean, dev = row[f"m{i}"], row[f"s{i}"]
        if dev:
            scaled[c + suffix] = (F.col(c) - F.lit(mean)) / F.lit(dev)
    return df.withColumns(scaled) if scaled else df


def log_skewed(df: DataFrame, columns: Sequence[str], min_skew: float = 2.0) -> DataFrame:
    """Add ``log1p`` of right-skewed, non-negative columns with more than two values."""
    row = df.agg(
        *[F.skewness(c).alias(f"k{i}") for i, c in enumerate(columns)],
        *[F.min(c).alias(f"m{i}") for i, c in enumerate(columns)],
        *[F.approx_count_distinct(c).alias(f"d{i}") for i, c in enumerate(columns)],
    ).first()
    chosen = [
        c for i, c in enumerate(columns)
        if "log" not in c.lower() and row[f"k{i}"] is not None and row[f"k{i}"] > min_skew
        and row[f"m{i}"] >= 0 and row[f"d{i}"] > 2
    ]
    return df.withColumns({c + "_log": F.log1p(c) for c in chosen}) if chosen else df
