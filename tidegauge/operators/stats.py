"""Profiles, audits, rates, correlations and tests; one pass over the data wherever possible."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.numeric import correlation, ladder, ratio
from .clean import columns_of_type, is_missing, to_long
from .joins import aggregate_back
from .ranking import cumulative_by_value
from .gram import correlations
from .quantiles import exact_quantiles



def row_total(df: DataFrame) -> Column:
    """Row count as a scalar subquery."""
    return df.agg(F.count(F.lit(1)).alias("n")).scalar()


# ---- counts, shares, rates -------------------------------------------------------------

def shares(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("share_pct", F.round(100.0 * F.col("n") / row_total(df), 6))


def rates(
    df: DataFrame, keys: Sequence[str], label: Column, min_rows: int = 0, top: int | None = None,
) -> DataFrame:
    """Rows, positives and rate per group; small groups dropped; busiest rate first when cut."""
    out = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(label.cast("long")).alias("n_pos"),
        F.round(F.avg(label.cast("double")), 9).alias("rate"),
    )
    if min_rows:
        out = out.filter(F.col("n") >= min_rows)
    return out.orderBy(F.desc("rate"), *keys).limit(top) if top else out


def volume_top(df: DataFrame, keys: Sequence[str], label: Column, top: int) -> DataFrame:
    return rates(df, keys, label).orderBy(F.desc("n"), *keys).limit(top)


def conditional_table(df: DataFrame, given: str, outcome: str) -> DataFrame:
    """P(outcome | given) with its counts."""
    counts = df.groupBy(given, outcome).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(W.partitionBy(given))  # over the small count table
    return counts.withColumn("total", total).withColumn("probability", F.round(F.col("n") / F.col("total"), 9))


def class_balance(df: DataFrame, label: str) -> DataFrame:
    one = F.count(F.when(F.col(label) == 1, 1))
    zero = F.count(F.when(F.col(label) == 0, 1))
    return df.agg(
        F.count(F.lit(1)).alias("n"), one.alias("n_pos"), zero.alias("n_neg"),
        F.round(ratio(one, F.count(label)), 9).alias("pos_rate"),
        F.round(ratio(zero, one), 9).alias("imbalance"),
    )


def consistency(df: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """Number of rows that violate each rule; a null condition is no violation."""
    names = list(checks)
    wide = df.agg(*[F.count(F.when(checks[n], F.lit(1))).alias(f"c{i}") for i, n in enumerate(names)],
                  F.count(F.lit(1)).alias("rows"))
    rows = [F.struct(F.lit(n).alias("rule"), F.col(f"c{i}").alias("violations"), F.col("rows"))
            for i, n in enumerate(names)]
    return wide.select(F.inline(F.array(*rows)))


def mean_of_counts(df: DataFrame, group: str, inner: str) -> DataFrame:
    """Mean number of rows per inner key, by group."""
    counts = df.groupBy(group, inner).agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy(group).agg(
        F.round(F.avg("n"), 9).alias("mean_n"), F.max("n").alias("max_n"), F.count(F.lit(1)).alias("n_inner")
    )


def entity_quality(df: DataFrame, key: str, label: Column) -> DataFrame:
    """Rate, spread (0 for a single row) and volume per entity."""
    y = label.cast("double")
    return df.groupBy(key).agg(
        F.round(F.avg(y), 9).alias("rate"),
        F.round(F.coalesce(F.stddev_samp(y), F.lit(0.0)), 9).alias("spread"),
        F.count(F.lit(1)).alias("volume"),
    )


# ---- distinct counts, quantiles, profiles ----------------------------------------------

def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return to_long(df, columns, {"n_distinct": F.count_distinct})


def approx_distinct_counts(df: DataFrame, columns: Sequence[str], rsd: float = 0.05) -> DataFrame:
    return to_long(df, columns, {"n_distinct": lambda c: F.approx_count_distinct(c, rsd)})


#: log2 of the registers of a stored sketch; 4096 registers are off by 1.6 % (one standard deviation) and have 4 kB at most.
SKETCH_SIZE = 12


def distinct_sketches(df: DataFrame, columns: Sequence[str], by: Column, name: str) -> DataFrame:
    """(name, column, sketch): one mergeable sketch of the distinct values per period and column, to be stored.

    Later periods are added as rows of their own; ``merged_distinct`` joins any of them without the data. Nulls are no values; a period
    with nulls only has an empty sketch.
    """
    sketches = df.groupBy(by.alias(name)).agg(*[F.hll_sketch_agg(F.col(c).cast("string"), SKETCH_SIZE).alias(f"_s{i}") for i, c in enumerate(columns)])
    return sketches.select(name, F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"_s{i}").alias("sketch")) for i, c in enumerate(columns)])))


def merged_distinct(sketches: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Approximate distinct counts per column, and per ``keys`` of the stored periods, from the sketches alone."""
    merged = sketches.groupBy(*keys, "column").agg(F.hll_union_agg("sketch").alias("_s"))
    return merged.select(*keys, "column", F.hll_sketch_estimate("_s").alias("n_distinct"))


def quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """Exact quantiles, one row per column and probability."""
    wanted = {f"q{i}_{j}": (c, p) for i, c in enumerate(columns) for j, p in enumerate(probs)}
    found = exact_quantiles(df, wanted)
    rows = [(c, float(p), found[n]) for n, (c, p) in wanted.items()]
    return df.sparkSession.createDataFrame(rows, "column string, prob double, value double")


def quantile_row(df: DataFrame, wanted: Mapping[str, tuple[str, float]]) -> dict[str, float]:
    """Named thresholds: name -> (column, probability)."""
    return exact_quantiles(df, wanted)


def profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, spread, extremes and exact quartiles per column."""
    found = exact_quantiles(df, {f"{q}_{i}": (c, p) for i, c in enumerate(columns) for q, p in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75))})
    long = to_long(df, columns, {
        "n": F.count,
        "mean": lambda c: F.round(F.avg(c), 6),
        "stddev": lambda c: F.round(F.stddev_samp(c), 6),
        "min": lambda c: F.min(c.cast("double")),
        "max": lambda c: F.max(c.cast("double")),
    })
    return long.select("column", "n", "mean", "stddev", "min", "max", *[ladder([(F.col("column") == c, found[f"{q}_{i}"]) for i, c in enumerate(columns)], None).cast("double").alias(q) for q in ("q25", "q50", "q75")])


# ---- missing values --------------------------------------------------------------------

def missing_report(df: DataFrame, columns: Sequence[str] | None = None, keys: Sequence[str] = ()) -> DataFrame:
    """Missing rows and their percentage per column (and group), long format."""
    columns = list(columns or df.columns)
    flags = df.select(*keys, *[is_missing(df, c).cast("long").alias(f"m{i}") for i, c in enumerate(columns)])
    aggs = [F.count(F.lit(1)).alias("n_rows"), *[F.sum(f"m{i}").alias(f"m{i}") for i in range(len(columns))]]
    wide = flags.groupBy(*keys).agg(*aggs) if keys else flags.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"m{i}").alias("n_missing")) for i, c in enumerate(columns)]
    long = wide.select(*keys, "n_rows", F.inline(F.array(*rows)))
    return long.withColumn("missing_pct", F.round(100 * ratio(F.col("n_missing"), F.col("n_rows")), 6))


# Fixed labels of the severity and cardinality classes.
def severity(pct: Column) -> Column:
    return ladder([
        (pct >= 90, "Extreme (90-100% missing)"), (pct >= 50, "High (50-90% missing)"),
        (pct >= 10, "Moderate (10-50% missing)"), (pct >= 1, "Low (1-10% missing)"),
    ], "Minimal (<1% missing)")


def cardinality_class(n: Column, share: Column) -> Column:
    return ladder([
        (n <= 2, "Binary"), (n <= 10, "Low (2-10)"), (n <= 50, "Medium (11-50)"), (n <= 100, "High (51-100)"),
        (share > 0.5, "Extremely High (>50% unique)"),
    ], "Very High (>100)")


def encoding_advice(n: Column, share: Column) -> Column:
    return ladder([
        ((share > 0.5) | (n > 1000), "DROP (Too High Cardinality)"), (n > 100, "Target/Frequency Encode"),
        (n > 50, "One-Hot Encode (With Caution)"),
    ], "One-Hot Encode (Safe)")


def cardinality_report(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    wide = to_long(df, columns, {
        "n_rows": lambda c: F.count(F.lit(1)), "n_present": F.count, "n_distinct": F.count_distinct,
    })
    share = ratio(F.col("n_distinct"), F.col("n_rows"))
    return wide.select(
        "column", "n_distinct", (F.col("n_rows") - F.col("n_present")).alias("n_missing"),
        F.round(share, 9).alias("ratio"),
        cardinality_class(F.col("n_distinct"), share).alias("class"),
        encoding_advice(F.col("n_distinct"), share).alias("advice"),
    )


def stage_comparison(stages: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """Rows, columns and missing share of successive versions of a table, with the change."""
    out = None
    for i, (name, df) in enumerate(stages):
        flags = [is_missing(df, c).cast("long") for c in df.columns]
        row = df.select(sum(flags[1:], flags[0]).alias("m")).agg(
            F.lit(i).alias("step"), F.lit(name).alias("stage"), F.count(F.lit(1)).alias("n_rows"),
            F.lit(len(df.columns)).alias("n_columns"),
            F.round(100 * ratio(F.sum("m"), F.count(F.lit(1)) * len(df.columns)), 6).alias("missing_pct"),
        )
        out = row if out is None else out.unionByName(row)
    prior = W.orderBy("step")  # one row per stage
    return out.withColumns({
        "rows_change": F.col("n_rows") - F.lag("n_rows").over(prior),
        "columns_change": F.col("n_columns") - F.lag("n_columns").over(prior),
        "missing_change": F.round(F.col("missing_pct") - F.lag("missing_pct").over(prior), 6),
    })


def quality_summary(df: DataFrame) -> DataFrame:
    """Type and missing rows of every column, value range and mean of the numeric ones; one pass."""
    numeric = set(columns_of_type(df, "tinyint", "smallint", "int", "bigint", "float", "double"))
    types = dict(df.dtypes)
    aggs = [F.count(F.lit(1)).alias("rows")]
    for i, c in enumerate(df.columns):
        aggs.append(F.count(F.when(is_missing(df, c), F.lit(1))).alias(f"m{i}"))
        if c in numeric:
            x = F.col(c).cast("double")
            aggs += [F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}"), F.avg(x).alias(f"av{i}")]
    none = F.lit(None).cast("double")
    rows = [
        F.struct(
            F.lit(c).alias("column"), F.lit(types[c]).alias("type"), F.col("rows"), F.col(f"m{i}").alias("n_missing"),
            (F.col(f"lo{i}") if c in numeric else none).alias("min"),
            (F.col(f"hi{i}") if c in numeric else none).alias("max"),
            (F.round(f"av{i}", 6) if c in numeric else none).alias("mean"),
        )
        for i, c in enumerate(df.columns)
    ]
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


# ---- correlation and selection ---------------------------------------------------------

def target_correlation(df: DataFrame, columns: Sequence[str], target: Column) -> DataFrame:
    y = target.cast("double")
    return to_long(df, columns, {"r": lambda c: F.round(correlation(c, y), 9)})


def _rounded(value: float, digits: int = 9) -> float | None:
    return None if value != value else round(float(value), digits)


def correlation_pairs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson r for every pair i < j, from one pass over the rows whatever the width."""
    r = correlations(df, [F.col(c) for c in columns])
    rows = [(a, b, _rounded(r[i, j])) for (i, a), (j, b) in combinations(enumerate(columns), 2)]
    return df.sparkSession.createDataFrame(rows, "a string, b string, r double")


def average_ranks(df: DataFrame, column: str, name: str) -> DataFrame:
    """Distinct values of a column with the mean rank of their rows."""
    cum = cumulative_by_value(df, column, {"_n": F.count(F.lit(1))})
    return cum.select(column, (F.col("_n_before") + (F.col("_n") + 1) / 2).alias(name))


def rank_correlation(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """Pearson and Spearman correlation of each column with the target, and their gap."""
    pairs = df.select(*columns, target)
    out = pairs
    for i, c in enumerate([*columns, target]):
        out = out.join(average_ranks(pairs, c, f"_rk{i}"), c, "left")
    last = f"_rk{len(columns)}"
    wide = out.agg(
        *[correlation(F.col(c), F.col(target)).alias(f"p{i}") for i, c in enumerate(columns)],
        *[correlation(F.col(f"_rk{i}"), F.col(last)).alias(f"s{i}") for i in range(len(columns))],
    )
    rows = [
        F.struct(F.lit(c).alias("column"), F.round(f"p{i}", 9).alias("pearson"), F.round(f"s{i}", 9).alias("spearman"),
                 F.round(F.abs(F.col(f"s{i}")) - F.abs(F.col(f"p{i}")), 9).alias("gap"))
        for i, c in enumerate(columns)
    ]
    return wide.select(F.inline(F.array(*rows)))


def prune_pairs(df: DataFrame, columns: Sequence[str], target: Column, limit: float) -> DataFrame:
    """Pairs with |r| above ``limit`` and which of the two to drop: the one farther from the target."""
    r = correlations(df, [*[F.col(c) for c in columns], target])
    near = abs(r[:, -1])
    rows = [(a, b, _rounded(r[i, j]), b if near[i] >= near[j] else a)
            for (i, a), (j, b) in combinations(enumerate(columns), 2) if abs(r[i, j]) > limit]
    return df.sparkSession.createDataFrame(rows, "a string, b string, r double, drop string")


def anova(df: DataFrame, categories: Sequence[str], target: str) -> DataFrame:
    """One-way F statistic of the target by each category.

    One grouping per category on its own; group moments are summed into the two squares.
    """
    out = None
    y = F.col(target).cast("double")
    center = df.agg(F.avg(y).alias("m")).scalar()
    for c in categories:
        groups = (
            df.filter(F.col(c).isNotNull() & y.isNotNull()).withColumn("_y", y - center).groupBy(c)
            .agg(F.count(F.lit(1)).alias("n"), F.sum("_y").alias("s"), F.sum(F.col("_y") * F.col("_y")).alias("q"))
        )
        row = groups.agg(
            F.lit(c).alias("column"), F.count(F.lit(1)).alias("k"), F.sum("n").alias("n"),
            F.sum("s").alias("_s"), F.sum("q").alias("_q"), F.sum(F.col("s") * F.col("s") / F.col("n")).alias("_b"),
        )
        out = row if out is None else out.unionByName(row)
    between = F.col("_b") - ratio(F.col("_s") * F.col("_s"), F.col("n"))
    within = F.col("_q") - F.col("_b")
    f = ratio(ratio(between, F.col("k") - 1), ratio(within, F.col("n") - F.col("k")))
    return out.select("column", "k", F.coalesce("n", F.lit(0)).alias("n"), F.round(f, 6).alias("f"))


def chi_square(df: DataFrame, category: str, label: str) -> DataFrame:
    """Pearson chi-square of two categorical columns with its degrees of freedom.

    Uses sum(n_ij^2 / (row_i * col_j)) over filled cells, so empty cells need no rows.
    """
    cells = df.filter(F.col(category).isNotNull() & F.col(label).isNotNull()).groupBy(category, label).agg(
        F.count(F.lit(1)).alias("n"))
    rows = cells.groupBy(category).agg(F.sum("n").alias("_row"))
    cols = cells.groupBy(label).agg(F.sum("n").alias("_col"))
    joined = cells.join(rows, category).join(cols, label)
    return joined.agg(
        F.lit(category).alias("column"), F.sum("n").alias("n"),
        ((F.count_distinct(category) - 1) * (F.count_distinct(label) - 1)).alias("dof"),
        F.round(F.sum("n") * (F.sum(F.col("n") * F.col("n") / (F.col("_row") * F.col("_col"))) - 1), 6).alias("chi2"),
    )


# Fixed skew limits and the scaler each bucket gets.
def scaler_plan(df: DataFrame, columns: Sequence[str], unit_names: Sequence[str] = (
    "rate", "ratio", "prob", "probability", "share", "fraction")) -> DataFrame:
    """Skew bucket of each column and the scaler it should get."""
    long = to_long(df, columns, {"skew": lambda c: F.round(F.skewness(c.cast("double")), 6)})
    size = F.abs("skew")
    bucket = ladder([(size > 70, "ultra high"), (size > 20, "high"), (size > 5, "medium")], "low")
    unit = F.lit(False)
    for name in unit_names:
        unit = unit | F.lower("column").contains(name)
    scaler = ladder([(size > 5, "robust"), (unit, "minmax")], "standard")
    return long.withColumns({"bucket": bucket, "scaler": scaler})


# ---- bins, heat maps, outliers ---------------------------------------------------------

def binned_rate(df: DataFrame, bin_: Column, label: Column) -> DataFrame:
    return rates(df.withColumn("bin", bin_), ["bin"], label)


def binned_interval(df: DataFrame, bin_: Column, value: str, z: float = 1.96) -> DataFrame:
    """Mean per bin with a normal interval; a bin of one row has no interval."""
    g = df.withColumn("bin", bin_).groupBy("bin").agg(
        F.count(value).alias("n"), F.avg(value).alias("_m"), F.stddev_samp(value).alias("_s"))
    half = ratio(F.lit(z) * F.col("_s"), F.sqrt("n"))
    return g.select("bin", "n", F.round("_m", 6).alias("mean"), F.round(F.col("_m") - half, 6).alias("low"),
                    F.round(F.col("_m") + half, 6).alias("high"))


def heat_map(df: DataFrame, row: str, column: str, values: Sequence[object], label: Column, names: Sequence[str]) -> DataFrame:
    """Rate by row and column with a fixed list of columns, so no extra pass finds them."""
    wide = df.withColumn("_y", label.cast("double")).groupBy(row).pivot(column, list(values)).agg(F.round(F.avg("_y"), 9))
    return wide.toDF(row, *names)


def outlier_counts(df: DataFrame, columns: Sequence[str], low: float = 0.01, high: float = 0.99) -> DataFrame:
    """Rows below and above the sketched percentiles; the second pass carries literal bounds."""
    bounds = quantile_row(df, {f"{e}{i}": (c, p) for i, c in enumerate(columns) for e, p in (("lo", low), ("hi", high))})
    wide = df.agg(*[F.count(F.when(F.col(c) < F.lit(bounds[f"lo{i}"]), F.lit(1))).alias(f"b{i}") for i, c in enumerate(columns)],
                  *[F.count(F.when(F.col(c) > F.lit(bounds[f"hi{i}"]), F.lit(1))).alias(f"a{i}") for i, c in enumerate(columns)])
    rows = [F.struct(F.lit(c).alias("column"), F.lit(bounds[f"lo{i}"]).alias("low"), F.lit(bounds[f"hi{i}"]).alias("high"),
                     F.col(f"b{i}").alias("n_below"), F.col(f"a{i}").alias("n_above")) for i, c in enumerate(columns)]
    return wide.select(F.inline(F.array(*rows)))


def iqr_filter(df: DataFrame, column: str, k: float = 1.5) -> DataFrame:
    q = quantile_row(df, {"q1": (column, 0.25), "q3": (column, 0.75)})
    reach = k * (q["q3"] - q["q1"])
    return df.filter(F.col(column).between(q["q1"] - reach, q["q3"] + reach))


def against_normal(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Group normal and the row's deviation from it."""
    return aggregate_back(df, keys, {"normal": F.avg(value)}).withColumn("anomaly", F.col(value) - F.col("normal"))


def composite_score(df: DataFrame, flags: Sequence[str], label: Column, default: float = 0.25) -> DataFrame:
    """Weighted sum of 0/1 flags; weights are |corr with label|, scaled to 1, ``default`` if undefined."""
    y = label.cast("double")
    row = df.agg(*[correlation(F.col(f), y).alias(f"r{i}") for i, f in enumerate(flags)]).first()
    raw = [default if row[i] is None or row[i] != row[i] else abs(row[i]) for i in range(len(flags))]
    total = sum(raw)
    weights = [w / total for w in raw] if total > 0 else [1.0 / len(flags)] * len(flags)
    score = F.lit(0.0)
    for f, w in zip(flags, weights):
        score = score + F.col(f) * F.lit(w)
    return df.withColumn("score", score)


def degree_centrality(df: DataFrame, node: str, other: str) -> DataFrame:
    """Distinct counterparts of each node over the number of other nodes."""
    pairs = df.select(node, other).distinct()
    n = df.agg(F.count_distinct(node).alias("n")).scalar()
    return pairs.groupBy(node).agg(F.count(other).alias("degree")).withColumn(
        "centrality", F.round(ratio(F.col("degree"), n - 1), 9))


def variance_baseline(df: DataFrame, target: str) -> DataFrame:
    """The mean as a model: its value and its mean squared error."""
    return df.agg(F.count(target).alias("n"), F.round(F.avg(target), 6).alias("mean"),
                  F.round(F.var_pop(target), 4).alias("mse"))


def run_summary(df: DataFrame, when: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns)).alias("n_columns"),
                  F.min(when).alias("first"), F.max(when).alias("last"))
