"""Aggregations, audits, correlations, tests, bins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import bin_floor, ladder
from ..functions.time import time_block
from ..operators import stats
from ..sources.tables import write_stage
from .enrichment import route_rows
from .registry import Tables, query

NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
def returned() -> Column:
    return F.col("l_returnflag") == "R"


IS_R = "CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END"


def each(columns, template: str) -> str:
    """The same SELECT for every column, stacked."""
    return "\nUNION ALL ".join(template.format(c=c) for c in columns)


def gaps(t: Tables) -> DataFrame:
    """Events with two columns that have holes."""
    return t.events.select(
        "event_id", "event_type", F.when(F.col("event_id") % 7 != 0, F.col("value")).alias("gappy"),
        F.when(F.col("event_id") % 3 == 0, F.col("user_id")).alias("sparse"))


GAPS_SQL = """gaps AS (SELECT event_id, event_type, CASE WHEN event_id % 7 <> 0 THEN value END AS gappy,
                       CASE WHEN event_id % 3 = 0 THEN user_id END AS sparse FROM events)"""
GAP_COLUMNS = ["event_id", "event_type", "gappy", "sparse"]


@query("a1_count_share", "SELECT o_orderstatus, o_orderpriority, count(*) AS n, round(100.0 * count(*) / (SELECT count(*) FROM orders), 6) AS share_pct FROM orders GROUP BY ALL")
def a1_count_share(t: Tables) -> DataFrame:
    return stats.shares(t.orders, ["o_orderstatus", "o_orderpriority"])


@query("a2_mean_rate", f"SELECT l_suppkey, l_linestatus, count(*) AS n, CAST(sum({IS_R}) AS BIGINT) AS n_pos, round(avg({IS_R}), 9) AS rate FROM lineitem GROUP BY l_suppkey, l_linestatus")
def a2_mean_rate(t: Tables) -> DataFrame:
    return stats.rates(t.lineitem, ["l_suppkey", "l_linestatus"], returned())


@query("a3_rate_with_support", f"""
SELECT l_partkey, count(*) AS n, CAST(sum({IS_R}) AS BIGINT) AS n_pos, round(avg({IS_R}), 9) AS rate FROM lineitem
GROUP BY l_partkey HAVING count(*) >= 25 ORDER BY rate DESC, l_partkey LIMIT 20""")
def a3_rate_with_support(t: Tables) -> DataFrame:
    return stats.rates(t.lineitem, ["l_partkey"], returned(), min_rows=25, top=20)


@query("a4_volume_top", """
SELECT o_custkey, count(*) AS n, count(*) FILTER (o_orderstatus = 'F') AS n_pos, round(avg(CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0 END), 9) AS rate
FROM orders GROUP BY o_custkey ORDER BY n DESC, o_custkey LIMIT 10""")
def a4_volume_top(t: Tables) -> DataFrame:
    return stats.volume_top(t.orders, ["o_custkey"], F.col("o_orderstatus") == "F", 10)


DISTINCT_COLUMNS = ["l_suppkey", "l_partkey", "l_quantity", "l_returnflag"]


@query("a5_exact_distinct", each(DISTINCT_COLUMNS, "SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS n_distinct FROM lineitem"))
def a5_exact_distinct(t: Tables) -> DataFrame:
    return stats.distinct_counts(t.lineitem, DISTINCT_COLUMNS)


@query("a6_approx_distinct")
def a6_approx_distinct(t: Tables) -> DataFrame:
    return stats.approx_distinct_counts(t.lineitem, DISTINCT_COLUMNS)


@query("a6_merged_sketches", each(DISTINCT_COLUMNS, "SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS n_distinct, true AS within FROM lineitem"))
def a6_merged_sketches(t: Tables) -> DataFrame:
    """Monthly sketches, stored and merged, beside the exact counts: is the estimate within six standard deviations?"""
    months = stats.distinct_sketches(t.lineitem, DISTINCT_COLUMNS, F.date_trunc("month", "l_shipdate"), "month")
    merged = stats.merged_distinct(write_stage(months, t.scratch("sketches"))).withColumnRenamed("n_distinct", "estimate")
    close = F.abs(F.col("estimate") - F.col("n_distinct")) <= F.greatest(0.1 * F.col("n_distinct"), F.lit(1.0))
    return stats.distinct_counts(t.lineitem, DISTINCT_COLUMNS).join(merged, "column").select("column", "n_distinct", close.alias("within"))


@query("a7_quantiles", each([(c, p) for c in NUMBERS for p in (0.01, 0.25, 0.5, 0.95)],
                            "SELECT '{c[0]}' AS \"column\", CAST({c[1]} AS DOUBLE) AS prob, quantile_disc({c[0]}, {c[1]}) AS value FROM lineitem"))
def a7_quantiles(t: Tables) -> DataFrame:
    return stats.quantiles(t.lineitem, NUMBERS, [0.01, 0.25, 0.5, 0.95])


@query("a8_profile", each(NUMBERS, """SELECT '{c}' AS "column", count({c}) AS n, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS stddev, min({c}) AS "min",
  quantile_disc({c}, 0.25) AS q25, quantile_disc({c}, 0.5) AS q50, quantile_disc({c}, 0.75) AS q75, max({c}) AS "max" FROM lineitem"""))
def a8_profile(t: Tables) -> DataFrame:
    return stats.profile(t.lineitem, NUMBERS)


@query("a9_missing_report", f"WITH {GAPS_SQL} " + each(GAP_COLUMNS, """SELECT '{c}' AS "column", count(*) AS n_rows, count(*) - count({c}) AS n_missing,
  round(100.0 * (count(*) - count({c})) / count(*), 6) AS missing_pct FROM gaps"""))
def a9_missing_report(t: Tables) -> DataFrame:
    return stats.missing_report(gaps(t))


TYPED = {"event_id": "bigint", "event_type": "string", "gappy": "double", "sparse": "bigint"}


@query("a10_quality_summary", f"WITH {GAPS_SQL} " + "\nUNION ALL ".join(
    f"""SELECT '{c}' AS "column", '{ty}' AS type, count(*) AS "rows", count(*) - count({c}) AS n_missing, """
    + (f"""CAST(min({c}) AS DOUBLE) AS "min", CAST(max({c}) AS DOUBLE) AS "max", round(avg({c}), 6) AS mean""" if ty != "string"
       else 'CAST(NULL AS DOUBLE) AS "min", CAST(NULL AS DOUBLE) AS "max", CAST(NULL AS DOUBLE) AS mean')
    + " FROM gaps" for c, ty in TYPED.items()))
def a10_quality_summary(t: Tables) -> DataFrame:
    return stats.quality_summary(gaps(t))


@query("a11_missing_by_group", f"WITH {GAPS_SQL} " + each(["gappy", "sparse"], """SELECT event_type, '{c}' AS "column", count(*) AS n_rows, count(*) - count({c}) AS n_missing,
  round(100.0 * (count(*) - count({c})) / count(*), 6) AS missing_pct FROM gaps GROUP BY event_type"""))
def a11_missing_by_group(t: Tables) -> DataFrame:
    return stats.missing_report(gaps(t), ["gappy", "sparse"], ["event_type"])


@query("a12_stage_comparison", f"""
WITH {GAPS_SQL},
 s AS (SELECT 0 AS step, 'raw' AS stage, count(*) AS n_rows, 4 AS n_columns, round(100.0 * (2 * count(*) - count(gappy) - count(sparse)) / (4 * count(*)), 6) AS missing_pct FROM gaps
  UNION ALL SELECT 1, 'required', count(*), 4, round(100.0 * (2 * count(*) - count(gappy) - count(sparse)) / (4 * count(*)), 6) FROM gaps WHERE gappy IS NOT NULL
  UNION ALL SELECT 2, 'pruned', count(*), 3, round(100.0 * (count(*) - count(gappy)) / (3 * count(*)), 6) FROM gaps WHERE gappy IS NOT NULL)
SELECT *, n_rows - lag(n_rows) OVER (ORDER BY step) AS rows_change, n_columns - lag(n_columns) OVER (ORDER BY step) AS columns_change,
       round(missing_pct - lag(missing_pct) OVER (ORDER BY step), 6) AS missing_change FROM s""")
def a12_stage_comparison(t: Tables) -> DataFrame:
    raw = gaps(t)
    required = raw.dropna(subset=["gappy"])
    return stats.stage_comparison([("raw", raw), ("required", required), ("pruned", required.drop("sparse"))])


@query("a13_severity_bands", f"WITH {GAPS_SQL}, r AS (" + each(GAP_COLUMNS, """SELECT '{c}' AS "column", round(100.0 * (count(*) - count({c})) / count(*), 6) AS missing_pct FROM gaps""") + """)
SELECT CASE WHEN missing_pct >= 90 THEN 'Extreme (90-100% missing)' WHEN missing_pct >= 50 THEN 'High (50-90% missing)' WHEN missing_pct >= 10 THEN 'Moderate (10-50% missing)'
  WHEN missing_pct >= 1 THEN 'Low (1-10% missing)' ELSE 'Minimal (<1% missing)' END AS severity, count(*) AS n_columns FROM r GROUP BY severity""")
def a13_severity_bands(t: Tables) -> DataFrame:
    report = stats.missing_report(gaps(t))
    return report.groupBy(stats.severity(F.col("missing_pct")).alias("severity")).agg(F.count(F.lit(1)).alias("n_columns"))


CARDINALITY_CLASS = """CASE WHEN n_distinct <= 2 THEN 'Binary' WHEN n_distinct <= 10 THEN 'Low (2-10)' WHEN n_distinct <= 50 THEN 'Medium (11-50)'
  WHEN n_distinct <= 100 THEN 'High (51-100)' WHEN r > 0.5 THEN 'Extremely High (>50% unique)' ELSE 'Very High (>100)' END"""
ADVICE = """CASE WHEN r > 0.5 OR n_distinct > 1000 THEN 'DROP (Too High Cardinality)' WHEN n_distinct > 100 THEN 'Target/Frequency Encode'
  WHEN n_distinct > 50 THEN 'One-Hot Encode (With Caution)' ELSE 'One-Hot Encode (Safe)' END"""
PART_COLUMNS = ["p_name", "p_brand", "p_type", "p_size", "p_partkey"]


@query("a14_encoding_advice", "WITH c AS (" + each(PART_COLUMNS, """SELECT '{c}' AS "column", count(DISTINCT {c}) AS n_distinct, count(*) - count({c}) AS n_missing,
  1.0 * count(DISTINCT {c}) / count(*) AS r FROM part""") + f""")
SELECT "column", n_distinct, n_missing, round(r, 9) AS ratio, {CARDINALITY_CLASS} AS class, {ADVICE} AS advice FROM c""")
def a14_encoding_advice(t: Tables) -> DataFrame:
    return stats.cardinality_report(t.part, PART_COLUMNS)


@query("a15_target_correlation", each(NUMBERS, f"SELECT '{{c}}' AS \"column\", round(corr({{c}}, {IS_R}), 9) AS r FROM lineitem"))
def a15_target_correlation(t: Tables) -> DataFrame:
    return stats.target_correlation(t.lineitem, NUMBERS, returned())


@query("a16_correlation_matrix", each([(a, b) for i, a in enumerate(NUMBERS) for b in NUMBERS[i + 1:]],
                                      "SELECT '{c[0]}' AS a, '{c[1]}' AS b, round(corr({c[0]}, {c[1]}), 9) AS r FROM lineitem"))
def a16_correlation_matrix(t: Tables) -> DataFrame:
    return stats.correlation_pairs(t.lineitem, NUMBERS)


RANKED = ", ".join(f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0 AS r_{c}" for c in ("l_quantity", "l_discount", "l_extendedprice"))


@query("a17_rank_correlation", f"WITH r AS (SELECT *, {RANKED} FROM lineitem) " + each(["l_quantity", "l_discount"], """SELECT '{c}' AS "column", round(corr({c}, l_extendedprice), 9) AS pearson,
  round(corr(r_{c}, r_l_extendedprice), 9) AS spearman, round(abs(corr(r_{c}, r_l_extendedprice)) - abs(corr({c}, l_extendedprice)), 9) AS gap FROM r"""))
def a17_rank_correlation(t: Tables) -> DataFrame:
    return stats.rank_correlation(t.lineitem, ["l_quantity", "l_discount"], "l_extendedprice")


DERIVED = "(SELECT l_returnflag, l_quantity, l_extendedprice, l_extendedprice * (1 - l_discount) AS net, l_extendedprice * (1 + l_tax) AS gross FROM lineitem)"
PRUNED = ["l_quantity", "l_extendedprice", "net", "gross"]


@query("a18_prune_pairs", "WITH p AS (" + each([(a, b) for i, a in enumerate(PRUNED) for b in PRUNED[i + 1:]],
       f"""SELECT '{{c[0]}}' AS a, '{{c[1]}}' AS b, round(corr({{c[0]}}, {{c[1]}}), 9) AS r,
  CASE WHEN abs(corr({{c[0]}}, {IS_R})) >= abs(corr({{c[1]}}, {IS_R})) THEN '{{c[1]}}' ELSE '{{c[0]}}' END AS "drop" FROM {DERIVED}""") + ") SELECT * FROM p WHERE abs(r) > 0.95")
def a18_prune_pairs(t: Tables) -> DataFrame:
    price = F.col("l_extendedprice")
    rows = t.lineitem.select("l_returnflag", "l_quantity", "l_extendedprice", (price * (1 - F.col("l_discount"))).alias("net"),
                             (price * (1 + F.col("l_tax"))).alias("gross"))
    return stats.prune_pairs(rows, PRUNED, returned(), 0.95)


@query("a19_anova", each(["l_returnflag", "l_linestatus", "l_suppkey"], """
SELECT '{c}' AS "column", count(*) AS k, CAST(sum(n) AS BIGINT) AS n,
       round((sum(n * (m - g) * (m - g)) / (count(*) - 1)) / (sum(ss) / (sum(n) - count(*))), 6) AS f
FROM (SELECT {c}, count(*) AS n, avg(l_extendedprice) AS m, var_pop(l_extendedprice) * count(*) AS ss FROM lineitem GROUP BY {c}),
     (SELECT avg(l_extendedprice) AS g FROM lineitem)"""))
def a19_anova(t: Tables) -> DataFrame:
    return stats.anova(t.lineitem, ["l_returnflag", "l_linestatus", "l_suppkey"], "l_extendedprice")


@query("a20_chi_square", """
WITH o AS (SELECT l_linenumber, l_returnflag, count(*) AS n FROM lineitem GROUP BY ALL),
     x AS (SELECT *, sum(n) OVER (PARTITION BY l_linenumber) AS r, sum(n) OVER (PARTITION BY l_returnflag) AS c, sum(n) OVER () AS t FROM o)
SELECT 'l_linenumber' AS "column", CAST(max(t) AS BIGINT) AS n, (count(DISTINCT l_linenumber) - 1) * (count(DISTINCT l_returnflag) - 1) AS dof,
       round(sum((n - r * c / t) * (n - r * c / t) / (r * c / t)), 6) AS chi2 FROM x""")
def a20_chi_square(t: Tables) -> DataFrame:
    return stats.chi_square(t.lineitem, "l_linenumber", "l_returnflag")


SKEWED = ["qty", "steep", "discount_rate"]
SKEWED_SQL = "(SELECT l_quantity AS qty, pow(l_quantity / 50, 60) AS steep, l_discount AS discount_rate FROM lineitem)"


@query("a21_scaler_plan", "WITH k AS (" + each(SKEWED, f"""SELECT '{{c}}' AS "column", round(avg((({{c}} - m) / s) ** 3), 6) AS skew
  FROM {SKEWED_SQL}, (SELECT avg({{c}}) AS m, stddev_pop({{c}}) AS s FROM {SKEWED_SQL})""") + """)
SELECT *, CASE WHEN abs(skew) > 70 THEN 'ultra high' WHEN abs(skew) > 20 THEN 'high' WHEN abs(skew) > 5 THEN 'medium' ELSE 'low' END AS bucket,
  CASE WHEN abs(skew) > 5 THEN 'robust' WHEN "column" LIKE '%rate%' THEN 'minmax' ELSE 'standard' END AS scaler FROM k""")
def a21_scaler_plan(t: Tables) -> DataFrame:
    rows = t.lineitem.select(F.col("l_quantity").alias("qty"), F.pow(F.col("l_quantity") / 50, F.lit(60.0)).alias("steep"),
                             F.col("l_discount").alias("discount_rate"))
    return stats.scaler_plan(rows, SKEWED)


@query("a22_equal_width_bins", f"SELECT floor(l_extendedprice / 5000) * 5000.0 AS bin, count(*) AS n, CAST(sum({IS_R}) AS BIGINT) AS n_pos, round(avg({IS_R}), 9) AS rate FROM lineitem GROUP BY bin")
def a22_equal_width_bins(t: Tables) -> DataFrame:
    return stats.binned_rate(t.lineitem, bin_floor(F.col("l_extendedprice"), 5000.0), returned())


@query("a23_decimal_bins", f"""SELECT CAST(floor(l_tax * 100 / 2.0) * 0.02 AS DECIMAL(4,2)) AS bin, count(*) AS n, CAST(sum({IS_R}) AS BIGINT) AS n_pos, round(avg({IS_R}), 9) AS rate
FROM lineitem GROUP BY bin""")
def a23_decimal_bins(t: Tables) -> DataFrame:
    """Tax text such as ``4%`` back to a number, then exact decimal bins of width 0.02."""
    percent = F.regexp_replace(F.concat(F.round(F.col("l_tax") * 100).cast("int").cast("string"), F.lit("%")), "%", "").try_cast("double")
    rows = t.lineitem.withColumn("pct", percent)
    bin_ = (F.floor(F.col("pct") / 2) * F.lit("0.02").cast("decimal(4,2)")).cast("decimal(4,2)")
    return stats.binned_rate(rows, bin_, returned())


VISIBILITY = [(10, "Poor"), (20, "Low"), (35, "Moderate")]


@query("a24_labelled_bins", f"""SELECT CASE WHEN l_quantity < 10 THEN 'Poor' WHEN l_quantity < 20 THEN 'Low' WHEN l_quantity < 35 THEN 'Moderate' ELSE 'Good' END AS bin, count(*) AS n,
  CAST(sum({IS_R}) AS BIGINT) AS n_pos, round(avg({IS_R}), 9) AS rate FROM lineitem GROUP BY bin""")
def a24_labelled_bins(t: Tables) -> DataFrame:
    return stats.binned_rate(t.lineitem, ladder([(F.col("l_quantity") < v, n) for v, n in VISIBILITY], "Good"), returned())


@query("a25_binned_interval", """
SELECT CAST(floor(l_quantity / 5) * 5 AS DOUBLE) AS bin, count(*) AS n, round(avg(l_extendedprice), 6) AS mean,
  round(avg(l_extendedprice) - 1.96 * stddev_samp(l_extendedprice) / sqrt(count(*)), 6) AS low,
  round(avg(l_extendedprice) + 1.96 * stddev_samp(l_extendedprice) / sqrt(count(*)), 6) AS high FROM lineitem GROUP BY bin""")
def a25_binned_interval(t: Tables) -> DataFrame:
    return stats.binned_interval(t.lineitem, bin_floor(F.col("l_quantity"), 5.0), "l_extendedprice")


DAYS = ["sun", "mon", "tue", "wed", "thu", "fri", "sat"]


@query("a26_heat_map", f"""
SELECT CASE WHEN hour(ts) < 6 THEN 'Early AM (12-6a)' WHEN hour(ts) < 12 THEN 'Morning (6a-12p)' WHEN hour(ts) < 17 THEN 'Afternoon (12-5p)'
            WHEN hour(ts) < 21 THEN 'Evening (5-9p)' ELSE 'Night (9p-12a)' END AS block,
  {", ".join(f"round(avg(CASE WHEN event_type = 'error' THEN 1.0 ELSE 0 END) FILTER (dayofweek(ts) = {i}), 9) AS {d}" for i, d in enumerate(DAYS))}
FROM events GROUP BY block""")
def a26_heat_map(t: Tables) -> DataFrame:
    rows = t.events.withColumns({"block": time_block(F.hour("ts")), "dow": F.dayofweek("ts")})
    return stats.heat_map(rows, "block", "dow", range(1, 8), F.col("event_type") == "error", DAYS)


@query("a27_daily_means", "SELECT date_trunc('day', ts)::TIMESTAMP AS day, count(*) AS n, round(avg(value), 9) AS mean_value FROM events GROUP BY day")
def a27_daily_means(t: Tables) -> DataFrame:
    return t.events.groupBy(F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("value"), 9).alias("mean_value"))


ROUTES = """(SELECT s_nationkey, c_nationkey, l_returnflag FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey)"""


@query("a28_route_impact", f"""
SELECT s_nationkey, c_nationkey, count(*) AS n, CAST(sum({IS_R}) AS BIGINT) AS n_pos, round(avg({IS_R}), 9) AS rate, round(count(*) * round(avg({IS_R}), 9), 6) AS impact
FROM {ROUTES} GROUP BY s_nationkey, c_nationkey ORDER BY impact DESC, s_nationkey, c_nationkey LIMIT 25""")
def a28_route_impact(t: Tables) -> DataFrame:
    routes = stats.rates(route_rows(t), ["s_nationkey", "c_nationkey"], returned())
    return routes.withColumn("impact", F.round(F.col("n") * F.col("rate"), 6)).orderBy(F.desc("impact"), "s_nationkey", "c_nationkey").limit(25)


@query("a29_mean_of_daily_counts", """
SELECT user_id, round(avg(n), 9) AS mean_n, max(n) AS max_n, count(*) AS n_inner
FROM (SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY ALL) GROUP BY user_id""")
def a29_mean_of_daily_counts(t: Tables) -> DataFrame:
    return stats.mean_of_counts(t.events.withColumn("day", F.to_date("ts")), "user_id", "day")


@query("a30_outlier_counts", each(["l_quantity", "l_extendedprice"], """SELECT '{c}' AS "column", lo AS low, hi AS high, count(*) FILTER ({c} < lo) AS n_below, count(*) FILTER ({c} > hi) AS n_above
FROM lineitem, (SELECT quantile_disc({c}, 0.01) AS lo, quantile_disc({c}, 0.99) AS hi FROM lineitem) GROUP BY lo, hi"""))
def a30_outlier_counts(t: Tables) -> DataFrame:
    return stats.outlier_counts(t.lineitem, ["l_quantity", "l_extendedprice"])


@query("a31_iqr_filter", """
SELECT event_id, value FROM events, (SELECT quantile_disc(value, 0.25) AS q1, quantile_disc(value, 0.75) AS q3 FROM events)
WHERE value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)""")
def a31_iqr_filter(t: Tables) -> DataFrame:
    return stats.iqr_filter(t.events, "value").select("event_id", "value")


@query("a33_class_balance", """
SELECT count(*) AS n, count(*) FILTER (quality = 1) AS n_pos, count(*) FILTER (quality = 0) AS n_neg, round(avg(CASE WHEN quality = 1 THEN 1.0 ELSE 0 END), 9) AS pos_rate,
  round(1.0 * count(*) FILTER (quality = 0) / count(*) FILTER (quality = 1), 9) AS imbalance FROM labels""")
def a33_class_balance(t: Tables) -> DataFrame:
    return stats.class_balance(t.labels, "quality")


@query("a34_consistency", """
SELECT 'flag but small' AS rule, count(*) FILTER (l_returnflag = 'R' AND l_quantity < 15) AS violations, count(*) AS "rows" FROM lineitem
UNION ALL SELECT 'large but no flag', count(*) FILTER (l_returnflag <> 'R' AND l_quantity >= 15), count(*) FROM lineitem
UNION ALL SELECT 'negative price', count(*) FILTER (l_extendedprice < 0), count(*) FROM lineitem""")
def a34_consistency(t: Tables) -> DataFrame:
    late = F.col("l_quantity") >= 15
    return stats.consistency(t.lineitem, {"flag but small": returned() & ~late, "large but no flag": ~returned() & late,
                                          "negative price": F.col("l_extendedprice") < 0})


@query("a35_degree_centrality", f"""
SELECT s_nationkey, count(DISTINCT c_nationkey) AS degree, round(1.0 * count(DISTINCT c_nationkey) / ((SELECT count(DISTINCT s_nationkey) FROM {ROUTES}) - 1), 9) AS centrality
FROM {ROUTES} GROUP BY s_nationkey""")
def a35_degree_centrality(t: Tables) -> DataFrame:
    return stats.degree_centrality(route_rows(t), "s_nationkey", "c_nationkey")


@query("a36_entity_quality", f"SELECT l_suppkey, round(avg({IS_R}), 9) AS rate, round(coalesce(stddev_samp({IS_R}), 0), 9) AS spread, count(*) AS volume FROM lineitem GROUP BY l_suppkey")
def a36_entity_quality(t: Tables) -> DataFrame:
    return stats.entity_quality(t.lineitem, "l_suppkey", returned())


@query("a37_group_anomaly", """
SELECT l_orderkey, l_linenumber, round(avg(l_extendedprice) OVER (PARTITION BY l_suppkey, month(l_shipdate)), 8) AS normal,
  round(l_extendedprice - avg(l_extendedprice) OVER (PARTITION BY l_suppkey, month(l_shipdate)), 8) AS anomaly FROM lineitem""")
def a37_group_anomaly(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", F.month("l_shipdate").alias("month"), "l_extendedprice")
    out = stats.against_normal(rows, ["l_suppkey", "month"], "l_extendedprice")
    return out.select("l_orderkey", "l_linenumber", F.round("normal", 8).alias("normal"), F.round("anomaly", 8).alias("anomaly"))


THRESHOLDS = {"big": ("l_extendedprice", 0.75), "few": ("l_quantity", 0.1), "many": ("l_quantity", 0.9), "cheap": ("l_discount", 0.95)}
EXTREME_SQL = """th AS (SELECT quantile_disc(l_extendedprice, 0.75) AS big, quantile_disc(l_quantity, 0.1) AS few, quantile_disc(l_quantity, 0.9) AS many,
                       quantile_disc(l_discount, 0.95) AS cheap FROM lineitem WHERE l_returnflag = 'R'),
     x AS (SELECT l_orderkey, l_linenumber, l_returnflag, CASE WHEN l_extendedprice >= big THEN 1 ELSE 0 END AS extreme_price,
             CASE WHEN l_quantity <= few OR l_quantity >= many THEN 1 ELSE 0 END AS extreme_quantity, CASE WHEN l_discount >= cheap THEN 1 ELSE 0 END AS extreme_discount
           FROM lineitem, th)"""


def extremes(t: Tables) -> DataFrame:
    """0/1 flags against thresholds learned from the positive rows only."""
    th = stats.quantile_row(t.lineitem.filter(returned()), THRESHOLDS)
    q = F.col("l_quantity")
    flags = {"extreme_price": F.col("l_extendedprice") >= th["big"], "extreme_quantity": (q <= th["few"]) | (q >= th["many"]),
             "extreme_discount": F.col("l_discount") >= th["cheap"]}
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_returnflag", *[F.when(c, 1).otherwise(0).alias(n) for n, c in flags.items()])


@query("a38_extreme_flags", f"WITH {EXTREME_SQL} SELECT * EXCLUDE (l_returnflag) FROM x")
def a38_extreme_flags(t: Tables) -> DataFrame:
    return extremes(t).drop("l_returnflag")


@query("a39_composite_score", f"""
WITH {EXTREME_SQL}, w AS (SELECT coalesce(abs(corr(extreme_price, {IS_R})), 0.25) AS a, coalesce(abs(corr(extreme_quantity, {IS_R})), 0.25) AS b,
                                 coalesce(abs(corr(extreme_discount, {IS_R})), 0.25) AS c FROM x)
SELECT l_orderkey, l_linenumber, round((extreme_price * a + extreme_quantity * b + extreme_discount * c) / (a + b + c), 7) AS score FROM x, w""")
def a39_composite_score(t: Tables) -> DataFrame:
    scored = stats.composite_score(extremes(t), ["extreme_price", "extreme_quantity", "extreme_discount"], returned())
    return scored.select("l_orderkey", "l_linenumber", F.round("score", 7).alias("score"))


@query("a40_variance_baseline", "SELECT count(l_quantity) AS n, round(avg(l_quantity), 6) AS mean, round(var_pop(l_quantity), 4) AS mse FROM lineitem")
def a40_variance_baseline(t: Tables) -> DataFrame:
    return stats.variance_baseline(t.lineitem, "l_quantity")
