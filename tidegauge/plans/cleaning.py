"""Projection, type repair, validation and imputation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import numeric, text, time
from ..operators import clean, frames, impute
from .registry import Tables, query

# Damaged copies of clean columns, the same expression here and in the SQL.
FLAGGED = """CASE WHEN event_id % 11 = 0 THEN 'T' WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 13 = 0 THEN 'NA'
             WHEN event_id % 5 = 0 THEN concat(CAST(event_id % 97 AS {t}), '.5s') ELSE concat(CAST(event_id % 97 AS {t}), '.25') END"""
NULLED = "CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END"


def damaged(t: Tables) -> DataFrame:
    return t.events.select("event_id", "ts", "user_id", "event_type", "value",
                           F.expr(FLAGGED.format(t="STRING")).alias("raw"), F.expr(NULLED).alias("gappy"))


DAMAGED_SQL = f"""damaged AS (SELECT event_id, ts, user_id, event_type, value, {FLAGGED.format(t='VARCHAR')} AS raw,
                   {NULLED} AS gappy FROM events)"""


@query("p1_select_present", "SELECT o_orderkey, o_totalprice FROM orders")
def p1_select_present(t: Tables) -> DataFrame:
    return clean.select_present(t.orders, ["o_orderkey", "no_such_column", "o_totalprice"])


@query("p2_cast_columns", """
SELECT l_orderkey, l_linenumber, TRY_CAST(l_quantity AS INTEGER) AS l_quantity,
       TRY_CAST(CASE WHEN l_linenumber = 3 THEN 'n/a' ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) END AS DOUBLE) AS price,
       CAST(l_shipdate AS DATE) AS l_shipdate FROM lineitem""")
def p2_cast_columns(t: Tables) -> DataFrame:
    as_text = F.col("l_extendedprice").cast("decimal(18,2)").cast("string")
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_shipdate",
                             F.when(F.col("l_linenumber") == 3, "n/a").otherwise(as_text).alias("price"))
    return clean.cast_columns(rows, {"int": ["l_quantity"], "double": ["price"], "date": ["l_shipdate"]})


@query("p3_strip_quality_flag", f"""
WITH {DAMAGED_SQL}
SELECT event_id, CASE WHEN raw = 'T' THEN 0.0 ELSE TRY_CAST(regexp_replace(raw, 's$', '') AS DOUBLE) END AS reading FROM damaged""")
def p3_strip_quality_flag(t: Tables) -> DataFrame:
    return damaged(t).select("event_id", text.strip_quality_flag(F.col("raw")).alias("reading"))


@query("p4_to_double_safe", f"""
WITH {DAMAGED_SQL}
SELECT event_id, TRY_CAST(nullif(regexp_replace(raw, '[^0-9.-]', '', 'g'), '') AS DOUBLE) AS reading FROM damaged""")
def p4_to_double_safe(t: Tables) -> DataFrame:
    return damaged(t).select("event_id", text.to_double_safe(F.col("raw")).alias("reading"))


@query("p5_composite_key", """
SELECT concat_ws('|', strftime(o_orderdate, '%Y-%m-%d'), o_orderpriority, CAST(o_custkey AS VARCHAR), CAST(o_orderkey AS VARCHAR)) AS order_id
FROM orders""")
def p5_composite_key(t: Tables) -> DataFrame:
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    key = text.composite_key(day, "o_orderpriority", F.col("o_custkey").cast("string"), F.col("o_orderkey").cast("string"))
    return t.orders.select(key.alias("order_id"))


CANCELLED = "CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 5 = 0 THEN 1 ELSE 0 END"


@query("p6_null_tolerant_filter", f"""
SELECT o_orderkey, cancelled FROM (SELECT o_orderkey, {CANCELLED} AS cancelled FROM orders) WHERE cancelled <> 1 OR cancelled IS NULL""")
def p6_null_tolerant_filter(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", F.expr(CANCELLED).alias("cancelled"))
    return rows.filter((F.col("cancelled") != 1) | F.col("cancelled").isNull())


@query("p7_required_columns", f"""
WITH {DAMAGED_SQL}
SELECT c AS "column", CASE c WHEN 'raw' THEN count(*) FILTER (raw IS NULL) ELSE count(*) FILTER (gappy IS NULL) END AS n_missing,
       count(*) AS rows_before, count(*) FILTER (raw IS NOT NULL AND gappy IS NOT NULL) AS rows_after
FROM damaged CROSS JOIN (VALUES ('raw'), ('gappy')) v(c) GROUP BY c""")
def p7_required_columns(t: Tables) -> DataFrame:
    return clean.require_report(damaged(t), ["raw", "gappy"])


@query("p7_required_rows", f"WITH {DAMAGED_SQL} SELECT event_id, gappy FROM damaged WHERE raw IS NOT NULL AND gappy IS NOT NULL")
def p7_required_rows(t: Tables) -> DataFrame:
    return clean.require(damaged(t), ["raw", "gappy"]).select("event_id", "gappy")


@query("p8_drop_sparse", "SELECT event_id, mostly, kept FROM (SELECT event_id, CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END AS mostly, CASE WHEN event_id % 7 <> 0 THEN NULL ELSE value END AS kept FROM events)")
def p8_drop_sparse(t: Tables) -> DataFrame:
    seventh = F.col("event_id") % 7 == 0
    rows = t.events.select("event_id", F.when(~seventh, F.col("value")).alias("mostly"),
                           F.when(seventh, F.col("value")).alias("kept"), F.when(seventh, F.col("value")).alias("sparse"))
    return clean.drop_sparse(rows, 0.5, keep=["kept"])


@query("p9_leakage_drop", "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem")
def p9_leakage_drop(t: Tables) -> DataFrame:
    return clean.drop_leaky(t.lineitem, explicit=["l_returnflag"], keywords=["status", "SHIP"])


@query("p10_suffix_columns", "SELECT o_orderkey, o_totalprice AS price FROM orders")
def p10_suffix_columns(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", F.col("o_totalprice").alias("price_kept"), F.col("o_custkey").alias("cust_removed"))
    return clean.strip_suffix(clean.drop_by_suffix(rows, "_removed", "_high_corr"), "_kept")


@query("p11_domain_validation", """
SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity BETWEEN 5 AND 45 THEN l_quantity END AS quantity,
       CASE WHEN l_linenumber IN (1, 2, 3, 4, 5) THEN l_linenumber END AS line FROM lineitem""")
def p11_domain_validation(t: Tables) -> DataFrame:
    return t.lineitem.select("l_orderkey", "l_linenumber", numeric.null_outside(F.col("l_quantity"), 5, 45).alias("quantity"),
                             numeric.null_unless_in(F.col("l_linenumber"), [1, 2, 3, 4, 5]).alias("line"))


@query("p12_implausible_to_median", """
WITH v AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_extendedprice <= 50000 THEN l_extendedprice END AS price FROM lineitem)
SELECT l_orderkey, l_linenumber, coalesce(price, (SELECT quantile_disc(price, 0.5) FROM v)) AS price FROM v""")
def p12_implausible_to_median(t: Tables) -> DataFrame:
    plausible = F.when(F.col("l_extendedprice") <= 50000, F.col("l_extendedprice"))
    rows = t.lineitem.select("l_orderkey", "l_linenumber", plausible.alias("price"))
    return impute.median_fill(rows, ["price"])


@query("p13_normalise_code", """
SELECT c_custkey, nullif(regexp_replace(upper(CASE WHEN c_custkey % 6 = 0 THEN ' - ' ELSE concat(' ', lower(c_name), '-x') END), '[^A-Z0-9]', '', 'g'), '') AS code FROM customer""")
def p13_normalise_code(t: Tables) -> DataFrame:
    messy = F.when(F.col("c_custkey") % 6 == 0, " - ").otherwise(F.concat(F.lit(" "), F.lower("c_name"), F.lit("-x")))
    return t.customer.select("c_custkey", text.normalise_code(messy).alias("code"))


MESSY = "CASE WHEN doc_id % 9 = 0 THEN ' ' WHEN doc_id % 8 = 0 THEN 'NA' WHEN doc_id % 7 = 0 THEN '' ELSE source END"


@query("p14_blanks_to_null", f"""
SELECT doc_id, CASE WHEN trim(lang) IN ('', 'NA') THEN NULL ELSE lang END AS lang, CASE WHEN trim(source) IN ('', 'NA') THEN NULL ELSE source END AS source
FROM (SELECT doc_id, lang, {MESSY} AS source FROM documents)""")
def p14_blanks_to_null(t: Tables) -> DataFrame:
    return clean.blanks_to_null(t.documents.select("doc_id", "lang", F.expr(MESSY).alias("source")))


BROKEN = "CASE WHEN event_id % 13 = 0 THEN CAST('NaN' AS DOUBLE) WHEN event_id % 17 = 0 THEN CAST('Infinity' AS DOUBLE) WHEN event_id % 19 = 0 THEN NULL ELSE value END"


@query("p15_finite_values", f"SELECT event_id, CASE WHEN event_id % 13 = 0 OR event_id % 17 = 0 THEN 0.0 WHEN event_id % 19 = 0 THEN NULL ELSE value END AS value FROM events")
def p15_finite_values(t: Tables) -> DataFrame:
    return clean.finite_columns(t.events.select("event_id", F.expr(BROKEN).alias("value")))


@query("p15_not_finite_counts", "SELECT 'value' AS \"column\", count(*) FILTER (event_id % 13 = 0 OR event_id % 17 = 0) AS n_not_finite FROM events")
def p15_not_finite_counts(t: Tables) -> DataFrame:
    return clean.non_finite_counts(t.events.select("event_id", F.expr(BROKEN).alias("value")))


@query("p16_split_pair", "SELECT event_id, CAST(user_id % 360 - 180 AS DOUBLE) + 0.5 AS lon, CAST(user_id % 170 - 85 AS DOUBLE) AS lat FROM events")
def p16_split_pair(t: Tables) -> DataFrame:
    packed = F.concat((F.col("user_id") % 360 - 180 + F.lit(0.5)).cast("string"), F.lit(", "), (F.col("user_id") % 170 - 85).cast("string"))
    lon, lat = text.split_pair(F.col("packed"))
    return t.events.select("event_id", packed.alias("packed")).select("event_id", lon.alias("lon"), lat.alias("lat"))


@query("p17_hhmm_parts", "SELECT event_id, CAST(hour(ts) AS INTEGER) AS hour, CAST(minute(ts) AS INTEGER) AS minute, CAST(hour(ts) * 60 + minute(ts) AS INTEGER) AS minutes FROM events")
def p17_hhmm_parts(t: Tables) -> DataFrame:
    rows = t.events.select("event_id", time.hhmm(F.col("ts")).alias("c"))
    c = F.col("c")
    return rows.select("event_id", time.hhmm_hour(c).alias("hour"), time.hhmm_minute(c).alias("minute"), time.hhmm_minutes(c).alias("minutes"))


@query("p18_local_instant", "SELECT event_id, date_trunc('minute', ts) + CASE WHEN event_id % 50 = 0 THEN INTERVAL 1 DAY - INTERVAL 1 MINUTE * (hour(ts) * 60 + minute(ts)) ELSE INTERVAL 0 DAY END AS local_ts FROM events")
def p18_local_instant(t: Tables) -> DataFrame:
    """Date plus HHMM; every fiftieth row carries 2400, midnight of the next day."""
    clock = F.when(F.col("event_id") % 50 == 0, 2400).otherwise(time.hhmm(F.col("ts")))
    return t.events.select("event_id", time.local_instant(F.to_date("ts"), clock).alias("local_ts"))


# Zones by user and their offsets from UTC in January, when all sample events lie.
ZONES = (("America/New_York", -5), ("America/Chicago", -6), ("America/Denver", -7), ("America/Los_Angeles", -8))


@query("p19_prediction_instant", "SELECT event_id, ts - INTERVAL 2 HOUR + INTERVAL 1 HOUR * (5 + user_id % 4) AS prediction_utc FROM events")
def p19_prediction_instant(t: Tables) -> DataFrame:
    zone = numeric.ladder([(F.col("user_id") % 4 == i, z) for i, (z, _) in enumerate(ZONES)], "UTC")
    return t.events.select("event_id", "ts", zone.alias("zone")).select(
        "event_id", time.prediction_instant(F.col("ts"), F.col("zone"), 2).alias("prediction_utc"))


@query("p20_ladders", """
SELECT event_id, CASE WHEN month(ts) IN (12, 1, 2) THEN 'Winter' WHEN month(ts) IN (3, 4, 5) THEN 'Spring' WHEN month(ts) IN (6, 7, 8) THEN 'Summer' ELSE 'Fall' END AS season,
       CASE WHEN hour(ts) < 6 THEN 'Early AM (12-6a)' WHEN hour(ts) < 12 THEN 'Morning (6a-12p)' WHEN hour(ts) < 17 THEN 'Afternoon (12-5p)'
            WHEN hour(ts) < 21 THEN 'Evening (5-9p)' ELSE 'Night (9p-12a)' END AS time_block,
       CASE WHEN value > 25 THEN 'Severe' WHEN value > 15 THEN 'Moderate' ELSE 'Clear' END AS condition FROM events""")
def p20_ladders(t: Tables) -> DataFrame:
    condition = numeric.ladder([(F.col("value") > 25, "Severe"), (F.col("value") > 15, "Moderate")], "Clear")
    return t.events.select("event_id", time.season(F.month("ts")).alias("season"), time.time_block(F.hour("ts")).alias("time_block"),
                           condition.alias("condition"))


@query("p21_indicators", """
SELECT event_id, CASE WHEN dayofweek(ts) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend,
       CASE WHEN hour(ts) BETWEEN 6 AND 9 OR hour(ts) BETWEEN 17 AND 20 THEN 1 ELSE 0 END AS is_peak_hour,
       CASE WHEN month(ts) IN (6, 7, 8, 12) THEN 1 ELSE 0 END AS is_peak_month, CASE WHEN month(ts) IN (11, 12, 1) THEN 1 ELSE 0 END AS is_holiday_month,
       CASE WHEN hour(ts) BETWEEN 6 AND 22 THEN 1 ELSE 0 END AS is_business_hours,
       CASE WHEN value < 10 THEN 1 ELSE 0 END AS is_short, CASE WHEN value BETWEEN 10 AND 20 THEN 1 ELSE 0 END AS is_medium,
       CASE WHEN value > 20 THEN 1 ELSE 0 END AS is_long FROM events""")
def p21_indicators(t: Tables) -> DataFrame:
    hour, month, v = F.hour("ts"), F.month("ts"), F.col("value")
    flags = {
        "is_weekend": F.dayofweek("ts").isin(1, 7), "is_peak_hour": hour.between(6, 9) | hour.between(17, 20),
        "is_peak_month": month.isin(6, 7, 8, 12), "is_holiday_month": month.isin(11, 12, 1),
        "is_business_hours": hour.between(6, 22), "is_short": v < 10, "is_medium": v.between(10, 20), "is_long": v > 20,
    }
    return t.events.select("event_id", *[F.when(c, 1).otherwise(0).alias(n) for n, c in flags.items()])


@query("p22_top_value_indicators", """
WITH top AS (SELECT p_brand, row_number() OVER (ORDER BY count(*) DESC, p_brand) AS rn FROM part GROUP BY p_brand)
SELECT p_partkey, CASE WHEN p_brand = (SELECT p_brand FROM top WHERE rn = 1) THEN 1 ELSE 0 END AS p_brand_top1,
       CASE WHEN p_brand = (SELECT p_brand FROM top WHERE rn = 2) THEN 1 ELSE 0 END AS p_brand_top2,
       CASE WHEN p_brand = (SELECT p_brand FROM top WHERE rn = 3) THEN 1 ELSE 0 END AS p_brand_top3 FROM part""")
def p22_top_value_indicators(t: Tables) -> DataFrame:
    return clean.top_value_indicators(t.part.select("p_partkey", "p_brand"), "p_brand", 3).drop("p_brand")


@query("p23_like_ladder", """
SELECT p_partkey, CASE WHEN p_name LIKE '%ring%' THEN 'Ring' WHEN p_name LIKE '%bolt%' THEN 'Bolt' WHEN p_name LIKE 'blue%' THEN 'Blue' ELSE 'Unknown' END AS kind FROM part""")
def p23_like_ladder(t: Tables) -> DataFrame:
    rules = [("%ring%", "Ring"), ("%bolt%", "Bolt"), ("blue%", "Blue")]
    return t.part.select("p_partkey", text.like_ladder(F.col("p_name"), rules, "Unknown").alias("kind"))


@query("p24_name_search", """
SELECT s_suppkey, s_name FROM supplier WHERE upper(s_name) LIKE '%00001%' AND s_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey < 3)""")
def p24_name_search(t: Tables) -> DataFrame:
    """Substring search, and an id list applied as a semi join."""
    ids = t.nation.filter(F.col("n_regionkey") < 3).select(F.col("n_nationkey").alias("s_nationkey"))
    return t.supplier.filter(text.name_contains(F.col("s_name"), ["00001"])).join(ids, "s_nationkey", "left_semi").select("s_suppkey", "s_name")


@query("p25_weighted_score", """
SELECT l_orderkey, l_linenumber, round(coalesce(CASE WHEN l_linenumber = 2 THEN NULL ELSE l_quantity END, 0) + coalesce(l_discount, 0) * 10 + coalesce(l_tax, 0) * -2, 6) AS score FROM lineitem""")
def p25_weighted_score(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_orderkey", "l_linenumber", F.when(F.col("l_linenumber") != 2, F.col("l_quantity")).alias("q"), "l_discount", "l_tax")
    return rows.select("l_orderkey", "l_linenumber", F.round(numeric.weighted_score({"q": 1, "l_discount": 10, "l_tax": -2}), 6).alias("score"))


@query("p26_log_skewed", "SELECT l_orderkey, l_linenumber, steep, l_quantity, round(ln(1 + steep), 9) AS steep_log FROM (SELECT l_orderkey, l_linenumber, l_quantity * l_quantity * l_quantity * l_quantity * l_quantity * l_quantity * l_quantity * l_quantity AS steep, l_quantity FROM lineitem)")
def p26_log_skewed(t: Tables) -> DataFrame:
    square = F.col("l_quantity") * F.col("l_quantity")
    rows = t.lineitem.select("l_orderkey", "l_linenumber", (square * square * square * square).alias("steep"), "l_quantity")
    return clean.log_skewed(rows, ["steep", "l_quantity"]).withColumn("steep_log", F.round("steep_log", 9))


@query("p27_cyclic", """
SELECT event_id, round(sin(2 * pi() * m / 1440), 9) AS day_sin, round(cos(2 * pi() * m / 1440), 9) AS day_cos
FROM (SELECT event_id, hour(ts) * 60 + minute(ts) AS m FROM events)""")
def p27_cyclic(t: Tables) -> DataFrame:
    s, c = numeric.cyclic(time.hhmm_minutes(time.hhmm(F.col("ts"))), 1440)
    return t.events.select("event_id", F.round(s, 9).alias("day_sin"), F.round(c, 9).alias("day_cos"))


@query("p28_interactions", """
SELECT event_id, concat_ws('_', CAST(dayofweek(ts) + 1 AS VARCHAR), CAST(hour(ts) AS VARCHAR)) AS day_hour,
       round(CASE WHEN value > 20 THEN value + (user_id - 50) * 0.1 ELSE value END, 6) AS adjusted FROM events""")
def p28_interactions(t: Tables) -> DataFrame:
    day_hour = text.composite_key(F.dayofweek("ts").cast("string"), F.hour("ts").cast("string"), sep="_")
    adjusted = F.when(F.col("value") > 20, F.col("value") + (F.col("user_id") - 50) * 0.1).otherwise(F.col("value"))
    return t.events.select("event_id", day_hour.alias("day_hour"), F.round(adjusted, 6).alias("adjusted"))


@query("p29_zscore", """
WITH s AS (SELECT avg(l_quantity) AS mq, stddev_samp(l_quantity) AS sq, avg(l_extendedprice) AS mp, stddev_samp(l_extendedprice) AS sp FROM lineitem)
SELECT l_orderkey, l_linenumber, round((l_quantity - mq) / sq, 7) AS l_quantity_z, round((l_extendedprice - mp) / sp, 7) AS l_extendedprice_z FROM lineitem, s""")
def p29_zscore(t: Tables) -> DataFrame:
    rows = t.lineitem.withColumn("constant", F.lit(1.0))
    out = clean.zscore(rows, ["l_quantity", "l_extendedprice", "constant"])
    z = [c for c in out.columns if c.endswith("_z")]
    return out.select("l_orderkey", "l_linenumber", *[F.round(c, 7).alias(c) for c in z])


@query("p30_duration_hours", """
SELECT o_orderkey, l_linenumber, round(epoch_us(l_shipdate) / 3600000000.0 - epoch_us(o_orderdate) / 3600000000.0, 6) AS hours
FROM lineitem JOIN orders ON o_orderkey = l_orderkey""")
def p30_duration_hours(t: Tables) -> DataFrame:
    o = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    out = t.lineitem.select("l_orderkey", "l_linenumber", "l_shipdate").join(o, "l_orderkey")
    return out.select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber",
                      F.round(time.hours_between(F.col("o_orderdate"), F.col("l_shipdate")), 6).alias("hours"))


# ---- imputation ------------------------------------------------------------------------

@query("m1_three_tier", f"""
WITH {DAMAGED_SQL}, d AS (SELECT *, epoch_us(ts) // 1000000 AS sec, CASE WHEN event_id % 3 = 0 THEN NULL ELSE value END AS v FROM damaged)
SELECT event_id, round(coalesce(v, avg(v) OVER (PARTITION BY user_id ORDER BY sec RANGE BETWEEN 86400 PRECEDING AND CURRENT ROW),
                (SELECT quantile_disc(v, 0.5) FROM d)), 6) AS v FROM d""")
def m1_three_tier(t: Tables) -> DataFrame:
    rows = t.events.select("event_id", "user_id", time.epoch_seconds(F.col("ts")).alias("sec"),
                           F.when(F.col("event_id") % 3 != 0, F.col("value")).alias("v"))
    return impute.three_tier(rows, ["user_id"], "sec", ["v"], 86400).select("event_id", F.round("v", 6).alias("v"))


@query("m2_median_fill", """
WITH v AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber <> 1 THEN l_quantity END AS q, CASE WHEN l_linenumber <> 2 THEN l_extendedprice END AS p FROM lineitem)
SELECT l_orderkey, l_linenumber, coalesce(q, (SELECT quantile_disc(q, 0.5) FROM v)) AS q, coalesce(p, (SELECT quantile_disc(p, 0.5) FROM v)) AS p FROM v""")
def m2_median_fill(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_orderkey", "l_linenumber", F.when(F.col("l_linenumber") != 1, F.col("l_quantity")).alias("q"),
                             F.when(F.col("l_linenumber") != 2, F.col("l_extendedprice")).alias("p"))
    return impute.median_fill(rows, ["q", "p"])


@query("m3_unknown_fill", """
SELECT p_partkey, coalesce(CASE WHEN p_partkey % 4 <> 0 THEN p_brand END, 'UNK') AS brand, coalesce(CAST(CASE WHEN p_partkey % 3 <> 0 THEN p_size END AS VARCHAR), 'UNK') AS size FROM part""")
def m3_unknown_fill(t: Tables) -> DataFrame:
    rows = t.part.select("p_partkey", F.when(F.col("p_partkey") % 4 != 0, F.col("p_brand")).alias("brand"),
                         F.when(F.col("p_partkey") % 3 != 0, F.col("p_size")).alias("size"))
    return impute.unknown_fill(rows, ["brand", "size"])


@query("m4_mode_fill", """
WITH v AS (SELECT p_partkey, CASE WHEN p_partkey % 4 <> 0 THEN p_size > 25 END AS big, CASE WHEN p_partkey % 5 <> 0 THEN p_type = 'SMALL' END AS small FROM part)
SELECT p_partkey, coalesce(big, (SELECT big FROM v WHERE big IS NOT NULL GROUP BY big ORDER BY count(*) DESC, big LIMIT 1)) AS big,
       coalesce(small, (SELECT small FROM v WHERE small IS NOT NULL GROUP BY small ORDER BY count(*) DESC, small LIMIT 1)) AS small FROM v""")
def m4_mode_fill(t: Tables) -> DataFrame:
    rows = t.part.select("p_partkey", F.when(F.col("p_partkey") % 4 != 0, F.col("p_size") > 25).alias("big"),
                         F.when(F.col("p_partkey") % 5 != 0, F.col("p_type") == "SMALL").alias("small"))
    return impute.mode_fill(rows, ["big", "small"])


@query("m5_group_mean_fill", """
WITH v AS (SELECT l_orderkey, l_linenumber, l_suppkey, CASE WHEN l_linenumber > 2 AND l_suppkey % 10 <> 0 THEN l_discount END AS d FROM lineitem)
SELECT l_orderkey, l_linenumber, round(coalesce(d, avg(d) OVER (PARTITION BY l_suppkey), 0.2), 9) AS d FROM v""")
def m5_group_mean_fill(t: Tables) -> DataFrame:
    known = (F.col("l_linenumber") > 2) & (F.col("l_suppkey") % 10 != 0)
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", F.when(known, F.col("l_discount")).alias("d"))
    return impute.group_mean_fill(rows, ["l_suppkey"], "d", 0.2).select("l_orderkey", "l_linenumber", F.round("d", 9).alias("d"))


@query("m6_first_event_fill", """
WITH v AS (SELECT event_id, value, CASE WHEN row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1 THEN 1 ELSE 0 END AS f FROM events)
SELECT event_id, f AS is_first, round(CASE WHEN f = 1 THEN (SELECT avg(value) FROM v WHERE f = 0) ELSE value END, 6) AS value FROM v""")
def m6_first_event_fill(t: Tables) -> DataFrame:
    rows = t.events.select("event_id", "user_id", time.epoch_micros(F.col("ts")).alias("at"), "value")
    seen = frames.running_before(rows, ["user_id"], "at", "event_id", {"_n": F.lit(1)})
    flagged = seen.withColumn("is_first", F.when(F.col("_n") == 0, 1).otherwise(0))
    return impute.first_event_fill(flagged, "is_first", "value").select("event_id", "is_first", F.round("value", 6).alias("value"))


@query("m7_ml_imputer", """
WITH v AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber <> 1 THEN l_quantity END AS q FROM lineitem)
SELECT l_orderkey, l_linenumber, coalesce(q, (SELECT quantile_disc(q, 0.5) FROM v)) AS q_imputed FROM v""")
def m7_ml_imputer(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_orderkey", "l_linenumber", F.when(F.col("l_linenumber") != 1, F.col("l_quantity")).alias("q"))
    return impute.ml_impute(rows, ["q"]).drop("q")
