"""Time frames, lags, running totals, capped history, ranks and sorts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.numeric import ratio
from ..functions.time import epoch_day, epoch_micros, epoch_seconds, gap_class
from ..operators import encode, frames, joins, ranking, stats
from ..operators.frames import Stat
from ..operators.skew import attach
from .enrichment import TRIPS_SQL, trips
from .registry import Tables, query

DAY_S, HOUR_S = 86_400, 3_600

E_SQL = """e AS (SELECT event_id, user_id, event_type, value, ts, epoch_us(ts) // 1000000 AS sec, epoch_us(ts) AS us,
                 CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS late FROM events)"""


def timed(t: Tables) -> DataFrame:
    late = F.when(F.col("event_type") == "error", 1).otherwise(0)
    return t.events.select("event_id", "user_id", "event_type", "value", "ts", epoch_seconds(F.col("ts")).alias("sec"),
                           epoch_micros(F.col("ts")).alias("us"), late.alias("late"))


@query("w1_pick_latest", f"""WITH {E_SQL} SELECT user_id, event_id, value FROM e QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY us DESC, event_id DESC) = 1""")
def w1_pick_latest(t: Tables) -> DataFrame:
    out = ranking.top_per_group(timed(t), ["user_id"], [F.desc("us"), F.desc("event_id")], 1)
    return out.select("user_id", "event_id", "value")


def over(part: str, start: int, end: int) -> str:
    return f"(PARTITION BY {part} ORDER BY sec RANGE BETWEEN {start} PRECEDING AND {end} PRECEDING)"


@query("w2_rolling_counts", f"""
WITH {E_SQL}
SELECT event_id, count(*) OVER w AS n, CAST(coalesce(sum(late) OVER w, 0) AS BIGINT) AS n_late,
       CASE WHEN count(*) OVER w > 0 THEN round(1.0 * sum(late) OVER w / count(*) OVER w, 9) ELSE 0 END AS late_share,
       round(stddev_samp(late) OVER w, 7) AS late_spread
FROM e WINDOW w AS {over('user_id', DAY_S, 2 * HOUR_S)}""")
def w2_rolling_counts(t: Tables) -> DataFrame:
    """Last day up to two hours ago: volume, positives, share and spread."""
    out = frames.rolling(timed(t), ["user_id"], "sec", DAY_S, 2 * HOUR_S, {
        "n": Stat("count", F.lit(1)), "n_late": Stat("sum", F.col("late")), "late_share": Stat("ratio", F.col("late")),
        "late_spread": Stat("stddev", F.col("late"))})
    return out.select("event_id", "n", F.coalesce("n_late", F.lit(0)).alias("n_late"), F.round("late_share", 9).alias("late_share"),
                      F.round("late_spread", 7).alias("late_spread"))


@query("w3_rolling_means", f"""
WITH {E_SQL}
SELECT event_id, round(avg(value) OVER {over('user_id', DAY_S, 100)}, 6) AS by_user,
       round(avg(value) OVER {over('user_id, event_type', DAY_S, 100)}, 6) AS by_user_type FROM e""")
def w3_rolling_means(t: Tables) -> DataFrame:
    one = frames.rolling(timed(t), ["user_id"], "sec", DAY_S, 100, {"by_user": Stat("avg", F.col("value"))})
    two = frames.rolling(one, ["user_id", "event_type"], "sec", DAY_S, 100, {"by_user_type": Stat("avg", F.col("value"))})
    return two.select("event_id", F.round("by_user", 6).alias("by_user"), F.round("by_user_type", 6).alias("by_user_type"))


@query("w4_rolling_to_now", f"""
WITH {E_SQL} SELECT event_id, round(avg(value) OVER {over('user_id', DAY_S, 0)}, 6) AS mean_24h FROM e""")
def w4_rolling_to_now(t: Tables) -> DataFrame:
    out = frames.rolling(timed(t), ["user_id"], "sec", DAY_S, 0, {"mean_24h": Stat("avg", F.col("value"))})
    return out.select("event_id", F.round("mean_24h", 6).alias("mean_24h"))


@query("w5_congestion", f"""
WITH {E_SQL}
SELECT event_id, count(*) OVER w AS n_recent, CAST(coalesce(sum(late) OVER w, 0) AS BIGINT) AS late_recent,
       CAST(coalesce(sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) OVER w, 0) AS BIGINT) AS clicks_recent
FROM e WINDOW w AS {over('event_type', 2 * HOUR_S, 1)}""")
def w5_congestion(t: Tables) -> DataFrame:
    """The two hours before, own instant excluded, over a key with few values."""
    out = frames.rolling(timed(t), ["event_type"], "sec", 2 * HOUR_S, 1, {
        "n_recent": Stat("count", F.lit(1)), "late_recent": Stat("count", F.when(F.col("late") == 1, 1)),
        "clicks_recent": Stat("count", F.when(F.col("event_type") == "click", 1))})
    return out.select("event_id", "n_recent", "late_recent", "clicks_recent")


@query("w6_counterpart_volume", f"""
WITH {TRIPS_SQL}
SELECT event_id, count(*) OVER (PARTITION BY dest ORDER BY dep RANGE BETWEEN 7200 PRECEDING AND CURRENT ROW) AS n_same_dest FROM trips""")
def w6_counterpart_volume(t: Tables) -> DataFrame:
    out = frames.rolling(trips(t), ["dest"], "dep", 2 * HOUR_S, 0, {"n_same_dest": Stat("count", F.lit(1))})
    return out.select("event_id", "n_same_dest")


O_SQL = """o AS (SELECT o_orderkey, o_custkey, o_orderpriority, o_orderstatus, o_totalprice, date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS day,
                 CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS hit FROM orders)"""


def dated(t: Tables) -> DataFrame:
    hit = F.when(F.col("o_orderstatus") == "F", 1).otherwise(0)
    return t.orders.select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus", "o_totalprice",
                           epoch_day(F.col("o_orderdate")).alias("day"), hit.alias("hit"))


def days(part: str, start: int, end: int) -> str:
    return f"(PARTITION BY {part} ORDER BY day RANGE BETWEEN {start} PRECEDING AND {end} PRECEDING)"


@query("w7_thirty_day_volume", f"WITH {O_SQL} SELECT o_orderkey, count(*) OVER {days('o_orderpriority', 29, 0)} AS n_30d FROM o")
def w7_thirty_day_volume(t: Tables) -> DataFrame:
    out = frames.rolling_by_day(dated(t), ["o_orderpriority"], "day", 29, 0, {"n_30d": Stat("count", F.lit(1))})
    return out.select("o_orderkey", "n_30d")


@query("w8_year_rate", f"""
WITH {O_SQL} SELECT o_orderkey, round(coalesce(avg(hit) OVER {days('o_custkey', 365, 1)}, avg(hit) OVER (PARTITION BY o_orderpriority), 0.2), 9) AS rate FROM o""")
def w8_year_rate(t: Tables) -> DataFrame:
    """Rate over the year before today, else the mean of a coarser group, else a constant."""
    out = frames.rolling_by_day(dated(t), ["o_custkey"], "day", 365, 1, {"_y": Stat("avg", F.col("hit"))})
    out = joins.aggregate_back(out, ["o_orderpriority"], {"_g": F.avg("hit")})
    return out.select("o_orderkey", F.round(F.coalesce("_y", "_g", F.lit(0.2)), 9).alias("rate"))


@query("w9_pair_volume", f"WITH {O_SQL} SELECT o_orderkey, count(*) OVER {days('o_custkey, o_orderpriority', 365, 0)} AS n_year FROM o")
def w9_pair_volume(t: Tables) -> DataFrame:
    out = frames.rolling_by_day(dated(t), ["o_custkey", "o_orderpriority"], "day", 365, 0, {"n_year": Stat("count", F.lit(1))})
    return out.select("o_orderkey", "n_year")


LAGS = {"prev_value": "value", "prev_us": "us", "prev_late": "late"}


@query("w10_previous_event", f"""
WITH {E_SQL} SELECT event_id, lag(value) OVER w AS prev_value, lag(us) OVER w AS prev_us, lag(late) OVER w AS prev_late
FROM e WINDOW w AS (PARTITION BY user_id ORDER BY us, event_id)""")
def w10_previous_event(t: Tables) -> DataFrame:
    return frames.previous(timed(t), ["user_id"], "us", "event_id", LAGS).select("event_id", *LAGS)


@query("w11_turnaround", f"""
WITH {E_SQL}, g AS (SELECT event_id, (us - lag(us) OVER (PARTITION BY user_id ORDER BY us, event_id)) / 3600000000.0 AS h FROM e)
SELECT event_id, round(h, 6) AS gap_hours, CASE WHEN h < 1 THEN 'Quick (<1h)' WHEN h < 3 THEN 'Normal (1-3h)' WHEN h < 6 THEN 'Long (3-6h)'
  WHEN h >= 6 THEN 'Very Long (>6h)' END AS gap_class FROM g""")
def w11_turnaround(t: Tables) -> DataFrame:
    out = frames.previous(timed(t), ["user_id"], "us", "event_id", {"prev_us": "us"})
    gap = (F.col("us") - F.col("prev_us")) / F.lit(3.6e9)
    return out.select("event_id", F.round(gap, 6).alias("gap_hours"), gap_class(gap).alias("gap_class"))


@query("w12_first_event", f"""
WITH {E_SQL} SELECT event_id, CASE WHEN row_number() OVER (PARTITION BY user_id ORDER BY us, event_id) = 1 THEN 1 ELSE 0 END AS is_first FROM e""")
def w12_first_event(t: Tables) -> DataFrame:
    out = frames.running_before(timed(t), ["user_id"], "us", "event_id", {"_n": F.lit(1)})
    return out.select("event_id", F.when(F.col("_n") == 0, 1).otherwise(0).alias("is_first"))


@query("w13_partition_stats", """
SELECT l_orderkey, l_linenumber, round(avg(l_discount) OVER (PARTITION BY l_suppkey), 9) AS mean_discount, count(*) OVER (PARTITION BY l_suppkey) AS n FROM lineitem""")
def w13_partition_stats(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", "l_discount")
    out = joins.aggregate_back(rows, ["l_suppkey"], {"mean_discount": F.round(F.avg("l_discount"), 9), "n": F.count(F.lit(1))})
    return out.drop("l_suppkey", "l_discount")


@query("w14_prior_day_rate", f"""
WITH {E_SQL}, d AS (SELECT user_id, CAST(ts AS DATE) AS day, avg(late) AS rate FROM e GROUP BY ALL),
     p AS (SELECT user_id, day, lag(rate) OVER (PARTITION BY user_id ORDER BY day) AS prior FROM d)
SELECT event_id, round(prior, 9) AS prior_day_rate
FROM e LEFT JOIN p ON p.user_id IS NOT DISTINCT FROM e.user_id AND p.day IS NOT DISTINCT FROM CAST(e.ts AS DATE)""")
def w14_prior_day_rate(t: Tables) -> DataFrame:
    """Rate of the entity's previous active day: aggregate per day, step over days, join back."""
    rows = timed(t).withColumn("day", F.to_date("ts"))
    daily = rows.groupBy("user_id", "day").agg(F.avg("late").alias("rate"))
    prior = daily.withColumn("prior", F.lag("rate").over(W.partitionBy("user_id").orderBy("day"))).drop("rate")
    return attach(rows, prior, ["user_id", "day"]).select("event_id", F.round("prior", 9).alias("prior_day_rate"))


TODAY = "(PARTITION BY user_id, CAST(ts AS DATE) ORDER BY us, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"


@query("w15_running_today", f"""
WITH {E_SQL} SELECT event_id, CAST(coalesce(count(*) OVER w, 0) AS BIGINT) AS n_before, CAST(coalesce(sum(late) OVER w, 0) AS BIGINT) AS late_before FROM e WINDOW w AS {TODAY}""")
def w15_running_today(t: Tables) -> DataFrame:
    return today(t).select("event_id", "n_before", "late_before")


def today(t: Tables) -> DataFrame:
    rows = timed(t).withColumn("day", F.to_date("ts"))
    return frames.running_before(rows, ["user_id", "day"], "us", "event_id",
                                 {"n_before": F.lit(1), "late_before": F.col("late")})


@query("w16_smoothed_prior", f"""
WITH {E_SQL} SELECT event_id, round((coalesce(sum(late) OVER w, 0) + 0.5) / (count(*) OVER w + 1), 9) AS prior_share FROM e WINDOW w AS {TODAY}""")
def w16_smoothed_prior(t: Tables) -> DataFrame:
    share = (F.col("late_before") + F.lit(0.5)) / (F.col("n_before") + 1)
    return today(t).select("event_id", F.round(share, 9).alias("prior_share"))


@query("w17_history_share", f"""
WITH {E_SQL} SELECT event_id, round(1 - avg(late) OVER (PARTITION BY user_id ORDER BY us, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 9) AS on_time_share FROM e""")
def w17_history_share(t: Tables) -> DataFrame:
    out = frames.running_before(timed(t), ["user_id"], "us", "event_id", {"n": F.lit(1), "bad": F.col("late")})
    return out.select("event_id", F.round(1 - ratio(F.col("bad"), F.col("n")), 9).alias("on_time_share"))


@query("w18_same_hour_history", f"""
WITH {E_SQL}, h AS (SELECT event_type, dayofweek(ts) AS dow, hour(ts) AS hr, date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS day, count(*) AS n FROM e GROUP BY ALL),
     m AS (SELECT *, avg(n) OVER (PARTITION BY event_type, dow, hr ORDER BY day RANGE BETWEEN 365 PRECEDING AND 1 PRECEDING) AS usual FROM h)
SELECT event_type, CAST(hr AS BIGINT) AS hr, CAST(day AS BIGINT) AS day, n, round(usual, 9) AS usual, round(CASE WHEN usual > 0 THEN n / usual ELSE 1.0 END, 9) AS congestion FROM m""")
def w18_same_hour_history(t: Tables) -> DataFrame:
    """Volume of an hour against the same weekday and hour over the year before."""
    rows = timed(t).select("event_type", F.dayofweek("ts").alias("dow"), F.hour("ts").cast("long").alias("hr"),
                           epoch_day(F.col("ts")).cast("long").alias("day"))
    hourly = rows.groupBy("event_type", "dow", "hr", "day").agg(F.count(F.lit(1)).alias("n"))
    out = frames.rolling_by_day(hourly, ["event_type", "dow", "hr"], "day", 365, 1, {"usual": Stat("avg", F.col("n"))})
    load = F.when(F.col("usual") > 0, F.col("n") / F.col("usual")).otherwise(F.lit(1.0))
    return out.select("event_type", "hr", "day", "n", F.round("usual", 9).alias("usual"), F.round(load, 9).alias("congestion"))


@query("w19_local_range", f"""
WITH {E_SQL}, r AS (SELECT event_id, max(value) OVER w - min(value) OVER w AS spread FROM e WINDOW w AS {over('user_id', 3 * HOUR_S, 0)})
SELECT event_id, round(spread, 6) AS spread, CASE WHEN spread > 5 THEN 1 ELSE 0 END AS rapid_change FROM r""")
def w19_local_range(t: Tables) -> DataFrame:
    out = frames.rolling(timed(t), ["user_id"], "sec", 3 * HOUR_S, 0, {"hi": Stat("max", F.col("value")), "lo": Stat("min", F.col("value"))})
    spread = F.col("hi") - F.col("lo")
    return out.select("event_id", F.round(spread, 6).alias("spread"), F.when(spread > 5, 1).otherwise(0).alias("rapid_change"))


@query("w20_capped_history", f"""
WITH {O_SQL}, s AS (SELECT o.*, CASE WHEN day < date_diff('day', DATE '1970-01-01', DATE '1999-01-01') THEN 'train' ELSE 'test' END AS split FROM o),
     h AS (SELECT o_custkey, count(*) AS n, sum(hit) AS p FROM s WHERE split = 'train' GROUP BY o_custkey)
SELECT o_orderkey, split, coalesce(n, 0) AS hist_n, round(1.0 * p / n, 9) AS hist_rate FROM s LEFT JOIN h USING (o_custkey)""")
def w20_capped_history(t: Tables) -> DataFrame:
    cut = F.date_diff(F.lit("1999-01-01").cast("date"), F.lit("1970-01-01").cast("date"))
    rows = dated(t).withColumn("split", F.when(F.col("day") < cut, "train").otherwise("test"))
    out = encode.capped_history(rows, ["o_custkey"], "split", "hit")
    return out.select("o_orderkey", "split", "hist_n", F.round("hist_rate", 9).alias("hist_rate"))


@query("w21_same_day_arrivals", f"""
WITH {TRIPS_SQL}
SELECT a.event_id, count(b.event_id) AS n_arrived FROM trips a
LEFT JOIN trips b ON b.dest = a.origin AND b.arr BETWEEN a.dep - 7200 AND a.dep - 1 AND b.arr // 86400 = a.dep // 86400 GROUP BY a.event_id""")
def w21_same_day_arrivals(t: Tables) -> DataFrame:
    """Arrivals at the place of departure on the same day in the two hours before."""
    trip = trips(t)
    probes = trip.select("event_id", "origin", F.floor(F.col("dep") / DAY_S).alias("day"), "dep")
    events = trip.select(F.col("dest").alias("origin"), F.floor(F.col("arr") / DAY_S).alias("day"), "arr")
    out = frames.preceding_stats(probes, events, ["origin", "day"], "dep", "arr", 2 * HOUR_S, 1, {"n_arrived": Stat("count", F.lit(1))})
    return out.select("event_id", "n_arrived")


@query("w22_partition_total_share", """
SELECT o_orderpriority, o_orderstatus, count(*) AS n, CAST(sum(count(*)) OVER (PARTITION BY o_orderpriority) AS BIGINT) AS total,
       round(1.0 * count(*) / sum(count(*)) OVER (PARTITION BY o_orderpriority), 9) AS probability FROM orders GROUP BY o_orderpriority, o_orderstatus""")
def w22_partition_total_share(t: Tables) -> DataFrame:
    return stats.conditional_table(t.orders, "o_orderpriority", "o_orderstatus")


@query("a32_conditional_probability", f"""
WITH {E_SQL}, p AS (SELECT late, lag(late) OVER (PARTITION BY user_id ORDER BY us, event_id) AS prev_late FROM e)
SELECT prev_late, late, count(*) AS n, CAST(sum(count(*)) OVER (PARTITION BY prev_late) AS BIGINT) AS total, round(1.0 * count(*) / sum(count(*)) OVER (PARTITION BY prev_late), 9) AS probability
FROM p WHERE prev_late IS NOT NULL GROUP BY prev_late, late""")
def a32_conditional_probability(t: Tables) -> DataFrame:
    out = frames.previous(timed(t), ["user_id"], "us", "event_id", {"prev_late": "late"})
    return stats.conditional_table(out.filter(F.col("prev_late").isNotNull()), "prev_late", "late")


# ---- sorts and ranks -------------------------------------------------------------------

@query("t1_top_n", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def t1_top_n(t: Tables) -> DataFrame:
    return ranking.top_n(t.orders.select("o_orderkey", "o_totalprice"), "o_totalprice", 20, "o_orderkey")


@query("t6_total_order", """
SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) - 1 AS place FROM orders""")
def t6_total_order(t: Tables) -> DataFrame:
    """Total order by sampled range partitions; the place makes the order checkable."""
    return ranking.global_rank(t.orders.select("o_orderkey", "o_totalprice"), [F.desc("o_totalprice"), F.asc("o_orderkey")], "place")
