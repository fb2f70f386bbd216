"""Joins: as-of, nearest sites, dimensions, calendars, audits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.time import epoch_day, epoch_micros
from ..functions.numeric import haversine_km
from ..operators import dedup, frames, joins, sets, stats
from ..operators.skew import attach
from .registry import Tables, query

HOUR = 3_600_000_000  # microseconds

# Positions are bounded functions of a key, the same here and in the SQL.
GEO = "({k} * {a} % 1700) / 10.0 - 85.0 AS lat, ({k} * {b} % 3600) / 10.0 - 180.0 AS lon"


def place(df: DataFrame, key: str, a: int, b: int) -> DataFrame:
    lat = ((F.col(key) * a) % 1700) / F.lit(10.0) - F.lit(85.0)
    lon = ((F.col(key) * b) % 3600) / F.lit(10.0) - F.lit(180.0)
    return df.withColumns({"lat": lat, "lon": lon})


def km_sql(a: str, b: str) -> str:
    return f"""round(2 * 6371.0088 * atan2(
        sqrt(pow(sin((radians({b}.lat) - radians({a}.lat)) / 2), 2) + cos(radians({a}.lat)) * cos(radians({b}.lat))
             * pow(sin((radians({b}.lon) - radians({a}.lon)) / 2), 2)),
        sqrt(1 - (pow(sin((radians({b}.lat) - radians({a}.lat)) / 2), 2) + cos(radians({a}.lat)) * cos(radians({b}.lat))
             * pow(sin((radians({b}.lon) - radians({a}.lon)) / 2), 2)))), 6)"""


def purchases(t: Tables) -> DataFrame:
    facts = t.events.filter(F.col("event_type") == "purchase")
    return facts.select("event_id", "user_id", "ts", (epoch_micros(F.col("ts")) - 2 * HOUR).alias("at"))


def observations(t: Tables) -> DataFrame:
    seen = t.events.filter(F.col("event_type") != "purchase")
    return seen.select(F.col("user_id").alias("site"), epoch_micros(F.col("ts")).alias("obs_at"),
                       F.col("event_id").alias("obs_id"), F.col("value").alias("obs_value"))


OBS_SQL = """obs AS (SELECT user_id AS site, epoch_us(ts) AS obs_at, event_id AS obs_id, value AS obs_value
            FROM events WHERE event_type <> 'purchase'),
     facts AS (SELECT event_id, user_id, epoch_us(ts) - 7200000000 AS at FROM events WHERE event_type = 'purchase')"""


@query("j4_as_of_own_site", f"""
WITH {OBS_SQL},
     m AS (SELECT f.*, o.obs_at, o.obs_id, o.obs_value,
                  row_number() OVER (PARTITION BY f.event_id ORDER BY o.obs_at DESC NULLS LAST, o.obs_id DESC) AS rn
           FROM facts f LEFT JOIN obs o ON o.site = f.user_id AND o.obs_at <= f.at AND o.obs_at >= f.at - 21600000000)
SELECT event_id, user_id, obs_id, obs_value, (m.at - m.obs_at) // 60000000 AS age_minutes FROM m WHERE rn = 1""")
def j4_as_of_own_site(t: Tables) -> DataFrame:
    """Latest observation of the same user at or before T-2h, at most six hours old."""
    facts = purchases(t).withColumn("site", F.col("user_id"))
    out = frames.as_of(facts, observations(t), ["site"], "at", "obs_at", 6 * HOUR, ["obs_id", "obs_value"], "obs_id")
    age = F.floor((F.col("at") - F.col("obs_at")) / F.lit(60_000_000)).cast("long")
    return out.select("event_id", "user_id", "obs_id", "obs_value", age.alias("age_minutes"))


BRIDGE_SQL = f"""
     u AS (SELECT DISTINCT user_id, {GEO.format(k='user_id', a=37, b=101)} FROM events),
     bridge AS (SELECT a.user_id AS place, b.user_id AS site, {km_sql('a', 'b')} AS dist_km,
                       row_number() OVER (PARTITION BY a.user_id ORDER BY {km_sql('a', 'b')}, b.user_id) AS rank
                FROM u a CROSS JOIN u b QUALIFY rank <= 3)"""


def bridge(t: Tables) -> DataFrame:
    users = place(t.events.select("user_id").distinct(), "user_id", 37, 101)
    sites = users.select(F.col("user_id").alias("site"), "lat", "lon")
    return joins.nearest_k(users, sites, 3, point_id="user_id", site_id="site")


@query("j4_ranked_as_of", f"""
WITH {OBS_SQL}, {BRIDGE_SQL},
     m AS (SELECT f.event_id, f.at, b.site, b.rank, o.obs_at, o.obs_id, o.obs_value,
                  row_number() OVER (PARTITION BY f.event_id
                      ORDER BY (o.obs_at IS NULL), b.rank, o.obs_at DESC, o.obs_id DESC) AS rn
           FROM facts f JOIN bridge b ON b.place = f.user_id
           LEFT JOIN obs o ON o.site = b.site AND o.obs_at <= f.at AND o.obs_at >= f.at - 21600000000)
SELECT f.event_id, f.user_id, m.site, m.rank, m.obs_id, m.obs_value, (m.at - m.obs_at) // 60000000 AS age_minutes
FROM facts f JOIN m ON m.event_id = f.event_id AND m.rn = 1""")
def j4_ranked_as_of(t: Tables) -> DataFrame:
    """Flagship: each purchase with the freshest observation of its nearest site that has one."""
    facts = purchases(t)
    best = joins.ranked_as_of(
        facts, bridge(t), observations(t), fact_id="event_id", place="user_id", site="site", rank="rank", at="at",
        obs_time="obs_at", lookback=6 * HOUR, payload=["obs_id", "obs_value"], tie="obs_id")
    out = facts.join(best, "event_id", "left")
    age = F.floor((F.col("at") - F.col("obs_at")) / F.lit(60_000_000)).cast("long")
    return out.select("event_id", "user_id", "site", "rank", "obs_id", "obs_value", age.alias("age_minutes"))


@query("j3_nearest_k", f"""
WITH p AS (SELECT c_custkey, {GEO.format(k='c_custkey', a=53, b=197)} FROM customer),
     s AS (SELECT s_suppkey, {GEO.format(k='s_suppkey', a=71, b=389)} FROM supplier)
SELECT p.c_custkey, s.s_suppkey, {km_sql('p', 's')} AS dist_km,
       row_number() OVER (PARTITION BY p.c_custkey ORDER BY {km_sql('p', 's')}, s.s_suppkey) AS rank
FROM p CROSS JOIN s QUALIFY rank <= 3""")
def j3_nearest_k(t: Tables) -> DataFrame:
    points = place(t.customer.select("c_custkey"), "c_custkey", 53, 197)
    sites = place(t.supplier.select("s_suppkey"), "s_suppkey", 71, 389)
    return joins.nearest_k(points, sites, 3, point_id="c_custkey", site_id="s_suppkey")


@query("j1_left_enrichment", """
SELECT o.o_orderkey, o.o_custkey, c.c_mktsegment, c.c_nationkey,
       concat_ws('|', CAST(o.o_orderkey AS VARCHAR), c.c_name) AS order_key
FROM orders o LEFT JOIN customer c ON c.c_custkey = o.o_custkey""")
def j1_left_enrichment(t: Tables) -> DataFrame:
    dim = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment", "c_nationkey")
    key = F.concat_ws("|", F.col("o_orderkey").cast("string"), "c_name")
    return t.orders.select("o_orderkey", "o_custkey").join(dim, "o_custkey", "left").select(
        "o_orderkey", "o_custkey", "c_mktsegment", "c_nationkey", key.alias("order_key"))


@query("j2_source_precedence", """
SELECT c.c_custkey, coalesce(CASE WHEN c.c_custkey % 3 = 0 THEN NULL ELSE c.c_mktsegment END, n.n_name) AS label
FROM customer c LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey""")
def j2_source_precedence(t: Tables) -> DataFrame:
    label = F.when(F.col("c_custkey") % 3 != 0, F.col("c_mktsegment"))
    left = t.customer.select("c_custkey", "c_nationkey", label.alias("label"))
    fallback = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("label"))
    return joins.prefer(left, fallback, "c_nationkey", ["label"]).select("c_custkey", "label")


@query("j5_bridge_fan_out", f"""
WITH {BRIDGE_SQL}
SELECT e.event_id, e.user_id, b.site, b.rank, b.dist_km
FROM events e LEFT JOIN bridge b ON b.place = e.user_id""")
def j5_bridge_fan_out(t: Tables) -> DataFrame:
    return t.events.select("event_id", "user_id").join(bridge(t), "user_id", "left").select(
        "event_id", "user_id", "site", "rank", "dist_km")


@query("j6_role_playing", """
SELECT l.l_orderkey, l.l_linenumber, cn.n_name AS dest_n_name, sn.n_name AS origin_n_name
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
JOIN customer c ON c.c_custkey = o.o_custkey JOIN supplier s ON s.s_suppkey = l.l_suppkey
LEFT JOIN nation cn ON cn.n_nationkey = c.c_nationkey LEFT JOIN nation sn ON sn.n_nationkey = s.s_nationkey""")
def j6_role_playing(t: Tables) -> DataFrame:
    """One nation table twice: origin of the supplier and destination of the customer."""
    dim = t.nation.select("n_nationkey", "n_name")
    origin, dest = joins.role(dim, "origin_"), joins.role(dim, "dest_")
    flow = route_rows(t)
    out = flow.join(origin, flow.s_nationkey == origin.origin_n_nationkey, "left")
    out = out.join(dest, flow.c_nationkey == dest.dest_n_nationkey, "left")
    return out.select("l_orderkey", "l_linenumber", "origin_n_name", "dest_n_name")


def route_rows(t: Tables) -> DataFrame:
    """Order lines with the nation of the supplier (origin) and of the customer (destination)."""
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", "l_returnflag", "l_extendedprice")
    suppliers = t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    buyers = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey").join(
        t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey")
    return lines.join(suppliers, "l_suppkey").join(buyers, "l_orderkey")


@query("j7_aggregate_back", """
SELECT l_orderkey, l_linenumber, avg_qty, n_lines, round(l_quantity / avg_qty, 9) AS relative_qty
FROM lineitem JOIN (SELECT l_suppkey, round(avg(l_quantity), 9) AS avg_qty, count(*) AS n_lines
                    FROM lineitem GROUP BY l_suppkey) USING (l_suppkey)""")
def j7_aggregate_back(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity")
    out = joins.aggregate_back(rows, ["l_suppkey"], {
        "avg_qty": F.round(F.avg("l_quantity"), 9), "n_lines": F.count(F.lit(1))})
    return out.select("l_orderkey", "l_linenumber", "avg_qty", "n_lines",
                      F.round(F.col("l_quantity") / F.col("avg_qty"), 9).alias("relative_qty"))


@query("j8_small_aggregate_join", """
SELECT o_orderkey, o_orderpriority, month, mean_price
FROM (SELECT *, month(o_orderdate) AS month FROM orders) o
LEFT JOIN (SELECT o_orderpriority AS p, month(o_orderdate) AS m, round(avg(o_totalprice), 7) AS mean_price
           FROM orders GROUP BY ALL) ON p IS NOT DISTINCT FROM o_orderpriority AND m IS NOT DISTINCT FROM month""")
def j8_small_aggregate_join(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", "o_orderpriority", F.month("o_orderdate").cast("long").alias("month"), "o_totalprice")
    small = rows.groupBy("o_orderpriority", "month").agg(F.round(F.avg("o_totalprice"), 7).alias("mean_price"))
    return attach(rows.drop("o_totalprice"), small, ["o_orderpriority", "month"])


# Fixed dates marked in the calendar of the example.
MARKED_DAYS = ("1995-12-25", "1996-07-04", "1996-12-25", "1997-07-04", "1998-01-01", "1999-11-25", "2000-01-01", "2001-07-04")


@query("j9_calendar_buffer", f"""
WITH marks AS (SELECT CAST(unnest({list(MARKED_DAYS)}) AS DATE) AS d),
     days AS (SELECT DISTINCT CAST(unnest(generate_series(d - INTERVAL 3 DAY, d + INTERVAL 3 DAY, INTERVAL 1 DAY)) AS DATE) AS day
              FROM marks)
SELECT o_orderkey, CASE WHEN day IS NULL THEN 0 ELSE 1 END AS near_holiday
FROM orders LEFT JOIN days ON days.day = CAST(o_orderdate AS DATE)""")
def j9_calendar_buffer(t: Tables) -> DataFrame:
    calendar = joins.calendar_window(t.spark, MARKED_DAYS, 3)
    rows = t.orders.select("o_orderkey", "o_orderdate")
    return joins.flag_by_calendar(rows, F.to_date("o_orderdate"), calendar, "near_holiday").drop("o_orderdate")


KEPT_LINES = """SELECT l_orderkey, l_linenumber, l_partkey, max(l_tax) AS l_tax, max(l_discount) AS l_discount
                FROM lineitem GROUP BY l_orderkey, l_linenumber, l_partkey"""


@query("j10_reattach_columns", f"""
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_quantity, s.l_tax AS l_tax_removed, s.l_discount AS l_discount_removed
FROM lineitem l LEFT JOIN ({KEPT_LINES}) s USING (l_orderkey, l_linenumber, l_partkey)""")
def j10_reattach_columns(t: Tables) -> DataFrame:
    key = ["l_orderkey", "l_linenumber", "l_partkey"]
    source = t.lineitem.groupBy(*key).agg(F.max("l_tax").alias("l_tax"), F.max("l_discount").alias("l_discount"))
    return joins.reattach(t.lineitem.select(*key, "l_quantity"), source, key, ["l_tax", "l_discount"], "_removed")


# Each event has a second place: the one it goes to.
OTHER = "(user_id * 7 + event_id) % 150"


def trips(t: Tables) -> DataFrame:
    """Events as trips: origin, destination, departure and arrival in seconds."""
    to = ((F.col("user_id") * 7 + F.col("event_id")) % 150).alias("dest")
    start = F.floor(epoch_micros(F.col("ts")) / F.lit(1_000_000)).cast("long")
    return t.events.select("event_id", F.col("user_id").alias("origin"), to, start.alias("dep"),
                           (start + 1800 + F.col("event_id") % 7200).alias("arr"), "event_type")


TRIPS_SQL = f"""trips AS (SELECT event_id, user_id AS origin, {OTHER} AS dest, epoch_us(ts) // 1000000 AS dep,
                          epoch_us(ts) // 1000000 + 1800 + event_id % 7200 AS arr, event_type FROM events)"""


@query("j11_oncoming_count", f"""
WITH {TRIPS_SQL}
SELECT a.event_id, count(b.event_id) AS n_oncoming
FROM trips a LEFT JOIN trips b ON b.dest = a.origin AND b.arr BETWEEN a.dep - 7200 AND a.dep
GROUP BY a.event_id""")
def j11_oncoming_count(t: Tables) -> DataFrame:
    """Trips that arrived at the place of departure in the two hours before."""
    trip = trips(t)
    arrivals = trip.select(F.col("dest").alias("origin"), "arr")
    out = frames.preceding_stats(trip.select("event_id", "origin", "dep"), arrivals, ["origin"], "dep", "arr", 7200, 0,
                                 {"n_oncoming": frames.Stat("count", F.lit(1))})
    return out.select("event_id", "n_oncoming")


@query("j13_membership", """
SELECT doc_id, lang, CASE WHEN doc_id IN (SELECT doc_id FROM labels WHERE toxic = 0) THEN 1 ELSE 0 END AS kept
FROM documents""")
def j13_membership(t: Tables) -> DataFrame:
    """Rows inside (semi join) and outside (anti join) a key set."""
    docs, good = t.documents.select("doc_id", "lang"), t.labels.filter(F.col("toxic") == 0).select("doc_id")
    inside = docs.join(good, "doc_id", "left_semi").withColumn("kept", F.lit(1))
    return inside.unionByName(docs.join(good, "doc_id", "left_anti").withColumn("kept", F.lit(0)))


@query("j14_key_coverage", """
WITH dim AS (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'MACHINERY'),
     g AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey)
SELECT CAST(sum(n) AS BIGINT) AS n_rows, CAST(coalesce(sum(n) FILTER (c_custkey IS NOT NULL), 0) AS BIGINT) AS matched_rows,
       count(*) AS n_keys, count(c_custkey) AS matched_keys,
       round(100.0 * sum(n) FILTER (c_custkey IS NOT NULL) / sum(n), 6) AS coverage_pct
FROM g LEFT JOIN dim ON c_custkey = o_custkey""")
def j14_key_coverage(t: Tables) -> DataFrame:
    dim = t.customer.filter(F.col("c_mktsegment") != "MACHINERY")
    return joins.key_coverage(t.orders, dim, "o_custkey", "c_custkey")


@query("j14_missing_keys", """
SELECT o_custkey, count(*) AS n_rows FROM orders
WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'MACHINERY') GROUP BY o_custkey""")
def j14_missing_keys(t: Tables) -> DataFrame:
    dim = t.customer.filter(F.col("c_mktsegment") != "MACHINERY")
    return joins.missing_keys(t.orders, dim, "o_custkey", "c_custkey")


@query("j14_distance_over_limit", f"""
WITH {BRIDGE_SQL}
SELECT count(*) AS n, count(*) FILTER (rank = 3 AND dist_km > 500) AS third_far,
       count(*) FILTER (dist_km > 500) AS far, max(dist_km) AS max_km FROM bridge""")
def j14_distance_over_limit(t: Tables) -> DataFrame:
    far = F.col("dist_km") > 500
    return bridge(t).agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when((F.col("rank") == 3) & far, 1)).alias("third_far"),
        F.count(F.when(far, 1)).alias("far"), F.max("dist_km").alias("max_km"))


PRIORITY = ("click", "view", "signup")


@query("d4_priority_dedup", """
SELECT * EXCLUDE (rn) FROM (
  SELECT event_id, user_id, event_type, date_trunc('day', ts) AS day,
         row_number() OVER (PARTITION BY user_id, date_trunc('day', ts)
             ORDER BY CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 2 ELSE 3 END, ts DESC, event_id DESC) AS rn
  FROM events WHERE event_type IN ('click', 'view', 'signup')) WHERE rn = 1""")
def d4_priority_dedup(t: Tables) -> DataFrame:
    rows = t.events.withColumn("day", F.date_trunc("day", "ts").cast("timestamp_ntz"))
    best = dedup.keep_by_priority(rows, ["user_id", "day"], "event_type", PRIORITY, [F.desc("ts"), F.desc("event_id")])
    return best.select("event_id", "user_id", "event_type", "day")


DOUBLED = "(SELECT lang, source, n_chars, text, doc_id FROM documents UNION ALL SELECT lang, source, n_chars, text, doc_id FROM documents WHERE doc_id % 10 = 0)"


def doubled(t: Tables) -> DataFrame:
    """Documents with every tenth one present twice."""
    docs = t.documents.select("lang", "source", "n_chars", "text", "doc_id")
    return docs.union(docs.filter(F.col("doc_id") % 10 == 0))


@query("d1_distinct_rows", f"SELECT DISTINCT doc_id, lang, source, n_chars, md5(text) AS digest FROM {DOUBLED}")
def d1_distinct_rows(t: Tables) -> DataFrame:
    return dedup.distinct_rows(doubled(t).select("doc_id", "lang", "source", "n_chars", F.md5("text").alias("digest")))


@query("d1_distinct_report", f"""
SELECT count(*) AS rows_before, count(DISTINCT (doc_id, lang, source, n_chars, text)) AS rows_after,
       count(*) - count(DISTINCT (doc_id, lang, source, n_chars, text)) AS rows_removed FROM {DOUBLED}""")
def d1_distinct_report(t: Tables) -> DataFrame:
    return dedup.distinct_report(doubled(t))


@query("d2_keep_first_per_key", f"""
SELECT lang, source, doc_id, n_chars FROM {DOUBLED}
QUALIFY row_number() OVER (PARTITION BY lang, source ORDER BY n_chars DESC, doc_id) = 1""")
def d2_keep_first_per_key(t: Tables) -> DataFrame:
    return dedup.keep_first(doubled(t).drop("text"), ["lang", "source"], [F.desc("n_chars"), F.asc("doc_id")])


@query("d3_duplicate_groups", "SELECT md5(text) AS digest, count(*) AS n FROM documents GROUP BY text HAVING count(*) > 1")
def d3_duplicate_groups(t: Tables) -> DataFrame:
    return dedup.duplicate_groups(t.documents.select(F.md5("text").alias("digest")), ["digest"])


FIRST, SECOND = "o_orderdate < TIMESTAMP '1998-01-01'", "o_orderdate >= TIMESTAMP '1997-01-01'"


@query("u1_union_by_position", f"""
SELECT o_orderkey AS key, o_totalprice AS amount FROM orders WHERE {FIRST}
UNION ALL SELECT o_custkey, o_totalprice FROM orders WHERE {SECOND}""")
def u1_union_by_position(t: Tables) -> DataFrame:
    a = t.orders.filter(FIRST.replace("TIMESTAMP", "TIMESTAMP_NTZ")).select(F.col("o_orderkey").alias("key"), F.col("o_totalprice").alias("amount"))
    return a.union(t.orders.filter(SECOND.replace("TIMESTAMP", "TIMESTAMP_NTZ")).select("o_custkey", "o_totalprice"))


@query("u2_union_by_name", f"""
SELECT o_orderkey, o_orderstatus, NULL AS o_orderpriority FROM orders WHERE {FIRST}
UNION ALL BY NAME SELECT o_orderkey, o_orderpriority FROM orders WHERE {SECOND}""")
def u2_union_by_name(t: Tables) -> DataFrame:
    a = t.orders.filter(FIRST.replace("TIMESTAMP", "TIMESTAMP_NTZ")).select("o_orderkey", "o_orderstatus")
    b = t.orders.filter(SECOND.replace("TIMESTAMP", "TIMESTAMP_NTZ")).select("o_orderkey", "o_orderpriority")
    return a.unionByName(b, allowMissingColumns=True)


@query("u3_distinct_ids", "SELECT l_suppkey AS id FROM lineitem UNION SELECT l_partkey FROM lineitem")
def u3_distinct_ids(t: Tables) -> DataFrame:
    return sets.all_ids(t.lineitem, "l_suppkey", "l_partkey")


@query("u4_difference", "SELECT l_partkey AS id FROM lineitem EXCEPT SELECT l_suppkey FROM lineitem")
def u4_difference(t: Tables) -> DataFrame:
    parts = t.lineitem.select(F.col("l_partkey").alias("id"))
    return sets.only_in_first(parts, t.lineitem.select(F.col("l_suppkey").alias("id")), "id")


@query("u5_overlap", """
WITH a AS (SELECT DISTINCT l_partkey AS id FROM lineitem WHERE l_returnflag = 'R'),
     b AS (SELECT DISTINCT l_partkey AS id FROM lineitem WHERE l_quantity > 40)
SELECT count(*) AS n_first, count(b.id) AS n_shared, round(100.0 * count(b.id) / count(*), 6) AS overlap_pct
FROM a LEFT JOIN b USING (id)""")
def u5_overlap(t: Tables) -> DataFrame:
    lines = t.lineitem.withColumn("id", F.col("l_partkey"))
    return sets.overlap(lines.filter(F.col("l_returnflag") == "R"), lines.filter(F.col("l_quantity") > 40), "id")
