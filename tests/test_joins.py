import math
import random

import pytest
from pyspark.sql import functions as F

from tidegauge.operators import dedup, encode, joins, quantiles, ranking, skew


def km(a, b):
    p, q = math.radians(a[0]), math.radians(b[0])
    h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(b[1] - a[1]) / 2) ** 2
    return round(2 * 6371.0088 * math.atan2(math.sqrt(h), math.sqrt(max(0.0, 1 - h))), 6)


def brute_nearest(points, sites, k):
    out = set()
    for p, la, lo in points:
        ranked = sorted((km((la, lo), (a, b)), s) for s, a, b in sites)[:k]
        out |= {(p, s, i) for i, (_, s) in enumerate(ranked, 1)}
    return out


@pytest.mark.parametrize("k,n_sites", [(1, 30), (3, 60), (5, 4)])
def test_nearest_k(spark, k, n_sites):
    """Poles, the date line, clusters, equal coordinates, and fewer sites than asked for."""
    rng = random.Random(n_sites)
    points = [(i, rng.uniform(-90, 90), rng.uniform(-180, 180)) for i in range(40)]
    points += [(100, 90.0, 0.0), (101, -90.0, 10.0), (102, 10.0, 180.0), (103, 10.0, -180.0), (104, 50.0, 8.0), (105, 50.0, 8.0)]
    sites = [(i, rng.uniform(-90, 90), rng.uniform(-180, 180)) for i in range(n_sites - 2)]
    sites += [(500, 10.0, 179.9), (501, 10.0, -179.9)] if n_sites < 10 else [(500 + i, 50 + i * 1e-4, 8.0) for i in range(2)]
    p = spark.createDataFrame(points, "p int, lat double, lon double")
    s = spark.createDataFrame(sites, "s int, lat double, lon double")
    rows = joins.nearest_k(p, s, k, point_id="p", site_id="s").collect()
    assert {(r.p, r.s, r["rank"]) for r in rows} == brute_nearest(points, sites, k)


def test_nearest_k_many_sites_at_one_place(spark):
    sites = [(i, 1.0, 1.0) for i in range(50)] + [(99, 1.5, 1.0)]
    p = spark.createDataFrame([(1, 1.0, 1.0), (2, None, 3.0)], "p int, lat double, lon double")
    s = spark.createDataFrame(sites, "s int, lat double, lon double")
    rows = joins.nearest_k(p, s, 3, point_id="p", site_id="s").collect()
    assert [(r.p, r.s) for r in sorted(rows, key=lambda r: r["rank"])] == [(1, 0), (1, 1), (1, 2)]


def test_ranked_as_of_falls_back_to_farther_site(spark):
    facts = spark.createDataFrame([(1, "x", 100), (2, "x", 500), (3, "y", 100), (4, "z", 100)], "f int, place string, at long")
    bridge = spark.createDataFrame([("x", "s1", 1), ("x", "s2", 2), ("y", "s3", 1)], "place string, site string, rank int")
    obs = spark.createDataFrame([("s1", 450, 1, 1.0), ("s2", 95, 2, 2.0), ("s2", 99, 3, 3.0), ("s2", 101, 4, 4.0), ("s3", 10, 5, 5.0)],
                                "site string, seen long, oid int, v double")
    out = joins.ranked_as_of(facts, bridge, obs, fact_id="f", place="place", site="site", rank="rank", at="at", obs_time="seen",
                             lookback=60, payload=["v"], tie="oid")
    got = {r.f: (r.site, r["rank"], r.v) for r in out.collect()}
    assert got == {1: ("s2", 2, 3.0), 2: ("s1", 1, 1.0), 3: ("s3", 1, None), 4: (None, None, None)}


def test_attach_is_a_left_join(spark):
    rows = [("hot", i) for i in range(30)] + [("b", 1), ("b", 1), (None, 2), ("c", 3)]
    df = spark.createDataFrame(rows, "k string, x int")
    stats = df.filter("k is null or k <> 'c'").groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.sum("x").alias("s"))
    out = skew.attach(df, stats, ["k"])
    assert out.columns == ["k", "x", "n", "s"]
    want = sorted([(k, x, *{"hot": (30, 435), "b": (2, 2), None: (1, 2), "c": (None, None)}[k]) for k, x in rows], key=repr)
    assert sorted((tuple(r) for r in out.collect()), key=repr) == want


def test_cut_in_time_bounds_every_piece(spark):
    df = spark.createDataFrame([("hot", i) for i in range(1000)] + [("b", 5)], "k string, t long")
    cells, cut = skew.cut_in_time(df, ["k"], "t", 100)
    sizes = {(r.k, r._cell): r["count"] for r in cells.groupBy("k", "_cell").count().collect()}
    assert cut and max(sizes.values()) <= 100 and sizes["b", 0] == 1 and sum(sizes.values()) == 1001


def test_prefer_and_roles(spark):
    a = spark.createDataFrame([(1, "x"), (2, None), (3, None)], "k int, v string")
    b = spark.createDataFrame([(1, "p"), (2, "q")], "k int, v string")
    assert {r.k: r.v for r in joins.prefer(a, b, "k", ["v"]).collect()} == {1: "x", 2: "q", 3: None}
    assert joins.role(a, "o_").columns == ["o_k", "o_v"]


def test_calendar(spark):
    cal = joins.calendar_window(spark, ["2020-01-01", "2020-01-03"], 2)
    assert cal.count() == 7  # Dec 30 to Jan 5
    df = spark.createDataFrame([("2020-01-05",), ("2020-01-06",), (None,)], "d string")
    out = joins.flag_by_calendar(df, F.to_date("d"), cal, "f").collect()
    assert sorted((r.d or "", r.f) for r in out) == [("", 0), ("2020-01-05", 1), ("2020-01-06", 0)]


def test_missing_and_coverage(spark):
    f = spark.createDataFrame([(1,), (1,), (2,), (3,)], "k int")
    d = spark.createDataFrame([(1,), (1,), (9,)], "dk int")
    assert {r.k: r.n_rows for r in joins.missing_keys(f, d, "k", "dk").collect()} == {2: 1, 3: 1}
    assert tuple(joins.key_coverage(f, d, "k", "dk").first()) == (4, 2, 3, 1, 50.0)


def test_attach_splits_null_unseen_and_hot_keys(spark):
    """A third of the rows has no key, a third a key the table doesn't know, a sixth one key: no task holds much of them."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "8",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2"}
    before = {k: spark.conf.get(k) for k in settings if k != "spark.sql.adaptive.autoBroadcastJoinThreshold"}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        i = F.col("id") % 6
        df = spark.range(0, 240_000, 1, 16).select("id", F.sha2(F.col("id").cast("string"), 256).alias("load"), F.when(i < 2, F.lit(None)).when(i < 4, "unseen").when(i == 4, "hot").otherwise((F.col("id") % 997).cast("string")).alias("k"))
        stats = df.filter("k <> 'unseen'").groupBy("k").agg(F.count(F.lit(1)).alias("n"))
        out = skew.attach(df, stats, ["k"])
        rows = out.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("count"), F.max("load")).collect()
        assert sum(r["count"] for r in rows) == 240_000
        assert max(r["count"] for r in rows) <= 0.1 * 240_000
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_exact_quantiles_whatever_the_bracket(spark, monkeypatch):
    rng = random.Random(8)
    values = [rng.choice([1.0, 1.0, 2.0, float(rng.randint(0, 40)), rng.random() * 100]) for _ in range(5_000)] + [None] * 50 + [float("nan")] * 3
    df = spark.createDataFrame([(v, 7.0) for v in values], "x double, y double")
    known = sorted(v for v in values if v is not None and v == v)
    wanted = {f"q{i}": ("x", p) for i, p in enumerate([0.0, 0.001, 0.1, 0.25, 0.5, 0.75, 0.9, 0.999, 1.0])} | {"flat": ("y", 0.3)}
    for rows, error in ((50_000, 5_000), (20, 25), (1, 100)):
        monkeypatch.setattr(quantiles, "EXACT_ROWS", rows)
        monkeypatch.setattr(quantiles, "ERROR", error)
        got = quantiles.exact_quantiles(df, wanted)
        for n, (_, p) in list(wanted.items())[:-1]:
            want = known[max(1, math.ceil(p * len(known))) - 1]
            assert got[n] == want, (n, rows)
        assert got["flat"] == 7.0
    assert quantiles.exact_quantiles(df.limit(0), wanted)["q0"] is None and quantiles.exact_quantiles(df, {}) == {}


def test_dedup(spark):
    df = spark.createDataFrame([("a", "V", 1), ("a", "M", 2), ("a", "M", 3), ("b", "X", 1), ("c", "V", 1), ("c", "V", 1)], "k string, kind string, t int")
    got = {r.k: (r.kind, r.t) for r in dedup.keep_by_priority(df, ["k"], "kind", ["M", "V"], [F.desc("t")]).collect()}
    assert got == {"a": ("M", 3), "c": ("V", 1)}
    assert tuple(dedup.distinct_report(df).first()) == (6, 5, 1)
    assert [(r.k, r.n) for r in dedup.duplicate_groups(df, ["k", "kind", "t"]).collect()] == [("c", 2)]


def test_global_rank_and_cumulative(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice([1.0, 1.0, 1.0, 2.5, -3.0, float(i)])) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, v double")
    want = {i: n for n, (_, i) in enumerate(sorted((-v, i) for i, v in rows))}
    got = {r.id: r["rank"] for r in ranking.global_rank(df, [F.desc("v"), F.asc("id")], partitions=5).collect()}
    assert got == want
    for buckets in (2, 7, 64):
        cum = ranking.cumulative_by_value(df, "v", {"n": F.count(F.lit(1))}, buckets).collect()
        assert {r.v: r.n_before for r in cum} == {v: sum(x < v for _, x in rows) for _, v in rows}


def test_both_ends_breaks_ties_by_key(spark):
    df = spark.createDataFrame([("b", 1), ("a", 1), ("c", 1), ("d", 0)], "w string, n int")
    got = {(r.end, r.place): r.w for r in ranking.both_ends(df, "n", 2, "w").collect()}
    assert got == {("top", 1): "a", ("top", 2): "b", ("bottom", 1): "d", ("bottom", 2): "a"}


def test_target_encoding_sees_training_rows_only(spark):
    train = spark.createDataFrame([("a", 1), ("a", 0), ("b", 1), (None, 1)], "c string, y int")
    other = spark.createDataFrame([("a",), ("b",), ("new",), (None,)], "c string")
    got = {r.c: r.c_te for r in encode.target_encode(train, other, ["c"], "y", 2.0).collect()}
    assert got == {"a": pytest.approx((0.5 * 2 + 0.75 * 2) / 4), "b": pytest.approx((1 + 1.5) / 3), "new": 0.75, None: 0.75}


def test_capped_history(spark):
    df = spark.createDataFrame([("a", "train", 1), ("a", "train", 0), ("a", "test", 1), ("b", "test", 1)], "k string, split string, y int")
    got = {(r.k, r.split): (r.hist_n, r.hist_rate) for r in encode.capped_history(df, ["k"], "split", "y").collect()}
    assert got == {("a", "train"): (2, 0.5), ("a", "test"): (2, 0.5), ("b", "test"): (0, None)}
