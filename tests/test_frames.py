"""Frames against plain Python, with ordinary and with split keys."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from tidegauge.operators import frames
from tidegauge.operators.frames import Stat


def make(seed, n=160, keys=("a", "b", None), span=400):
    """Rows with ties in time, one key far busier than the others."""
    rng = random.Random(seed)
    return [(i, rng.choices(keys, [8, 1, 1])[0], rng.randrange(span), float(rng.randrange(50)), rng.randrange(2)) for i in range(n)]


@pytest.fixture(scope="module")
def rows():
    return make(1)


@pytest.fixture(scope="module")
def df(spark, rows):
    return spark.createDataFrame(rows, "id int, k string, t long, v double, y int").cache()


def within(rows, r, start, end):
    return [x for x in rows if x[1] == r[1] and r[2] - start <= x[2] <= r[2] - end]


@pytest.mark.parametrize("start,end,cell", [(30, 5, None), (30, 0, 30), (100, 100, None), (7, 1, 1000)])
def test_rolling(df, rows, start, end, cell):
    stats = {"n": Stat("count", F.lit(1)), "s": Stat("sum", F.col("y")), "m": Stat("avg", F.col("v")), "r": Stat("ratio", F.col("y")),
             "d": Stat("stddev", F.col("v")), "lo": Stat("min", F.col("v")), "hi": Stat("max", F.col("v"))}
    got = {r.id: r for r in frames.rolling(df, ["k"], "t", start, end, stats, cell).collect()}
    assert len(got) == len(rows)
    for r in rows:
        w = within(rows, r, start, end)
        g = got[r[0]]
        v = [x[3] for x in w]
        assert g.n == len(w)
        assert g.s == (sum(x[4] for x in w) if w else None)
        assert g.m == (pytest.approx(sum(v) / len(v)) if w else None)
        assert g.r == (pytest.approx(sum(x[4] for x in w) / len(w)) if w else 0)
        assert g.d == (pytest.approx(statistics.stdev(v), abs=1e-9) if len(w) > 1 else None)
        assert (g.lo, g.hi) == ((min(v), max(v)) if w else (None, None))


def test_rolling_edge_of_frame(spark):
    df = spark.createDataFrame([(1, "a", 0), (2, "a", 7200), (3, "a", 7201), (4, "a", 7200)], "id int, k string, t long")
    out = frames.rolling(df, ["k"], "t", 7200, 1, {"n": Stat("count", F.lit(1))})
    assert {r.id: r.n for r in out.collect()} == {1: 0, 2: 1, 3: 2, 4: 1}


def test_rolling_ignores_null_values(spark):
    df = spark.createDataFrame([(1, "a", 0, None), (2, "a", 1, 4.0), (3, "a", 2, None)], "id int, k string, t long, v double")
    out = frames.rolling(df, ["k"], "t", 10, 0, {"m": Stat("avg", F.col("v")), "n": Stat("count", F.col("v"))})
    assert {r.id: (r.m, r.n) for r in out.collect()} == {1: (None, 0), 2: (4.0, 1), 3: (4.0, 1)}


def test_rolling_by_day(df, rows):
    stats = {"n": Stat("count", F.lit(1)), "s": Stat("sum", F.col("v")), "m": Stat("avg", F.col("y"))}
    for g in frames.rolling_by_day(df, ["k"], "t", 40, 1, stats).collect():
        w = within(rows, (g.id, g.k, g.t), 40, 1)
        assert g.n == len(w)
        assert g.s == (pytest.approx(sum(x[3] for x in w)) if w else None)
        assert g.m == (pytest.approx(sum(x[4] for x in w) / len(w)) if w else None)


def test_preceding_stats(spark, df, rows):
    others = make(2, 90)
    events = spark.createDataFrame(others, "id int, k string, u long, v double, y int").select("k", "u", "v")
    out = frames.preceding_stats(df, events, ["k"], "t", "u", 25, 3, {"n": Stat("count", F.lit(1)), "m": Stat("avg", F.col("v"))}).collect()
    assert len(out) == len(rows)
    for g in out:
        w = [x for x in others if x[1] == g.k and g.t - 25 <= x[2] <= g.t - 3]
        assert g.n == len(w)
        assert g.m == (pytest.approx(sum(x[3] for x in w) / len(w)) if w else None)


@pytest.mark.parametrize("limit", [None, 7, 1])
@pytest.mark.parametrize("lookback", [10, 300])
def test_as_of(spark, df, rows, limit, lookback):
    others = make(3, 60)
    obs = spark.createDataFrame(others, "oid int, k string, at long, w double, y int").select("oid", "k", "at", "w")
    out = frames.as_of(df, obs, ["k"], "t", "at", lookback, ["oid", "w"], "oid", limit).collect()
    assert len(out) == len(rows)
    for g in out:
        seen = [(x[2], x[0], x[3]) for x in others if x[1] == g.k and g.t - lookback <= x[2] <= g.t]
        assert (g["at"], g.oid, g.w) == (max(seen) if seen else (None, None, None))


@pytest.mark.parametrize("limit", [None, 9, 1])
def test_previous(df, rows, limit):
    for g in frames.previous(df, ["k"], "t", "id", {"pt": "t", "pv": "v"}, limit).collect():
        before = [(x[2], x[0], x[3]) for x in rows if x[1] == g.k and (x[2], x[0]) < (g.t, g.id)]
        assert (g.pt, g.pv) == ((max(before)[0], max(before)[2]) if before else (None, None))


@pytest.mark.parametrize("limit", [None, 9, 1])
def test_running_before(df, rows, limit):
    out = frames.running_before(df, ["k"], "t", "id", {"n": F.lit(1), "y_sum": F.col("y")}, limit).collect()
    assert len(out) == len(rows)
    for g in out:
        before = [x for x in rows if x[1] == g.k and (x[2], x[0]) < (g.t, g.id)]
        assert (g.n, g.y_sum) == (len(before), sum(x[4] for x in before))


def test_empty_and_single(spark):
    empty = spark.createDataFrame([], "id int, k string, t long, v double, y int")
    stats = {"m": Stat("avg", F.col("v"))}
    assert frames.rolling(empty, ["k"], "t", 5, 0, stats).count() == 0
    assert frames.previous(empty, ["k"], "t", "id", {"p": "v"}, 1).count() == 0
    one = spark.createDataFrame([(1, "a", 5, 2.0, 1)], "id int, k string, t long, v double, y int")
    assert frames.previous(one, ["k"], "t", "id", {"p": "v"}).first().p is None
    assert frames.rolling(one, ["k"], "t", 5, 1, stats).first().m is None
