import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from tidegauge.functions import numeric, text, time
from tidegauge.operators import clean, impute
from tidegauge.sources import tables as files


def values(spark, rows, schema, col):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(col).collect()]


def test_text_repair(spark):
    raw = [("1.5s",), ("T",), ("NA",), (None,), ("",), (" 7 ",), ("s",)]
    assert values(spark, raw, "x string", text.strip_quality_flag(F.col("x"))) == [1.5, 0.0, None, None, None, 7.0, None]
    raw = [("12.5 mi",), ("-3",), ("",), ("1.2.3",), (None,), ("abc",)]
    assert values(spark, raw, "x string", text.to_double_safe(F.col("x"))) == [12.5, -3.0, None, None, None, None]
    raw = [(" ab-1 ",), ("--",), (None,)]
    assert values(spark, raw, "x string", text.normalise_code(F.col("x"))) == ["AB1", None, None]
    raw = [(" ",), ("NA",), (" NA ",), ("n",), (None,)]
    assert values(spark, raw, "x string", text.blank_to_null(F.col("x"))) == [None, None, None, "n", None]


def test_split_pair(spark):
    df = spark.createDataFrame([("-75.5, 40.1",), ("1",), ("x, 2",), (None,)], "p string")
    a, b = text.split_pair(F.col("p"))
    assert [tuple(r) for r in df.select(a, b).collect()] == [(-75.5, 40.1), (1.0, None), (None, 2.0), (None, None)]


def test_clock(spark):
    rows = [(dt.date(2020, 2, 28), c) for c in (0, 5, 945, 2359, 2400, 1275, None)]
    got = values(spark, rows, "d date, c int", time.local_instant(F.col("d"), F.col("c")))
    day = dt.datetime(2020, 2, 28)
    assert got == [day, day + dt.timedelta(minutes=5), day + dt.timedelta(hours=9, minutes=45), day + dt.timedelta(hours=23, minutes=59),
                   dt.datetime(2020, 2, 29), None, None]


def test_prediction_instant_by_zone_column(spark):
    rows = [("2020-01-15 12:00:00", "America/New_York"), ("2020-07-15 12:00:00", "America/New_York"), ("2020-01-15 01:00:00", "Asia/Tokyo")]
    df = spark.createDataFrame(rows, "t string, z string").select(F.col("t").cast("timestamp_ntz").alias("t"), "z")
    got = [r[0] for r in df.select(time.prediction_instant(F.col("t"), F.col("z"), 2)).collect()]
    assert got == [dt.datetime(2020, 1, 15, 15), dt.datetime(2020, 7, 15, 14), dt.datetime(2020, 1, 14, 14)]


def test_epoch_keys_do_not_depend_on_the_session_zone(spark):
    df = spark.createDataFrame([("1970-01-02 00:00:01.5",)], "t string").select(F.col("t").cast("timestamp_ntz").alias("t"))
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert tuple(df.select(time.epoch_seconds(F.col("t")), time.epoch_micros(F.col("t")), time.epoch_day(F.col("t"))).first()) == (86401, 86401500000, 1)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_finite(spark):
    rows = [(1.0,), (float("nan"),), (float("inf"),), (float("-inf"),), (None,)]
    df = spark.createDataFrame(rows, "x double")
    assert [r.x for r in clean.finite_columns(df).collect()] == [1.0, 0.0, 0.0, 0.0, None]
    assert clean.non_finite_counts(df).first().n_not_finite == 3


def test_bins_and_cycles(spark):
    assert values(spark, [(-1.0,), (0.0,), (4.9,), (5.0,)], "x double", numeric.bin_floor(F.col("x"), 5.0)) == [-5.0, 0.0, 0.0, 5.0]
    assert [str(v) for v in values(spark, [(0.37,), (1.0,)], "x double", numeric.decimal_bin(F.col("x"), "0.25"))] == ["0.25", "1.00"]
    s, c = numeric.cyclic(F.col("x"), 24)
    df = spark.createDataFrame([(0.0,), (6.0,), (24.0,)], "x double")
    assert [tuple(round(v, 9) for v in r) for r in df.select(s, c).collect()] == [(0, 1), (1, 0), (0, 1)]


def test_haversine(spark):
    df = spark.createDataFrame([(0.0, 0.0, 0.0, 180.0), (90.0, 0.0, -90.0, 5.0), (10.0, 20.0, 10.0, 20.0)], "a double, b double, c double, d double")
    got = [r[0] for r in df.select(numeric.haversine_km(*[F.col(x) for x in "abcd"])).collect()]
    assert got == [pytest.approx(math.pi * numeric.EARTH_RADIUS_KM)] * 2 + [0.0]


def test_missing_and_drops(spark):
    df = spark.createDataFrame([(1, None, float("nan")), (2, None, 1.0), (3, "x", None)], "id int, s string, v double")
    assert clean.null_shares(df) == {"id": 0.0, "s": pytest.approx(2 / 3), "v": pytest.approx(2 / 3)}
    assert clean.drop_sparse(df, 0.5, keep=["v"]).columns == ["id", "v"]
    assert clean.require(df, ["s", "v"]).count() == 0
    assert {r["column"]: (r.n_missing, r.rows_before, r.rows_after) for r in clean.require_report(df, ["s", "v"]).collect()} == {
        "s": (2, 3, 0), "v": (2, 3, 0)}
    assert clean.drop_leaky(df, ["s"], ["V"]).columns == ["id"]
    assert clean.select_present(df, ["v", "no", "id"]).columns == ["v", "id"]
    assert clean.strip_suffix(clean.drop_by_suffix(df.toDF("id_x", "s_gone", "v"), "_gone"), "_x").columns == ["id", "v"]


def test_cast_zscore_log(spark):
    df = spark.createDataFrame([("1", "x"), ("2.5", "3"), (None, "4")], "a string, b string")
    assert [tuple(r) for r in clean.cast_columns(df, {"double": ["a"], "int": ["b", "none"]}).collect()] == [(1.0, None), (2.5, 3), (None, 4)]
    df = spark.createDataFrame([(1.0, 7.0), (3.0, 7.0)], "a double, c double")
    out = clean.zscore(df, ["a", "c"])
    assert out.columns == ["a", "c", "a_z"] and [round(r.a_z, 6) for r in out.collect()] == [-0.707107, 0.707107]
    df = spark.createDataFrame([(0.0, -1.0, 1.0, 0.0)] * 30 + [(90.0, 90.0, 2.0, 5.0), (50.0, 3.0, 3.0, 5.0)], "a double, neg double, third double, two double")
    assert clean.log_skewed(df, df.columns).columns == [*df.columns, "a_log", "third_log"]


def test_imputation(spark):
    df = spark.createDataFrame([(1, "x", 1.0, True), (2, "x", None, None), (3, "y", 5.0, False), (4, None, 9.0, False), (5, "y", None, True)],
                               "id int, k string, v double, b boolean")
    assert {r.id: r.v for r in impute.median_fill(df, ["v"]).collect()}[2] == 5.0
    assert [r.k for r in impute.unknown_fill(df, ["k"]).orderBy("id").collect()] == ["x", "x", "y", "UNK", "y"]
    assert {r.id: r.b for r in impute.mode_fill(df, ["b"]).collect()}[2] is False  # a tie goes to the smaller value
    assert {r.id: r.v for r in impute.group_mean_fill(df, ["k"], "v", -1.0).collect()} == {1: 1.0, 2: 1.0, 3: 5.0, 4: 9.0, 5: 5.0}
    nothing = df.withColumn("v", F.lit(None).cast("double"))
    assert {r.v for r in impute.median_fill(nothing, ["v"]).collect()} == {None}
    assert {r.v for r in impute.group_mean_fill(nothing, ["k"], "v", -1.0).collect()} == {-1.0}
    assert impute.mode_fill(df.filter("false"), ["b"]).count() == 0


def test_three_tier(spark):
    rows = [(1, "a", 0, 2.0), (2, "a", 10, None), (3, "a", 500, None), (4, "b", 0, None), (5, "a", 5, 4.0), (6, "c", 0, 8.0)]
    out = impute.three_tier(spark.createDataFrame(rows, "id int, k string, t long, v double"), ["k"], "t", ["v"], 100)
    assert {r.id: r.v for r in out.collect()} == {1: 2.0, 2: 3.0, 3: 4.0, 4: 4.0, 5: 4.0, 6: 8.0}


def test_first_event_fill(spark):
    df = spark.createDataFrame([(1, None), (0, 2.0), (0, 4.0)], "f int, v double")
    assert sorted(r.v for r in impute.first_event_fill(df, "f", "v").collect()) == [2.0, 3.0, 4.0]


def test_files(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", 2019), (2, "b", 2020)], "id int, s string, y int")
    back = files.write_stage(df, f"{tmp_path}/stage")
    assert back.count() == 2 and back.dtypes == df.dtypes
    assert files.write_year(df, F.col("y"), 2020, f"{tmp_path}/y").first().id == 2
    files.export_report(df, f"{tmp_path}/csv")
    assert files.read_csv(spark, f"{tmp_path}/csv").dtypes == [("id", "string"), ("s", "string"), ("y", "string")]
    assert files.read_csv(spark, f"{tmp_path}/csv", infer=True).dtypes[0] == ("id", "int")
    tagged = files.read_delimited(spark, f"{tmp_path}/csv", "id int, s string, y int", "kind", 1, sep=",")
    assert tagged.columns == ["id", "s", "y", "kind"]
    files.write_lines(df.select(F.col("s").alias("value")).repartition(1), f"{tmp_path}/txt", 2)
    assert sorted(r.value for r in files.read_lines(spark, f"{tmp_path}/txt").collect()) == ["a", "b"]
    assert files.up_to_month(df.withColumn("m", F.lit(3)), F.col("y"), F.col("m"), 2020, 2).count() == 1


def test_slice_reaches_the_scan(spark, tmp_path):
    path = f"{tmp_path}/t"
    spark.sql("select timestamp_ntz'1995-02-01' as ts, 1 as x, 2 as unused union all select timestamp_ntz'1999-02-01', 2, 3").write.parquet(path)
    out = files.slice_rows(files.read_table(spark, path), "ts", "3M").select("x", "ts")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert out.count() == 1
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in plan and "unused" not in plan
