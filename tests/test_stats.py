import random

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from tidegauge.operators import evaluate, gram, learn, ranking, split, stats


@pytest.fixture(scope="module")
def pdf():
    rng = np.random.default_rng(3)
    n = 400
    x = rng.integers(0, 30, n).astype(float)
    return pd.DataFrame({"id": range(n), "x": x, "z": x * 2 + rng.normal(size=n), "w": rng.normal(size=n), "y": (rng.random(n) < x / 40).astype(int),
                         "c": rng.choice(list("abc"), n)})


@pytest.fixture(scope="module")
def df(spark, pdf):
    return spark.createDataFrame(pdf).cache()


def test_rank_correlation(df, pdf):
    got = {r["column"]: (r.pearson, r.spearman) for r in stats.rank_correlation(df, ["x", "w"], "z").collect()}
    for c in ("x", "w"):
        ranks = pdf[[c, "z"]].rank().corr().iloc[0, 1]
        assert got[c] == (pytest.approx(pdf[c].corr(pdf["z"]), abs=1e-8), pytest.approx(ranks, abs=1e-8))


def test_prune_keeps_the_one_closer_to_the_target(df, pdf):
    r = stats.prune_pairs(df, ["x", "z", "w"], F.col("y"), 0.95).collect()
    closer = abs(pdf.x.corr(pdf.y)) >= abs(pdf.z.corr(pdf.y))
    assert [(q.a, q.b, q.drop) for q in r] == [("x", "z", "z" if closer else "x")]


def test_undefined_correlation_of_a_constant(spark):
    df = spark.createDataFrame([(1.0, 1.0, 0), (1.0, 2.0, 1)], "k double, v double, y int")
    got = {r["column"]: r.r for r in stats.target_correlation(df, ["k", "v"], F.col("y")).collect()}
    assert got["k"] is None or np.isnan(got["k"])
    scored = stats.composite_score(df.withColumn("f", F.lit(1)), ["f"], F.col("y"))
    assert scored.first().score == 1.0


def test_anova_and_chi_square(df, pdf):
    groups = [g.z.to_numpy() for _, g in pdf.groupby("c")]
    n, k, m = len(pdf), len(groups), pdf.z.mean()
    f = (sum(len(g) * (g.mean() - m) ** 2 for g in groups) / (k - 1)) / (sum(((g - g.mean()) ** 2).sum() for g in groups) / (n - k))
    assert stats.anova(df, ["c"], "z").first().f == pytest.approx(f, abs=1e-5)
    table = pd.crosstab(pdf.c, pdf.y).to_numpy()
    e = table.sum(1, keepdims=True) * table.sum(0, keepdims=True) / n
    r = stats.chi_square(df, "c", "y").first()
    assert (r.chi2, r.dof) == (pytest.approx(((table - e) ** 2 / e).sum(), abs=1e-5), 2)


def test_approximate_counts_are_close(df, pdf):
    got = {r["column"]: r.n_distinct for r in stats.approx_distinct_counts(df, ["id", "x", "c"], 0.02).collect()}
    assert got["c"] == 3 and got["x"] == pytest.approx(pdf.x.nunique(), rel=0.06) and got["id"] == pytest.approx(400, rel=0.06)


def test_reports_on_empty_and_null_tables(spark):
    empty = spark.createDataFrame([], "a int, b double")
    assert {r["column"]: (r.n_rows, r.missing_pct) for r in stats.missing_report(empty).collect()} == {"a": (0, None), "b": (0, None)}
    nulls = spark.createDataFrame([(None, float("nan")), (None, None)], "a int, b double")
    assert {r["column"]: r.missing_pct for r in stats.missing_report(nulls).collect()} == {"a": 100.0, "b": 100.0}
    assert stats.profile(nulls.select("a"), ["a"]).first().mean is None
    assert stats.class_balance(spark.createDataFrame([(1,), (1,)], "y int"), "y").first().imbalance == 0.0


def test_auc_against_evaluator(spark, df, pdf):
    rng = random.Random(1)
    rows = [(i, int(y), round(rng.random() * 0.6 + 0.4 * y, 2)) for i, y in enumerate(pdf.y)]
    scored = spark.createDataFrame(rows, "id int, y int, s double")
    r = evaluate.auc(scored, "y", "s").first()
    roc = BinaryClassificationEvaluator(labelCol="y", rawPredictionCol="s", numBins=0).evaluate(scored)
    assert r.auc_roc == pytest.approx(roc, abs=1e-8)
    assert evaluate.auc(spark.createDataFrame([(1, 0.5)], "y int, s double"), "y", "s").first().auc_roc is None


def test_sweep_agrees_with_single_thresholds(spark):
    rows = [(y, s / 10) for y in (0, 1) for s in range(11)]
    df = spark.createDataFrame(rows, "y int, s double")
    for r in evaluate.threshold_sweep(df, "y", "s", [0.0, 0.5, 0.99, 2.0]).collect():
        one = evaluate.confusion(df, "y", F.col("s") >= r.threshold).first().asDict()
        assert {k: v for k, v in r.asDict().items() if k != "threshold"} == one
    nothing = evaluate.confusion(df, "y", F.col("s") > 5).first()
    assert (nothing.precision, nothing.recall, nothing.f1) == (0.0, 0.0, 0.0)


def test_regression_errors_of_the_mean(df, pdf):
    r = evaluate.regression_errors(df, F.col("z"), F.lit(float(pdf.z.mean()))).first()
    assert r.mse == pytest.approx(pdf.z.var(ddof=0), abs=1e-5) and r.r2 == pytest.approx(0, abs=1e-6)


def test_splits(spark):
    df = spark.range(5000).withColumn("y", (F.col("id") % 10 == 0).cast("int"))
    parts = {r.split: r["count"] for r in split.hash_split(df, "id", {"a": 0.6, "b": 0.3, "c": 0.1}).groupBy("split").count().collect()}
    assert parts["a"] == pytest.approx(3000, rel=0.05) and parts["c"] == pytest.approx(500, rel=0.2)
    assert split.fold(df, "id", 5).select("fold").distinct().count() == 5
    assert {r.y: r["count"] for r in split.exact_per_class(df, "id", "y", 600).groupBy("y").count().collect()} == {0: 600, 1: 500}
    under = {r.y: r["count"] for r in split.undersample(df, "id", "y", 0.5).groupBy("y").count().collect()}
    assert under[1] == 500 and under[0] == pytest.approx(500, rel=0.15)
    assert split.undersample(df.filter("y = 1"), "id", "y", 0.5).count() == 500
    weights = {r.y: r.weight for r in split.class_weights(df, "y").select("y", "weight").distinct().collect()}
    assert weights == {0: pytest.approx(5000 / 9000), 1: pytest.approx(5.0)}
    assert sorted(r.id for r in split.draw(df, "id", 7).collect()) == sorted(r.id for r in split.draw(df.repartition(3), "id", 7).collect())


def test_time_folds_do_not_overlap(spark):
    df = spark.sql("select id, timestampadd(DAY, id, timestamp_ntz'2020-01-01') as ts from range(100)")
    for train, valid in split.expanding_folds(df, F.col("ts"), ["2020-02-01", "2020-03-01", "2020-04-01"]):
        assert train.agg(F.max("ts")).first()[0] < valid.agg(F.min("ts")).first()[0]
    parts = split.split_ranges(split.time_split(df, F.col("ts"), "2020-02-01", "2020-03-01"), "ts").collect()
    assert {r.split: (r.n, r.overlaps) for r in parts} == {"train": (31, 0), "valid": (29, 0), "test": (40, 0)}


def test_stage_comparison(spark):
    a = spark.createDataFrame([(1, None), (2, 3.0)], "i int, v double")
    rows = stats.stage_comparison([("a", a), ("b", a.dropna())]).orderBy("step").collect()
    assert [(r.n_rows, r.missing_pct, r.rows_change, r.missing_change) for r in rows] == [(2, 25.0, None, None), (1, 0.0, -1, -25.0)]


def test_wide_correlations_with_gaps(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(400, 200)) + rng.normal(size=(400, 1)) * rng.random(200) + 1e6
    x[rng.random(x.shape) < 0.1] = np.nan
    x[:, 7] = 5.0
    df = spark.createDataFrame([tuple(None if v != v else float(v) for v in row) for row in x], ", ".join(f"c{i} double" for i in range(200)))
    got = gram.correlations(df, [F.col(c) for c in df.columns])
    for i, j in ((0, 1), (3, 150), (199, 20), (50, 50)):
        both = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
        assert got[i, j] == pytest.approx(np.corrcoef(x[both, i], x[both, j])[0, 1], abs=1e-9)
    assert np.isnan(got[7, 3]) and np.isnan(got[3, 7])
    assert stats.correlation_pairs(df, df.columns).count() == 199 * 100
    assert stats.prune_pairs(df, df.columns, F.col("c0"), 0.99).columns == ["a", "b", "r", "drop"]


def test_classes_have_partitions_of_their_own(spark):
    rows = [(k, i % 37, i) for k, n in (("a", 500), ("b", 3), (None, 20), ("c", 90)) for i in range(n)]
    df = spark.createDataFrame(rows, "k string, n int, id int")
    for pieces in (1, 4):
        out = ranking.grouped_sort(df, "k", "n", [F.asc("id")], pieces).collect()
        assert len(out) == len(rows) and all(r["partition"] is not None for r in out)
        assert len({(r["partition"], r["place"]) for r in out}) == len(rows)
        for i, k in enumerate([None, "a", "b", "c"]):
            mine = sorted((r["partition"], r["place"], -r["n"], r["id"]) for r in out if r["k"] == k)
            assert {m[0] for m in mine} <= set(range(i * pieces, (i + 1) * pieces))
            assert [m[2:] for m in mine] == sorted(m[2:] for m in mine)
    assert ranking.grouped_sort(df.limit(0), "k", "n", [F.asc("id")]).count() == 0
    with pytest.raises(ValueError):
        ranking.grouped_sort(df, "k", "n", [], limit=2)


def test_nan_has_no_rank(spark):
    df = spark.createDataFrame([(1.0, 1), (float("nan"), 2), (2.0, 3), (None, 4)], "v double, id int")
    got = {r["v"]: r["n_before"] for r in ranking.cumulative_by_value(df, "v", {"n": F.count(F.lit(1))}).collect()}
    assert got == {1.0: 0, 2.0: 1}


def test_chi_square_selection_of_continuous_columns(spark):
    rng = np.random.default_rng(7)
    rows = [(float(v), float(rng.normal()), None if i % 5 == 0 else float(rng.random()), int(v > 0.5)) for i, v in enumerate(rng.random(3000))]
    df = spark.createDataFrame(rows, "good double, noise double, gappy double, y int")
    got = learn.select_by_chi2(df, ["noise", "gappy", "good"], "y", 2).collect()
    assert [(r["place"], r["column"], r["dof"]) for r in got][0] == (1, "good", 9)
    assert learn.select_by_chi2(df.limit(0), ["good"], "y", 1).count() == 0


def test_stored_sketches_merge_to_the_sketch_of_all(spark):
    rows = [(i % 7, i % 900, None if i % 5 else f"v{i % 40}", None) for i in range(6000)]
    df = spark.createDataFrame(rows, "day int, a long, b string, c string")
    by_day = stats.distinct_sketches(df, ["a", "b", "c"], stats.F.col("day"), "day")
    whole = {r.column: r.n_distinct for r in stats.merged_distinct(stats.distinct_sketches(df, ["a", "b", "c"], stats.F.lit(0), "day")).collect()}
    merged = {r.column: r.n_distinct for r in stats.merged_distinct(by_day).collect()}
    assert merged == whole and abs(merged["a"] - 900) <= 45 and merged["b"] == 8 and merged["c"] == 0
    per_day = {(r.day, r.column): r.n_distinct for r in stats.merged_distinct(by_day, ["day"]).collect()}
    assert len(per_day) == 21 and all(abs(per_day[d, "a"] - len({i % 900 for i in range(6000) if i % 7 == d})) <= 45 for d in range(7))
    # a later day is added without the rows of the others
    late = spark.createDataFrame([(8, 10_000 + i, "new", "x") for i in range(100)], df.schema)
    more = stats.merged_distinct(by_day.union(stats.distinct_sketches(late, ["a", "b", "c"], stats.F.col("day"), "day")))
    got = {r.column: r.n_distinct for r in more.collect()}
    assert got["b"] == 9 and got["c"] == 1 and abs(got["a"] - 1000) <= 50
    assert stats.merged_distinct(by_day.filter("day > 100")).count() == 0
