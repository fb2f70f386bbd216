"""No operator stops on an empty table, a single row or all-null columns."""

import pytest
from pyspark.sql import functions as F

from tidegauge.operators import clean, dedup, descent, encode, evaluate, impute, joins, ranking, sets, split, stats, text

SCHEMA = "id long, k string, t long, v double, w double, y int"
TABLES = {
    "empty": [],
    "one": [(1, "a", 0, 1.0, 2.0, 1)],
    "nulls": [(1, None, None, None, None, None), (2, None, None, None, None, None)],
    "constant": [(1, "a", 0, 1.0, 1.0, 1), (2, "a", 0, 1.0, 1.0, 1)],
}
Y = lambda: F.col("y") == 1
JOBS = {
    "shares": lambda d: stats.shares(d, ["k"]),
    "rates": lambda d: stats.rates(d, ["k"], Y(), 1, 3),
    "conditional": lambda d: stats.conditional_table(d, "k", "y"),
    "balance": lambda d: stats.class_balance(d, "y"),
    "consistency": lambda d: stats.consistency(d, {"r": F.col("v") < 0}),
    "quality": lambda d: stats.entity_quality(d, "k", Y()),
    "distinct": lambda d: stats.distinct_counts(d, ["k", "v"]),
    "quantiles": lambda d: stats.quantiles(d, ["v"], [0.1, 0.9]),
    "profile": lambda d: stats.profile(d, ["v", "t"]),
    "missing": lambda d: stats.missing_report(d),
    "cardinality": lambda d: stats.cardinality_report(d, ["k"]),
    "stages": lambda d: stats.stage_comparison([("a", d), ("b", d.dropna())]),
    "summary": lambda d: stats.quality_summary(d),
    "target": lambda d: stats.target_correlation(d, ["v"], Y()),
    "pairs": lambda d: stats.correlation_pairs(d, ["v", "w"]),
    "ranks": lambda d: stats.rank_correlation(d, ["v"], "w"),
    "prune": lambda d: stats.prune_pairs(d, ["v", "w"], Y(), 0.9),
    "anova": lambda d: stats.anova(d, ["k"], "v"),
    "chi": lambda d: stats.chi_square(d, "k", "y"),
    "scalers": lambda d: stats.scaler_plan(d, ["v"]),
    "interval": lambda d: stats.binned_interval(d, F.floor("t"), "v"),
    "heat": lambda d: stats.heat_map(d, "k", "y", [0, 1], Y(), ["zero", "one"]),
    "anomaly": lambda d: stats.against_normal(d, ["k"], "v"),
    "centrality": lambda d: stats.degree_centrality(d, "k", "y"),
    "baseline": lambda d: stats.variance_baseline(d, "v"),
    "run": lambda d: stats.run_summary(d, "t"),
    "confusion": lambda d: evaluate.confusion(d, "y", F.col("v") > 0),
    "sweep": lambda d: evaluate.threshold_sweep(d, "y", "v", [0.5]),
    "auc": lambda d: evaluate.auc(d, "y", "v"),
    "errors": lambda d: evaluate.regression_errors(d, F.col("v"), F.col("w")),
    "zscore": lambda d: clean.zscore(d, ["v"]),
    "log": lambda d: clean.log_skewed(d, ["v"]),
    "sparse": lambda d: clean.drop_sparse(d, 0.5),
    "top_values": lambda d: clean.top_value_indicators(d, "k", 2),
    "median": lambda d: impute.median_fill(d, ["v"]),
    "mode": lambda d: impute.mode_fill(d, ["k"]),
    "group_mean": lambda d: impute.group_mean_fill(d, ["k"], "v", 0.0),
    "first_event": lambda d: impute.first_event_fill(d, "y", "v"),
    "distinct_report": lambda d: dedup.distinct_report(d),
    "keep_first": lambda d: dedup.keep_first(d, ["k"], [F.asc("id")]),
    "coverage": lambda d: joins.key_coverage(d, d, "k", "k"),
    "both_ends": lambda d: ranking.both_ends(d, "v", 2, "id"),
    "global_rank": lambda d: ranking.global_rank(d, [F.asc("v"), F.asc("id")]),
    "overlap": lambda d: sets.overlap(d, d, "k"),
    "undersample": lambda d: split.undersample(d, "id", "y", 0.5),
    "weights": lambda d: split.class_weights(d.filter("y is not null"), "y") if d.filter("y is not null").count() else d,
    "frequency": lambda d: encode.frequency_encode(d, "k"),
    "words": lambda d: text.word_count(d, "k"),
    "ngrams": lambda d: text.ngrams(d, "k"),
    "moments": lambda d: descent.descend(d, ["v"], "w", 1) if d.dropna().count() else d,
}


@pytest.mark.parametrize("job", sorted(JOBS))
def test_job(spark, job):
    for name, rows in TABLES.items():
        try:
            JOBS[job](spark.createDataFrame(rows, SCHEMA)).collect()
        except Exception as e:
            raise AssertionError(f"{job} on {name}: {str(e)[:500]}") from e
