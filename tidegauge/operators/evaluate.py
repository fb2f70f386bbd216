"""Threshold metrics, ranking metrics, regression errors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import ratio
from .ranking import cumulative_by_value


def with_rates(counts: DataFrame, betas: Sequence[float] = (0.5, 1.0, 2.0)) -> DataFrame:
    """Add accuracy, precision, recall and F-beta to tp/fp/fn/tn; an empty ratio is 0."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    zero = F.lit(0.0)
    p = F.coalesce(ratio(tp, tp + fp), zero)
    r = F.coalesce(ratio(tp, tp + fn), zero)
    cols = {
        "accuracy": F.round(F.coalesce(ratio(tp + tn, tp + fp + fn + tn), zero), 9),
        "precision": F.round(p, 9), "recall": F.round(r, 9),
    }
    for b in betas:
        name = "f" + f"{b:g}".replace(".", "_")
        cols[name] = F.round(F.coalesce(ratio((1 + b * b) * p * r, b * b * p + r), zero), 9)
    return counts.withColumns(cols)


def confusion(df: DataFrame, label: str, predicted: Column, keys: Sequence[str] = ()) -> DataFrame:
    """Confusion counts and their rates in one aggregate."""
    y, hit = F.col(label) == 1, predicted
    aggs = [
        F.count(F.when(c, F.lit(1))).alias(n)
        for n, c in (("tp", hit & y), ("fp", hit & ~y), ("fn", ~hit & y), ("tn", ~hit & ~y))
    ]
    return with_rates(df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs))


def threshold_sweep(df: DataFrame, label: str, score: str, thresholds: Sequence[float]) -> DataFrame:
    """Confusion counts at every threshold (prediction is score >= threshold), one pass.

    Rows are counted once by the highest threshold they reach; counts are then added up
    over the short list of thresholds.
    """
    grid = sorted(set(thresholds))
    reach = F.lit(0)
    for t in grid:
        reach = reach + (F.col(score) >= F.lit(float(t))).cast("int")
    y = F.col(label) == 1
    binned = df.groupBy(reach.alias("_b")).agg(
        F.count(F.when(y, F.lit(1))).alias("p"), F.count(F.when(~y, F.lit(1))).alias("n"))
    steps = F.array(*[F.struct(F.lit(i).alias("_i"), F.lit(float(t)).alias("threshold")) for i, t in enumerate(grid)])
    hit = F.col("_b") > F.col("_i")
    counts = binned.select("*", F.inline(steps)).groupBy("threshold").agg(*[
        F.sum(F.when(side, F.col(c)).otherwise(F.lit(0))).alias(name)
        for name, c, side in (("tp", "p", hit), ("fp", "n", hit), ("fn", "p", ~hit), ("tn", "n", ~hit))
    ])
    return with_rates(counts)


def best_threshold(sweep: DataFrame, metric: str) -> DataFrame:
    return sweep.orderBy(F.desc(metric), "threshold").limit(1)


def auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """Exact area under the ROC curve (ties count half) and average precision.

    Works on distinct scores with cumulative counts, so neither a global sort of the rows
    nor a sampled curve is needed.
    """
    y = F.col(label) == 1
    cum = cumulative_by_value(df, score, {
        "pos": F.count(F.when(y, F.lit(1))), "neg": F.count(F.when(~y, F.lit(1)))})
    totals = df.filter(F.col(score).isNotNull()).agg(
        F.count(F.when(y, F.lit(1))).alias("p"), F.count(F.when(~y, F.lit(1))).alias("n")).first()
    p, n = totals["p"], totals["n"]
    above_p = F.lit(p) - F.col("pos_before")          # positives at or above this score
    above = above_p + F.lit(n) - F.col("neg_before")  # rows at or above this score
    return cum.agg(
        F.round(ratio(F.sum(F.col("pos") * (F.col("neg_before") + F.col("neg") / 2)), F.lit(p * n)), 9).alias("auc_roc"),
        F.round(ratio(F.sum(F.col("pos") * above_p / above), F.lit(p)), 9).alias("avg_precision"),
        F.lit(p).cast("long").alias("n_pos"), F.lit(n).cast("long").alias("n_neg"),
    )


def regression_errors(df: DataFrame, actual: Column, predicted: Column, digits: int = 6) -> DataFrame:
    e = (actual - predicted).cast("double")
    return df.agg(
        F.count(e).alias("n"), F.round(F.avg(e * e), digits).alias("mse"),
        F.round(F.sqrt(F.avg(e * e)), digits).alias("rmse"), F.round(F.avg(F.abs(e)), digits).alias("mae"),
        F.round(1 - ratio(F.avg(e * e), F.var_pop(F.when(e.isNotNull(), actual.cast("double")))), 9).alias("r2"),
    )


def residuals_by_actual(df: DataFrame, actual: Column, predicted: Column) -> DataFrame:
    return df.groupBy(actual.alias("actual")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg(actual - predicted), 6).alias("mean_residual"),
        F.round(F.avg(F.abs(actual - predicted)), 6).alias("mean_abs_residual"))
