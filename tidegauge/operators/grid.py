"""Logistic regressions of a whole grid of penalties and folds, trained together: each round is one pass over the rows.

The coefficients of all models are one matrix. A task multiplies its rows by it, and the errors by its rows; what leaves a
task is one row per model, so neither the number of passes nor the rows that are shuffled depend on the size of the table,
and a larger grid makes the matrix wider, not the passes more.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage


@dataclass(frozen=True)
class Setting:
    """Strength of the penalty and its lasso part, on columns of unit variance."""

    reg: float
    mix: float = 0.0


@dataclass
class Grid:
    columns: list[str]
    settings: list[Setting]
    folds: int
    mean: np.ndarray
    scale: np.ndarray
    coefficients: np.ndarray  # (setting, held-out fold or none: the last, intercept and columns)
    losses: np.ndarray  # (setting, fold): mean log loss on the rows of the fold

    def best(self) -> int:
        """The setting with the smallest mean loss over the folds; the first of equal ones."""
        return int(np.argmin(np.round(self.losses.mean(axis=1), 9)))

    def probability(self, setting: int) -> Column:
        """Of label 1, by the model trained on all rows; a row with a null feature has none."""
        b = self.coefficients[setting, -1]
        margin = F.lit(float(b[0]))
        for c, w, m, s in zip(self.columns, b[1:], self.mean, self.scale):
            margin = margin + (F.col(c).cast("double") - F.lit(float(m))) / F.lit(float(s)) * F.lit(float(w))
        return 1 / (1 + F.exp(-margin))


def _pass(rows: DataFrame, width: int, height: int, values) -> np.ndarray:
    """Sum over all rows of ``values(z, label, weight, fold)``, a matrix with a row per model."""

    def run(batches):
        total = np.zeros((height, width))
        for batch in batches:
            y, w, fold = (batch.column(c).to_numpy() for c in ("y", "w", "fold"))
            total += values(batch.column("z").flatten().to_numpy().reshape(len(y), -1), y, w, fold)
        yield pa.RecordBatch.from_arrays([pa.array(range(height), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], names=["m", "row"])

    parts = rows.mapInArrow(run, "m int, row array<double>").withColumn("row", array_to_vector("row"))
    out = np.zeros((height, width))
    for r in parts.groupBy("m").agg(Summarizer.sum(F.col("row")).alias("row")).select("m", vector_to_array("row").alias("row")).collect():  # a row per model
        out[r["m"]] = r["row"]
    return out


def train(df: DataFrame, columns: Sequence[str], label: str, settings: Sequence[Setting], fold: Column | None = None, folds: int = 0,
          weight: str | None = None, rounds: int = 60) -> Grid:
    """Every setting without each of the ``folds`` and on all rows, by ``rounds`` steps of accelerated proximal descent.

    ``fold`` numbers the rows from 0. Columns are scaled to mean 0 and variance 1 over all rows; a constant one stays at 0. Rows
    with a null label, feature or weight are left out. Without rows all coefficients are 0.
    """
    columns, settings, d = list(columns), list(settings), len(columns) + 1
    x = [F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(columns)]
    rows = df.select(*x, F.col(label).cast("double").alias("y"), (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("w"),
                     (F.lit(-1) if fold is None else fold).cast("int").alias("fold")).dropna(subset=[f"x{i}" for i in range(d - 1)] + ["y", "w"])
    row = rows.agg(*[e for i in range(d - 1) for e in (F.avg(f"x{i}").alias(f"m{i}"), F.stddev_pop(f"x{i}").alias(f"s{i}"))]).first()
    mean, scale = np.array([row[f"m{i}"] or 0.0 for i in range(d - 1)]), np.array([row[f"s{i}"] or 1.0 for i in range(d - 1)])
    z = [(F.col(f"x{i}") - F.lit(float(mean[i]))) / F.lit(float(scale[i])) for i in range(d - 1)]
    rows = cut_lineage(rows.select(F.array(F.lit(1.0), *z).alias("z"), "y", "w", F.coalesce("fold", F.lit(-1)).alias("fold")))

    held = np.tile(np.append(np.arange(folds), -2), len(settings))  # -2: no row has this number
    reg, mix = (np.repeat([getattr(s, k) for s in settings], folds + 1) for k in ("reg", "mix"))
    models = len(held)

    def sizes(z, y, w, fold):
        own = w * (fold != held[:, None])
        return np.stack([own.sum(axis=1), own @ (z * z).sum(axis=1)], axis=1)

    weights, squares = np.maximum(_pass(rows, 2, models, sizes), 1e-300).T
    lasso, ridge = reg * mix, reg * (1 - mix)
    step = 1 / (np.where(weights > 1e-300, squares / weights, 1.0) / 4 + ridge)
    free = np.append(0.0, np.ones(d - 1))  # the intercept has no penalty
    now = ahead = np.zeros((models, d))
    for t in range(rounds):
        def slopes(z, y, w, fold, b=ahead):
            error = 1 / (1 + np.exp(-np.clip(b @ z.T, -500, 500))) - y
            return (error * w * (fold != held[:, None])) @ z

        gradient = _pass(rows, d, models, slopes) / weights[:, None] + ridge[:, None] * free * ahead
        moved = ahead - step[:, None] * gradient
        new = np.sign(moved) * np.maximum(np.abs(moved) - (step * lasso)[:, None] * free, 0)
        now, ahead = new, new + t / (t + 3) * (new - now)

    def losses(z, y, w, fold, b=now):
        loss = np.logaddexp(0, -(b @ z.T) * (2 * y - 1)) * w * (fold == held[:, None])
        return np.stack([loss.sum(axis=1), (w * (fold == held[:, None])).sum(axis=1)], axis=1)

    total, n = _pass(rows, 2, models, losses).reshape(len(settings), folds + 1, 2)[:, :folds].transpose(2, 0, 1) if folds else np.zeros((2, len(settings), 0))
    return Grid(columns, settings, folds, mean, scale, now.reshape(len(settings), folds + 1, d), total / np.maximum(n, 1e-300))
