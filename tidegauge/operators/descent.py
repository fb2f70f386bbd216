"""Gradient descent for linear models from one pass over the data.

The squared-loss gradient is ``2 (X'X w - X'y) / n``. X'X, X'y and y'y hold (d + 2)^2 sums
whatever the row count, so Spark aggregates them once (per fold if asked) and every step,
model and loss afterwards is arithmetic on that small matrix.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .gram import sums_of_products


def moments(df: DataFrame, features: Sequence[str], target: str, fold: str | None = None) -> dict[object, np.ndarray]:
    """Sum of z z' with z = (1, features, target), by fold; rows with a null are left out."""
    z = [F.lit(1.0), *[F.col(c) for c in [*features, target]]]
    return sums_of_products(df.dropna(subset=[*features, target]), z, None if fold is None else F.col(fold))


def loss(m: np.ndarray, w: np.ndarray) -> float:
    """Mean squared error of weights ``w`` (bias first)."""
    e = np.append(w, -1.0)
    return float(e @ m @ e / m[0, 0])


def step(m: np.ndarray, w: np.ndarray, rate: float, penalty: str | None = None, strength: float = 0.1) -> np.ndarray:
    """One descent step; the bias is not penalised."""
    gradient = 2.0 * (m[:-1, :-1] @ w - m[:-1, -1]) / m[0, 0]
    slope = w.copy()
    slope[0] = 0.0
    if penalty == "ridge":
        gradient = gradient + 2.0 * strength * slope
    elif penalty == "lasso":
        gradient = gradient + strength * np.sign(slope)
    return w - rate * gradient


def descend(
    df: DataFrame, features: Sequence[str], target: str, steps: int, rate: float = 0.1,
    penalty: str | None = None, strength: float = 0.1,
) -> DataFrame:
    """Weights and training loss after each step, starting from the mean of the target."""
    m = moments(df, features, target)[0]
    w = np.zeros(len(features) + 1)
    w[0] = m[0, -1] / m[0, 0]
    rows = []
    for s in range(steps + 1):
        rows.append((s, *[float(x) for x in w], loss(m, w)))
        w = step(m, w, rate, penalty, strength)
    names = ", ".join(f"w{i} double" for i in range(len(w)))
    return df.sparkSession.createDataFrame(rows, f"step int, {names}, loss double").coalesce(1)


def descend_folds(
    df: DataFrame, features: Sequence[str], target: str, fold: str, steps: int, rate: float = 0.1,
    penalty: str | None = None, strength: float = 0.1,
) -> DataFrame:
    """One model per fold, trained on all other folds: train and test loss after each step."""
    by_fold = moments(df, features, target, fold)
    total = sum(by_fold.values())
    rows = []
    for k in sorted(by_fold):
        train, test = total - by_fold[k], by_fold[k]
        w = np.zeros(len(features) + 1)
        w[0] = train[0, -1] / train[0, 0]
        for s in range(steps + 1):
            rows.append((int(k), s, loss(train, w), loss(test, w)))
            w = step(train, w, rate, penalty, strength)
    return df.sparkSession.createDataFrame(rows, "model int, step int, train_loss double, test_loss double").coalesce(1)
