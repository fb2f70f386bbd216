import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tidegauge.operators import grid
from tidegauge.operators.grid import Setting


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(600, 3)) * [1, 20, 0.1] + [0, 5, 1]
    y = (x[:, 0] + (x[:, 1] - 5) / 20 + rng.normal(size=600) > 0.3).astype(float)
    data = [(i, *map(float, v), float(t), 1.0 + i % 2, i % 3) for i, (v, t) in enumerate(zip(x, y))]
    data += [(1000, None, 1.0, 1.0, 1.0, 1.0, 0), (1001, 1.0, 1.0, 1.0, None, 1.0, 0)]
    return spark.createDataFrame(data, "id long, a double, b double, c double, y double, w double, k int")


@pytest.mark.parametrize("reg,mix", [(0.05, 1.0), (0.02, 0.5)])
def test_same_optimum_as_spark_ml(rows, reg, mix):
    got = grid.train(rows, ["a", "b", "c"], "y", [Setting(reg, mix)], weight="w", rounds=40)
    ready = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(rows.dropna())
    want = LogisticRegression(labelCol="y", weightCol="w", regParam=reg, elasticNetParam=mix, maxIter=500, tol=1e-12).fit(ready)
    assert np.allclose(got.coefficients[0, 0, 1:] / got.scale, want.coefficients.toArray(), rtol=0.01, atol=1e-3)


def test_folds_together_are_the_folds_apart(rows):
    settings = [Setting(0.001), Setting(0.3, 1.0)]
    got = grid.train(rows, ["a", "b", "c"], "y", settings, F.col("k"), 3, rounds=8)
    clean = np.array(rows.dropna().select("a", "b", "c", "y", "k").collect())
    z = np.column_stack([np.ones(len(clean)), (clean[:, :3] - clean[:, :3].mean(axis=0)) / clean[:, :3].std(axis=0)])
    y, k = clean[:, 3], clean[:, 4]
    for s, setting in enumerate(settings):
        for fold in range(3):
            own, lasso, ridge = k != fold, setting.reg * setting.mix, setting.reg * (1 - setting.mix)
            step = 1 / ((z[own] ** 2).sum(axis=1).mean() / 4 + ridge)
            now = ahead = np.zeros(4)
            for t in range(8):
                g = z[own].T @ (1 / (1 + np.exp(-z[own] @ ahead)) - y[own]) / own.sum() + ridge * np.append(0, ahead[1:])
                new = ahead - step * g
                new[1:] = np.sign(new[1:]) * np.maximum(abs(new[1:]) - step * lasso, 0)
                now, ahead = new, new + t / (t + 3) * (new - now)
            assert np.allclose(got.coefficients[s, fold], now)
            assert np.isclose(got.losses[s, fold], np.log1p(np.exp(-(z[~own] @ now) * (2 * y[~own] - 1))).mean())
    assert got.best() == 0


def test_a_larger_grid_takes_no_more_passes(rows, monkeypatch):
    calls = []
    plain = grid._pass
    monkeypatch.setattr(grid, "_pass", lambda *a: calls.append(1) or plain(*a))
    grid.train(rows, ["a"], "y", [Setting(0.1)], F.col("k"), 2, rounds=2)
    few = len(calls)
    grid.train(rows, ["a"], "y", [Setting(r / 10) for r in range(1, 9)], F.col("k"), 3, rounds=2)
    assert len(calls) == 2 * few


def test_empty_and_constant(rows):
    none = grid.train(rows.filter("false"), ["a", "b"], "y", [Setting(0.1)], F.col("k"), 2, rounds=2)
    assert not none.coefficients.any() and not none.losses.any()
    flat = grid.train(rows.withColumn("one", F.lit(1)), ["one", "a"], "y", [Setting(0.1)], rounds=3)
    assert flat.coefficients[0, 0, 1] == 0 and flat.coefficients[0, 0, 2] > 0
    assert rows.withColumn("one", F.lit(1)).filter(flat.probability(0).between(0, 1)).count() == 601  # not the null
