"""Perceptrons as tables of weights: the fitted model's scores by joins and sums, and training against numpy."""

import random

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tidegauge.operators import learn, perceptron

NAMES = ["a", "b"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(2)
    data = [(i, a := rng.gauss(0, 1), b := rng.gauss(0, 1), float(a + b * b > 0.5)) for i in range(300)]
    return spark.createDataFrame(data, "id long, a double, b double, label double").cache()


def long(rows):
    return rows.select("id", F.posexplode(F.array(*NAMES)).alias("place", "x"))


@pytest.mark.parametrize("layers", [[2, 4, 2], [2, 3, 5, 2], [2, 3, 3]])
def test_table_of_a_fitted_model(spark, rows, layers):
    made = VectorAssembler(inputCols=NAMES, outputCol="features").transform(rows)
    made = made.withColumn("label", (F.col("label") + F.when(F.col("a") > 1, 1.0).otherwise(0.0)) if layers[-1] == 3 else F.col("label"))
    model = learn.perceptron("label", layers, rounds=10).fit(made)
    table = perceptron.weight_table(spark, layers, model.weights.toArray().tolist())
    want = {(r.id, j): p for r in model.transform(made).select("id", "probability").collect() for j, p in enumerate(r.probability.toArray())}
    got = {(r.id, r.target): r.p for r in perceptron.score_long(long(rows), table, len(layers)).collect()}
    assert got == pytest.approx(want)
    if layers[-1] == 2:
        one = {r.id: r.p for r in rows.select("id", perceptron.probability(table.collect(), layers, [F.col(c) for c in NAMES]).alias("p")).collect()}
        assert one == pytest.approx({i: p for (i, j), p in want.items() if j == 1})


def brute(x, y, hidden, steps, rate, seed=7):
    w = [np.array([[perceptron.first_weight(k, i, j, seed) for j in range(o)] for i in range(-1, n)]) for k, (n, o) in enumerate([(x.shape[1], hidden), (hidden, 2)])]
    for _ in range(steps):
        h = 1 / (1 + np.exp(-(w[0][0] + x @ w[0][1:])))
        z = w[1][0] + h @ w[1][1:]
        p = np.exp(z) / np.exp(z).sum(axis=1, keepdims=True)
        d = (p - np.stack([1 - y, y], axis=1)) / len(y)
        back = d @ w[1][1:].T * h * (1 - h)
        w[1] = w[1] - rate * np.vstack([d.sum(axis=0), h.T @ d])
        w[0] = w[0] - rate * np.vstack([back.sum(axis=0), x.T @ back])
    return w


def test_descent_against_numpy(spark, rows):
    data = np.array([tuple(r) for r in rows.select(*NAMES, "label").collect()])
    want = brute(data[:, :2], data[:, 2], 3, 6, 2.0)
    odd = rows.union(spark.createDataFrame([(900, None, 1.0, 1.0), (901, 1.0, 1.0, None)], rows.schema))
    got = perceptron.descend(odd, NAMES, "label", 3, 6, 2.0).collect()
    assert len(got) == 3 * 3 + 4 * 2
    for r in got:
        assert r.w == pytest.approx(want[r.layer][r.source + 1, r.target])


def test_no_rows(spark):
    empty = spark.createDataFrame([], "id long, a double, b double, label double")
    table = perceptron.descend(empty, NAMES, "label", 2, 2)
    assert {(r.layer, r.source, r.target): r.w for r in table.collect()} == {p: perceptron.first_weight(*p, 7) for p in perceptron.places([2, 2, 2])}
    assert perceptron.score_long(long(empty), table, 3).count() == 0
