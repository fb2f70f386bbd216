"""Clusters against plain k-means in whole numbers, and the bounds against full scans."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidegauge.llm import centroid_clusters as cc

SCHEMA = "vec_id long, embedding array<double>, label int, cluster int, distance string"


def table(spark, rows):
    return spark.createDataFrame([(i, x, 1, 5, "x") for i, x in rows], SCHEMA)


def brute(rows, k=8, rounds=10, dims=64):
    kept = [(i, [int(np.floor(1024 * v)) for v in x]) for i, x in rows if x is not None and len(x) == dims and all(v is not None and abs(v) <= 1e5 for v in x)]
    starts = sorted((hashlib.sha256(f"3:{'' if i is None else i}".encode()).hexdigest(), x) for i, x in kept)[:k]
    centroids = [x for _, x in starts]

    def nearest(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), j) for j, c in enumerate(centroids))

    for _ in range(rounds):
        own = [nearest(x)[1] for _, x in kept]
        for j in range(len(centroids)):
            mine = [x for (_, x), c in zip(kept, own) if c == j]
            if mine:
                centroids[j] = [sum(v) // len(mine) for v in zip(*mine)]
    found = [(i, *reversed(nearest(x))) for i, x in kept]
    total = {j: sum(d for _, c, d in found if c == j) for j in range(len(centroids))}
    return sorted(((i, c, d, total[c], sum(total.values()), hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()) for i, c, d in found), key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def points(rng, n, spread=0.3):
    middles = [[rng.gauss(0, 1) for _ in range(64)] for _ in range(6)]
    return [(i, [m + rng.gauss(0, spread) for m in rng.choice(middles)]) for i in range(n)]


@pytest.mark.parametrize("spread", [0.05, 1.0])
def test_against_brute_force(spark, spread):
    rows = points(random.Random(1), 300, spread)
    assert rows_of(cc.cluster(table(spark, rows))) == brute(rows)


def test_odd_vectors(spark):
    rng = random.Random(2)
    good = points(rng, 30)
    same = [(100 + i, [0.25] * 64) for i in range(40)]  # a third are equal
    bad = [(200, None), (201, []), (202, [1.0] * 63), (203, [1.0] * 65), (204, [None] + [1.0] * 63), (205, [float("nan")] * 64), (206, [float("inf")] + [0.0] * 63), (207, [1e6] * 64)]
    large = [(300, [1e5] * 64), (301, [-1e5] * 64)]
    rows = good + good[:3] + same + bad + large + [(None, [0.5] * 64), (None, [-0.0001] * 64)]
    assert rows_of(cc.cluster(table(spark, rows))) == brute(rows)


@pytest.mark.parametrize("n", [0, 1, 5])
def test_few_vectors(spark, n):
    rows = points(random.Random(3), n)
    assert rows_of(cc.cluster(table(spark, rows))) == brute(rows)


def test_ties_go_to_the_smaller_number(spark):
    """Vectors half-way between centroids, in each round."""
    rows = [(i, [float(i % 3)] + [0.0] * 63) for i in range(24)]
    assert rows_of(cc.cluster(table(spark, rows), k=2)) == brute(rows, k=2)


def test_only_expired_gaps_are_rescanned():
    """Over rounds with moving centroids, clusters equal full scans although few rows are popped."""
    rng = np.random.default_rng(4)
    middles = rng.normal(0, 3000, (5, 16))
    x = np.floor(middles[rng.integers(0, 5, 2000)] + rng.normal(0, 400, (2000, 16))).astype(np.int64)
    centroids, drift, data = x[:5].copy(), np.zeros(5), None
    sums, popped = np.zeros((5, 17), np.int64), []
    for _ in range(8):
        if data:
            popped.append(len(cc.Heaps.of(data, 5).expired(drift)[0]))
        heaps, moved = cc.advance(data, x, centroids, drift)
        full = ((x[:, None] - centroids) ** 2).sum(axis=2).argmin(axis=1)
        assert (heaps.clusters(len(x)) == full).all()
        data, sums = heaps.data(), sums + moved
        assert (sums[:, 0] == np.bincount(full, minlength=5)).all()
        now = cc.moved_on(centroids, sums)
        centroids, drift = now, cc.drifted(drift, centroids, now)
    assert popped[-1] < 0.2 * len(x)


def test_blocks_hold_all_vectors(spark):
    rows = points(random.Random(5), 5000)
    blocks = cc.blocks_of(table(spark, rows).coalesce(1), "vec_id", "embedding", 64)
    assert sorted(blocks.select(F.explode("vec_ids")).toPandas()["col"]) == list(range(5000)) and blocks.count() == 3
