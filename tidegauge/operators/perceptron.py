"""Perceptrons as tables: one row per weight (layer, source, target, w); source -1 is the constant.

A fitted Spark ML perceptron becomes such a table (``weight_table``), and ``descend`` makes one from aggregates: one pass per
step, whose mean gradients are all that reaches the driver. Hidden units are logistic, the output is a softmax. ``score_long`` applies a
table of any width by joins and sums, over rows in long form; ``probability`` applies a small one as a single column.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage

WEIGHTS = "layer int, source int, target int, w double"
CONSTANT = -1


def first_weight(layer: int, source: int, target: int, seed: int) -> float:
    """Between -0.5 and 0.5, by a hash."""
    return int(hashlib.md5(f"{layer}:{source}:{target}:{seed}".encode()).hexdigest()[:8], 16) / 2.0**32 - 0.5


def places(layers: Sequence[int]) -> list[tuple[int, int, int]]:
    """(layer, source, target) of all weights."""
    return [(k, i, j) for k in range(len(layers) - 1) for j in range(layers[k + 1]) for i in range(CONSTANT, layers[k])]


def weight_table(spark: SparkSession, layers: Sequence[int], weights: Sequence[float]) -> DataFrame:
    """The weights of a fitted Spark ML perceptron: per layer a matrix by columns of sources, then the constants."""
    rows, at = [], 0
    for k, (wide, out) in enumerate(zip(layers, layers[1:])):
        for i in [*range(wide), CONSTANT]:
            for j in range(out):
                rows.append((k, i, j, float(weights[at])))
                at += 1
    return spark.createDataFrame(rows, WEIGHTS).coalesce(1)


def logistic(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def units(weights: dict[tuple[int, int, int], Column], layers: Sequence[int], x: Sequence[Column]) -> list[list[Column]]:
    """The columns of each layer; the last one before the softmax."""
    out = [list(x)]
    for k, wide in enumerate(layers[1:]):
        sums = [reduce(lambda a, b: a + b, [weights[k, i, j] * out[-1][i] for i in range(layers[k])], weights[k, CONSTANT, j]) for j in range(wide)]
        out.append(sums if k == len(layers) - 2 else [logistic(s) for s in sums])
    return out


def probability(weights: Sequence, layers: Sequence[int], x: Sequence[Column]) -> Column:
    """Of the second of two classes, for collected rows of a table."""
    table = {(r["layer"], r["source"], r["target"]): F.lit(r["w"]) for r in weights}
    a, b = units(table, layers, x)[-1]
    return logistic(b - a)


def score_long(values: DataFrame, weights: DataFrame, layers: int) -> DataFrame:
    """(id, target, p) for rows (id, place, x): per layer one join on the place and one sum per unit."""
    here = values
    for k in range(layers - 1):
        own = weights.filter(F.col("layer") == k)
        constants = own.filter(F.col("source") == CONSTANT).select("target", F.col("w").alias("c"))
        sums = here.join(own.select(F.col("source").alias("place"), "target", "w"), "place").groupBy("id", "target").agg(F.sum(F.col("x") * F.col("w")).alias("z"))
        sums = sums.join(constants, "target").select("id", "target", (F.col("z") + F.col("c")).alias("z"))
        here = sums.select("id", F.col("target").alias("place"), logistic(F.col("z")).alias("x")) if k < layers - 2 else sums
    total = here.groupBy("id").agg(F.max("z").alias("top"), F.collect_list(F.struct("target", "z")).alias("zs"))  # one entry per class
    whole = F.aggregate("zs", F.lit(0.0), lambda a, z: a + F.exp(z["z"] - F.col("top")))
    return total.select("id", "top", whole.alias("whole"), F.inline("zs")).select("id", "target", (F.exp(F.col("z") - F.col("top")) / F.col("whole")).alias("p"))


def descend(rows: DataFrame, x: Sequence[str], label: str, hidden: int, steps: int, rate: float = 1.0, seed: int = 7) -> DataFrame:
    """Full descent on the mean log loss of two classes, with one hidden layer; rows with nulls are left out."""
    layers = [len(x), hidden, 2]
    table = cut_lineage(rows.select(*[F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(x)], F.col(label).cast("double").alias("_y")).dropna())
    names = places(layers)
    now = {p: first_weight(*p, seed) for p in names}
    for _ in range(steps):
        _, h, _ = units({p: F.lit(w) for p, w in now.items()}, layers, [F.col(f"_x{i}") for i in range(len(x))])
        known = table.withColumns({f"_h{j}": c for j, c in enumerate(h)})
        z = units({(k - 1, i, j): F.lit(w) for (k, i, j), w in now.items() if k == 1}, layers[1:], [F.col(f"_h{j}") for j in range(hidden)])[-1]
        known = known.withColumn("_e", logistic(z[1] - z[0]) - F.col("_y"))  # of the second output; of the first its negative
        slope = {}
        for k, i, j in names:
            if k == 1:
                slope[k, i, j] = (F.col("_e") if j else -F.col("_e")) * (F.lit(1.0) if i == CONSTANT else F.col(f"_h{i}"))
            else:
                back = F.col("_e") * F.lit(now[1, j, 1] - now[1, j, 0]) * F.col(f"_h{j}") * (1 - F.col(f"_h{j}"))
                slope[k, i, j] = back * (F.lit(1.0) if i == CONSTANT else F.col(f"_x{i}"))
        mean = known.agg(*[F.avg(c).alias(f"g{n}") for n, c in enumerate(slope.values())]).first()
        now = {p: w - rate * (mean[f"g{list(slope).index(p)}"] or 0.0) for p, w in now.items()}
    return rows.sparkSession.createDataFrame([(*p, w) for p, w in now.items()], WEIGHTS).coalesce(1)
