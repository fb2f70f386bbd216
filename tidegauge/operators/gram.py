"""Sums of products of all pairs of columns in one pass, for tables of any width."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sums_of_products(df: DataFrame, columns: Sequence[Column], by: Column | None = None) -> dict[int, np.ndarray]:
    """Group (0 without ``by``) -> matrix of the sums of z_i * z_j over its rows; null counts as 0.

    With groups, each task multiplies blocks of rows as matrices and hands on one matrix per group; what
    reaches the driver is as large as the square of the number of columns, whatever the rows.
    """
    k = len(columns)
    if by is None:
        return {0: gramian(df, columns)}
    rows = df.select(by.cast("long").alias("g"), F.array(*[F.coalesce(c.cast("double"), F.lit(0.0)) for c in columns]).alias("z"))

    def multiply(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            g = batch.column("g").to_numpy(zero_copy_only=False)
            z = batch.column("z").flatten().to_numpy().reshape(len(g), k)
            for x in np.unique(g):
                part = z[g == x]
                sums[int(x)] = sums.get(int(x), 0) + part.T @ part
        for x, m in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([x] * k, pa.int64()), pa.array(range(k), pa.int32()), pa.array(list(m), pa.list_(pa.float64()))], names=["g", "i", "row"])

    parts = rows.filter(F.col("g").isNotNull()).mapInArrow(multiply, "g long, i int, row array<double>")
    total = parts.withColumn("row", array_to_vector("row")).groupBy("g", "i").agg(Summarizer.sum(F.col("row")).alias("row"))
    out: dict[int, np.ndarray] = {}
    for r in total.select("g", "i", vector_to_array("row").alias("row")).collect():  # columns squared, per group
        out.setdefault(r["g"], np.zeros((k, k)))[r["i"]] = r["row"]
    return out


def gramian(df: DataFrame, columns: Sequence[Column]) -> np.ndarray:
    """Sums of z_i * z_j over all rows, without Python workers; null counts as 0.

    Tasks add up packed triangles, which meet as a tree; up to 65,535 columns.
    """
    z = F.array(*[F.coalesce(c.cast("double"), F.lit(0.0)) for c in columns])
    nothing = df.sparkSession.range(1).select(F.array_repeat(F.lit(0.0), len(columns)).alias("z"))  # so that there is a row
    vectors = df.select(z.alias("z")).union(nothing).select(array_to_vector("z").alias("z"))
    return RowMatrix(MLUtils.convertVectorColumnsFromML(vectors, "z"), 0, len(columns)).computeGramianMatrix().toArray()


def correlations(df: DataFrame, columns: Sequence[Column]) -> np.ndarray:
    """Pearson r of all pairs, each over the rows where both are present; NaN where either is constant there.

    Values are taken about their mean, which keeps the differences of sums well conditioned. Only columns with
    nulls bring a column of their own that says where they are present.
    """
    k = len(columns)
    x = [F.col(f"x{i}") for i in range(k)]
    df = df.select(*[c.cast("double").alias(f"x{i}") for i, c in enumerate(columns)])
    row = df.agg(F.count(F.lit(1)).alias("n"), *[e for i, c in enumerate(x) for e in (F.avg(c).alias(f"m{i}"), F.count(c).alias(f"n{i}"))]).first()
    mean = [row[f"m{i}"] or 0.0 for i in range(k)]
    holes = [i for i in range(k) if row[f"n{i}"] < row["n"]]
    centred = [c - F.lit(m) for c, m in zip(x, mean)]
    z = [F.lit(1.0), *[x[i].isNotNull() for i in holes], *centred, *([c * c for c in centred] if holes else [])]
    m = gramian(df, z)
    present, own = np.zeros(k, int), 1 + len(holes) + np.arange(k)
    present[holes] = 1 + np.arange(len(holes))
    n, first, both = m[np.ix_(present, present)], m[np.ix_(own, present)], m[np.ix_(own, own)]
    second = m[np.ix_(own + k, present)] if holes else np.tile(both.diagonal()[:, None], k)
    with np.errstate(all="ignore"):
        variance = second / n - (first / n) ** 2  # of column i where column j is present
        flat = variance <= 1e-24 * np.maximum(1.0, np.array(mean) ** 2)[:, None]
        variance[flat] = np.nan
        return (both / n - first * first.T / n**2) / np.sqrt(variance * variance.T)
