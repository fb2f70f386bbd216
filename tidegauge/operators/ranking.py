"""Top-k, both ends, global ranks and cumulative totals without a single-task sort."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import cut_lineage
from .quantiles import exact_quantiles


def top_n(df: DataFrame, measure: str, n: int, tie: str) -> DataFrame:
    return df.orderBy(F.desc(measure), F.col(tie)).limit(n)


def both_ends(df: DataFrame, measure: str, n: int, tie: str) -> DataFrame:
    """The ``n`` largest and ``n`` smallest rows with their place, ties by ``tie``."""
    def end(order: list[Column], label: str) -> DataFrame:
        cut = df.orderBy(*order).limit(n)  # n rows, so one window task is enough
        return cut.select("*", F.lit(label).alias("end"), F.row_number().over(W.orderBy(*order)).cast("long").alias("place"))
    return end([F.desc(measure), F.col(tie)], "top").unionByName(end([F.asc(measure), F.col(tie)], "bottom"))


def top_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    place = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("place", place).filter(F.col("place") <= k).withColumn("place", F.col("place").cast("long"))


def grouped_sort(df: DataFrame, key: str, measure: str, tie: Sequence[Column], pieces: int = 1, limit: int = 10_000) -> DataFrame:
    """Send each class to partitions of its own and sort inside them by falling ``measure``, then ``tie``.

    Classes are numbered in their order, nulls first; class i fills the partitions i * pieces to (i + 1) * pieces - 1.
    With several ``pieces`` a class is cut at quantiles of its measure, so that its partitions follow one another.
    The rows are written once, so that ``partition`` and ``place`` (from 0) say where they lie. At most ``limit`` classes.
    """
    found = df.select(key).distinct().orderBy(F.asc_nulls_first(key)).limit(limit + 1).collect()
    if len(found) > limit:
        raise ValueError(f"{key} has more than {limit} values")
    at = F.lit(0)
    cuts = exact_quantiles(df, {f"{i}_{p}": (F.when(F.col(key).eqNullSafe(F.lit(r[0])), F.col(measure)), p / pieces) for i, r in enumerate(found) for p in range(1, pieces)})
    for i, r in enumerate(found):
        step = F.lit(i * pieces)
        for p in range(1, pieces):
            step = step + F.coalesce(F.col(measure) <= F.lit(cuts[f"{i}_{p}"]), F.lit(False)).cast("int")
        at = F.when(F.col(key).eqNullSafe(F.lit(r[0])), step).otherwise(at)
    n = max(1, len(found) * pieces)
    laid = df.withColumn("_at", at.cast("int")).repartitionById(n, F.col("_at")).sortWithinPartitions("_at", F.desc(measure), *tie)
    laid = cut_lineage(laid.select(*df.columns, F.col("_at").cast("long").alias("partition"), F.spark_partition_id().alias("_real"), F.monotonically_increasing_id().alias("_mid")))
    return laid.select(*df.columns, F.when(F.col("_real") == F.col("partition"), F.col("partition")).alias("partition"), (F.col("_mid") % F.lit(2**33)).alias("place"))


def global_rank(df: DataFrame, order: Sequence[Column], name: str = "rank", partitions: int | None = None) -> DataFrame:
    """0-based position in the total order.

    Rows are range partitioned and numbered inside their partition; the offsets come from
    one count per partition. The numbered rows are written once, because sampled range
    bounds may differ between two runs of the same plan.
    """
    spread = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    numbered = cut_lineage(
        spread.sortWithinPartitions(*order).withColumn("_mid", F.monotonically_increasing_id())
    )
    shift = 2**33  # the id holds the partition number above 33 bits of row number
    part = F.floor(F.col("_mid") / F.lit(shift)).cast("long")
    numbered = numbered.withColumns({"_part": part, "_in": F.col("_mid") % F.lit(shift)})
    sizes = numbered.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))  # one row per partition
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    return (
        numbered.join(offsets, "_part").withColumn(name, F.col("_off") + F.col("_in"))
        .drop("_mid", "_part", "_in", "_off")
    )


def cumulative_by_value(df: DataFrame, value: str, sums: Mapping[str, Column], buckets: int | None = None) -> DataFrame:
    """One row per distinct value with each sum over that value and over all smaller values.

    Equal values meet in a map-side aggregate. The distinct values are cut into buckets at
    sketched quantiles; running sums go bucket by bucket and the totals of earlier buckets
    (a table of ``buckets`` rows) are added. The cut points affect balance, not the result.
    Adds ``<name>`` and ``<name>_before``. There are as many buckets as shuffle partitions.
    Rows whose value is null or NaN take no part.
    """
    number = F.col(value).cast("double")
    df = df.filter(number.isNotNull() & ~F.isnan(number))
    buckets = buckets or max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    grouped = df.groupBy(value).agg(*[e.alias(n) for n, e in sums.items()])
    cuts = df.agg(F.percentile_approx(number, [i / buckets for i in range(1, buckets)], 1000)).first()[0]
    edges = F.array(*[F.lit(float(c)) for c in sorted(set(cuts or [0.0]))])
    numbered = grouped.withColumn("_bucket", F.size(F.filter(edges, lambda e: e <= number)))
    totals = numbered.groupBy("_bucket").agg(*[F.sum(n).alias("_t_" + n) for n in sums])
    earlier = W.orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select("_bucket", *[F.coalesce(F.sum("_t_" + n).over(earlier), F.lit(0)).alias("_o_" + n) for n in sums])
    inside = W.partitionBy("_bucket").orderBy(value).rowsBetween(W.unboundedPreceding, -1)
    run = numbered.withColumns({"_i_" + n: F.coalesce(F.sum(n).over(inside), F.lit(0)) for n in sums})
    out = run.join(offsets, "_bucket")
    return out.select(value, *sums, *[(F.col("_i_" + n) + F.col("_o_" + n)).alias(n + "_before") for n in sums])
