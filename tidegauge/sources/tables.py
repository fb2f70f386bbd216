"""Scans, slices and sinks over files. Schemas are declared where the format has none."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Deal out the rows of a scan that has fewer partitions than cores, before costly row work.

    A large table has many more partitions than that and is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(2 * cores) if df.rdd.getNumPartitions() < cores else df


def read_csv(spark: SparkSession, path: str, schema: str | None = None, infer: bool = False, sep: str = ",") -> DataFrame:
    """CSV with a header; all columns are text unless a schema is given or inference is asked for."""
    reader = spark.read.option("header", True).option("sep", sep)
    if schema:
        return reader.schema(schema).csv(path)
    return reader.option("inferSchema", infer).csv(path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text lines of a file, a folder or gzip files, in a column ``value``."""
    return spark.read.text(path)


def read_delimited(spark: SparkSession, path: str, schema: str, tag: str, value: object, sep: str = ";") -> DataFrame:
    """Delimited numbers with a header line, plus a constant column naming the source."""
    return read_csv(spark, path, schema=schema, sep=sep).withColumn(tag, F.lit(value))


def from_rows(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A small configuration table."""
    return spark.createDataFrame(list(rows), schema)


# Fixed meaning of the named slices: (first instant, instant after the last).
SLICES = {
    "3M": ("1995-01-01", "1995-04-01"),
    "1Y": ("1995-01-01", "1996-01-01"),
    "5Y": ("1995-01-01", "2000-01-01"),
    "FUTURE": ("2000-01-01", "2100-01-01"),
}


def slice_rows(df: DataFrame, when: str, name: str) -> DataFrame:
    """Plain range on the time column, so that it reaches the Parquet scan."""
    low, high = (F.lit(x).cast(df.schema[when].dataType) for x in SLICES[name])
    return df.filter((F.col(when) >= low) & (F.col(when) < high))


def up_to_month(df: DataFrame, year: Column, month: Column, last_year: int, last_month: int) -> DataFrame:
    return df.filter((year < last_year) | ((year == last_year) & (month <= last_month)))


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    writer = df.write.mode("overwrite").option("compression", "snappy")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_stage(df: DataFrame, path: str) -> DataFrame:
    """Write a stage and continue from the file, so later steps do not recompute it."""
    write_table(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_year(df: DataFrame, year: Column, value: int, path: str) -> DataFrame:
    return write_stage(df.filter(year == value), path)


def write_lines(df: DataFrame, path: str, files: int) -> None:
    df.repartition(files).write.mode("overwrite").text(path)


def balanced(df: DataFrame, *columns: str) -> DataFrame:
    """Let adaptive execution choose even output files; a hot value is split over several."""
    return df.hint("rebalance", *columns)


def export_report(df: DataFrame, path: str, fmt: str = "csv", max_rows: int = 1_000_000) -> None:
    """Small result tables as one CSV or JSON file; a table above ``max_rows`` is refused, as one task writes it."""
    if df.limit(max_rows + 1).count() > max_rows:
        raise ValueError(f"a report has {max_rows} rows at most; use write_table")
    writer = df.coalesce(1).write.mode("overwrite")
    writer.option("header", True).csv(path) if fmt == "csv" else writer.json(path)
