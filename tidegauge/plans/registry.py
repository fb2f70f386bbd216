"""Where queries register themselves, and access to the tables they read."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..session import shared_folder
from ..sources.tables import read_table

NAMES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


class Tables:
    """The tables of one folder as attributes."""

    def __init__(self, spark: SparkSession, folder: str):
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        self.spark, self.folder = spark, folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name not in NAMES:
            raise AttributeError(name)
        return read_table(self.spark, f"{self.folder}/{name}.parquet")

    def scratch(self, name: str) -> str:
        """A new folder for files a query writes and reads back, beside the checkpoints."""
        return f"{shared_folder(self.spark)}/scratch-{uuid.uuid4().hex}/{name}"


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under a name, with its check."""

    def register(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = Query(lambda spark, folder: fn(Tables(spark, folder)), sql)
        return fn

    return register
