"""Session settings and the two durability helpers that need the session."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}

SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(master: str, app: str = "tidegauge", shuffle_partitions: int = 8) -> SparkSession:
    """Local session for tests and the bench; a cluster brings its own settings."""
    builder = SparkSession.builder.master(master).appName(app)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = (
        builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which driver and executors share.

    Only where all of Spark is one process, as in tests, is a folder of its own made if none is set.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not re.match(r"local(\[|$)", sc.master):
                raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
            folder = tempfile.mkdtemp(prefix="tidegauge-")
        sc.setCheckpointDir(folder)
    return sc.getCheckpointDir().rstrip("/")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and continue from that copy.

    The copy survives the loss of executors, and a plan that refers to it twice reads
    the same rows both times even when the rows came out of a sampled range partitioning.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


@contextmanager
def compact(df: DataFrame) -> Iterator[DataFrame]:
    """A copy of ``df`` in the shared folder as compressed Parquet, until the block ends.

    For large tables that are read several times: a checkpoint is not compressed. What the caller goes on with must not
    depend on the copy. The shuffles that made it are removed when it is written, not when the driver collects its garbage.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/compact-{uuid.uuid4().hex}"
    before = spark.conf.get(SHUFFLES_GO, "false")
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(SHUFFLES_GO, before)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
