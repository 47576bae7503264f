"""Session settings and the shared folder for written intermediates."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import DataFrame, SparkSession

# What the library relies on.  Adaptive execution is on by default in Spark 4;
# it sizes shuffle partitions, turns joins into broadcasts from measured sizes
# and splits skewed join partitions.
SESSION_OPTIONS = {
    "spark.sql.session.timeZone": "UTC",
    # Generated methods above this size are interpreted by the JVM; split them instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def apply_options(builder: SparkSession.Builder) -> SparkSession.Builder:
    for name, value in SESSION_OPTIONS.items():
        builder = builder.config(name, value)
    return builder


@cache
def _local_scratch() -> str:
    return tempfile.mkdtemp(prefix="statement-lake-")


def scratch_folder(spark: SparkSession) -> str:
    """The shared folder the cluster names; a folder of this machine only in local mode."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        return _local_scratch()
    raise ValueError("set spark.checkpoint.dir to a folder that all executors share")


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_folder(spark)}/{label}-{uuid.uuid4().hex}"


#: Removes the shuffle files of a write when it has ended.
FREES_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """What writes shuffle inside goes as each of them ends.

    Otherwise it stays until the driver happens to collect its garbage, and a
    chain of writes needs the disk of all its shuffles together.
    """
    before = spark.conf.get(FREES_SHUFFLES, "false")
    spark.conf.set(FREES_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(FREES_SHUFFLES, before)


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write once to the shared folder and read back.

    Cuts the lineage so a lost executor costs a re-read and not a recomputation,
    and gives the planner measured sizes: a join to a settled side is broadcast
    only when the files are small, and otherwise keeps a plain shuffle on both
    sides, which is the shape whose skewed partitions adaptive execution splits.
    """
    return settle_at(df, scratch_path(df.sparkSession, label))


def settle_at(df: DataFrame, path: str) -> DataFrame:
    with shuffles_freed(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def settled(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """``settle`` for what is read inside only: its files go at the end, well or not."""
    path = scratch_path(df.sparkSession, label)
    try:
        yield settle_at(df, path)
    finally:
        discard(df.sparkSession, path)


def discard(spark: SparkSession, path: str) -> None:
    """Remove a folder of written intermediates."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
