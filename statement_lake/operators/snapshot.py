"""Snapshots, batch summaries and ordered output."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_snapshot(rows: DataFrame, date: str) -> DataFrame:
    """Rows of the last date of the whole table."""
    last = rows.agg(F.max(date)).scalar()
    return rows.where(F.col(date) == last)


def batch_summary(rows: DataFrame, by: str, date: str) -> DataFrame:
    """Per file or source: rows, first and last date, number of dates.

    Rows are counted per date first, so one large file is summed from small
    partial counts.
    """
    per_date = rows.groupBy(by, date).agg(F.count("*").alias("_rows"))
    return per_date.groupBy(by).agg(
        F.sum("_rows").alias("rows"),
        F.min(date).alias("min_date"),
        F.max(date).alias("max_date"),
        F.count(date).alias("dates"),
    )


def in_order(rows: DataFrame, *keys: str) -> DataFrame:
    """Ordered output as range partitions sorted inside, written in parallel."""
    return rows.repartitionByRange(*keys).sortWithinPartitions(*keys)


def stored_positions(stored: DataFrame) -> DataFrame:
    """Rows of a stored parquet dataset with the ``position`` each has in its files, by file name.

    Files are as many as the write had partitions; their sizes alone are added up.
    """
    placed = stored.select(
        "*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_index")
    )
    sizes = placed.groupBy("_file").agg(F.count("*").alias("_size"))
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_file", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    return placed.join(starts, "_file").withColumn("position", F.col("_start") + F.col("_index")).drop(
        "_file", "_index", "_start"
    )
