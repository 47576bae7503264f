"""A key that holds a third of the rows is split over tasks, and results stay whole."""

import contextlib

import pytest
from pyspark.sql import functions as F

from statement_lake.operators import obfuscate as X
from statement_lake.operators import registry as R
from statement_lake.operators import upsert as U
from statement_lake.session import settle

ROWS = 60000
SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@contextlib.contextmanager
def settings(spark, values):
    before = {name: spark.conf.get(name, None) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@pytest.fixture(scope="module")
def facts(spark):
    """A third of the rows share one key; the others have a key of their own each."""
    hot = F.expr("id < {}".format(ROWS // 3))
    key = F.when(hot, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id").cast("string")))
    rows = spark.range(0, ROWS, numPartitions=8).select(
        key.alias("symbol"),
        F.lit(1).cast("bigint").alias("conid"),
        F.lit("text").alias("description"),
        F.sha2(key, 256).alias("h"),
        F.when(hot, F.lit("b")).otherwise(F.lit("a")).alias("file_order"),
        F.sha2(F.col("id").cast("string"), 256).alias("filler"),
        F.col("id").cast("double").alias("tradePrice"),
    )
    return settle(rows, "facts")


def splits(df):
    """Write the result, as the callers do, and look at the plan that ran."""
    df = df.withColumn("one", F.lit(1))
    rows = df.toArrow().num_rows
    return rows, "skew=true" in df._jdf.queryExecution().executedPlan().toString()


def test_canonical(spark, facts):
    known = facts.select("symbol", "conid", "description").distinct()
    known = settle(known.withColumn("map_to", F.lit("M")), "known")
    with settings(spark, SETTINGS):
        assert splits(R.canonical(facts, known)) == (ROWS, True)


def test_replace_by_hash(spark, facts):
    batch = settle(facts.where("symbol = 'k50000'"), "batch")
    with settings(spark, SETTINGS):
        assert splits(U.replace_by_hash(facts, batch, "h")) == (ROWS, True)


def test_last_file_by_hash(spark, facts):
    with settings(spark, SETTINGS):
        assert splits(U.last_file_by_hash(facts, "h")) == (ROWS, True)


def test_obfuscate(spark, facts):
    codes = settle(X.symbol_codes(facts), "codes")
    with settings(spark, SETTINGS):
        assert splits(X.obfuscate(facts, "trades_history", codes, 2.0)) == (ROWS, True)
