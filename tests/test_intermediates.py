"""What intermediates leave on disk."""

import datetime as dt
import os
import time

from pyspark.sql import functions as F

from statement_lake.operators import upsert
from statement_lake.operators.registry import REGISTRY_SCHEMA, resolve
from statement_lake.plans.lake import Lake
from statement_lake.plans.pipeline import load_files
from statement_lake.session import scratch_folder, settle, settled
from statement_lake.sources import specs
from tests.helpers import as_list, element, statement, write

D = dt.date


def shuffle_files(spark):
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
    return {name for name in map(str, (blocks.apply(i) for i in range(blocks.size()))) if name.startswith("shuffle_")}


def folders(spark, label):
    at = scratch_folder(spark)
    return {name for name in os.listdir(at) if name.startswith(f"{label}-")} if os.path.isdir(at) else set()


def rows_by_key(spark):
    return spark.range(20_000).groupBy((F.col("id") % 7_000).alias("key")).agg(F.max("id").alias("last"))


def test_settling_leaves_no_shuffle_behind(spark):
    before = shuffle_files(spark)
    settle(rows_by_key(spark), "by-key")
    for _ in range(50):  # they are removed in the background
        if not shuffle_files(spark) - before:
            break
        time.sleep(0.1)
    assert shuffle_files(spark) - before == set()


def test_what_is_settled_for_a_step_goes_with_it(spark):
    with settled(rows_by_key(spark), "for-a-step") as frame:
        assert frame.count() == 7_000 and len(folders(spark, "for-a-step")) == 1
    assert folders(spark, "for-a-step") == set()


def test_resolving_writes_open_rows_only(spark):
    mapped = [("A", "A", 1, "x", D(2024, 1, 1), "trades")] * 5
    opened = [(None, "B", 1, "y", D(2024, 2, 1), "trades"), (None, None, 2, "z", D(2024, 2, 1), "trades")]
    registry = settle(spark.createDataFrame(mapped + opened, REGISTRY_SCHEMA), "given")
    before = folders(spark, "registry")
    found = resolve(registry)
    (written,) = folders(spark, "registry") - before
    assert spark.read.parquet(f"{scratch_folder(spark)}/{written}").count() == 2
    assert folders(spark, "moves") == set()
    assert sorted(map(repr, (r.map_to for r in found.collect()))) == ["'A'"] * 6 + ["None"]


def trade(symbol, day, **more):
    return element("Trade", accountId="U1", symbol=symbol, tradeDate=day, **more)


def test_a_load_keeps_no_copies_of_its_rows(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    folder = write(tmp_path / "in", "a.xml", statement(trade("A", "20240102"), trade("A", "20240102"), trade("B", "20240103")))
    write(tmp_path / "in", "b.xml", statement(trade("A", "20240102"), trade("C", "20240104", quantity="x")))
    write(tmp_path / "in", "c.xml", statement(trade("A", "20240102")))
    for _ in range(2):
        assert load_files(lake, specs.TRADES, folder).status == "error"  # b.xml is held back
        assert as_list(lake.bronze(specs.TRADES), "symbol") == [("A",), ("B",)]
    quarantined = spark.read.option("recursiveFileLookup", "true").parquet(f"{lake.root}/quarantine")
    assert as_list(quarantined, "symbol") == [("A",), ("A",), ("C",), ("C",)]
    for label in ("ingest-trades", "batch-trades", "kept-trades"):
        assert folders(spark, label) == set()


def test_copies_of_the_last_file_stay_without_a_shuffle_of_whole_rows(spark):
    rows = [("h", "f1", 1), ("h", "f2", 1), ("h", "f2", 1), ("k", "f1", 2), ("k", "f1", 2), (None, "f1", 3), (None, "f2", 3)]
    batch = settle(spark.createDataFrame(rows, "h string, file_order string, value int"), "given")
    last = upsert.last_file_copies(batch, "h", ["h", "value"])
    assert as_list(last, "h", "value") == [("h", 1), ("h", 1), ("k", 2), ("k", 2), (None, 3)]
    plan = last._jdf.queryExecution().sparkPlan().toString()
    assert "Aggregate" not in plan
