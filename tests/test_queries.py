"""Every registered query against its SQL on the smallest tables."""

import os

import duckdb
import pytest

from statement_lake.plans import oracle, queries as registered

FOLDER = "/root/testdata/sf0.001"
TABLES = ("orders", "lineitem", "events", "part", "customer")

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not there")


@pytest.fixture(scope="module")
def engine():
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def test_every_query_has_its_sql():
    assert set(registered.queries()) == set(oracle.oracle_sql())


@pytest.mark.parametrize("name", sorted(registered.queries()))
def test_query_equals_sql(spark, engine, name):
    found = registered.queries()[name](spark, FOLDER)
    expected = engine.sql(oracle.oracle_sql()[name])
    columns = sorted(found.columns)
    assert columns == sorted(expected.columns)
    order = [expected.columns.index(column) for column in columns]
    wanted = sorted((tuple(row[i] for i in order) for row in expected.fetchall()), key=repr)
    assert sorted((tuple(row) for row in found.select(*columns).collect()), key=repr) == wanted


def test_cash_texts_are_rewritten_for_every_order(spark):
    found = registered.obfuscate_cash_text(spark, FOLDER)
    assert found.count() == spark.read.parquet(f"{FOLDER}/orders.parquet").count()
    # symbols S1, S2, ... and texts that begin with them are replaced throughout
    assert found.where("symbol rlike '^S[0-9]' or description rlike '^S[0-9]+[(]'").count() == 0
