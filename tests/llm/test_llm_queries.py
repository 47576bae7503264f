"""Queries of the subpackage that SQL can express, against it."""

import duckdb
import pytest

from statement_lake.llm import queries

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, name):
    engine = duckdb.connect()
    for table in ("documents", "embeddings", "pages"):
        engine.sql(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    found = queries.queries()[name](spark, FOLDER)
    expected = engine.sql(queries.oracle_sql()[name])
    columns = sorted(found.columns)
    assert columns == sorted(expected.columns)
    order = [expected.columns.index(column) for column in columns]
    wanted = sorted((tuple(row[i] for i in order) for row in expected.fetchall()), key=repr)
    assert sorted((tuple(row) for row in found.select(*columns).collect()), key=repr) == wanted
