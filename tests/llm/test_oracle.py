"""Registered queries of the package against their DuckDB SQL."""

import duckdb
import pytest

from layerwright.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in "documents embeddings pages benchmark labels conversations".split():
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", list(queries.ORACLE))
def test_query(spark, duck, name):
    found = queries.QUERIES[name](spark, SF)
    expected = duck.sql(queries.ORACLE[name])
    order = sorted(found.columns)
    assert sorted(expected.columns) == order
    at = [expected.columns.index(c) for c in order]
    rows = sorted(tuple(str(r[c]) for c in order) for r in found.collect())
    assert rows == sorted(tuple(str(r[i]) for i in at) for r in expected.fetchall())
