"""Every registered query against its DuckDB SQL."""

import math
import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry  # noqa: E402
from workload.oracle import ORACLE  # noqa: E402
from workload.queries import QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return connection


def comparable(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return str(value)


def content(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(comparable(row[i]) for i in order) for row in rows)


def test_each_query_has_sql():
    """All but those that SQL cannot express, which come with the training-data package."""
    assert set(QUERIES) == set(ORACLE) and set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", list(ORACLE))
def test_query(spark, duck, name):
    found = entry.queries()[name](spark, SF)
    expected = duck.sql(entry.oracle_sql()[name])
    assert content(found.columns, found.collect()) == content(expected.columns, expected.fetchall())


def test_flagship(spark):
    first = entry.entry(spark)
    assert first.count() > 0 and first.schema == entry.entry(spark).schema
