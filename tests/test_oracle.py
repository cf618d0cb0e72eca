"""Every registered query against its DuckDB counterpart, on whole tables."""

import os

import duckdb
import pytest

import __spark_entry__ as driver
from oracle_queries import ORACLE_SQL
from tablegauge.plans.registry import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
TABLES = """region nation customer supplier part orders lineitem events documents embeddings
pages benchmark labels conversations""".split()
SPARK_TYPES = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF_DIR}/{table}.parquet')"
        )
    return connection


def _sorted(rows):
    return sorted(rows, key=lambda row: [(v is None, str(v)) for v in row])


def test_every_query_has_a_counterpart():
    assert QUERIES.keys() == ORACLE_SQL.keys()
    assert QUERIES.keys() <= driver.queries().keys()
    assert ORACLE_SQL.keys() <= driver.oracle_sql().keys() <= driver.queries().keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_duckdb(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    columns = sorted(result.columns)
    expected = duck.sql(ORACLE_SQL[name])
    assert columns == sorted(expected.columns)
    types = dict(zip(expected.columns, map(str, expected.types)))
    assert {c: SPARK_TYPES[t] for c, t in result.dtypes} == types

    got = _sorted([tuple(row[c] for c in columns) for row in result.collect()])
    quoted = ", ".join(f'"{c}"' for c in columns)
    want = _sorted(expected.project(quoted).fetchall())
    assert len(got) == len(want) > 0
    assert got == want


def test_entry(spark):
    assert driver.entry(spark).count() == 14
