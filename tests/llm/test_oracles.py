"""Queries of the subpackage against their DuckDB counterparts, on whole tables."""

import os

import duckdb
import pytest
from tablegauge.llm.queries import ORACLE_SQL, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_duckdb(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF_DIR}/{table}.parquet')")
    result = QUERIES[name](spark, SF_DIR)
    columns = sorted(result.columns)
    expected = duck.sql(ORACLE_SQL[name])
    assert columns == sorted(expected.columns)
    quoted = ", ".join(f'"{c}"' for c in columns)
    want = sorted(map(str, expected.project(quoted).fetchall()))
    got = sorted(str(tuple(row[c] for c in columns)) for row in result.collect())
    assert got == want and got


def test_toxicity_of_rows_held_out(spark):
    """Held-out accuracy: documents of the holdout that have a label."""
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    scored = QUERIES["op2_ftrl"](spark, SF_DIR).filter("held_out").join(labels, "doc_id").collect()
    right = sum(r.predicted == r.toxic for r in scored)
    assert right >= 0.93 * len(scored) > 0
    clean = [r.predicted for r in scored if not r.toxic]
    assert sum(clean) <= 0.05 * len(clean)
