"""Every registered query against its DuckDB oracle SQL.

Runs on sf0.001 by default (fast); set QUIVER_ORACLE_SF=/root/testdata/sf0.01
for the scale the driver checks at.
"""

import os

import pytest

from __spark_entry__ import entry
from quiver.plans import QUERIES, oracle_sql
from oracle_compare import compare, duckdb_connection

SF_DIR = os.environ.get("QUIVER_ORACLE_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return duckdb_connection(SF_DIR)


def test_every_query_has_oracle():
    assert set(QUERIES) == set(oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    out = compare(spark, con, name, QUERIES[name], oracle_sql()[name], SF_DIR)
    assert out.columns_match, out.detail
    assert out.rows_spark == out.rows_oracle, out.detail
    assert out.values_match, out.detail


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.columns == ["closings", "triangles"]
    assert df.collect()[0].closings == 27181
