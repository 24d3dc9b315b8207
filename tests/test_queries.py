"""Every registered query against its SQL in DuckDB, and the flagship entry."""

import pytest
from compare import compare, duckdb_views

from __spark_entry__ import entry
from stationfield.plans.oracle import ORACLE
from stationfield.plans.registry import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duckdb_views(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    verdict, _ = compare(spark, con, name, SF_DIR)
    assert verdict == "ok"


def test_entry(spark):
    df = entry(spark)
    assert df.columns[:2] == ["plz", "timestamp"]
    assert df.count() == 321
