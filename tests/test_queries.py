"""Every registered query against its DuckDB oracle on the smallest tables,
plus the driver smoke contract."""

import os

import pytest

import __spark_entry__ as E
from mesura import catalog
from tests.oracle_harness import compare, duck

SF = os.environ.get("MESURA_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert {"mpi_rank", "mpi_cumulative_pct"} <= set(df.columns)


def test_every_query_has_a_check():
    assert set(E.oracle_sql()) <= set(E.queries()) and set(catalog.QUERIES) <= set(E.queries())
    assert set(catalog.ORACLE) == set(catalog.QUERIES)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_oracle(spark, con, name):
    info = compare(spark, con, SF, name, catalog.QUERIES[name], catalog.ORACLE[name])
    assert info.get("ok") is True, info
    assert info["rows"] > 0
