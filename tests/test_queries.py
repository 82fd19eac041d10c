"""Every registered query against its DuckDB SQL twin on the smallest test tables."""

import os

import pytest

import __spark_entry__ as entry
from varframe.plans import catalog
from varframe.plans.check import compare, duck

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(catalog.SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_sql(spark, con, name):
    ok, nrows, _, detail = compare(spark, con, name, entry.queries()[name], entry.oracle_sql()[name], SF)
    assert ok, detail


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() >= 0 and "gene" in df.columns
