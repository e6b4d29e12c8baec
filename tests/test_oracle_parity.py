"""Every registered query equals its DuckDB oracle (sf0.001 fixture tables)."""

import pytest

import __spark_entry__ as E
from cinespark.oracles import ORACLES
from cinespark.queries import QUERIES
from oracle_check import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES) and set(QUERIES) <= set(E.queries())


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, con, key):
    r = compare(spark, con, key, E.queries()[key], E.oracle_sql()[key], SF)
    assert r["ok"], r


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["genre", "runtimeminutes", "averagerating", "numvotes"]
    assert df.count() > 0
