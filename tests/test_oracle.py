"""Every registered query against its DuckDB oracle on the smallest tables."""

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from oracle_check import compare, duck

ORACLES = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_query(spark, con, name):
    fn = E.queries()[name]
    if name not in ORACLES:
        assert fn(spark, SF_SMALL).count() > 0
        return
    ok, msg = compare(spark, con, name, fn, ORACLES[name], SF_SMALL)
    assert ok, msg


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "product_name_list" in df.columns
