"""Every registered query against its DuckDB oracle on the smallest tables."""

import pytest

import __spark_entry__ as driver
from listflow.checks import compare

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = driver.queries(), driver.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return compare.duck(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    if name in ORACLES:
        assert compare.compare(df, duck, ORACLES[name]) is None
    else:
        assert df.count() > 0


def test_entry(spark):
    assert driver.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
