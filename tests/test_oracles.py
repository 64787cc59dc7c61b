"""Every registered query against its SQL on the test tables."""

import pytest

import __spark_entry__ as driver
import workload.oracles
import workload.queries
from tests.comparison import assert_same, duck, folder

QUERIES, ORACLES = driver.queries(), driver.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return duck(folder("0.001"))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, connection, name):
    assert_same(QUERIES[name](spark, folder("0.001")), connection, ORACLES[name])


def test_every_query_but_the_forest_has_sql():
    assert set(workload.queries.QUERIES) - set(workload.oracles.ORACLES) == {"ml_dynamic_weights"}


def test_entry_returns_rows(spark):
    assert driver.entry(spark).count() == 32
