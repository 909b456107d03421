import os

import pytest
from compare import connect, difference

import __spark_entry__ as driver
from quotelens.plans.queries import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, con, name):
    assert difference(QUERIES[name](spark, FOLDER), con, SQL[name]) is None


def test_driver_contract(spark):
    assert set(SQL) == set(QUERIES)
    assert set(driver.oracle_sql()) <= set(driver.queries())
    assert set(QUERIES) <= set(driver.queries())
    assert driver.entry(spark).columns == ["source", "carp", "quotes", "ungrounded"]
