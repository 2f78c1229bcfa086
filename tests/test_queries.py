"""Every registered query against its SQL on the smallest tables."""

import os

import oracle
import pytest

import __spark_entry__ as driver
from listinglake.plans.catalog import ORACLES, QUERIES

TABLES = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(TABLES), reason="test tables not there")


@pytest.fixture(scope="module")
def connection():
    return oracle.connect(TABLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, connection, name):
    assert oracle.difference(spark, connection, name, TABLES) is None


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES) <= set(driver.queries())
    assert set(ORACLES) <= set(driver.oracle_sql()) <= set(driver.queries())


def test_entry(spark):
    assert driver.entry(spark).count() == 1500
