"""Every registered query against its SQL, on the smallest tables."""

import checker
import pytest

import __spark_entry__ as driver
from chartloom.registry import QUERIES, SQL

TABLES = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return checker.connect(TABLES)


def test_each_query_has_its_sql():
    assert set(QUERIES) == set(SQL)
    assert set(SQL) <= set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert checker.compare(QUERIES[name](spark, TABLES), con, SQL[name]) > 0


def test_entry(spark):
    assert driver.entry(spark).columns[-1] == "clinical_flag"
