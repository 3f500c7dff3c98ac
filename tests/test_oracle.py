"""Every trip query against its SQL on the smallest tables."""

import pytest
from compare import compare, connect
from conftest import SF

import __spark_entry__ as driver
import trip_oracle
from tripflow.plans import registry

QUERIES, SQL = registry.queries(), trip_oracle.oracle_sql()
WITHOUT_SQL = {"schema_hash", "file_hash"}


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_all_are_registered():
    assert set(QUERIES) <= set(driver.queries()) and set(SQL) <= set(driver.oracle_sql())


def test_only_file_facts_lack_sql():
    assert set(QUERIES) - set(SQL) == WITHOUT_SQL
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    assert compare(spark, duck, QUERIES[name], SQL[name], SF) is None


@pytest.mark.parametrize("name", sorted(WITHOUT_SQL))
def test_file_query_has_rows(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    frame = driver.entry(spark)
    assert frame.count() > 0 and len(frame.columns) == 10
