"""Every registered query against its SQL in DuckDB."""

import pytest

import __spark_entry__ as entry_module
from oracle import compare, connect
from sparkloom.plans.catalog import ORACLE_SQL, QUERIES

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(entry_module.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, duck, name):
    frame = entry_module.queries()[name](spark, FOLDER)
    assert compare(duck, frame, entry_module.oracle_sql()[name]) == []


def test_entry(spark):
    frame = entry_module.entry(spark)
    assert frame.columns == ["registration", "average_price"]
    assert frame.count() > 0
