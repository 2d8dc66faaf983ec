"""Every registered query against its SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from compare import database, differences
from crateflow.catalog.oracle import ORACLE
from crateflow.catalog.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return database(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries())
    assert set(ORACLE) <= set(entry.oracle_sql())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["employee_id", "region", "revenue", "order_lines"]
    assert df.count() > 0


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_gives_what_sql_gives(spark, con, name):
    assert differences(entry.queries()[name](spark, FOLDER), con, entry.oracle_sql()[name]) is None
