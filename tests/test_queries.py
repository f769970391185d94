"""Every registered query against its SQL twin, on the smallest test tables."""

import os

import pytest

from compare import difference, duck

import __spark_entry__ as entry

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", entry.queries())
def test_query(spark, con, name):
    df = entry.queries()[name](spark, SF_DIR)
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert df.count() > 0
    else:
        assert difference(df, con, sql) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_oracles_name_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())
