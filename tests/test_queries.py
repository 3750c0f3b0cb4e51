"""Every named query against its SQL, on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from check_queries import compare, connect
from surgelens.registry.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, name):
    sql = entry.oracle_sql().get(name)
    wrong, _, _ = compare(spark, con, name, entry.queries()[name], sql, SF_DIR)
    assert wrong is None


def test_entry(spark):
    assert entry.entry(spark).count() == 20
    assert set(QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())
