"""Every registered query against its SQL, on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from oracle import compare, connect

SF = os.environ.get("SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_entry_points():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    sql = entry.oracle_sql().get(name)
    problems = compare(df, duck, sql) if sql else ([] if df.count() else ["no rows"])
    # A query without rows checks nothing.
    assert problems == []
