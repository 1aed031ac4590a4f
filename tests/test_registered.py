"""Every registered query against its SQL, or at least against being empty."""

import os

import pytest
from oracle_check import compare, connect

from lendmill.plans.registered import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")

@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    problem, _, _ = compare(spark, con, SF, QUERIES[name], ORACLE.get(name))
    assert problem is None


def test_entry_points():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.queries())
