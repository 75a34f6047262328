"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
import compare
from workload.registry import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_matches_sql(spark, con, name):
    assert compare.differences(entry.queries()[name](spark, SF), con, entry.oracle_sql()[name]) == []
