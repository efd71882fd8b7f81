"""Each registered query against its SQL on the smallest tables."""

from pathlib import Path

import pytest
from oracle import connect, difference

import __spark_entry__ as entry_points
from millrace_queries import ORACLE, QUERIES

# The smallest tables on which every query returns rows.
SF_DIR = "/root/testdata/sf0.01"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, connection, name):
    assert difference(spark, connection, SF_DIR, name, QUERIES[name], ORACLE[name]) is None


def test_entry(spark):
    assert entry_points.entry(spark).columns == ["l_partkey", "cnt", "avg", "p_partkey", "p_name"]
    assert set(ORACLE) == set(QUERIES)
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", ["ratings_ranking", "ratings_report"])
def test_order_of_sorted_results(spark, name):
    """The comparison above takes results as bags."""
    found = [(-r.avg, r[0]) for r in QUERIES[name](spark, SF_DIR).collect()]
    assert len(found) > 1 and found == sorted(found)
