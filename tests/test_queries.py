"""Every query of the engine against its SQL twin on the smallest data set.

The corpus operators have tests of their own: they can be left out of the package.
"""

import pytest

import __spark_entry__ as entry_points
from workload.compare import connect, differences
from workload.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_its_sql(spark, con, name):
    rows, found = differences(spark, con, SF, name)
    assert rows > 0 and not found, found


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def test_all_queries_are_registered():
    assert set(QUERIES) <= set(entry_points.queries())
    assert {name: ORACLES[name] for name in QUERIES} == {
        name: sql for name, sql in entry_points.oracle_sql().items() if name in QUERIES
    }


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.count() == 150 and df.columns[0] == "customer_id"
