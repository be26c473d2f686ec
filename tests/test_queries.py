"""Every registered query against its SQL on the smallest tables."""

import pytest
from compare import connect, difference

import __spark_entry__ as contract
from textmill.checks.queries import all_queries

SF = "/root/testdata/sf0.001"
ORACLES = contract.oracle_sql()
WITHOUT_SQL: set[str] = set()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query(spark, con, name):
    got = contract.queries()[name](spark, SF).toPandas()
    assert len(got) > 0
    assert (name in ORACLES) is (name not in WITHOUT_SQL)
    if name in ORACLES:
        assert difference(got, con.sql(ORACLES[name]).df()) is None


def test_entry(spark):
    assert {r.reason for r in contract.entry(spark).collect()} >= {"keep", "duplicate", "html", "pii", "length"}
