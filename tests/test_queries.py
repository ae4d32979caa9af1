"""The driver contract: every registered query against its SQL statement."""

import pytest
from oracle import compare, connect

import __spark_entry__ as contract
from provenlake.queries import ORACLES, QUERIES

CONFIGURED = contract.queries()


@pytest.fixture(scope="module")
def con():
    return connect("0.001")


def test_entry(spark):
    df = contract.entry(spark)
    assert df.count() > 0 and "state" in df.columns


def test_every_query_has_a_statement():
    assert set(QUERIES) == set(ORACLES) and set(QUERIES) <= set(CONFIGURED)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    rows, problems = compare(spark, con, name, CONFIGURED[name], ORACLES[name], "0.001")
    assert rows > 0 and problems == []
