"""The queries that SQL can express, against their counterparts."""

import pytest

from tallybook.llm.queries import ORACLES, QUERIES
from tests.oracle import DATA, connect, differences

SF = str(DATA / "sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, con, name):
    assert differences(con, ORACLES[name], QUERIES[name](spark, SF)) == []


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
