"""Every query against its SQL counterpart on the given tables."""

import pytest

from tallybook.plans import ORACLES, QUERIES
from tests.oracle import DATA, connect, differences

SF = str(DATA / "sf0.01")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    assert differences(con, ORACLES[name], QUERIES[name](spark, SF)) == []
