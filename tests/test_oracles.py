"""Every registered query against its SQL on another engine."""

import pytest
from checking import compare, connect

from ferrybook.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(folder):
    return connect(folder)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, folder, con, name):
    assert compare(QUERIES[name](spark, folder), con, ORACLES[name]) is None
