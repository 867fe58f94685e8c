"""Every text query with SQL against that SQL on another engine."""

import pytest
from checking import compare, connect

from ferrybook.llm.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(folder):
    return connect(folder)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, folder, con, name):
    assert compare(QUERIES[name](spark, folder), con, ORACLES[name]) is None


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
