import pytest
from __spark_entry__ import entry, oracle_sql, queries

from checks.compare import difference, duck
from checks.registry import ORACLES, QUERIES


@pytest.fixture(scope="module")
def connection(sf):
    return duck(sf)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_against_duckdb(spark, sf, connection, name):
    assert difference(QUERIES[name](spark, sf), connection, ORACLES[name]) is None


def test_every_query_is_registered(spark, sf):
    assert set(QUERIES) == set(ORACLES)
    assert QUERIES.items() <= queries().items() and ORACLES.items() <= oracle_sql().items()
    assert not entry(spark).isEmpty()
