"""Every registered query against its SQL, at the smallest scale."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from checks.oracles import all_oracles
from checks.queries import all_queries
from tests.compare import connect, difference

QUERIES, SQL = queries(), oracle_sql()


@pytest.fixture(scope="module")
def con(small):
    return connect(small)


def test_each_query_has_sql():
    assert set(all_queries()) == set(all_oracles())


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query_equals_sql(spark, con, small, name):
    assert difference(spark, con, small, QUERIES[name], SQL[name]) is None


def test_entry(spark):
    found = entry(spark)
    assert found.columns == ["client_id", "transaction_day", "daily_transaction_count", "daily_total_amount"]
    assert found.count() == 11
