"""Every query of the library's plans against DuckDB on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from tallymill.plans import ORACLES, QUERIES
from tests.compare import differences, duck
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def connection():
    return duck(SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, connection, name):
    found = contract.queries()[name](spark, SMALL).toArrow()
    assert found.num_rows > 0
    expected = connection.sql(contract.oracle_sql()[name]).to_arrow_table()
    assert differences(found, expected) == []


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    assert contract.entry(spark).count() == 6


def test_comparison_sees_changed_values_and_types(connection):
    one = connection.sql("SELECT 1 AS a, 'x' AS b").to_arrow_table()
    for other in ["SELECT 2 AS a, 'x' AS b", "SELECT 1.0::DOUBLE AS a, 'x' AS b", "SELECT 1 AS c, 'x' AS b"]:
        assert differences(one, connection.sql(other).to_arrow_table())
