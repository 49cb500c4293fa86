"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from gridlake.plans.registered import REGISTRY
from tests.conftest import SMALL
from tests.oracle import compare, database


@pytest.fixture(scope="module")
def connection():
    return database(SMALL)


@pytest.mark.parametrize("name", list(REGISTRY))
def test_query(spark, connection, name):
    count, _, problem = compare(spark, connection, name, SMALL)
    assert not problem and count > 0


def test_every_query_has_sql():
    own = set(REGISTRY)
    assert own <= set(contract.oracle_sql()) and own <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    found = contract.entry(spark)
    assert found.columns == ["event_time", "solar_share"] and found.count() > 0
