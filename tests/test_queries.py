"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from tablebridge.plans.oracles import ORACLES
from tablebridge.plans.queries import QUERIES
from tests.compare import differences, duck_tables
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def duck():
    return duck_tables(SMALL)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    rows = contract.entry(spark)
    assert rows.columns == ["p_brand", "n", "buyers", "revenue"]
    assert rows.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    rows = QUERIES[name](spark, SMALL)
    assert differences(rows, ORACLES[name], duck) is None
