"""Queries with SQL against DuckDB, and the contract's names and columns."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from tablebridge.llm.queries import ORACLES, QUERIES
from tests.compare import differences, duck_tables
from tests.conftest import SMALL


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_its_sql(spark, name):
    assert differences(QUERIES[name](spark, SMALL), ORACLES[name], duck_tables(SMALL)) is None


def test_all_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(contract.queries())
    names = [name.split("_")[0] for name in QUERIES]
    assert names == [f"op{n}" for n in range(1, len(names) + 1)]
