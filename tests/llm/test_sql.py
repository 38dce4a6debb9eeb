"""Queries that SQL can express, against DuckDB on the same tables."""

import pytest

from compare import connect, difference
from medalake.llm import registered


@pytest.mark.parametrize("name", sorted(registered.oracle_sql()))
def test_query_matches_sql(spark, sf_dir, name):
    query = registered.queries()[name](spark, sf_dir)
    assert difference(query, connect(sf_dir), registered.oracle_sql()[name]) is None


def test_names():
    names = set(registered.queries())
    assert {n.split("_")[0] for n in names} == {f"op{i}" for i in range(1, 14)} | {"pipeline"}
