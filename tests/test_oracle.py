"""Every query of the library against its SQL on another engine, whole tables, exact values."""

import pytest

import __spark_entry__ as contract
from compare import connect, difference
from medalake.plans import oracle, registered

SQL = oracle.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(SQL) == set(registered.queries())


def test_contract_offers_every_query():
    assert set(registered.queries()) <= set(contract.queries())
    assert set(SQL) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", list(registered.queries()))
def test_query_matches_sql(spark, sf_dir, con, name):
    assert difference(contract.queries()[name](spark, sf_dir), con, SQL[name]) is None


def test_entry(spark, sf_dir):
    assert contract.entry(spark).count() > 0
