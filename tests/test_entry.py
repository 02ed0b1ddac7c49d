import importlib

import pytest

from glossmill.plans import registry
from tests import oracle

QUERIES, ORACLES = registry.collect()


@pytest.fixture(scope="module")
def con():
    return oracle.connect()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    oracle.same(spark, con, QUERIES[name], ORACLES[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_runs(spark, name):
    assert QUERIES[name](spark, oracle.DATA).count() > 0


def test_contract(spark):
    e = importlib.import_module("__spark_entry__")
    assert set(e.oracle_sql()) <= set(e.queries())
    assert set(QUERIES) <= set(e.queries())
    assert e.entry(spark).count() == 1
