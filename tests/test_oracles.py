"""Every registered query against its DuckDB oracle (the driver's gate, at sf0.001 here)."""

import pytest

from conftest import SMALL
from oracle_harness import compare, duck

import __spark_entry__ as E
from ledgerscope.plans import catalog

ORACLES = catalog.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    res = compare(E.queries()[name](spark, SMALL), con, ORACLES[name])
    assert res["ok"], res


def test_every_query_is_registered_with_a_callable():
    assert set(E.oracle_sql()) <= set(E.queries())
    q = catalog.queries()
    assert set(ORACLES) <= set(q)
    assert len(q) == 42 and len(ORACLES) == 41


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert len(df.columns) == 234
    assert df.count() > 0
