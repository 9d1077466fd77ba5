"""Every SQL-expressible registered query equals its DuckDB oracle (sf0.001)."""

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from hearthlake import params
from hearthlake.plans.oracle_sql import tuned_oracles
from hearthlake.plans.queries import registry
from oracle_check import compare, duck

# the queries of this package's own; the training-data operators have tests of their own
OWN = registry()
# The full candidate grid takes minutes (tests/oracle_check.py runs it); here the same queries and SQL with the small one.
KEYS = sorted((entry.oracle_sql().keys() & OWN.keys()) - set(entry.TUNED))


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, con, key):
    assert compare(spark, con, key, entry.queries()[key], entry.oracle_sql()[key], SF_SMALL)


@pytest.mark.parametrize("key", entry.TUNED)
def test_tuned_queries_match_oracle(spark, con, key):
    grid = params.SMALL_CANDIDATES
    assert compare(spark, con, key, lambda s, d: OWN[key](s, d, grid), tuned_oracles(grid)[key], SF_SMALL)


def test_entry_contract(spark):
    df = entry.entry(spark)
    assert df.columns == ["store_id", "reporting_date", "total_daily_revenue", "total_items_sold",
                          "avg_transaction_value"]
    assert df.count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(OWN) <= set(entry.oracle_sql())
