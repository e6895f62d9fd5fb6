"""Every registered query runs on the smallest tables, and every query with
oracle SQL matches DuckDB exactly."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.conftest import SF_SMALL
from tests.oracle import duck, same_result

KEYS = sorted(queries())


def test_entry_runs(spark):
    df = entry(spark)
    assert df.count() > 0
    assert df.columns == ["order_date", "category", "daily_gmv_category",
                          "daily_orders_category", "daily_items_sold"]


def test_oracle_keys_are_registered():
    assert set(oracle_sql()) <= set(queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    df = queries()[key](spark, SF_SMALL)
    sql = oracle_sql().get(key)
    if sql is None:
        assert df.count() >= 0
        return
    ok, why = same_result(df, con, sql)
    assert ok, why
