"""Every registered query against its SQL, with whole keys and with cut keys."""

import pytest

import __spark_entry__ as driver
from millrace.plans import QUERIES
from millrace.session import ROCKSDB, STATE_STORE
from tests.compare import oracle, spark_bag, sql_bag
from tests.conftest import MEDIUM, SMALL


def _check(spark, name, sf_dir):
    query = QUERIES[name]
    columns, rows = spark_bag(query.plan(spark, sf_dir))
    expected_columns, expected = sql_bag(oracle(sf_dir), query.sql)
    assert columns == expected_columns
    assert rows == expected


@pytest.mark.parametrize("name", list(QUERIES))
def test_whole_keys(spark, name):
    _check(spark, name, MEDIUM)


@pytest.mark.parametrize("name", list(QUERIES))
def test_cut_keys(spark, cut_small, name):
    _check(spark, name, SMALL)


KEYED = (
    "changelog_streamed", "changelog_table", "continued_totals", "cumulative_streamed", "current_streamed",
    "enriched_streamed", "firings_streamed", "rules_streamed",
)


@pytest.mark.parametrize("name", KEYED)
def test_session_without_a_state_store(spark, name):
    spark.conf.unset(STATE_STORE)
    try:
        _check(spark, name, SMALL)
        assert spark.conf.get(STATE_STORE, None) is None
    finally:
        spark.conf.set(STATE_STORE, ROCKSDB)


def test_driver_contract(spark):
    assert set(driver.oracle_sql()) <= set(driver.queries())
    assert driver.entry(spark).count() > 0
