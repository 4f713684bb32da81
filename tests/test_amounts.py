"""Amounts of more than two digits: exact sums, however keys and windows are cut."""

import os
from decimal import Decimal

import pyarrow.compute as pc
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from millrace.functions.mergeable import total
from millrace.functions.numbers import as_double, exact
from millrace.operators import aggregate, windows
from millrace.plans import QUERIES
from tests.compare import TABLES, oracle, spark_bag, sql_bag
from tests.conftest import SMALL

MONEY = [
    "keyed_sum", "composite_key_sum", "order_by_total", "running_sum", "tumbling_sum", "tumbling_all", "tumble_sql",
    "sliding_reduce", "sliding_all", "window_max", "window_avg", "count_window", "count_window_all", "count_or_time_trigger",
    "window_cumulative", "late_window_avg", "allowed_lateness", "lateness_firings", "avg_every_two", "visitor_radar",
]


@pytest.fixture(scope="module")
def four_digits(tmp_path_factory):
    """The small tables, with two more digits on the values of events and lines."""
    folder = tmp_path_factory.mktemp("digits")
    for name in TABLES:
        if name == "events":
            events = pq.read_table(f"{SMALL}/events.parquet")
            extra = pc.multiply(pc.cast(pc.subtract(events["event_id"], 0), "double"), 0.0001)
            value = pc.round(pc.add(events["value"], extra), 4)
            events = events.set_column(events.schema.get_field_index("value"), "value", value)
            pq.write_table(events, f"{folder}/events.parquet")
        else:
            os.symlink(f"{SMALL}/{name}.parquet", f"{folder}/{name}.parquet")
    return str(folder)


@pytest.mark.parametrize("name", MONEY)
def test_money_queries_keep_all_digits(spark, four_digits, name):
    query = QUERIES[name]
    assert "round" not in query.sql
    assert spark_bag(query.plan(spark, four_digits)) == sql_bag(oracle(four_digits), query.sql)


def test_digits_behind_the_second(spark):
    rows = [(i, "a", value) for i, value in enumerate((0.1111, 0.2222, 0.3333, 1000000.0001, -0.6666))]
    df = spark.createDataFrame(rows, "id bigint, k string, v double")
    sums = aggregate.grouped(df, ["k"], {"s": total(exact("v"))}).withColumn("d", as_double("s")).first()
    assert sums.s == Decimal("1000000.0001") and sums.d == 1000000.0001
    df = df.withColumn("ts", F.timestamp_seconds("id"))
    found = windows.windowed(df, "ts", "4 seconds", ["k"], {"s": total(exact("v"))}, "2 seconds").orderBy("window_start")
    assert [r.s for r in found.collect()] == [Decimal(x) for x in ("0.3333", "1000000.6667", "999999.6668", "-0.6666")]


def test_amounts_that_do_not_fit_are_errors(spark):
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        spark.range(1).select(exact(F.lit(1e13))).collect()
