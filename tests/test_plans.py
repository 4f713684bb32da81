"""What the physical plans must and must not contain."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from millrace.functions.mergeable import count
from millrace.operators import joins, state, windows
from millrace.plans import QUERIES
from tests.conftest import SMALL


def explained(df) -> str:
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain()
    return text.getvalue()


@pytest.fixture
def plan_of(spark):
    return lambda name: explained(QUERIES[name].plan(spark, SMALL))


def read_columns(plan):
    return [set(re.findall(r"(\w+):", s)) for s in re.findall(r"ReadSchema: struct<([^>]*)>", plan)]


def test_sliding_windows_repeat_results_not_rows(plan_of):
    plan = plan_of("sliding_count")
    assert "Expand" not in plan
    assert plan.index("Generate explode") < plan.index("partial_count")


@pytest.mark.parametrize("name", ["threshold_guard", "cdc_latest", "upsert_latest", "hot_topn"])
def test_groups_are_cut_before_the_shuffle(plan_of, name):
    plan = plan_of(name)
    partial = plan.index("Partial")
    assert "WindowGroupLimit" in plan
    assert plan.rindex("Exchange", 0, partial) > plan.index("Final")


@pytest.mark.parametrize(
    "name, columns",
    [
        ("sliding_count", {"ts", "event_type"}),
        ("distinct_users", {"ts", "user_id"}),
        ("keyed_sum", {"l_returnflag", "l_linestatus", "l_quantity", "l_extendedprice"}),
        ("hot_topn", {"ts", "user_id", "event_type"}),
        ("word_count", {"text"}),
    ],
)
def test_only_needed_columns_are_read(plan_of, name, columns):
    assert read_columns(plan_of(name)) == [columns]


@pytest.mark.parametrize("name", ["semi_lookup", "window_join_inner", "times_n", "project_filter"])
def test_filters_reach_the_scan(plan_of, name):
    assert re.search(r"PushedFilters: \[[^\]]*(EqualTo|GreaterThan)\(", plan_of(name))


def test_no_query_pairs_rows_freely_or_runs_python(spark):
    for name, query in QUERIES.items():
        plan = explained(query.plan(spark, SMALL))
        for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "EvalPython", "InPandas"):
            assert operator not in plan, (name, operator)


def test_global_order_is_cut(spark, cut_small):
    """Above one segment no task gets all rows, not even for a global count window."""
    rows = spark.read.parquet(f"{SMALL}/events.parquet")
    plan = explained(windows.count_windows(rows, [], ["event_id"], 3, {"n": count()}))
    for at in (m.start() for m in re.finditer("Exchange SinglePartition", plan)):
        # Only the one row per segment is collected for the running result.
        assert "Aggregate" in plan[at : at + 400]


def test_guard_above_the_rank_limit_keeps_whole_groups(spark):
    rows = spark.range(5000).withColumn("k", F.lit(1))
    guarded = state.threshold_guard(rows, ["k"], ["id"], 2000)
    assert dict(guarded.groupBy("status").count().collect()) == {"pass": 2000, "alert": 1}


def test_skewed_joins_are_split(spark):
    """A third of the rows in one key, and a lookup table too large to broadcast."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "30KB",
        "spark.sql.shuffle.partitions": "20",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        hot = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id"))
        rows = spark.range(0, 200_000, numPartitions=8).select("id", hot.alias("k"))
        table = spark.range(200_000).select(F.col("id").alias("k"), F.lit("x").alias("v"))
        found = joins.lookup(rows, table, ["k"], {"v": ""})
        assert len(found.collect()) == 200_000
        assert "skew=true" in explained(found)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
