"""Rules by id against a loop; filters before joins; dictionaries by buckets."""

import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import bitmap, joins
from millrace.streaming import rules
from millrace.streaming.batches import Output, run
from tests.compare import spark_bag
from tests.conftest import SMALL
from tests.test_streaming import finish, landed


def _log(seed, n):
    """(event_id, is rule, rule id, action, removed, subject, text)"""
    rng, out = random.Random(seed), []
    for i in range(n):
        if rng.random() < 0.3:
            out.append((i, True, rng.randrange(6), rng.choice("xyz"), rng.random() < 0.3, rng.choice(["a", "b", None]), None))
        else:
            out.append((i, rng.choice([False, None]), None, None, None, rng.choice(["a", "b", "c", None]), f"t{i}"))
    return out


def _loop(log):
    known, out = {}, []
    for i, is_rule, id, action, removed, subject, text in log:
        if is_rule:
            known[id] = None if removed else (action, subject)
        else:
            out += [(i, id, r[0]) for id, r in known.items() if r and r[1] in (subject, None)]
    return sorted(out)


@pytest.mark.parametrize("spread", [1, 5])
def test_many_rules_at_once(spark, tmp_path, spread):
    """Over four micro-batches and a restart."""
    log, out = _log(spread, 300), Output(f"{tmp_path}/out")
    schema = "event_id long, is_rule boolean, rule int, action string, removed boolean, subject string, text string"
    for part in (log[:150], log[150:]):
        stream = landed(spark, spark.createDataFrame(part, schema), tmp_path / "in")
        found = rules.rules_stream(
            stream, F.col("is_rule"), ["event_id"], "rule", ["action"], removed=F.col("removed"),
            subject=(F.col("subject"), F.col("subject")), spread=spread)
        finish(run(found, out.write, f"{tmp_path}/c"))
    rows = out.read(spark)
    assert sorted((r.event_id, r.rule, r.action) for r in rows.collect()) == _loop(log)
    assert dict(rows.dtypes)["rule"] == "int"


def test_older_versions_are_passed_over(spark, tmp_path):
    schema = "event_id long, at long, is_rule boolean, rule string, action string, removed boolean"
    batches = [
        [(1, 10, True, "r", "new", False), (2, 11, True, "s", "gone", True)],
        [(3, 5, True, "r", "old", False), (4, 6, True, "s", "old", False), (5, 12, False, None, None, None)],
    ]
    stream = None
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    found = rules.rules_stream(stream, F.col("is_rule"), ["at"], "rule", ["action"], removed=F.col("removed"))
    out = Output(f"{tmp_path}/out")
    finish(run(found, out.write, f"{tmp_path}/c"))
    assert [(r.event_id, r.rule, r.action) for r in out.read(spark).collect()] == [(5, "r", "new")]


def _partners(spark):
    rows = spark.range(20_000).select(
        F.when(F.col("id") % 50 > 0, F.col("id") % 4000).alias("k"), F.concat(F.lit("n"), F.col("id") % 3).alias("j"), "id")
    table = spark.range(0, 400, 4).select(F.col("id").alias("k"), F.lit("n1").alias("j"), (F.col("id") * 2).alias("v"))
    return rows, table.unionByName(spark.createDataFrame([(None, "n1", 9)], "k long, j string, v long"))


@pytest.mark.parametrize("words", [1 << 18, 64, 1])
def test_filter_before_the_shuffle(spark, words):
    rows, table = _partners(spark)
    on = ["k", "j"]
    assert spark_bag(joins.keep_matching_filtered(rows, table, on, words)) == spark_bag(joins.keep_matching(rows, table, on))
    found = joins.lookup_filtered(rows, table, on, {"v": -1}, words)
    assert spark_bag(found) == spark_bag(joins.lookup(rows, table, on, {"v": -1}))
    matching, passed = joins.keep_matching(rows, table, on).count(), joins.possible(rows, table, on, words).count()
    assert matching <= passed
    assert joins.key_filter(table, on, words).count() <= words
    if words > 64:
        assert passed < matching + 200


def test_filter_stands_below_the_shuffle(spark):
    rows, table = _partners(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = joins.keep_matching_filtered(rows, table, ["k", "j"])
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lines = [line.strip() for line in plan.splitlines()]
    join = next(i for i, line in enumerate(lines) if "SortMergeJoin" in line)
    shuffle = next(i for i, line in enumerate(lines) if i > join and "Exchange hashpartitioning(k" in line)
    assert any("BroadcastHashJoin" in line for line in lines[shuffle:])


def test_numbers_by_bucket(spark):
    names = spark.read.parquet(f"{SMALL}/part.parquet").select("p_name").unionByName(
        spark.createDataFrame([(None,), ("",)], "p_name string"))
    old = bitmap.hashed_dictionary(names.filter("p_name < 'm'"), "p_name", buckets=7)
    ids = sorted(r.id for r in old.collect())
    assert ids == list(range(1, len(ids) + 1))
    assert sorted(r.p_name for r in old.collect()) == sorted(
        r.p_name for r in names.filter("p_name < 'm'").distinct().collect())
    both = bitmap.hashed_extended(old, names, "p_name")
    found = {r.p_name: r.id for r in both.collect()}
    assert sorted(found.values()) == list(range(1, len(found) + 1))
    assert {r.p_name: r.id for r in old.collect()}.items() <= found.items()
    assert set(found) == {r.p_name for r in names.dropna().distinct().collect()}
    again = bitmap.hashed_extended(both, names, "p_name")
    assert spark_bag(again) == spark_bag(both)
    assert bitmap.hashed_dictionary(names.filter("false"), "p_name").collect() == []


def test_numbers_need_no_order_over_all_values(spark):
    names = spark.read.parquet(f"{SMALL}/part.parquet").select("p_name")
    plan = bitmap.hashed_dictionary(names, "p_name", buckets=7)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and plan.count("Exchange SinglePartition") == 1
