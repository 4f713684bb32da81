"""Streams of changes, firings and keyed tables, against the batch operators and plain loops."""

import random
import time

import pytest
from pyspark.sql import functions as F

from millrace.functions.mergeable import count, highest, total
from millrace.functions.numbers import cents
from millrace.operators import aggregate, cdc, late, windows
from millrace.streaming import carried, changes, firings
from millrace.streaming.batches import Output, read_or_none, run
from millrace.streaming.tables import KeyedTable, folded
from tests.test_streaming import FILES, ORDER, collected, events, finish, landed, plain, same, with_null_keys  # noqa: F401

ARRIVAL = ["arrival", "event_id"]


@pytest.mark.parametrize("lateness", ["1 hour", "0 seconds"])
def test_firings(spark, events, tmp_path, lateness):  # noqa: F811
    """Every firing of the batch form whose window the last watermark has closed, over a restart."""
    rows = with_null_keys(events).withColumn("v", cents("value")).select("event_id", "ts", "event_type", "v", "arrival")
    folds = {"n": ("count", None), "total": ("sum", "v"), "high": ("max", "v")}
    outputs = {"n": count(), "total": total("v"), "high": highest("v")}
    half = rows.agg(F.max("arrival")).first()[0] // 2
    parts = rows.filter(F.col("arrival") <= half), rows.filter(F.col("arrival") > half)
    source, out = tmp_path / "in", Output(f"{tmp_path}/split/rows")
    for part in parts:
        finish(carried.late_split_stream(
            landed(spark, part, source, "arrival"), "ts", ARRIVAL, "6 hours", "1 hour", str(tmp_path / "split"), lateness))
        fired = firings.firings_stream(
            out.stream(spark), ["event_type"], "ts", ARRIVAL, folds, delay="1 hour", lateness=lateness)
        writer = fired.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/c")
        finish(writer.trigger(availableNow=True).start(f"{tmp_path}/out"))
    found = spark.read.parquet(f"{tmp_path}/out")
    classified = late.classify(rows, "ts", ARRIVAL, "6 hours", "1 hour", lateness)
    batch = late.window_firings(classified, ["event_type"], ARRIVAL, outputs)
    reached = rows.agg((F.max("ts") - F.expr("INTERVAL 1 hour 1 millisecond")).alias("w")).first()[0]
    closed = F.col("window_end") - F.expr("INTERVAL 1 millisecond") <= F.lit(reached)
    expected = batch.filter(closed | (F.col("status") == late.ALLOWED))
    same(found, expected, "event_id", "event_type", "window_start", "status", *outputs)
    assert found.filter("status = 'allowed'").count() > 0 or lateness == "0 seconds"
    assert found.filter("status = 'on_time'").count() > 0


def test_changelog(spark, events, tmp_path):  # noqa: F811
    rows = with_null_keys(events)
    stream = changes.changelog_stream(landed(spark, rows, tmp_path / "in"), ["event_type"], ORDER, {"n": ("count", None)})
    found = collected(spark, stream, "changelog", "append")
    batch = aggregate.count_changelog(rows, ["event_type"], ORDER)
    same(found, batch, "event_type", "event_id", "kind", "n")
    same(folded(found, ["event_type"], ["n"]), aggregate.replayed(batch, ["event_type"]), "event_type", "n")


@pytest.mark.parametrize("net", [True, False])
def test_changelog_into_a_table(spark, events, tmp_path, net):  # noqa: F811
    """Fewer changes, the same table, merged into a base on the way."""
    rows = with_null_keys(events).withColumn("v", cents("value"))
    folds = {"n": ("count", None), "total": ("sum", "v"), "high": ("max", "v")}
    stream = changes.changelog_stream(landed(spark, rows, tmp_path / "in"), ["event_type"], ORDER, folds, net=net)
    held = KeyedTable(str(tmp_path / "table"), ["event_type"], ORDER, compact=2)
    assert held.read(spark) is None
    finish(run(stream, held.write, str(tmp_path / "c")))
    outputs = {"n": count(), "total": total("v"), "high": highest("v")}
    same(held.read(spark), aggregate.grouped(rows, ["event_type"], outputs), "event_type", *outputs)
    assert held._base(spark, None) is not None


def _log(spark, seed, n, keys, orders):
    """Changes of a table by position: keys repeat, rows go and come back."""
    rng = random.Random(seed)
    rows = [(i, rng.randrange(keys), rng.randrange(orders), rng.choice("cuuud")) for i in range(n)]
    return spark.createDataFrame(rows, "pos bigint, id bigint, k bigint, op string").withColumn(
        "k", F.when(F.col("k") > 0, F.col("k"))
    ).withColumn("text", F.concat(F.lit("t"), F.col("pos") % 7))


def test_current_table_with_late_changes(spark, tmp_path):
    """Changes reach the stream in a mixed order: an older one never wins, also behind a delete."""
    log = _log(spark, 1, 400, 25, 9)
    mixed = log.withColumn("at", F.abs(F.xxhash64("pos")) % 1000)
    stream = changes.current_stream(landed(spark, mixed, tmp_path / "in", "at").drop("at"), ["id"], ["pos"])
    held = KeyedTable(str(tmp_path / "table"), ["id"], compact=3)
    finish(run(stream, held.write, str(tmp_path / "c")))
    same(held.read(spark), cdc.current_table(log, ["id"], ["pos"]), "id", "pos", "k", "text")


def test_forgotten_deletes(spark, tmp_path):
    """Behind its time to live a delete no longer keeps out an older change; live rows stay known."""
    schema = "id bigint, pos bigint, op string"
    source = str(tmp_path / "in")
    spark.createDataFrame([(1, 5, "u"), (1, 6, "d"), (2, 7, "u")], schema).coalesce(1).write.mode("append").parquet(source)
    stream = changes.current_stream(spark.readStream.schema(schema).parquet(source), ["id"], ["pos"], remembered="4 seconds")
    out = Output(f"{tmp_path}/out")
    query = run(stream, out.write, str(tmp_path / "c"), every="500 milliseconds")

    def shown(n):
        for _ in range(120):
            rows = read_or_none(spark, f"{tmp_path}/out")
            rows = [] if rows is None else sorted(tuple(r)[:3] for r in rows.collect())
            if len(rows) >= n or query.exception():
                return rows
            time.sleep(0.5)
        return rows

    try:
        assert shown(1) == [(2, 7, "+I")]
        time.sleep(6)
        spark.createDataFrame([(1, 4, "u"), (2, 3, "u")], schema).coalesce(1).write.mode("append").parquet(source)
        assert shown(2) == [(1, 4, "+I"), (2, 7, "+I")]
    finally:
        query.stop()


def test_current_changes_add_up(spark, tmp_path):
    """Withdrawals and additions leave each row of the table once, and nothing else."""
    log = _log(spark, 2, 300, 20, 9)
    stream = changes.current_stream(landed(spark, log, tmp_path / "in", "pos"), ["id"], ["pos"])
    found = collected(spark, stream, "current", "append")
    sign = F.when(F.col("kind").isin(*changes.HOLDS), 1).otherwise(-1)
    left = found.groupBy("id", "pos", "k", "text").agg(F.sum(sign).alias("n")).filter("n <> 0")
    assert left.filter("n <> 1").count() == 0
    same(left, cdc.current_table(log, ["id"], ["pos"]), "id", "pos", "k", "text")
    assert {r[0] for r in found.select("kind").distinct().collect()} == {"+I", "-U", "+U", "-D"}


@pytest.mark.parametrize("how", ["left", "inner"])
def test_both_sides_of_a_join_change(spark, tmp_path, how):
    """After any order of changes the pairs that are left equal the join of both current tables."""
    left, right = _log(spark, 3, 240, 30, 8), _log(spark, 4, 160, 12, 8)
    sides = []
    for name, log, key in (("l", left, 5), ("r", right, 6)):
        mixed = log.withColumn("at", F.abs(F.xxhash64("pos", F.lit(key))) % 1000)
        sides.append(changes.current_stream(landed(spark, mixed, tmp_path / name, "at").drop("at"), ["id"], ["pos"]))
    right_side = sides[1].withColumnRenamed("text", "named")
    joined = changes.enriched_stream(sides[0], right_side, "k", "k", ["id"], ["id"], ["named"], how=how)
    out = Output(f"{tmp_path}/out")
    finish(run(joined, out.write, str(tmp_path / "c")))
    sign = F.when(F.col("kind").isin(*changes.HOLDS), 1).otherwise(-1)
    found = out.read(spark).groupBy("id", "pos", "k", "text", "named").agg(F.sum(sign).alias("n")).filter("n <> 0")
    found = found.select("*", F.explode(F.expr("sequence(1, int(n))")).alias("i"))
    tables = [cdc.current_table(log, ["id"], ["pos"]) for log in (left, right)]
    partners = tables[1].select("k", F.col("text").alias("named"))
    expected = tables[0].join(partners, "k", how)
    assert expected.filter("named IS NULL").count() > 0 or how == "inner"
    same(found, expected, "id", "pos", "k", "text", "named")


def test_only_two_kinds_of_join(spark):
    rows = spark.range(1).withColumn("kind", F.lit("+I"))
    with pytest.raises(ValueError, match="left or inner"):
        changes.enriched_stream(rows, rows, "id", "id", ["id"], ["id"], [], how="full")


def test_cumulative_windows(spark, events, tmp_path):  # noqa: F811
    rows = with_null_keys(events).withColumn("v", cents("value"))
    stream = firings.cumulative_stream(
        landed(spark, rows, tmp_path / "in"), "ts", "1 day", ["event_type"],
        {"n": ("count", None), "total": ("sum", "v"), "high": ("max", "v")})
    found = collected(spark, stream, "cumulative", "append")
    outputs = {"n": count(), "total": total("v"), "high": highest("v")}
    batch = windows.cumulative(rows, "ts", "1 day", ["event_type"], outputs)
    closed = batch.filter(F.col("window_end") <= F.lit(rows.agg(F.max("ts")).first()[0]))
    names = [n + end for n in outputs for end in ("", "_so_far")]
    same(plain(found, "window_start"), closed, "window_start", "event_type", *names)
    assert found.count() > 0


def test_repeated_batch_leaves_the_table_alone(spark, tmp_path):
    held = KeyedTable(str(tmp_path), ["k"], compact=2)
    schema = "k bigint, v string, kind string"
    held.write(spark.createDataFrame([(1, "a", "+I"), (2, "b", "+I")], schema), 0)
    second = spark.createDataFrame([(1, "a", "-U"), (1, "c", "+U"), (2, "b", "-D"), (3, "d", "+I")], schema)
    for _ in range(2):
        held.write(second, 1)
        assert sorted(map(tuple, held.read(spark).collect())) == [(1, "c"), (3, "d")]
    held.write(spark.createDataFrame([(3, "d", "-D")], schema), 2)
    assert [tuple(r) for r in held.read(spark).collect()] == [(1, "c")]
