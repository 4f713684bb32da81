"""Streams over the events, one file per micro-batch, against the batch operators."""

import time

import pytest
from pyspark.sql import functions as F

from millrace.functions.mergeable import count, earliest, highest, latest, lowest, total
from millrace.functions.numbers import cents
from millrace.operators import aggregate, cdc, joins, late, project, sequences, state, windows
from millrace.functions.times import local_day
from millrace.streaming import carried, event_time, keyed, sinks
from millrace.streaming.batches import Output, State
from tests.compare import spark_bag
from tests.conftest import SMALL

FILES = 4
ORDER = ["ts", "event_id"]


@pytest.fixture
def events(spark):
    df = spark.read.parquet(f"{SMALL}/events.parquet")
    shift = F.col("event_id") * 37 % 50
    return df.withColumn("arrival", F.col("event_id") + shift).withColumn("day", F.to_date("ts"))


def landed(spark, df, folder, by="event_id"):
    """The rows as a stream of files in the order of ``by``; the read follows file times."""
    last = df.agg(F.max(by)).first()[0] + 1
    for i in range(FILES):
        low, high = last * i // FILES, last * (i + 1) // FILES
        part = df.filter((F.col(by) >= low) & (F.col(by) < high)).coalesce(1)
        part = part.sortWithinPartitions(F.xxhash64(by))
        part.write.mode("append").parquet(str(folder))
        time.sleep(0.05)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(folder))


def with_null_keys(events):
    return events.withColumn("event_type", F.when(F.col("event_type") != "view", F.col("event_type")))


def finish(query):
    query.awaitTermination()
    assert query.exception() is None


def collected(spark, stream, name, mode):
    query = stream.writeStream.format("memory").queryName(name).outputMode(mode)
    finish(query.trigger(availableNow=True).start())
    return spark.table(name)


def plain(df, *times):
    return df.withColumns({t: F.col(t).cast("timestamp_ntz") for t in times})


def same(found, expected, *columns):
    assert spark_bag(found.select(*columns)) == spark_bag(expected.select(*columns))


@pytest.mark.parametrize("slide", [None, "1 hour"])
def test_windows_in_append_mode(spark, events, tmp_path, slide):
    stream = event_time.window_stream(
        landed(spark, events, tmp_path / "in"), "ts", "6 hours", ["event_type"], {"n": count()}, slide=slide)
    found = collected(spark, stream, f"windows_{slide is None}", "append")
    batch = windows.windowed(events, "ts", "6 hours", ["event_type"], {"n": count()}, slide)
    seen = events.agg(F.max("ts")).first()[0]
    closed = batch.filter(F.col("window_end") <= F.lit(seen))
    same(plain(found, "window_start", "window_end"), closed, "window_end", "event_type", "n")


def test_windows_in_update_mode_with_lateness(spark, events, tmp_path):
    stream = event_time.window_stream(
        landed(spark, events, tmp_path / "in"), "ts", "1 day", ["event_type"],
        {"high": highest("value"), "n": count()}, delay="10 seconds", lateness="2 seconds")
    found = collected(spark, stream, "updated_windows", "update")
    last = found.groupBy("window_start", "event_type").agg(F.max("n").alias("n"), F.max("high").alias("high"))
    batch = windows.windowed(events, "ts", "1 day", ["event_type"], {"high": highest("value"), "n": count()})
    same(plain(last, "window_start"), batch, "window_start", "event_type", "high", "n")


def test_distinct_users(spark, events, tmp_path):
    stream = event_time.distinct_stream(landed(spark, events, tmp_path / "in"), "ts", "1 day", "user_id")
    found = collected(spark, stream, "distinct_users", "complete")
    framed = windows.with_window(events, "ts", "1 day")
    same(plain(found, "window_end"), aggregate.distinct_in(framed, ["window_end"], "user_id"), "window_end", "n")


def test_window_join(spark, events, tmp_path):
    clicks = events.filter("event_type = 'click'")
    buys = events.filter("event_type = 'purchase'")
    names = {"event_id": "purchase_id"}
    stream = event_time.window_join_stream(
        landed(spark, clicks, tmp_path / "l"), landed(spark, buys, tmp_path / "r"), ["user_id"], "ts", "1 day", names,
        delay="10 days")
    found = collected(spark, stream, "joined", "append")
    batch = joins.window_join(clicks, buys, ["user_id"], "ts", "1 day", names, "inner")
    same(found, batch, "event_id", "purchase_id")


def test_running_totals(spark, events, tmp_path):
    events = with_null_keys(events).withColumn("v", F.when(F.col("event_id") % 5 > 0, cents("value")))
    folds = {"n": ("count", None), "s": ("sum", "v"), "high": ("max", "value"), "low": ("min", "v"),
             "old": ("first", "v"), "new": ("last", "v")}
    stream = keyed.running_stream(landed(spark, events, tmp_path / "in"), ["event_type"], ORDER, folds)
    found = collected(spark, stream, "running_totals", "append")
    outputs = {"n": count(), "s": total("v"), "high": highest("value"), "low": lowest("v"), "old": earliest("v"),
               "new": latest("v")}
    batch = aggregate.running(events, ["event_type"], ORDER, outputs)
    same(found, batch, *events.columns, *outputs)
    assert found.schema["ts"].dataType == events.schema["ts"].dataType


def test_running_totals_refuse_what_they_would_round(spark, events, tmp_path):
    rows = events.withColumn("v", F.lit("1.5").cast("decimal(10,2)"))
    with pytest.raises(TypeError, match="decimal"):
        keyed.running_stream(landed(spark, rows, tmp_path / "in"), ["event_type"], ORDER, {"s": ("sum", "v")})


def test_running_halves(spark, tmp_path):
    rows = spark.createDataFrame([(i, "a", 1.5) for i in range(FILES)], "event_id bigint, k string, v double")
    stream = keyed.running_stream(landed(spark, rows, tmp_path / "in"), ["k"], ["event_id"], {"s": ("sum", "v")})
    assert sorted(r["s"] for r in collected(spark, stream, "halves", "append").collect()) == [1.5, 3.0, 4.5, 6.0]


def test_threshold(spark, events, tmp_path):
    """Two zones' days, a null day among them: nothing passes twice."""
    day = local_day(F.col("ts").cast("timestamp"), "Asia/Shanghai")
    rows = events.withColumn("day", F.when(F.col("event_id") % 9 > 0, day))
    stream = keyed.threshold_stream(
        landed(spark, rows, tmp_path / "in"), ["event_type"], "ts", "day", ORDER, 5, "1 day")
    found = collected(spark, stream, "threshold", "append")
    batch = state.threshold_guard(rows, ["event_type", "day"], ORDER, 5)
    same(found, batch, "event_id", "status")


def test_late_rows(spark, events, tmp_path, cut_small):
    arrival = ["arrival", "event_id"]
    stream = landed(spark, events, tmp_path / "in", by="arrival")
    finish(carried.late_split_stream(
        stream, "ts", arrival, "6 hours", "1 hour", str(tmp_path / "out"), lateness="1 hour"))
    batch = late.classify(events, "ts", arrival, "6 hours", "1 hour", "1 hour")
    same(Output(f"{tmp_path}/out/rows").read(spark), batch, "event_id", "window_start", "status")
    assert batch.select("status").distinct().count() == 3


def _reached(events, delay):
    """The watermark after the last file."""
    return events.agg((F.max("ts") - F.expr(f"INTERVAL {delay}")).alias("w")).first()[0]


def test_sequences(spark, events, tmp_path):
    steps = [F.col("event_type") == s for s in ("view", "click", "purchase")]
    keys, within = ["user_id"], "3 days"
    events = events.select("event_id", "ts", "user_id", "event_type")
    stream = keyed.sequence_stream(landed(spark, events, tmp_path / "in"), keys, ORDER, steps, within, "1 hour")
    found = collected(spark, stream, "sequences", "append")
    batch = sequences.match_followed_by(events, keys, ORDER, steps, within)
    matched = F.col("outcome") == "match"
    settled = F.when(matched, F.element_at("step_times", -1)).otherwise(F.col("ts") + F.expr(f"INTERVAL {within}"))
    seen = events.filter(steps[0] | steps[1] | steps[2])
    times = F.col("step_times").cast("string").alias("times")
    same(found, batch.filter(settled < F.lit(_reached(seen, "1 hour"))), "event_id", "outcome", times)
    assert 0 < found.filter(matched).count() < found.count() < batch.count()


def test_many_open_starts_of_one_key(spark, tmp_path):
    """Ten thousand starts wait while other steps pass; each is handled once per step."""
    n = 10_000
    rows = spark.range(n + 300).select(
        F.col("id").alias("event_id"), F.lit("k").alias("k"),
        F.when(F.col("id") < n, "a").when(F.col("id") < n + 200, "c").when(F.col("id") == n + 200, "b")
        .when(F.col("id") == n + 250, "c").otherwise("x").alias("kind"),
        F.timestamp_millis(1000 + F.floor(F.col("id") / 10)).alias("ts"),
    )
    end = spark.createDataFrame([(n + 300, "k", "x")], "event_id long, k string, kind string").withColumn(
        "ts", F.timestamp_seconds(F.lit(100)))
    stream = landed(spark, rows.unionByName(end), tmp_path / "in")
    steps = [F.col("kind") == s for s in ("a", "b", "c")]
    found = keyed.sequence_stream(stream, ["k"], ORDER, [*steps[:2], steps[2] | (F.col("kind") == "x")], "1 minute", "0 seconds")
    began = time.monotonic()
    done = collected(spark, found, "many_open", "append")
    assert time.monotonic() - began < 150
    times = [F.element_at("step_times", i).cast("double").alias(f"t{i}") for i in (1, 2)]
    seen = done.groupBy("outcome", *times).agg(F.count(F.lit(1)).alias("n")).collect()
    assert [(r.outcome, r.t1, r.t2, r.n) for r in seen] == [("match", 1 + (n + 200) / 10_000, 1 + (n + 200) / 10_000, n)]


def test_strict_and_counted_sequences(spark, events, tmp_path):
    keys, within, view = ["user_id"], "2 days", F.col("event_type") == "view"
    click = F.col("event_type") == "click"
    stream = landed(spark, events, tmp_path / "in")
    found = collected(
        spark, keyed.next_stream(stream, keys, ORDER, view, click, within, "1 hour"), "strict", "append")
    batch = sequences.match_next(events, keys, ORDER, view, click, within)
    same(found, batch.filter(F.col("next_time") < F.lit(_reached(events, "1 hour"))), "event_id", "next_time")
    times = keyed.times_stream(stream, keys, ORDER, view, 3, within, "1 hour")
    found = collected(spark, times, "counted", "append")
    batch = sequences.match_times(events, keys, ORDER, view, 3, within)
    last = _reached(events.filter(view), "1 hour")
    same(found, batch.filter(F.col("last_time") < F.lit(last)), "event_id", "last_time")
    assert found.count() > 0


def test_hot_items(spark, events, tmp_path):
    args = ("ts", ["user_id"], ["event_type"], "1 day", "6 hours", 3)
    finish(carried.hot_items_stream(landed(spark, events, tmp_path / "in"), *args, str(tmp_path / "out")))
    found = Output(f"{tmp_path}/out/rows").read(spark)
    closed = F.col("window_end") <= F.lit(_reached(events, "0 seconds"))
    batch = state.hot_items(events, *args).filter(closed)
    same(plain(found, "window_end"), batch, "window_end", "event_type", "user_id", "n", "rank")
    assert found.count() > 0


def test_rules(spark, events, tmp_path):
    is_rule = F.col("event_type") == "signup"
    connected = events.withColumn("switch", F.when(is_rule, F.get_json_object("props", "$.k")))
    finish(carried.rule_stream(
        landed(spark, connected, tmp_path / "in"), is_rule, ORDER, ["switch"], str(tmp_path / "out")))
    rules = connected.filter(is_rule).select(*ORDER, "switch")
    batch = joins.latest_rule(events.filter(~is_rule), rules, ORDER, ["switch"])
    same(Output(f"{tmp_path}/out/rows").read(spark), batch, "event_id", "switch")


def test_repeated_batch_replaces_itself(spark, tmp_path):
    kept = State(str(tmp_path / "state"))
    assert kept.read(spark, 0) is None
    kept.write(spark.range(1), 0)
    kept.write(spark.range(5, 6), 1)
    kept.write(spark.range(9, 10), 1)
    assert kept.read(spark, 1).first()[0] == 0 and kept.read(spark, 2).first()[0] == 9


def test_count_windows(spark, events, tmp_path):
    outputs = {"n": count(), "s": total("v"), "first": lowest("event_id")}
    folds = {"n": ("count", None), "s": ("sum", "v"), "first": ("min", "event_id")}
    events = with_null_keys(events).withColumn("v", cents("value"))
    stream = keyed.count_window_stream(landed(spark, events, tmp_path / "in"), ["event_type"], ORDER, 7, folds)
    batch = windows.count_windows(events, ["event_type"], ORDER, 7, outputs)
    same(collected(spark, stream, "count_windows", "append"), batch, "event_type", *outputs)


def test_count_or_time(spark, events, tmp_path):
    outputs, folds = {"n": count(), "first": lowest("event_id")}, {"n": ("count", None), "first": ("min", "event_id")}
    stream = keyed.count_window_stream(
        landed(spark, events, tmp_path / "in"), ["event_type"], ORDER, 4, folds, ts="ts", size="1 day")
    batch = windows.count_or_time(events, ["event_type"], "ts", ORDER, "1 day", 4, outputs)
    seen = events.agg(F.max("ts")).first()[0]
    fired = batch.filter((F.col("n") == 4) | (F.col("window_end") <= F.lit(seen)))
    found = collected(spark, stream, "count_or_time", "append")
    same(found, fired, "event_type", "window_start", *outputs)


def test_sinks(spark, events, tmp_path):
    rows = events.select("event_id", "ts", "user_id", "event_type")
    finish(sinks.lines_sink(
        landed(spark, rows.select("event_id", "event_type"), tmp_path / "a"), str(tmp_path / "text"),
        str(tmp_path / "c1")))
    assert spark.read.text(str(tmp_path / "text")).count() == rows.count()

    table = {}

    def write(batch, number):
        table.update({r["user_id"]: r["event_id"] for r in batch.collect()})

    finish(sinks.upsert_sink(
        landed(spark, rows, tmp_path / "b"), ["user_id"], ORDER, write, str(tmp_path / "c2")))
    last = cdc.upsert_latest(rows, ["user_id"], ORDER).collect()
    assert table == {r["user_id"]: r["event_id"] for r in last}

    enriched, mirror = Output(str(tmp_path / "enriched")), Output(str(tmp_path / "mirror"))
    finish(sinks.to_many(
        landed(spark, rows, tmp_path / "d"),
        [lambda b, n: enriched.write(b.withColumn("x", F.lit(1)), n), mirror.write], str(tmp_path / "c3")))
    same(enriched.read(spark), rows, "event_id", "event_type")
    same(mirror.read(spark), rows, "event_id", "event_type")


def test_word_count(spark, tmp_path):
    words = spark.read.parquet(f"{SMALL}/part.parquet").select("p_partkey", "p_name")
    stream = landed(spark, words, tmp_path / "in", by="p_partkey")
    found = collected(spark, aggregate.word_count(stream, "p_name", " "), "word_counts", "update")
    last = found.groupBy("word").agg(F.max("n").alias("n"))
    same(last, aggregate.word_count(words, "p_name", " "), "word", "n")


def test_visitors(spark, events, tmp_path):
    visits = events.select("event_id", "ts", "user_id", "day", cents("value").cast("bigint").alias("stay"))
    stream = keyed.visitor_stream(
        landed(spark, visits, tmp_path / "in"), ["user_id"], "ts", "day", ORDER, "stay", "1 day")
    batch = state.visitor_radar(visits, ["user_id"], "day", ORDER, "stay")
    same(collected(spark, stream, "visitors", "append"), batch, "event_id", "visit_num", "total_stay_time")


def test_stateless_operators_on_a_stream(spark, tmp_path):
    orders = spark.read.parquet(f"{SMALL}/orders.parquet").select("o_orderkey", "o_custkey", "o_orderstatus")
    customers = spark.read.parquet(f"{SMALL}/customer.parquet").filter("c_acctbal > 0")
    customers = customers.withColumnRenamed("c_custkey", "o_custkey")
    routes = {"open": F.col("o_orderstatus") == "O", "any": F.lit(True)}

    def shaped(df):
        return project.route(joins.lookup(df, customers, ["o_custkey"], {"c_name": ""}), routes)

    found = collected(spark, shaped(landed(spark, orders, tmp_path / "in", by="o_orderkey")), "shaped", "append")
    same(found, shaped(orders), "o_orderkey", "c_name", "route")


def test_stream_goes_on_after_a_restart(spark, events, tmp_path):
    rows = events.select("event_id", "ts", "event_type")
    folder, source = str(tmp_path / "out"), tmp_path / "in"
    middle = rows.agg(F.max("event_id")).first()[0] // 2
    for part in (rows.filter(F.col("event_id") <= middle), rows.filter(F.col("event_id") > middle)):
        part.coalesce(1).write.mode("append").parquet(str(source))
        stream = spark.readStream.schema(rows.schema).parquet(str(source))
        counted = keyed.running_stream(stream, ["event_type"], ORDER, {"n": ("count", None)})
        writer = counted.writeStream.format("parquet").option("checkpointLocation", f"{folder}/checkpoint")
        finish(writer.trigger(availableNow=True).start(f"{folder}/rows"))
    batch = aggregate.running(rows, ["event_type"], ORDER, {"n": count()})
    same(spark.read.parquet(f"{folder}/rows"), batch, "event_id", "n")


def test_pair_rule(spark, events, tmp_path):
    is_rule = F.col("event_type") == "signup"
    k = F.get_json_object("props", "$.k").cast("int")
    actions = F.array(*[F.lit(a) for a in ("error", "click", "view", "purchase")])
    connected = with_null_keys(events).withColumns({
        "first_action": F.when(is_rule, F.get(actions, k % 4)),
        "second_action": F.when(is_rule, F.get(actions, F.floor(k / 4).cast("int") % 4)),
    })
    stream = landed(spark, connected, tmp_path / "in")
    finish(carried.pair_stream(stream, is_rule, ["user_id"], ORDER, "event_type", str(tmp_path / "out")))
    data = connected.filter(F.coalesce(~is_rule, F.lit(True))).drop("first_action", "second_action")
    rules = connected.filter(is_rule).select(*ORDER, "first_action", "second_action")
    batch = joins.paired_actions(data, rules, ["user_id"], ORDER, "event_type")
    assert batch.count() > 0
    same(Output(f"{tmp_path}/out/rows").read(spark), batch, "event_id", "user_id", "first_action", "second_action")


def test_late_join(spark, events, tmp_path):
    arrival, sides = ["arrival", "event_id"], {}
    for kind in ("click", "purchase"):
        rows = events.filter(F.col("event_type") == kind)
        stream = landed(spark, rows, tmp_path / f"in_{kind}", "arrival")
        finish(carried.late_split_stream(stream, "ts", arrival, "1 day", "0 seconds", f"{tmp_path}/{kind}"))
        sides[kind] = late.classify(rows, "ts", arrival, "1 day")
    left, right = [Output(f"{tmp_path}/{kind}/rows").stream(spark) for kind in sides]
    named = {"event_id": "purchase_id"}
    found = collected(spark, carried.late_join_stream(left, right, ["user_id"], "ts", "1 day", named), "late_join", "append")
    on_time = sides["purchase"].filter(F.col("status") == late.ON_TIME)
    on_time = on_time.select("user_id", "window_start", F.col("event_id").alias("purchase_id"))
    batch = joins.on_time_join(sides["click"], on_time, ["user_id"])
    # Rows without a partner wait for the slower side to pass their window.
    last = min(side.agg(F.max("ts")).first()[0] for side in sides.values())
    alone = F.col("purchase_id").isNull() & (F.col("status") == late.ON_TIME)
    batch = batch.filter(~alone | (F.col("window_end") <= F.lit(last)))
    assert {r[0] for r in batch.select("status").distinct().collect()} == {late.ON_TIME, late.LATE}
    same(found, batch, "event_id", "purchase_id", "status")
