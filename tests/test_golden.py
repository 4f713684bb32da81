"""Small inputs with results worked out by hand."""

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from millrace.functions import json
from millrace.functions.mergeable import count, highest, lowest, total
from millrace.functions.times import arrival_time, from_millis, from_seconds, from_text, local_day
from millrace.operators import (
    aggregate, bitmap, cdc, joins, late, project, sequences, state, windows,
)
from millrace.sources.lines import parse_lines

BASE = 1700000000


@pytest.fixture(params=[None, "2"], ids=["whole", "cut"])
def cut(spark, request):
    """Run with whole keys and with keys cut into segments of about two rows."""
    if request.param:
        spark.conf.set("spark.millrace.segmentRows", request.param)
    yield
    spark.conf.unset("spark.millrace.segmentRows")


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_word_count(spark):
    lines = spark.createDataFrame([("red,blue,red,red",), ("Blue,",), ("green,red, ",)], "line string")
    assert rows(aggregate.word_count(lines, "line"), "word", "n") == [("blue", 2), ("green", 1), ("red", 4)]


def sales(spark):
    lines = ["7, pear, 30", "7, plum, 12", "7, pear, 5", "8, fig, 40", "7, plum, 9"]
    df = spark.createDataFrame(list(enumerate(lines)), "seq int, line string")
    return parse_lines(df, "day bigint, item string, amount bigint")


def test_keyed_and_ordered_sum(spark):
    sums = aggregate.grouped(sales(spark), ["item"], {"amount": total("amount")})
    ordered = [tuple(r) for r in sums.orderBy(F.desc("amount")).collect()]
    assert ordered == [("fig", 40), ("pear", 35), ("plum", 21)]


def test_running_sum(spark, cut):
    sums = aggregate.running(sales(spark), ["day", "item"], ["seq"], {"s": total("amount")})
    assert [r[1] for r in rows(sums, "seq", "s")] == [30, 12, 35, 40, 21]


def test_changelog_additions(spark, cut):
    words = spark.createDataFrame(list(enumerate("up down up up down left".split())), "seq int, word string")
    log = aggregate.count_changelog(words, ["word"], ["seq"])
    assert [r[1:] for r in rows(aggregate.additions(log), "seq", "word", "n")] == [
        ("up", 1), ("down", 1), ("up", 2), ("up", 3), ("down", 2), ("left", 1)]
    assert rows(aggregate.replayed(log, ["word"]), "word", "n") == [("down", 2), ("left", 1), ("up", 3)]
    assert log.filter("kind = '-U'").count() == 3


def test_sequence_source(spark):
    assert [r[0] for r in rows(spark.range(1, 11).filter("id > 5"), "id")] == [6, 7, 8, 9, 10]


def test_routes(spark):
    towns = spark.createDataFrame(
        [("North", "Ayr", 6), ("North", "Ely", 3), ("South", "Rye", 5), ("South", "Ayr", 4)],
        "part string, town string, flow bigint")
    routes = {p: F.col("part") == p for p in ("North", "South")}
    routes |= {t: F.col("town") == t for t in ("Ayr", "Ely")}
    counted = project.route(towns, routes).groupBy("route").count()
    assert dict(rows(counted, "route", "count")) == {"North": 2, "South": 2, "Ayr": 2, "Ely": 1}


def page_views(spark):
    """Thirty views, three a minute from 08:00:05, then a robot's twelve at 08:09:50."""
    start = 1709280005000
    views = [(f"v{i % 5}", "NSW"[i % 3], start + 20_000 * i) for i in range(30)]
    views += [("robot", "N", start + 585_000)] * 12
    df = spark.createDataFrame([(i, *v, "shop.example") for i, v in enumerate(views)],
                               "seq int, user string, region string, ms bigint, site string")
    return df.withColumn("ts", from_millis("ms"))


def test_sliding_count(spark):
    counts = windows.windowed(page_views(spark), "ts", "1 hour", ["region"], {"n": count()}, "10 minutes")
    assert counts.count() == 18
    ends = rows(counts.select("window_end").distinct(), "window_end")
    assert [e[0].strftime("%H:%M") for e in ends] == ["08:10", "08:20", "08:30", "08:40", "08:50", "09:00"]
    assert set(rows(counts, "region", "n")) == {("N", 22), ("S", 10), ("W", 10)}


def test_distinct_and_salted(spark):
    framed = windows.with_window(page_views(spark), "ts", "1 hour")
    assert [r[1] for r in rows(aggregate.distinct_in(framed, ["window_end"], "user"), "window_end", "n")] == [6]
    minutes = windows.with_window(page_views(spark), "ts", "1 minute").withColumn("salt", F.col("seq") % 10)
    pv = aggregate.salted(minutes, ["window_start"], "salt", {"pv": count()})
    assert [r[1] for r in rows(pv, "window_start", "pv")] == [3] * 9 + [15]


def test_threshold(spark, cut):
    views, keys = page_views(spark).withColumn("day", local_day("ts")), ["user", "site", "region", "day"]
    guarded = state.threshold_guard(views, keys, ["ts", "seq"], 7, dropped=True)
    assert dict(rows(guarded.groupBy("status").count(), "status", "count")) == {"pass": 37, "alert": 1, "drop": 4}
    brief = state.threshold_guard(views, keys, ["ts", "seq"], 7)
    assert dict(rows(brief.groupBy("status").count(), "status", "count")) == {"pass": 37, "alert": 1}
    alert = brief.filter("status = 'alert'").select(state.alert_text("user", "site", "ts", 7))
    assert alert.first()[0].startswith("robot,shop.example2024-03-01") and alert.first()[0].endswith("超过阈值:7")


def test_top_items(spark):
    views = [("a", "view", "09:00:30")] * 2 + [("b", "view", "09:00:30")] + [("b", "view", "09:02:10")] * 2
    views += [("a", "cart", "09:02:10")]
    views = spark.createDataFrame([(i, k, f"2024-03-01 {t}") for i, k, t in views], "item string, kind string, t string")
    top = state.hot_items(views.withColumn("ts", from_text("t")), "ts", ["item"], ["kind"], "10 minutes", "1 minute", 1)
    found = {(k, e.strftime("%H:%M")): (i, n) for k, e, i, n in rows(top, "kind", "window_end", "item", "n")}
    expected = {("view", f"09:{m:02}"): ("a", 2) if m < 3 else ("b", 3) if m < 11 else ("b", 2) for m in range(1, 13)}
    assert found == expected | {("cart", f"09:{m:02}"): ("a", 1) for m in range(3, 13)}


def buys_of(spark):
    buys = [(500, "ann", 2.0), (2500, "bob", 5.0), (2500, "ann", 1.0), (7000, "ann", 4.0), (12000, "bob", 8.0)]
    return spark.createDataFrame(buys, "ms bigint, user string, money double").withColumn("ts", from_millis("ms"))


def test_tumble_and_hop(spark):
    start = F.unix_seconds("window_start").alias("at")
    tumbled = windows.windowed(buys_of(spark), "ts", "10 seconds", ["user"], {"s": total("money")})
    assert rows(tumbled, "user", start, "s") == [("ann", 0, 7.0), ("bob", 0, 5.0), ("bob", 10, 8.0)]
    hopped = windows.windowed(buys_of(spark), "ts", "10 seconds", ["user"], {"s": total("money")}, "2 seconds")
    expected = list(zip(["ann"] * 8, range(-8, 8, 2), [2.0, 3.0, 3.0, 7.0, 7.0, 5.0, 4.0, 4.0], strict=True))
    expected += [("bob", a, 5.0 if a < 4 else 8.0) for a in range(-6, 14, 2)]
    assert rows(hopped, "user", start, "s") == expected


def test_window_join_with_late_rows(spark, cut):
    left = [("kim", "x", 1000), ("kim", "x", 4000), ("lee", "y", 21000), ("kim", "x", 9000), ("kim", "x", 25000)]
    left = spark.createDataFrame([(i, *r) for i, r in enumerate(left)], "seq int, name string, tag string, time bigint")
    right = spark.createDataFrame([("kim", "oslo", 2000), ("lee", "rome", 35000)], "name string, city string, other bigint")
    left = left.withColumn("ts", from_millis("time"))
    right = right.withColumn("ts", from_millis("other"))
    on_time, behind = late.late_split(left, "ts", ["seq"], "10 seconds")
    joined = joins.window_join(on_time, right, ["name"], "ts", "10 seconds", {"city": "city", "other": "other"})
    joined = joins.filled(joined, {"city": "right late", "other": joins.RIGHT_MISSING})
    columns = ["name", "tag", "city", "time", "other"]
    bypassed = behind.withColumns({"city": F.lit("left late"), "other": F.lit(7).cast("bigint")})
    both = [("kim", "x", "oslo", 1000, 2000), ("kim", "x", "oslo", 4000, 2000)]
    assert rows(joined.select(*columns).unionByName(bypassed.select(*columns)), *columns) == sorted([
        *both, ("lee", "y", "right late", 21000, -999), ("kim", "x", "left late", 9000, 7),
        ("kim", "x", "right late", 25000, -999)])
    inner = joins.window_join(on_time, right, ["name"], "ts", "10 seconds", {"city": "city", "other": "other"}, "inner")
    assert rows(inner, *columns) == both


LOGINS = [("ann", "ok", 10), ("bob", "no", 20), ("bob", "no", 21), ("bob", "ok", 22), ("bob", "no", 23),
          ("ann", "no", 24), ("bob", "no", 25)]


def timed(spark, rows, schema):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"seq int, {schema}, t bigint")
    return df.withColumn("ts", from_seconds(F.col("t") + BASE))


def seconds(column):
    return (F.unix_seconds(column) - BASE).alias(column)


def test_strict_failures(spark, cut):
    failed = F.col("state") == "no"
    found = sequences.match_next(timed(spark, LOGINS, "user string, state string"), ["user"], ["ts", "seq"],
                                 failed, failed, "2 seconds")
    assert rows(found, "user", "t", seconds("next_time")) == [("bob", 20, 21)]


def test_three_failures(spark, cut):
    found = sequences.match_times(timed(spark, LOGINS, "user string, state string"), ["user"], ["ts", "seq"],
                                  F.col("state") == "no", 3, "10 seconds")
    assert rows(found, "user", "t", seconds("last_time")) == [("bob", 20, 23), ("bob", 21, 25)]


def test_delivery_follows(spark, cut):
    acts = [("p", "send", 5), ("p", "order", 6), ("q", "order", 6), ("q", "send", 9)]
    steps = [F.col("act") == "order", F.col("act") == "send"]
    found = sequences.match_followed_by(timed(spark, acts, "user string, act string"), ["user"], ["ts", "seq"],
                                        steps, "10 seconds")
    assert rows(found, "user", "outcome") == [("p", "timeout"), ("q", "match")]


def test_three_steps(spark, cut):
    acts = [("z", "web", "add", 1), ("x", "web", "add", 2), ("x", "web", "edit", 3), ("y", "web", "add", 4),
            ("x", "app", "add", 5), ("z", "app", "add", 6), ("z", "web", "edit", 7)]
    steps = [(F.col("source") == s) & (F.col("act") == a) for s, a in (("web", "add"), ("web", "edit"), ("app", "add"))]
    found = sequences.match_followed_by(timed(spark, acts, "user string, source string, act string"), ["user"],
                                        ["ts", "seq"], steps, "60 seconds")
    assert rows(found, "user", "outcome") == [("x", "match"), ("y", "timeout"), ("z", "timeout")]


@pytest.mark.parametrize("inclusive, outcome", [(False, "timeout"), (True, "match")])
def test_within_at_its_boundary(spark, inclusive, outcome):
    pays = [("1", "create", 0), ("1", "pay", 10)]
    steps = [F.col("act") == "create", F.col("act") == "pay"]
    found = sequences.match_followed_by(timed(spark, pays, "user string, act string"), ["user"], ["ts", "seq"],
                                        steps, "10 seconds", inclusive=inclusive)
    assert rows(found, "outcome") == [(outcome,)]


def test_visitor_radar(spark, cut):
    visits = [("m1", "2024-03-01 09:00:00", "ads", 4), ("m2", "2024-03-01 10:00:00", "web", 10),
              ("m2", "2024-03-01 10:05:00", "web", 20), ("m1", "2024-03-02 09:00:00", "ads", 6),
              ("m2", "2024-03-01 11:00:00", "app", 1), ("m2", "2024-03-03 08:00:00", "web", 5)]
    df = spark.createDataFrame([(i, "s9", *v) for i, v in enumerate(visits)],
                               "seq int, owner string, member string, t string, plate string, stay bigint")
    df = df.withColumn("ts", from_text("t")).withColumn("day", F.to_date("ts"))
    radar = state.visitor_radar(df, ["owner", "member", "plate"], "day", ["ts", "seq"], "stay")
    assert [r[1:] for r in rows(radar, "seq", "member", "visit_num", "total_stay_time")] == [
        ("m1", 1, 4), ("m2", 1, 10), ("m2", 2, 30), ("m1", 1, 10), ("m2", 1, 1), ("m2", 1, 35)]


def test_visits_without_a_day(spark):
    """Null days of one hot key are numbered through, cut or not."""
    df = spark.range(200).selectExpr("id", "'k' AS k", "CAST(NULL AS date) AS day", "1L AS stay")
    spark.conf.set("spark.millrace.segmentRows", "20")
    try:
        radar = state.visitor_radar(df, ["k"], "day", ["id"], "stay")
        assert [r[1] for r in rows(radar, "id", "visit_num")] == list(range(1, 201))
    finally:
        spark.conf.unset("spark.millrace.segmentRows")


def test_types_do_not_depend_on_the_way(spark):
    """Decimal sums have the type of a plain sum in the cut, pane and salted ways too."""
    df = spark.range(100).selectExpr("id", "1 AS k", "CAST(id AS decimal(10,2)) AS v", "id % 3 AS salt",
                                     "timestamp_seconds(id) AS ts")
    plain = df.groupBy("k").agg(F.sum("v").alias("s")).schema["s"].dataType
    found = [aggregate.salted(df, ["k"], "salt", {"s": total("v")}),
             windows.windowed(df, "ts", "10 seconds", ["k"], {"s": total("v")}, "5 seconds")]
    for size in ("1000", "20"):
        spark.conf.set("spark.millrace.segmentRows", size)
        found.append(aggregate.running(df, ["k"], ["id"], {"s": total("v")}))
    spark.conf.unset("spark.millrace.segmentRows")
    assert {f.schema["s"].dataType for f in found} == {plain}


def test_ranks_beyond_the_limit_are_spread(spark):
    df = spark.range(5000).withColumn("k", F.lit(1))
    top = state.ranked(df, ["k"], [F.col("id")], 1500)
    assert rows(top, "rank", "id") == [(i + 1, i) for i in range(1500)]


def test_dictionary(spark, cut):
    users = spark.createDataFrame([(f"k{i}", f"user{i}") for i in (3, 1, 2, 5, 4)], "k1 string, uuid string")
    numbers = bitmap.dictionary(users, "uuid")
    assert rows(numbers, "uuid", "id") == [(f"user{i}", i) for i in range(1, 6)]
    rows_ = bitmap.encoded(users, numbers, "uuid")
    assert rows(bitmap.number_lists(rows_, ["k1"]), "k1", "ids") == [(f"k{i}", str(i)) for i in range(1, 6)]
    more = spark.createDataFrame([("user2",), ("another",), ("user9",)], "uuid string")
    grown = bitmap.extended(numbers, more, "uuid")
    assert rows(grown, "id", "uuid")[:5] == [(i, f"user{i}") for i in range(1, 6)]
    assert rows(grown, "id", "uuid")[5:] == [(6, "another"), (7, "user9")]


def test_cells(spark):
    people = spark.createDataFrame([(f"{i:03d}", f"n{i}", 20 + i, "" if i == 2 else "c") for i in range(1, 11)],
                                   "id string, name string, age int, city string")
    cells = cdc.to_cells(people, F.col("id"), ["name", "age", "city"])
    assert cells.count() == 29
    # The tenth version is newer than the ninth.
    older = cells.select("rowkey", "qualifier", F.lit("99").alias("value"), F.lit(9).alias("version"))
    cells = older.unionByName(cells.withColumn("version", F.lit(10)))
    back = cdc.from_cells(cells, {"name": "string", "age": "int", "city": "string"}, "001", "003", version="version")
    assert rows(back, "rowkey", "name", "age") == [("001", "n1", 21), ("002", "n2", 22)]


def test_rules(spark, cut):
    data = spark.createDataFrame([(i, t) for i, t in enumerate(["tea x", "milk", "tea", "milk x"])],
                                 "seq int, text string")
    words = spark.createDataFrame([(2, "milk")], "seq int, keyword string")
    found = joins.intercepted(data, words, ["seq"], "text", "tea")
    assert [r[0] for r in rows(found, "message")] == [
        "拦截消息:milk x, 原因:包含拦截关键字：milk", "拦截消息:tea x, 原因:包含拦截关键字：tea"]
    controls = spark.createDataFrame([(1, "1"), (3, "2")], "seq int, switch string")
    assert [r[1] for r in rows(joins.switched(data, controls, ["seq"], "switch", {"1": "a", "2": "b"}, "c"), "seq", "text")] == [
        "c", "a", "a", "b"]
    ruled = joins.latest_rule(data, controls, ["seq"], ["switch"])
    assert rows(ruled, "seq", "switch") == [(0, None), (1, "1"), (2, "1"), (3, "2")]
    unruled = joins.latest_rule(data, controls.where("false"), ["seq"], ["switch"])
    assert rows(unruled, "seq", "switch") == [(i, None) for i in range(4)]


def test_values_without_a_number_stay(spark):
    users = spark.createDataFrame([("a", "u1"), ("a", None), ("b", None)], "k string, name string")
    coded = bitmap.encoded(users, bitmap.dictionary(users, "name"), "name")
    assert coded.count() == 3
    assert rows(bitmap.number_lists(coded, ["k"]), "k", "ids") == [("a", "1")]


def test_pair_pattern(spark, cut):
    actions = spark.createDataFrame([(0, 1, "login"), (2, 1, "pay"), (3, 2, "login"), (5, 2, "pay"), (6, 2, "quit")],
                                    "seq int, user int, action string")
    patterns = spark.createDataFrame([(1, "login", "pay"), (4, "pay", "quit")],
                                     "seq int, first_action string, second_action string")
    found = joins.paired_actions(actions, patterns, ["user"], ["seq"], "action")
    assert rows(found, "user", "first_action") == [(1, "login"), (2, "pay")]


def test_local_day(spark):
    noon = datetime(2020, 5, 21, 12, tzinfo=timezone.utc)
    df = spark.createDataFrame([(noon,), (noon + timedelta(hours=5),)], "ts timestamp")
    assert [str(r[0]) for r in df.select(local_day("ts")).collect()] == ["2020-05-21", "2020-05-22"]


def test_dimension_by_json(spark, cut):
    """Students join schools of the same window; misses go to the lookup table."""
    students = [("a", "1", 1), ("b", "2", 2), ("c", "9", 3), ("d", "1", 40), ("e", "9", 4), ("f", "2", 5)]
    texts = [(i, '{"data":{"id":"%s","school":"%s","time":%d}}' % s) for i, s in enumerate(students)]
    parsed = spark.createDataFrame(texts, "seq int, text string").withColumn(
        "data", json.record(json.path("text", "$.data"), "id string, school string, time bigint"))
    parsed = parsed.select("seq", "data.*").withColumn("ts", from_seconds("time"))
    schools = spark.createDataFrame([(1, "one", 5)], "id int, name string, time bigint")
    schools = schools.withColumn("ts", from_seconds("time"))
    dimension = windows.with_window(schools, "ts", "10 seconds").select(
        "window_start", F.col("id").cast("string").alias("school"), "name")
    table = spark.createDataFrame([("1", "one"), ("2", "two")], "school string, name string")
    status = late.classify(parsed, "ts", ["seq"], "10 seconds")
    found = joins.dimension_join(status, dimension, table, "school", "name")
    # c misses everywhere and is dropped; e is late and keeps its school's number.
    assert rows(found, "id", "name") == [("a", "one"), ("b", "two"), ("d", "one"), ("e", "9"), ("f", "two")]
    kept = joins.dimension_join(status, dimension, table, "school", "name", on_time_miss="keep", late_miss="drop")
    assert rows(kept, "id", "name") == [("a", "one"), ("b", "two"), ("c", "9"), ("d", "one"), ("f", "two")]


def test_resource_per_partition(spark):
    def open_resource():
        return {"factor": 3}

    def each(resource, batch):
        return batch.assign(id=batch["id"] * resource["factor"])

    tripled = project.with_resource(spark.range(4, numPartitions=2), open_resource, each, dict.clear, "id bigint")
    assert rows(tripled, "id") == [(0,), (3,), (6,), (9,)]


def test_arrival_windows(spark):
    framed = windows.windowed(arrival_time(spark.range(5)), "arrived_at", "1 day", [], {"n": count()})
    assert rows(framed, "n") == [(5,)]


def test_first_fields_of_running_rows(spark, cut):
    """Only the aggregated field changes; other fields stay as in the key's first row."""
    df = spark.createDataFrame([(0, "a", 5, "x"), (1, "a", 3, "y"), (2, "b", 1, "z"), (3, "a", 9, None)],
                               "seq int, k string, v int, note string")
    lows = aggregate.running(df, ["k"], ["seq"], {"low": lowest("v"), "high": highest("v")}, first=["note"])
    assert rows(lows, "seq", "low", "high", "note") == [(0, 5, 5, "x"), (1, 3, 5, "x"), (2, 1, 1, "z"), (3, 3, 9, "x")]


@pytest.mark.parametrize("slide", ["2 seconds", "3 seconds", "10 seconds"])
def test_windows_match_those_of_spark(spark, slide):
    """Also where the size is not a multiple of the slide."""
    buys = buys_of(spark)
    found = windows.windowed(buys, "ts", "10 seconds", ["user"], {"s": total("money"), "n": count()}, slide)
    window = F.window("ts", "10 seconds", slide)
    expected = buys.groupBy(window, "user").agg(F.sum("money").alias("s"), F.count("*").alias("n"))
    assert rows(found, "window_start", "window_end", "user", "s", "n") == rows(
        expected, "window.start", "window.end", "user", "s", "n")
