"""Windows, late rows, counters, thresholds and rankings."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.mergeable import count, highest, total
from millrace.functions.numbers import as_double, exact
from millrace.functions.times import local_day
from millrace.operators import aggregate, late, state, windows
from millrace.plans.registry import DAY, HOUR, bucket, query, table

EXACT = "CAST(value AS DECIMAL(18,6))"
MONEY = f"CAST(sum({EXACT}) AS DOUBLE)"


def _events(spark, sf):
    return table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "value")


def _slides(size: int, slide: int) -> str:
    """Events repeated once per sliding window that holds them."""
    return f"""
WITH w AS (SELECT *, {bucket('ts', slide)} - to_seconds({slide} * CAST(i AS BIGINT)) AS window_start,
    {bucket('ts', slide)} - to_seconds({slide} * CAST(i AS BIGINT)) + to_seconds({size}) AS window_end
  FROM events, generate_series(0, {size // slide - 1}) s(i))
"""


@query(f"""
SELECT {bucket('ts', HOUR)} AS window_start, {bucket('ts', HOUR)} + INTERVAL 1 HOUR AS window_end,
  event_type, {MONEY} AS total FROM events GROUP BY ALL""")
def tumbling_sum(spark, sf):
    sums = windows.windowed(_events(spark, sf), "ts", "1 hour", ["event_type"], {"total": total(exact("value"))})
    return sums.withColumn("total", as_double("total"))


@query(f"SELECT {bucket('ts', HOUR)} AS window_start, {MONEY} AS total, count(*) AS n FROM events GROUP BY 1")
def tumbling_all(spark, sf):
    sums = windows.windowed(
        _events(spark, sf), "ts", "1 hour", [], {"total": total(exact("value")), "n": count()}
    )
    return sums.withColumn("total", as_double("total")).drop("window_end")


@query(f"""
SELECT {bucket('ts', 10)} AS window_start, {bucket('ts', 10)} + INTERVAL 10 SECOND AS window_end, user_id,
  {MONEY} AS total FROM events GROUP BY ALL""")
def tumble_sql(spark, sf):
    return spark.sql("""
        SELECT window.start AS window_start, window.end AS window_end, user_id,
          CAST(sum(CAST(value AS DECIMAL(18,6))) AS DOUBLE) AS total
        FROM {buys} GROUP BY window(ts, '10 seconds'), user_id""", buys=_events(spark, sf))


@query(_slides(10, 2) + f"SELECT window_start, window_end, user_id, {MONEY} AS total FROM w GROUP BY ALL")
def hop_sql(spark, sf):
    return spark.sql("""
        SELECT window.start AS window_start, window.end AS window_end, user_id,
          CAST(sum(CAST(value AS DECIMAL(18,6))) AS DOUBLE) AS total
        FROM {buys} GROUP BY window(ts, '10 seconds', '2 seconds'), user_id""", buys=_events(spark, sf))


@query(_slides(6 * HOUR, HOUR) + "SELECT window_end, event_type, count(*) AS n FROM w GROUP BY ALL")
def sliding_count(spark, sf):
    counts = windows.windowed(
        _events(spark, sf), "ts", "6 hours", ["event_type"], {"n": count()}, slide="1 hour"
    )
    return counts.drop("window_start")


@query(_slides(6 * HOUR, HOUR) + f"SELECT window_start, {MONEY} AS total FROM w GROUP BY ALL")
def sliding_all(spark, sf):
    sums = windows.windowed(
        _events(spark, sf), "ts", "6 hours", [], {"total": total(exact("value"))}, slide="1 hour"
    )
    return sums.select("window_start", as_double("total").alias("total"))


@query(_slides(6 * HOUR, 3 * HOUR) + f"""
SELECT window_start, window_end, user_id, {MONEY} AS total, max(value) AS high FROM w GROUP BY ALL""")
def sliding_reduce(spark, sf):
    sums = windows.windowed(
        _events(spark, sf), "ts", "6 hours", ["user_id"],
        {"total": total(exact("value")), "high": highest("value")}, slide="3 hours",
    )
    return sums.withColumn("total", as_double("total"))


@query(f"""
SELECT {bucket('ts', DAY)} AS window_start, event_type, {MONEY} / count(*) AS mean FROM events GROUP BY ALL""")
def window_avg(spark, sf):
    parts = windows.windowed(
        _events(spark, sf), "ts", "1 day", ["event_type"], windows.mean_outputs(exact("value"))
    )
    return parts.select("window_start", "event_type", (as_double("total") / F.col("n")).alias("mean"))


@query(f"""
SELECT {bucket('ts', DAY)} AS window_start, {bucket('ts', DAY)} + INTERVAL 1 DAY AS window_end, event_type,
  max(value) AS high FROM events GROUP BY ALL""")
def window_max(spark, sf):
    return windows.windowed(_events(spark, sf), "ts", "1 day", ["event_type"], {"high": highest("value")})


@query(f"""
WITH r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events)
SELECT user_id, (n - 1) // 5 AS chunk, {MONEY} AS total FROM r GROUP BY ALL HAVING count(*) = 5""")
def count_window(spark, sf):
    sums = windows.count_windows(
        _events(spark, sf), ["user_id"], ["ts", "event_id"], 5, {"total": total(exact("value"))}
    )
    return sums.withColumn("total", as_double("total"))


@query(f"""
WITH r AS (SELECT *, row_number() OVER (ORDER BY event_id) AS n FROM events)
SELECT (n - 1) // 3 AS chunk, {MONEY} AS total FROM r GROUP BY ALL HAVING count(*) = 3""")
def count_window_all(spark, sf):
    sums = windows.count_windows(
        _events(spark, sf), [], ["event_id"], 3, {"total": total(exact("value"))}
    )
    return sums.withColumn("total", as_double("total"))


@query(f"""
WITH r AS (SELECT *, {bucket('ts', DAY)} AS window_start,
  row_number() OVER (PARTITION BY user_id, {bucket('ts', DAY)} ORDER BY ts, event_id) AS n FROM events)
SELECT user_id, window_start, (n - 1) // 5 AS chunk, {MONEY} AS total, count(*) AS n FROM r GROUP BY ALL""")
def count_or_time_trigger(spark, sf):
    sums = windows.count_or_time(
        _events(spark, sf), ["user_id"], "ts", ["ts", "event_id"], "1 day", 5,
        {"total": total(exact("value")), "n": count()},
    )
    return sums.withColumn("total", as_double("total")).drop("window_end")


@query(f"""
WITH d AS (SELECT {bucket('ts', DAY)} AS window_start, user_id, sum({EXACT}) AS c FROM events GROUP BY ALL)
SELECT window_start, user_id, CAST(c AS DOUBLE) AS total,
  CAST(sum(c) OVER (PARTITION BY user_id ORDER BY window_start) AS DOUBLE) AS total_so_far FROM d""")
def window_cumulative(spark, sf):
    sums = windows.cumulative(
        _events(spark, sf), "ts", "1 day", ["user_id"], {"total": total(exact("value"))}
    )
    return sums.select(
        "window_start", "user_id", as_double("total").alias("total"), as_double("total_so_far").alias("total_so_far")
    )


@query(f"""
SELECT {bucket('ts', HOUR)} + INTERVAL 1 HOUR AS window_end, count(DISTINCT user_id) AS users
FROM events GROUP BY 1""")
def distinct_users(spark, sf):
    rows = windows.with_window(_events(spark, sf), "ts", "1 hour")
    return aggregate.distinct_in(rows, ["window_end"], "user_id", "users")


@query(f"SELECT {bucket('ts', HOUR)} AS window_start, count(*) AS pv FROM events GROUP BY 1")
def salted_count(spark, sf):
    rows = windows.with_window(_events(spark, sf), "ts", "1 hour").withColumn("salt", F.col("event_id") % 10)
    return aggregate.salted(rows, ["window_start"], "salt", {"pv": count()})


# Rows arrive out of order by a rule, so that some are behind the watermark.
ARRIVED = """
WITH a AS (SELECT *, event_id + (event_id * 37) % 50 AS arrival FROM events),
m AS (SELECT *, max(ts) OVER (ORDER BY arrival, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
  AS max_ts FROM a)
"""


def classified_sql(lateness: int) -> str:
    start = bucket("ts", 6 * HOUR)
    last = f"{start} + INTERVAL 6 HOUR - INTERVAL 1 MILLISECOND"
    return ARRIVED + f""",
c AS (SELECT *, {start} AS window_start, CASE
    WHEN {last} + INTERVAL {lateness} HOUR <= max_ts - INTERVAL 1 HOUR THEN 'late'
    WHEN {last} <= max_ts - INTERVAL 1 HOUR THEN 'allowed' ELSE 'on_time' END AS status FROM m)
"""


def arrived(spark, sf):
    shift = F.col("event_id") * 37 % 50
    return table(spark, sf, "events").withColumn("arrival", F.col("event_id") + shift)


ARRIVAL = ["arrival", "event_id"]


def _statuses(spark, sf, lateness="0 seconds"):
    rows = arrived(spark, sf).select("event_id", "ts", "event_type", "value", "arrival")
    return late.classify(rows, "ts", ARRIVAL, "6 hours", "1 hour", lateness)


@query(ARRIVED + "SELECT event_id, max_ts, max_ts - INTERVAL 1 HOUR AS watermark FROM m")
def watermark_trace(spark, sf):
    rows = arrived(spark, sf).select("event_id", "ts", "arrival")
    return late.watermarked(rows, "ts", ARRIVAL, "1 hour").select("event_id", "max_ts", "watermark")


@query(classified_sql(0) + "SELECT event_id, window_start, status FROM c")
def late_split(spark, sf):
    return _statuses(spark, sf).select("event_id", "window_start", "status")


@query(classified_sql(0) + f"""
SELECT window_start, event_type, {MONEY} / count(*) AS mean FROM c WHERE status = 'on_time' GROUP BY ALL""")
def late_window_avg(spark, sf):
    parts = late.window_results(_statuses(spark, sf), ["event_type"], windows.mean_outputs(exact("value")))
    return parts.select("window_start", "event_type", (as_double("total") / F.col("n")).alias("mean"))


@query(classified_sql(1) + f"""
SELECT window_start, event_type, {MONEY} / count(*) AS mean, count(*) AS n FROM c WHERE status <> 'late' GROUP BY ALL""")
def allowed_lateness(spark, sf):
    parts = late.window_results(
        _statuses(spark, sf, "1 hour"), ["event_type"], windows.mean_outputs(exact("value"))
    )
    return parts.select("window_start", "event_type", (as_double("total") / F.col("n")).alias("mean"), "n")


@query(classified_sql(1) + f""",
r AS (SELECT *, sum({EXACT}) OVER w AS total, count(*) OVER w AS n, lead(status) OVER w AS following FROM c
  WHERE status <> 'late' WINDOW w AS (PARTITION BY event_type, window_start ORDER BY arrival, event_id))
SELECT event_id, window_start, event_type, status, CAST(total AS DOUBLE) / n AS mean FROM r
WHERE status = 'allowed' OR following IS DISTINCT FROM 'on_time'""")
def lateness_firings(spark, sf):
    fired = late.window_firings(
        _statuses(spark, sf, "1 hour"), ["event_type"], ARRIVAL, windows.mean_outputs(exact("value")), ["value"]
    )
    mean = (as_double("total") / F.col("n")).alias("mean")
    return fired.select("event_id", "window_start", "event_type", "status", mean)


@query("""
WITH r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM events)
SELECT user_id, (i - 1) // 2 AS chunk, CAST(sum(CAST(value AS DECIMAL(18,6))) AS DOUBLE) / 2 AS mean
FROM r GROUP BY ALL HAVING count(*) = 2""")
def avg_every_two(spark, sf):
    parts = state.average_every(_events(spark, sf), ["user_id"], ["ts", "event_id"], 2, exact("value"))
    return parts.select("user_id", "chunk", (as_double("total") / F.col("n")).alias("mean"))


@query("""
SELECT event_id, user_id, event_type,
  row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS n FROM events""")
def per_key_counter(spark, sf):
    rows = table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type")
    return state.counter(rows, ["user_id", "event_type"], ["ts", "event_id"]).drop("ts")


@query("""
SELECT event_id, user_id % 4 AS part,
  row_number() OVER (PARTITION BY user_id % 4 ORDER BY ts, event_id) AS n FROM events""")
def per_partition_counter(spark, sf):
    rows = table(spark, sf, "events").select("event_id", "ts", "user_id")
    return state.partition_counter(rows, F.col("user_id") % 4, ["ts", "event_id"]).drop("ts", "user_id")


LIMIT = 3
# Days of a zone eight hours ahead; the stored times are UTC.
GUARDED = f"""
WITH r AS (SELECT *, CAST(CAST(ts + INTERVAL 8 HOUR AS DATE) AS VARCHAR) AS day, row_number() OVER (
    PARTITION BY user_id, CAST(ts + INTERVAL 8 HOUR AS DATE) ORDER BY ts, event_id) AS n FROM events),
g AS (SELECT *, CASE WHEN n <= {LIMIT} THEN 'pass' WHEN n = {LIMIT + 1} THEN 'alert' ELSE 'drop' END AS status FROM r)
"""


def _guarded(spark, sf, dropped=False):
    day = local_day("ts", "Asia/Shanghai", "UTC").cast("string")
    rows = _events(spark, sf).withColumn("day", day)
    return state.threshold_guard(rows, ["user_id", "day"], ["ts", "event_id"], LIMIT, dropped=dropped)


@query(GUARDED + "SELECT event_id, user_id, day, status FROM g WHERE status <> 'drop'")
def threshold_guard(spark, sf):
    return _guarded(spark, sf).select("event_id", "user_id", "day", "status")


@query(GUARDED + "SELECT event_id, status FROM g")
def threshold_all_rows(spark, sf):
    return _guarded(spark, sf, dropped=True).select("event_id", "status")


@query(GUARDED + f""",
w AS (SELECT user_id || '_' || event_type AS key,
    {bucket('ts', HOUR)} + to_hours(CAST(i AS INTEGER)) AS window_end
  FROM g, generate_series(1, 6) s(i) WHERE status = 'pass')
SELECT key, window_end, count(*) AS n FROM w GROUP BY ALL""")
def threshold_counts(spark, sf):
    passed = _guarded(spark, sf).filter(F.col("status") == state.PASS)
    return state.per_window_counts(passed, "ts", ["user_id", "event_type"], "6 hours", "1 hour")


HOT = _slides(6 * HOUR, HOUR) + """,
c AS (SELECT window_start, window_end, event_type, user_id, count(*) AS n FROM w GROUP BY ALL)
"""


@query(HOT + """
SELECT * FROM (SELECT window_start, window_end, event_type, user_id, n, CAST(row_number() OVER (
  PARTITION BY event_type, window_start ORDER BY n DESC, user_id) AS INTEGER) AS rank FROM c) WHERE rank <= 3""")
def hot_topn(spark, sf):
    rows = table(spark, sf, "events").select("ts", "user_id", "event_type")
    return state.hot_items(rows, "ts", ["user_id"], ["event_type"], "6 hours", "1 hour", 3)


@query(HOT + """,
u AS (SELECT window_start, window_end, event_type, n, min(user_id) AS user_id FROM c GROUP BY ALL)
SELECT * FROM (SELECT *, CAST(row_number() OVER (
  PARTITION BY event_type, window_start ORDER BY n DESC) AS INTEGER) AS rank FROM u) WHERE rank <= 3""")
def hot_topn_without_ties(spark, sf):
    rows = table(spark, sf, "events").select("ts", "user_id", "event_type")
    counts = windows.windowed(rows, "ts", "6 hours", ["event_type", "user_id"], {"n": count()}, "1 hour")
    return state.hot_items_distinct_counts(counts, ["event_type"], ["user_id"], 3)


@query(f"""
SELECT event_id, user_id, CAST(sum({EXACT}) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS DOUBLE)
    AS total_stay_time,
  row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id) AS visit_num FROM events""")
def visitor_radar(spark, sf):
    rows = _events(spark, sf).withColumn("day", F.to_date("ts")).withColumn("stay", exact("value"))
    visits = state.visitor_radar(rows, ["user_id"], "day", ["ts", "event_id"], "stay")
    return visits.select("event_id", "user_id", as_double("total_stay_time").alias("total_stay_time"), "visit_num")
