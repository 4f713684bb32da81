"""Joins, lookups, changing rules, event sequences and change records."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.json import path, record
from millrace.functions.mergeable import count
from millrace.functions.times import wall_millis, with_window
from millrace.operators import aggregate, cdc, joins, late, sequences
from millrace.plans.registry import DAY, bucket, query, table
from millrace.plans.timed import ARRIVAL, ARRIVED, arrived


def _kind(events, kind):
    return events.filter(F.col("event_type") == kind)


PURCHASES = f"""
WITH l AS (SELECT *, {bucket('ts', DAY)} AS window_start FROM events WHERE event_type = 'click'),
r AS (SELECT *, {bucket('ts', DAY)} AS window_start FROM events WHERE event_type = 'purchase')
"""


def _join(spark, sf, how):
    events = table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "value")
    return joins.window_join(
        _kind(events, "click"), _kind(events, "purchase"), ["user_id"], "ts", "1 day",
        {"event_id": "purchase_id", "value": "paid"}, how,
    )


@query(PURCHASES + """
SELECT l.event_id, l.user_id, l.window_start, coalesce(r.event_id, -999) AS purchase_id, coalesce(r.value, -999) AS paid
FROM l LEFT JOIN r USING (user_id, window_start)""")
def window_join_left(spark, sf):
    rows = joins.filled(_join(spark, sf, "left"), {"purchase_id": joins.RIGHT_MISSING, "paid": -999.0})
    return rows.select("event_id", "user_id", "window_start", "purchase_id", "paid")


@query(PURCHASES + """
SELECT l.event_id, r.event_id AS purchase_id, l.value AS value, r.value AS paid
FROM l JOIN r USING (user_id, window_start)""")
def window_join_inner(spark, sf):
    return _join(spark, sf, "inner").select("event_id", "purchase_id", "value", "paid")


def _statuses(kind: str, name: str) -> str:
    """The rows of one event type told apart by their own watermark, without delay."""
    start = bucket("ts", DAY)
    last = f"{start} + INTERVAL 1 DAY - INTERVAL 1 MILLISECOND"
    return f"""
{name}_m AS (SELECT *, max(ts) OVER (ORDER BY arrival, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
  AS seen FROM a WHERE event_type = '{kind}'),
{name} AS (SELECT *, {start} AS window_start, CASE WHEN {last} <= seen THEN 'late' ELSE 'on_time' END AS status
  FROM {name}_m)
"""


def _classified(spark, sf, kind):
    return late.classify(_kind(arrived(spark, sf), kind), "ts", ARRIVAL, "1 day")


@query(ARRIVED + "," + _statuses("click", "l") + "," + _statuses("purchase", "r") + """
SELECT l.event_id, l.window_start, coalesce(r.event_id, -999) AS purchase_id,
  CASE WHEN r.event_id IS NULL THEN 'right late' ELSE 'joined' END AS origin
FROM l LEFT JOIN (SELECT * FROM r WHERE status = 'on_time') r USING (user_id, window_start) WHERE l.status = 'on_time'
UNION ALL SELECT event_id, window_start, -999, 'left late' FROM l WHERE status = 'late'""")
def late_join_union(spark, sf):
    clicks, purchases = _classified(spark, sf, "click"), _classified(spark, sf, "purchase")
    on_time = purchases.filter(F.col("status") == late.ON_TIME).select(
        "user_id", "window_start", F.col("event_id").alias("purchase_id")
    )
    rows = joins.on_time_join(clicks, on_time, ["user_id"])
    origin = (
        F.when(F.col("status") == late.LATE, F.lit("left late"))
        .when(F.col("purchase_id").isNull(), F.lit("right late"))
        .otherwise(F.lit("joined"))
    )
    rows = rows.withColumn("origin", origin)
    rows = joins.filled(rows, {"purchase_id": joins.RIGHT_MISSING})
    return rows.select("event_id", "window_start", "purchase_id", "origin")


@query(ARRIVED + "," + _statuses("purchase", "s") + f""",
known AS (SELECT n_nationkey, n_name FROM nation WHERE n_regionkey <> 4),
d AS (SELECT DISTINCT {bucket('ts', DAY)} AS window_start, CAST(props ->> '$.k' AS INTEGER) % 25 AS key
  FROM events WHERE event_type = 'signup'),
dim AS (SELECT window_start, key, n_name FROM d JOIN nation ON n_nationkey = key),
p AS (SELECT *, CAST(props ->> '$.k' AS INTEGER) % 25 AS key FROM s)
SELECT event_id, status, coalesce(dim.n_name, known.n_name) AS name FROM p LEFT JOIN dim USING (window_start, key)
  LEFT JOIN known ON n_nationkey = key
  WHERE status = 'on_time' AND coalesce(dim.n_name, known.n_name) IS NOT NULL
UNION ALL SELECT event_id, status, coalesce(known.n_name, CAST(key AS VARCHAR)) FROM p
  LEFT JOIN known ON n_nationkey = key WHERE status = 'late'""")
def json_dim_join(spark, sf):
    key = (record("props", "k int").getField("k") % 25).alias("n_nationkey")
    nation = table(spark, sf, "nation")
    purchases = _classified(spark, sf, "purchase").withColumn("n_nationkey", key)
    announced = with_window(_kind(table(spark, sf, "events"), "signup"), "ts", "1 day")
    dimension = announced.select("window_start", key).distinct().join(
        nation.select("n_nationkey", F.col("n_name").alias("name")), "n_nationkey"
    )
    known = nation.filter(F.col("n_regionkey") != 4).select("n_nationkey", F.col("n_name").alias("name"))
    rows = joins.dimension_join(
        purchases.select("event_id", "window_start", "n_nationkey", "status"),
        dimension, known, "n_nationkey", "name",
    )
    return rows.select("event_id", "status", "name")


@query("""
SELECT o_orderkey, o_custkey, o_totalprice, coalesce(c_name, '') AS c_name, coalesce(c_acctbal, 0) AS c_acctbal
FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_mktsegment = 'MACHINERY') ON o_custkey = c_custkey""")
def lookup_defaults(spark, sf):
    customers = table(spark, sf, "customer").filter(F.col("c_mktsegment") == "MACHINERY")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return joins.lookup(
        orders, customers.withColumnRenamed("c_custkey", "o_custkey"), ["o_custkey"],
        {"c_name": "", "c_acctbal": 0.0},
    )


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, coalesce(p_name, '') AS p_name, coalesce(p_size, 0) AS p_size
FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_size < 4) ON l_partkey = p_partkey""")
def lookup_filtered(spark, sf):
    """Rows whose key is surely not in the table take the defaults without a shuffle."""
    parts = table(spark, sf, "part").filter(F.col("p_size") < 4).withColumnRenamed("p_partkey", "l_partkey")
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return joins.lookup_filtered(lines, parts, ["l_partkey"], {"p_name": "", "p_size": 0})


NESTED = "regeocode struct<addressComponent: struct<province: string, city: string>>"


@query("""
SELECT c_custkey, coalesce(r_name, '') AS province, coalesce(n_name, '') AS city FROM customer
LEFT JOIN (SELECT * FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_regionkey <> 3)
  ON c_nationkey = n_nationkey""")
def nested_json_lookup(spark, sf):
    nation = table(spark, sf, "nation").filter(F.col("n_regionkey") != 3)
    region = table(spark, sf, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    component = F.struct(F.col("r_name").alias("province"), F.col("n_name").alias("city"))
    body = F.to_json(F.struct(F.struct(component.alias("addressComponent")).alias("regeocode")))
    answers = nation.join(region, "n_regionkey").select(F.col("n_nationkey").alias("c_nationkey"), body.alias("body"))
    found = record("body", NESTED).getField("regeocode").getField("addressComponent")
    paths = {"province": found.getField("province"), "city": path("body", "$.regeocode.addressComponent.city")}
    customers = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    return joins.nested_answer(customers, answers, ["c_nationkey"], paths).drop("c_nationkey")


RULES = """
WITH d AS (SELECT * FROM events WHERE event_type <> 'signup'),
c AS (SELECT ts, CAST(props ->> '$.k' AS INTEGER) AS k FROM events WHERE event_type = 'signup'),
j AS (SELECT d.*, c.k AS k FROM d ASOF LEFT JOIN c ON d.ts >= c.ts)
"""


def _data_and_rules(spark, sf):
    events = table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "props")
    signups = _kind(events, "signup").withColumn("k", path("props", "$.k").cast("int"))
    return events.filter(F.col("event_type") != "signup"), signups


@query(RULES + """
SELECT event_id, CASE k % 3 WHEN 1 THEN 'one' WHEN 2 THEN 'two' ELSE 'none' END AS text FROM j""")
def switch_rule(spark, sf):
    data, signups = _data_and_rules(spark, sf)
    controls = signups.select("ts", "event_id", (F.col("k") % 3).cast("string").alias("switch"))
    rows = joins.switched(data, controls, ["ts", "event_id"], "switch", {"1": "one", "2": "two"}, "none")
    return rows.select("event_id", "text")


@query(RULES + """,
w AS (SELECT *, coalesce(CAST(k % 10 AS VARCHAR), '9') AS keyword FROM j)
SELECT event_id, '拦截消息:' || props || ', 原因:包含拦截关键字：' || keyword AS message
FROM w WHERE contains(props, keyword)""")
def keyword_rule(spark, sf):
    data, signups = _data_and_rules(spark, sf)
    keywords = signups.select("ts", "event_id", (F.col("k") % 10).cast("string").alias("keyword"))
    rows = joins.intercepted(data, keywords, ["ts", "event_id"], "props", initial="9")
    return rows.select("event_id", "message")


@query(RULES + """,
p AS (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS previous,
  ['error', 'click', 'view', 'purchase'][k % 4 + 1] AS first_action,
  ['error', 'click', 'view', 'purchase'][k // 4 % 4 + 1] AS second_action FROM j)
SELECT event_id, user_id, first_action, second_action FROM p
WHERE previous = first_action AND event_type = second_action""")
def pair_rule(spark, sf):
    data, signups = _data_and_rules(spark, sf)
    actions = F.array(*[F.lit(a) for a in ("error", "click", "view", "purchase")])
    patterns = signups.select(
        "ts", "event_id",
        F.get(actions, F.col("k") % 4).alias("first_action"),
        F.get(actions, F.floor(F.col("k") / 4).cast("int") % 4).alias("second_action"),
    )
    rows = joins.paired_actions(data, patterns, ["user_id"], ["ts", "event_id"], "event_type")
    return rows.select("event_id", "user_id", "first_action", "second_action")


def _sequence_events(spark, sf):
    return table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type")


KEY, ORDER = ["user_id"], ["ts", "event_id"]


@query("""
SELECT event_id, user_id, ts, next_time FROM (SELECT *, lead(event_type) OVER w AS following, lead(ts) OVER w AS next_time
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
WHERE event_type = 'error' AND following = 'error' AND next_time < ts + INTERVAL 1 DAY""")
def strict_next(spark, sf):
    error = F.col("event_type") == "error"
    rows = sequences.match_next(_sequence_events(spark, sf), KEY, ORDER, error, error, "1 day")
    return rows.drop("event_type")


@query("""
SELECT event_id, user_id, ts, last_time FROM (SELECT *, lead(ts, 2) OVER (PARTITION BY user_id ORDER BY ts, event_id)
  AS last_time FROM events WHERE event_type = 'error') WHERE last_time < ts + INTERVAL 3 DAY""")
def times_n(spark, sf):
    error = F.col("event_type") == "error"
    return sequences.match_times(_sequence_events(spark, sf), KEY, ORDER, error, 3, "3 days").drop("event_type")


@query("""
SELECT a.event_id, a.user_id, a.ts, CASE WHEN min(b.ts) < a.ts + INTERVAL 1 DAY THEN 'match' ELSE 'timeout' END AS outcome
FROM events a LEFT JOIN events b ON b.user_id = a.user_id AND b.event_type = 'purchase' AND b.ts > a.ts
WHERE a.event_type = 'view' GROUP BY a.event_id, a.user_id, a.ts""")
def followed_by(spark, sf):
    steps = [F.col("event_type") == s for s in ("view", "purchase")]
    rows = sequences.match_followed_by(_sequence_events(spark, sf), KEY, ORDER, steps, "1 day")
    return rows.drop("event_type", "step_times")


@query("""
WITH s2 AS (SELECT a.event_id, a.user_id, a.ts, min(b.ts) AS t2
  FROM events a LEFT JOIN events b ON b.user_id = a.user_id AND b.event_type = 'click' AND b.ts > a.ts
  WHERE a.event_type = 'view' GROUP BY a.event_id, a.user_id, a.ts),
s3 AS (SELECT s2.event_id, s2.user_id, s2.ts, s2.t2, min(c.ts) AS t3
  FROM s2 LEFT JOIN events c ON c.user_id = s2.user_id AND c.event_type = 'purchase' AND c.ts > s2.t2
  GROUP BY s2.event_id, s2.user_id, s2.ts, s2.t2)
SELECT event_id, user_id, ts, CASE WHEN t3 < ts + INTERVAL 3 DAY THEN 'match' ELSE 'timeout' END AS outcome,
  CASE WHEN t2 < ts + INTERVAL 3 DAY THEN t2 END AS second_time,
  CASE WHEN t3 < ts + INTERVAL 3 DAY THEN t3 END AS third_time FROM s3""")
def three_step(spark, sf):
    steps = [F.col("event_type") == s for s in ("view", "click", "purchase")]
    rows = sequences.match_followed_by(_sequence_events(spark, sf), KEY, ORDER, steps, "3 days")
    times = {"second_time": F.get("step_times", F.lit(0)), "third_time": F.get("step_times", F.lit(1))}
    return rows.withColumns(times).drop("event_type", "step_times")


LOG = """
WITH log AS (SELECT *, CASE event_type WHEN 'signup' THEN 'c' WHEN 'error' THEN 'd' ELSE 'u' END AS op FROM events),
last AS (SELECT * FROM log QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1)
"""


def change_log(spark, sf):
    kind = F.col("event_type")
    op = F.when(kind == "signup", "c").when(kind == "error", "d").otherwise("u")
    return table(spark, sf, "events").select("event_id", "ts", "user_id", "value", op.alias("op"))


@query(LOG + "SELECT event_id, ts, user_id, value FROM last WHERE op <> 'd'")
def cdc_latest(spark, sf):
    return cdc.current_table(change_log(spark, sf), ["user_id"], ["ts", "event_id"])


@query(LOG + "SELECT user_id, value, epoch_us(ts) // 1000 AS ts_ms FROM last WHERE op <> 'd'")
def cdc_envelopes(spark, sf):
    row = F.struct("user_id", "event_id", "value")
    log = change_log(spark, sf).select(
        F.to_json(
            F.struct(
                "op",
                F.when(F.col("op") != "c", row).alias("before"),
                F.when(F.col("op") != "d", row).alias("after"),
                wall_millis("ts").alias("ts_ms"),
            )
        ).alias("value")
    )
    changes = cdc.changes_of(
        cdc.envelopes(log, "value", "user_id bigint, event_id bigint, value double"),
        ["user_id", "event_id", "value"],
    )
    return cdc.current_table(changes, ["user_id"], ["ts_ms", "event_id"]).drop("event_id")


@query("""
SELECT event_id, ts, user_id, event_type FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""")
def upsert_latest(spark, sf):
    return cdc.upsert_latest(_sequence_events(spark, sf), ["user_id", "event_type"], ["ts", "event_id"])


@query("""
WITH t AS (SELECT user_id, ts, event_id, value FROM events WHERE event_type = 'signup'
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1),
c AS (SELECT user_id, ts, event_id, value, 'r' AS op FROM t
  UNION ALL SELECT user_id, ts, event_id, value, CASE event_type WHEN 'error' THEN 'd' ELSE 'u' END FROM events
  WHERE event_type <> 'signup')
SELECT user_id, ts, event_id, value FROM c
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1 AND op <> 'd'""")
def mirrored_table(spark, sf):
    log = change_log(spark, sf)
    order = ["ts", "event_id"]
    base = cdc.upsert_latest(log.filter(F.col("op") == "c").drop("op"), ["user_id"], order)
    return cdc.upserted(base, log.filter(F.col("op") != "c"), ["user_id"], order)


@query(LOG + """
SELECT o_orderkey, o_custkey, o_totalprice, l.value AS last_value
FROM orders LEFT JOIN (SELECT * FROM last WHERE op <> 'd') l ON o_custkey = user_id""")
def enriched_orders(spark, sf):
    current = cdc.current_table(change_log(spark, sf), ["user_id"], ["ts", "event_id"])
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    current = current.withColumnRenamed("value", "last_value")
    return cdc.enriched(orders, current, "o_custkey", "user_id", ["last_value"])


@query("""
SELECT 'access' AS hash, event_type AS field, CAST(user_id AS VARCHAR) AS value FROM events
QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) = 1""")
def hash_upsert(spark, sf):
    rows = _sequence_events(spark, sf)
    return cdc.hash_fields(rows, F.lit("access"), "event_type", "user_id", ["ts", "event_id"])


@query("""
SELECT 'day_user_cnt-' || CAST(CAST(ts AS DATE) AS VARCHAR) || '-' || user_id AS hash, event_type AS field,
  CAST(count(*) AS VARCHAR) AS value FROM events GROUP BY 1, 2""")
def composite_hash(spark, sf):
    rows = _sequence_events(spark, sf).withColumn("day", F.to_date("ts").cast("string"))
    counts = aggregate.running(rows, ["day", "user_id", "event_type"], ["ts", "event_id"], {"n": count()})
    name = cdc.composite_name("day_user_cnt", "day", F.col("user_id").cast("string"))
    return cdc.hash_fields(counts, name, "event_type", "n", ["ts", "event_id"])


CELLS = """
WITH base AS (SELECT lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS rowkey, c_name AS name,
  CASE WHEN c_acctbal < 0 THEN '' ELSE c_mktsegment END AS segment, CAST(c_nationkey AS VARCHAR) AS nation FROM customer),
cells AS (SELECT rowkey, 'name' AS qualifier, name AS value FROM base UNION ALL SELECT rowkey, 'segment', segment FROM base
  UNION ALL SELECT rowkey, 'nation', nation FROM base)
"""


def _cells(spark, sf):
    rows = table(spark, sf, "customer").select(
        "c_custkey",
        F.col("c_name").alias("name"),
        F.when(F.col("c_acctbal") < 0, "").otherwise(F.col("c_mktsegment")).alias("segment"),
        F.col("c_nationkey").alias("nation"),
    )
    rowkey = F.lpad(F.col("c_custkey").cast("string"), 10, "0")
    return cdc.to_cells(rows, rowkey, ["name", "segment", "nation"])


@query(CELLS + "SELECT * FROM cells WHERE value <> ''")
def cells_out(spark, sf):
    return _cells(spark, sf)


@query(CELLS + """
SELECT rowkey, name, nullif(segment, '') AS segment, CAST(nation AS INTEGER) AS nation FROM base
WHERE rowkey >= '0' AND rowkey < ':'""")
def cells_in(spark, sf):
    types = {"name": "string", "segment": "string", "nation": "int"}
    cells = _cells(spark, sf)
    older = cells.select("rowkey", "qualifier", F.concat(F.lit("z"), "value").alias("value"), F.lit(9).alias("version"))
    both = older.unionByName(cells.withColumn("version", F.lit(10)))
    return cdc.from_cells(both, types, "0", ":", version="version")
