"""Rows, groups and running aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import text, times
from millrace.functions.json import text_of
from millrace.functions.mergeable import count, highest, lowest, total
from millrace.functions.numbers import as_double, exact
from millrace.operators import aggregate, project
from millrace.operators.bitmap import (
    bitmaps, cardinality, dictionary as number_values, encoded, extended, hashed_dictionary, hashed_extended, number_lists, united,
)
from millrace.operators.joins import keep_matching, keep_matching_filtered
from millrace.plans.registry import DAY, bucket, query, table
from millrace.session import pin
from millrace.sinks.writers import as_lines, for_target, in_order, queue_records, routed
from millrace.sources.lines import parse_lines, rejected_lines as rejected

NOT_LETTERS = r"[^\p{L}]+"


@query(rf"""
SELECT word, count(*) AS n FROM (
  SELECT unnest(string_split_regex(lower(text), '{NOT_LETTERS}')) AS word FROM documents)
WHERE word <> '' GROUP BY word""")
def word_count(spark, sf):
    return aggregate.word_count(table(spark, sf, "documents"), "text", NOT_LETTERS)


@query("""
SELECT l_returnflag, l_linestatus, CAST(sum(CAST(l_quantity AS DECIMAL(18,6))) AS DOUBLE) AS quantity,
  CAST(sum(CAST(l_extendedprice AS DECIMAL(18,6))) AS DOUBLE) AS price, count(*) AS n
FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def keyed_sum(spark, sf):
    sums = aggregate.grouped(
        table(spark, sf, "lineitem"),
        ["l_returnflag", "l_linestatus"],
        {"quantity": total(exact("l_quantity")), "price": total(exact("l_extendedprice")), "n": count()},
    )
    return sums.withColumns({c: as_double(c) for c in ("quantity", "price")})


@query("""
SELECT event_type, CAST(sum(CAST(value AS DECIMAL(18,6))) AS DOUBLE) AS total
FROM events GROUP BY event_type ORDER BY total DESC""")
def order_by_total(spark, sf):
    sums = aggregate.grouped(table(spark, sf, "events"), ["event_type"], {"total": total(exact("value"))})
    return sums.withColumn("total", as_double("total")).orderBy(F.desc("total"))


@query(f"""
SELECT {bucket('ts', DAY)} AS day, event_type, user_id,
  CAST(sum(CAST(value AS DECIMAL(18,6))) AS DOUBLE) AS total
FROM events GROUP BY ALL""")
def composite_key_sum(spark, sf):
    rows = table(spark, sf, "events").withColumn("day", F.date_trunc("day", "ts").cast("timestamp_ntz"))
    sums = aggregate.grouped(rows, ["day", "event_type", "user_id"], {"total": total(exact("value"))})
    return sums.withColumn("total", as_double("total"))


@query("""
SELECT c_custkey, c_name, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 20""")
def order_limit(spark, sf):
    rows = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    return rows.orderBy(F.desc("c_acctbal"), "c_custkey").limit(20)


@query("""
SELECT event_id, user_id, CAST(sum(CAST(value AS DECIMAL(18,6))) OVER w AS DOUBLE) AS total
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)""")
def running_sum(spark, sf):
    rows = table(spark, sf, "events").select("event_id", "ts", "user_id", "value")
    sums = aggregate.running(rows, ["user_id"], ["ts", "event_id"], {"total": total(exact("value"))})
    return sums.select("event_id", "user_id", as_double("total").alias("total"))


@query("""
SELECT event_id, event_type, min(value) OVER w AS low, max(value) OVER w AS high,
  first_value(props) OVER w AS props
FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)""")
def running_min_max(spark, sf):
    rows = table(spark, sf, "events").select("event_id", "ts", "event_type", "value", "props")
    scanned = aggregate.running(
        rows, ["event_type"], ["ts", "event_id"],
        {"low": lowest("value"), "high": highest("value")}, first=["props"],
    )
    return scanned.select("event_id", "event_type", "low", "high", "props")


CHANGES = """
WITH r AS (SELECT event_type, event_id, ts,
    row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS n FROM events),
c AS (SELECT event_type, event_id, CASE WHEN n = 1 THEN '+I' ELSE '+U' END AS kind, n FROM r
  UNION ALL SELECT event_type, event_id, '-U', n - 1 FROM r WHERE n > 1)
"""


def _changelog(spark, sf):
    return aggregate.count_changelog(table(spark, sf, "events"), ["event_type"], ["ts", "event_id"])


@query(CHANGES + "SELECT event_type, event_id, kind, n FROM c")
def changelog_count(spark, sf):
    return _changelog(spark, sf).drop("ts")


@query(CHANGES + "SELECT event_type, event_id, n FROM c WHERE kind <> '-U'")
def changelog_additions(spark, sf):
    return aggregate.additions(_changelog(spark, sf)).drop("ts")


@query("SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def changelog_replayed(spark, sf):
    return aggregate.replayed(_changelog(spark, sf), ["event_type"])


@query("""
SELECT o_orderkey, o_custkey, o_totalprice, lower(o_orderpriority) AS priority
FROM orders WHERE o_totalprice > 300000 AND lower(o_orderstatus) = 'f'""")
def project_filter(spark, sf):
    orders = project.drop_blank(table(spark, sf, "orders"), "o_orderpriority")
    kept = orders.filter((F.col("o_totalprice") > 300000) & text.same_ignoring_case("o_orderstatus", "F"))
    return kept.select("o_orderkey", "o_custkey", "o_totalprice", F.lower("o_orderpriority").alias("priority"))


@query("""
SELECT doc_id, text || ' :合计 ' || length(text) || '个字' AS annotated
FROM documents WHERE contains(text, 'the')""")
def line_annotate(spark, sf):
    return project.annotated(table(spark, sf, "documents"), "text", "the").select("doc_id", "annotated")


@query("""
SELECT event_id, 'click' AS route FROM events WHERE event_type = 'click'
UNION ALL SELECT event_id, 'click_small' FROM events WHERE event_type = 'click' AND value < 10
UNION ALL SELECT event_id, 'click_large' FROM events WHERE event_type = 'click' AND value > 100
UNION ALL SELECT event_id, 'purchase' FROM events WHERE event_type = 'purchase'""")
def routing(spark, sf):
    kind, value = F.col("event_type"), F.col("value")
    routes = {
        "click": kind == "click",
        "click_small": (kind == "click") & (value < 10),
        "click_large": (kind == "click") & (value > 100),
        "purchase": kind == "purchase",
    }
    return project.route(table(spark, sf, "events"), routes).select("event_id", "route")


@query("""
SELECT event_id, event_type FROM events WHERE event_type = 'click'
UNION ALL SELECT event_id, event_type FROM events WHERE event_type = 'view'
UNION ALL SELECT event_id, event_type FROM events WHERE event_type = 'view'""")
def union_all(spark, sf):
    events = table(spark, sf, "events").select("event_id", "event_type")
    views = events.filter(F.col("event_type") == "view")
    return project.union_all(events.filter(F.col("event_type") == "click"), views, views)


@query("""
SELECT c_name AS name, c_acctbal AS balance, c_mktsegment AS segment FROM customer
UNION ALL SELECT s_name, s_acctbal, NULL FROM supplier""")
def connect_map(spark, sf):
    return project.connect(
        table(spark, sf, "customer"), table(spark, sf, "supplier"),
        {"name": F.col("c_name"), "balance": F.col("c_acctbal"), "segment": F.col("c_mktsegment")},
        {"name": F.col("s_name"), "balance": F.col("s_acctbal")},
    )


@query("""
SELECT event_id, CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 2 WHEN 'purchase' THEN 3
  ELSE 4 END % 4 AS part FROM events""")
def key_placement(spark, sf):
    places = {"click": 1, "view": 2, "purchase": 3}
    placed = project.place(table(spark, sf, "events"), "event_type", places, 4, 4)
    return placed.select("event_id", F.spark_partition_id().alias("part"))


@query("""
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""")
def semi_lookup(spark, sf):
    customers = table(spark, sf, "customer").filter(F.col("c_mktsegment") == "BUILDING")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return keep_matching(orders, customers.withColumnRenamed("c_custkey", "o_custkey"), ["o_custkey"])


@query("""
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size = 7)""")
def semi_lookup_filtered(spark, sf):
    """Few of many rows match: a filter of the keys leaves the others out before the shuffle."""
    parts = table(spark, sf, "part").filter(F.col("p_size") == 7).select(F.col("p_partkey").alias("l_partkey"))
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return keep_matching_filtered(lines, parts, ["l_partkey"]).drop("l_partkey")


@query("SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word, 1 AS weight FROM part")
def split_udtf(spark, sf):
    return project.split_rows(table(spark, sf, "part"), "p_name", " ").select("p_partkey", "word", "weight")


@query("SELECT p_partkey, (p_partkey % 10) || '_' || p_name AS salted FROM part")
def salt_udf(spark, sf):
    salt = F.col("p_partkey") % 10
    return table(spark, sf, "part").select("p_partkey", text.salted("p_name", salt).alias("salted"))


LINES = """
WITH lines AS (SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag, CASE
    WHEN l_linenumber = 7 THEN l_orderkey || ', ' || l_linenumber || ',' || l_returnflag
    WHEN l_linenumber = 6 THEN l_orderkey || ',x' || l_linenumber || ',' || CAST(l_quantity AS BIGINT) || ',' || l_returnflag
    ELSE l_orderkey || ', ' || l_linenumber || ' ,' || CAST(l_quantity AS BIGINT) || ',' || l_returnflag END AS line
  FROM lineitem)
"""


def _lines(spark, sf):
    quantity = F.col("l_quantity").cast("bigint")
    short = F.concat_ws(",", "l_orderkey", F.concat(F.lit(" "), "l_linenumber"), "l_returnflag")
    wrong = F.concat_ws(",", "l_orderkey", F.concat(F.lit("x"), "l_linenumber"), quantity, "l_returnflag")
    good = F.concat_ws(
        ",", "l_orderkey", F.concat(F.lit(" "), "l_linenumber", F.lit(" ")), quantity, "l_returnflag"
    )
    number = F.col("l_linenumber")
    line = F.when(number == 7, short).when(number == 6, wrong).otherwise(good)
    return table(spark, sf, "lineitem").select(line.alias("line"))


LINE_SCHEMA = "order_key bigint, line_number int, quantity bigint, flag string"


@query(LINES + """
SELECT l_orderkey AS order_key, l_linenumber AS line_number, CAST(l_quantity AS BIGINT) AS quantity,
  l_returnflag AS flag FROM lines WHERE l_linenumber NOT IN (6, 7)""")
def validated_parse(spark, sf):
    return parse_lines(_lines(spark, sf), LINE_SCHEMA)


@query(LINES + "SELECT line FROM lines WHERE l_linenumber IN (6, 7)")
def rejected_lines(spark, sf):
    return rejected(_lines(spark, sf), LINE_SCHEMA)


@query("""
SELECT '{"p_name":"' || p_name || '","p_size":"' || p_size || '"}' AS value FROM part""")
def json_rows(spark, sf):
    return table(spark, sf, "part").select(text_of("p_name", "p_size", as_strings=True).alias("value"))


@query("""
SELECT p_name AS line, CASE WHEN contains(p_name, 'ring') THEN 'ring' ELSE 'other' END AS bucket
FROM part ORDER BY bucket, line""")
def routed_lines(spark, sf):
    lines = table(spark, sf, "part").select(F.col("p_name").alias("line"))
    return in_order(routed(lines, "line", "ring", "ring", "other"), "bucket", "line")


@query("""
SELECT event_id, upper(event_type) AS kind FROM events WHERE NOT contains(props, '7')""")
def guarded_rows(spark, sf):
    good, _ = project.guard(table(spark, sf, "events"), F.col("props").contains("7"))
    return good.select("event_id", F.upper("event_type").alias("kind"))


@query("""
SELECT CAST(p_size AS BIGINT) AS size, p_name AS name, CAST(p_partkey AS VARCHAR) AS id FROM part""")
def target_rows(spark, sf):
    parts = table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_size").alias("size")
    )
    return for_target(parts, [("size", "bigint"), ("name", "string"), ("id", "string")])


@query("""
SELECT CAST(o_custkey AS VARCHAR) AS key, o_orderkey || ',' || o_custkey || ',' || o_orderstatus AS value FROM orders""")
def queue_values(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return queue_records(orders, F.col("o_custkey"))


@query("""
SELECT s_suppkey || ',' || s_name || ',' || s_nationkey AS value FROM supplier""")
def delimited_lines(spark, sf):
    return as_lines(table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey"))


@query("""
SELECT event_id, epoch_us(ts) // 1000 AS ms, strftime(ts, '%Y-%m-%d %H:%M:%S') AS text,
  make_timestamp(epoch_us(ts) // 1000 * 1000) AS from_ms, date_trunc('second', ts) AS from_text,
  CAST(CAST(ts + INTERVAL 8 HOUR AS DATE) AS VARCHAR) AS local_day FROM events""")
def time_functions(spark, sf):
    pattern = "yyyy-MM-dd HH:mm:ss"
    ms = times.wall_millis("ts")
    since = F.make_dt_interval(secs=(ms / 1000).cast("decimal(18,6)"))
    from_ms = F.lit("1970-01-01").cast("timestamp_ntz") + since
    return table(spark, sf, "events").select(
        "event_id",
        ms.alias("ms"),
        F.date_format("ts", pattern).alias("text"),
        from_ms.alias("from_ms"),
        times.from_text(F.date_format("ts", pattern)).cast("timestamp_ntz").alias("from_text"),
        times.local_day("ts", "Asia/Shanghai", "UTC").cast("string").alias("local_day"),
    )


NUMBERED = """
WITH d AS (SELECT name, row_number() OVER (ORDER BY name) AS id
  FROM (SELECT DISTINCT 'u' || user_id AS name FROM events)),
e AS (SELECT event_type, id FROM events JOIN d ON name = 'u' || user_id)
"""


def _users(spark, sf):
    return table(spark, sf, "events").select("event_type", F.concat(F.lit("u"), "user_id").alias("name"))


@query(NUMBERED + "SELECT name, id FROM d")
def dictionary(spark, sf):
    return number_values(_users(spark, sf), "name")


@query("""
WITH o AS (SELECT count(DISTINCT o_orderpriority) AS known FROM orders),
f AS (SELECT DISTINCT p_name AS name FROM part EXCEPT SELECT DISTINCT o_orderpriority FROM orders)
SELECT known, known + (SELECT count(*) FROM f) AS n, known + (SELECT count(*) FROM f) AS different, CAST(1 AS BIGINT) AS low,
  known + (SELECT count(*) FROM f) AS high, known AS high_of_known FROM o""")
def dictionary_hashed(spark, sf):
    """Numbers by hash bucket, extended: dense, each given once, the old ones in front."""
    old = pin(hashed_dictionary(table(spark, sf, "orders"), "o_orderpriority"))
    old = old.withColumnRenamed("o_orderpriority", "name")
    both = hashed_extended(old, table(spark, sf, "part").withColumnRenamed("p_name", "name"), "name")
    marked = both.join(old.select("name", F.lit(True).alias("known")), "name", "left")
    highest = F.max(F.when(F.col("known"), F.col("id"))).alias("high_of_known")
    return marked.agg(
        F.count("known").alias("known"), F.count("id").alias("n"), F.countDistinct("id").alias("different"),
        F.min("id").alias("low"), F.max("id").alias("high"), highest,
    )


@query("""
WITH o AS (SELECT name, row_number() OVER (ORDER BY name) AS id
  FROM (SELECT DISTINCT o_orderpriority AS name FROM orders)),
f AS (SELECT DISTINCT c_mktsegment AS name FROM customer WHERE c_mktsegment NOT IN (SELECT name FROM o)
  UNION SELECT DISTINCT p_name FROM part)
SELECT name, id FROM o
UNION ALL SELECT name, row_number() OVER (ORDER BY name) + (SELECT max(id) FROM o) FROM f""")
def dictionary_extended(spark, sf):
    # Read three times below: the highest number, what is known, and all of it.
    old = pin(number_values(table(spark, sf, "orders").withColumnRenamed("o_orderpriority", "name"), "name"))
    later = [
        table(spark, sf, "customer").select(F.col("c_mktsegment").alias("name")),
        table(spark, sf, "part").select(F.col("p_name").alias("name")),
        table(spark, sf, "orders").select(F.col("o_orderpriority").alias("name")),
    ]
    return extended(old, project.union_all(*later), "name")


def _encoded(spark, sf):
    # A bitmap is a set, so each user counts once per type before the join.
    users = _users(spark, sf).distinct()
    return encoded(users, number_values(users, "name"), "name")


@query(NUMBERED + "SELECT event_type, count(DISTINCT id) AS n FROM e GROUP BY event_type")
def bitmap_union(spark, sf):
    return cardinality(bitmaps(_encoded(spark, sf), ["event_type"]), ["event_type"])


@query(NUMBERED + """
SELECT (id - 1) // 32768 + 1 AS bucket, count(DISTINCT id) AS n FROM e GROUP BY 1""")
def bitmap_united(spark, sf):
    maps = bitmaps(_encoded(spark, sf), ["event_type"])
    return cardinality(united(maps, []), ["bucket"])


@query(NUMBERED + """
SELECT event_type, (id - 1) // 32768 + 1 AS bucket, string_agg(id, ',' ORDER BY id) AS ids
FROM (SELECT DISTINCT event_type, id FROM e) GROUP BY 1, 2""")
def bitmap_text(spark, sf):
    return number_lists(_encoded(spark, sf), ["event_type"])


@query("""
WITH d AS (SELECT name, row_number() OVER (ORDER BY name) AS id
  FROM (SELECT DISTINCT 'u' || user_id AS name FROM events WHERE event_type <> 'error')),
e AS (SELECT event_type, id FROM events LEFT JOIN d ON name = CASE WHEN event_type <> 'error' THEN 'u' || user_id END)
SELECT event_type, count(*) AS n, count(DISTINCT id) AS known FROM e GROUP BY event_type""")
def encoded_rows(spark, sf):
    """Rows without a value stay, without a number."""
    users = _users(spark, sf).withColumn("name", F.when(F.col("event_type") != "error", F.col("name")))
    rows = encoded(users, number_values(users, "name"), "name")
    return rows.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("id").alias("known"))


@query("SELECT event_id, event_type FROM events WHERE contains(props, '7')")
def poisonous_rows(spark, sf):
    _, bad = project.guard(table(spark, sf, "events"), F.col("props").contains("7"))
    return bad.select("event_id", "event_type")
