"""Streams over the test tables, dealt into micro-batches, to the end."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import times
from millrace.functions.mergeable import count, total
from millrace.functions.numbers import amount, cents
from millrace.operators import aggregate
from millrace.plans.basic import CHANGES
from millrace.plans.registry import DAY, bucket, query, table
from millrace.plans.related import LOG, change_log
from millrace.plans.timed import ARRIVAL, EXACT, MONEY, arrived, classified_sql
from millrace.session import scratch
from millrace.sinks.writers import write_lines
from millrace.sources import epochs
from millrace.sources.lines import parse_lines, stream_lines
from millrace.streaming import carried, changes, event_time, firings, handover, rules, sinks
from millrace.streaming.batches import Output, run
from millrace.streaming.tables import KeyedTable

#: Micro-batches of a table, and rows that a file of it should have at most.
BATCHES, ROWS = 4, 500_000


def dealt(df: DataFrame, by: str, folder: str, *, nulls: bool = False) -> DataFrame:
    """``df`` as a stream whose micro-batches follow the order of ``by``, a whole number.

    Rows without ``by`` are left out, unless ``nulls`` puts them into the last one.
    """
    low, high, rows = df.agg(F.min(by), F.max(by), F.count(by)).first()
    # A micro-batch is a number of files, in the order of their times, so each part gets as many.
    files = max(1, -(-rows // (BATCHES * ROWS)))
    spark, empty = df.sparkSession, df.limit(0)
    if low is None:
        df.repartition(1).write.mode("append").parquet(folder)
    else:
        step = (high - low) // BATCHES + 1
        for i in range(BATCHES):
            within = (F.col(by) >= low + i * step) & (F.col(by) < low + (i + 1) * step)
            if nulls and i == BATCHES - 1:
                within |= F.col(by).isNull()
            part = df.filter(within)
            part.repartition(files).write.mode("append").parquet(folder)
            written = len(spark.read.schema(df.schema).parquet(folder).inputFiles())
            for _ in range(written, (i + 1) * files):
                empty.write.mode("append").parquet(folder)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", files).parquet(folder)


def _events(spark: SparkSession, sf: str, by: str, folder: str, *columns: str) -> DataFrame:
    return dealt(table(spark, sf, "events").select(*columns), by, folder)


def _timely(rows: DataFrame, folder: str, *, nulls: bool = False) -> DataFrame:
    """Rows that come in the order of their ``ts``, whatever that of their ids."""
    return dealt(rows.withColumn("at", times.wall_millis("ts")), "at", folder, nulls=nulls).drop("at")


@query(classified_sql(1) + f""",
r AS (SELECT *, sum({EXACT}) OVER w AS total, count(*) OVER w AS n, lead(status) OVER w AS following FROM c
  WHERE status <> 'late' WINDOW w AS (PARTITION BY event_type, window_start ORDER BY arrival, event_id)),
e AS (SELECT max(ts) - INTERVAL 1 HOUR AS reached FROM events)
SELECT event_id, window_start, event_type, status, CAST(total AS DOUBLE) / n AS mean FROM r, e
WHERE status = 'allowed' OR following IS NOT NULL AND following <> 'on_time'
   OR following IS NULL AND window_start + INTERVAL 6 HOUR - INTERVAL 1 MILLISECOND <= reached""")
def firings_streamed(spark, sf):
    """Windows that fire when they close and with each allowed late row, up to the last watermark."""
    folder = scratch(spark)
    rows = arrived(spark, sf).select("event_id", "ts", "event_type", cents("value").alias("value"), "arrival")
    split = carried.late_split_stream(
        dealt(rows, "arrival", f"{folder}/in"), "ts", ARRIVAL, "6 hours", "1 hour", f"{folder}/split", "1 hour")
    split.awaitTermination()
    fired = firings.firings_stream(
        Output(f"{folder}/split/rows").stream(spark), ["event_type"], "ts", ARRIVAL,
        {"total": ("sum", "value"), "n": ("count", None)}, delay="1 hour", lateness="1 hour",
    )
    out = Output(f"{folder}/out")
    run(fired, out.write, f"{folder}/checkpoint").awaitTermination()
    mean = (amount("total") / F.col("n")).alias("mean")
    return out.read(spark).select("event_id", "window_start", "event_type", "status", mean)


@query(f"""
WITH d AS (SELECT {bucket('ts', DAY)} AS window_start, user_id, sum({EXACT}) AS c FROM events GROUP BY ALL),
e AS (SELECT max(ts) - INTERVAL 2 DAY AS reached FROM events)
SELECT window_start, user_id, CAST(c AS DOUBLE) AS total,
  CAST(sum(c) OVER (PARTITION BY user_id ORDER BY window_start) AS DOUBLE) AS total_so_far FROM d, e
WHERE window_start + INTERVAL 1 DAY <= reached""")
def cumulative_streamed(spark, sf):
    """Closed windows feeding a total per user, in one query."""
    folder = scratch(spark)
    rows = table(spark, sf, "events").select("event_id", "ts", "user_id", cents("value").alias("value"))
    sums = firings.cumulative_stream(
        _timely(rows, f"{folder}/in"), "ts", "1 day", ["user_id"], {"total": ("sum", "value")}, delay="2 days")
    out = Output(f"{folder}/out")
    run(sums, out.write, f"{folder}/checkpoint").awaitTermination()
    start = F.col("window_start").cast("timestamp_ntz").alias("window_start")
    return out.read(spark).select(start, "user_id", amount("total").alias("total"), amount("total_so_far").alias("total_so_far"))


@query(CHANGES + "SELECT event_type, event_id, kind, n FROM c")
def changelog_streamed(spark, sf):
    """Every change that a running count makes to its table, out of a stream's state."""
    folder = scratch(spark)
    # Events without a time come last, as in the SQL.
    untimed = F.col("ts").isNull().cast("int").alias("untimed")
    stream = _timely(table(spark, sf, "events").select("event_id", "ts", "event_type", untimed), f"{folder}/in", nulls=True)
    log = changes.changelog_stream(stream, ["event_type"], ["untimed", "ts", "event_id"], {"n": ("count", None)})
    out = Output(f"{folder}/out")
    run(log, out.write, f"{folder}/checkpoint").awaitTermination()
    return out.read(spark).select("event_type", "event_id", "kind", "n")


@query(f"SELECT user_id, count(*) AS n, {MONEY} AS total FROM events GROUP BY user_id")
def changelog_table(spark, sf):
    """A grouped result that is kept up to date by one pair of changes per user and micro-batch."""
    folder = scratch(spark)
    rows = table(spark, sf, "events").select("event_id", "user_id", cents("value").alias("value"))
    folds = {"n": ("count", None), "total": ("sum", "value")}
    log = changes.changelog_stream(dealt(rows, "event_id", f"{folder}/in"), ["user_id"], ["event_id"], folds, net=True)
    held = KeyedTable(f"{folder}/table", ["user_id"], ["event_id"], compact=2)
    run(log, held.write, f"{folder}/checkpoint").awaitTermination()
    return held.read(spark).select("user_id", "n", amount("total").alias("total"))


def _current(spark, sf, folder):
    """The user log, read in an order that has nothing to do with its own."""
    log = change_log(spark, sf).withColumn("at", F.pmod(F.xxhash64("event_id"), F.lit(1_000_000)))
    return changes.current_stream(dealt(log, "at", folder).drop("at"), ["user_id"], ["ts", "event_id"])


@query(LOG + "SELECT event_id, ts, user_id, value FROM last WHERE op <> 'd'")
def current_streamed(spark, sf):
    """The table of a change log whose older changes come late, deletes among them."""
    folder = scratch(spark)
    held = KeyedTable(f"{folder}/table", ["user_id"], compact=2)
    run(_current(spark, sf, f"{folder}/in"), held.write, f"{folder}/checkpoint").awaitTermination()
    return held.read(spark).select("event_id", "ts", "user_id", "value")


@query(LOG + """
SELECT o_orderkey, o_custkey, l.value AS last_value
FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN o_custkey % 50 ELSE o_custkey END AS o_custkey FROM orders
      WHERE o_orderkey % 7 <> 0) LEFT JOIN (SELECT * FROM last WHERE op <> 'd') l ON o_custkey = user_id""")
def enriched_streamed(spark, sf):
    """Orders that move to other customers or go, joined with users that change as well."""
    folder = scratch(spark)
    key, step = F.col("o_orderkey"), F.explode(F.array(*[F.lit(i) for i in range(3)]))
    steps = table(spark, sf, "orders").select("o_orderkey", "o_custkey", step.alias("step"))
    steps = steps.filter((F.col("step") == 0) | (F.col("step") == 1) & (key % 3 == 0) | (F.col("step") == 2) & (key % 7 == 0))
    log = steps.select(
        "o_orderkey", F.when(F.col("step") > 0, F.col("o_custkey") % 50).otherwise(F.col("o_custkey")).alias("o_custkey"),
        "step", F.when(F.col("step") == 2, "d").otherwise("u").alias("op"),
        F.pmod(F.xxhash64("o_orderkey", "step"), F.lit(1_000_000)).alias("at"),
    )
    orders = changes.current_stream(dealt(log, "at", f"{folder}/orders").drop("at"), ["o_orderkey"], ["step"])
    users = _current(spark, sf, f"{folder}/users").withColumnRenamed("value", "last_value")
    joined = changes.enriched_stream(orders, users, "o_custkey", "user_id", ["o_orderkey"], ["user_id"], ["last_value"])
    held = KeyedTable(f"{folder}/table", ["o_orderkey"], compact=2)
    run(joined, held.write, f"{folder}/checkpoint").awaitTermination()
    return held.read(spark).select("o_orderkey", "o_custkey", "last_value")


@query("SELECT event_id, ts, user_id, event_type, value FROM events")
def epochs_streamed(spark, sf):
    """A table through a log of epochs: a stream commits one per micro-batch, another reads them."""
    epochs.register(spark)
    folder = scratch(spark)
    columns = ("event_id", "ts", "user_id", "event_type", "value")
    rows = _events(spark, sf, "event_id", f"{folder}/in", *columns)
    writer = rows.writeStream.format("epochs").option("checkpointLocation", f"{folder}/written")
    writer.trigger(availableNow=True).start(f"{folder}/log").awaitTermination()
    out = Output(f"{folder}/out")
    log = spark.readStream.format("epochs").schema(rows.schema).load(f"{folder}/log")
    run(log, out.write, f"{folder}/read").awaitTermination()
    return out.read(spark).select(*columns)


@query("SELECT s_suppkey, s_name, s_nationkey FROM supplier")
def epochs_read_back(spark, sf):
    """Two writes, each one epoch of the log."""
    epochs.register(spark)
    folder = scratch(spark)
    rows = table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    for part in (F.col("s_suppkey") % 2 == 0, F.col("s_suppkey") % 2 != 0):
        rows.filter(part).write.format("epochs").mode("append").save(f"{folder}/log")
    return spark.read.format("epochs").schema(rows.schema).load(f"{folder}/log")


@query(f"SELECT user_id, count(*) AS n, {MONEY} AS total FROM events GROUP BY user_id")
def continued_totals(spark, sf):
    """Totals of the even events from a batch, carried on by a stream of the odd ones; read out of its state."""
    folder = scratch(spark)
    rows = table(spark, sf, "events").select("event_id", "user_id", cents("value").alias("value"))
    odd = F.col("event_id") % 2 == 1
    known = aggregate.grouped(rows.filter(~odd), ["user_id"], {"n": count(), "total": total("value")})
    folds = {"n": ("count", None), "total": ("sum", "value")}
    stream = dealt(rows.filter(odd), "event_id", f"{folder}/in")
    found = handover.continued_stream(stream, ["user_id"], ["event_id"], folds, known)
    run(found, Output(f"{folder}/out").write, f"{folder}/checkpoint").awaitTermination()
    held = handover.state_now(spark, f"{folder}/checkpoint", ["user_id"], ["n", "total"])
    return held.select("user_id", "n", amount("total").alias("total"))


@query("""
WITH r AS (SELECT event_id, user_id % 40 AS rule, user_id % 3 AS part, value AS least, event_id % 4 = 0 AS removed,
    lead(event_id) OVER (PARTITION BY user_id % 40 ORDER BY event_id) AS until FROM events WHERE event_type = 'signup')
SELECT d.event_id, r.rule, r.least FROM events d JOIN r ON d.event_id > r.event_id
  AND (r.until IS NULL OR d.event_id < r.until) AND NOT r.removed AND d.user_id % 3 = r.part AND d.value >= r.least
WHERE d.event_type = 'purchase'""")
def rules_streamed(spark, sf):
    """Purchases that reach the least value of rules for their part, forty rules that come, change and go."""
    folder = scratch(spark)
    events = table(spark, sf, "events").filter(F.col("event_type").isin("signup", "purchase"))
    is_rule = F.col("event_type") == "signup"
    rows = events.select(
        "event_id", "value", (F.col("user_id") % 3).alias("part"), is_rule.alias("is_rule"),
        F.when(is_rule, F.col("user_id") % 40).alias("rule"), F.when(is_rule, F.col("value")).alias("least"),
    )
    found = rules.rules_stream(
        dealt(rows, "event_id", f"{folder}/in"), F.col("is_rule"), ["event_id"], "rule", ["least"],
        removed=F.col("event_id") % 4 == 0, subject=(F.col("part"), F.col("part")),
    )
    out = Output(f"{folder}/out")
    run(found, out.write, f"{folder}/checkpoint").awaitTermination()
    return out.read(spark).filter("value >= least").select("event_id", "rule", "least")


@query("SELECT s_suppkey AS id, s_name AS name, s_nationkey AS nation FROM supplier")
def lines_streamed(spark, sf):
    """Text lines that land in a folder, parsed as they come."""
    folder = scratch(spark)
    rows = table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    for part in range(3):
        write_lines(rows.filter(F.col("s_suppkey") % 3 == part), f"{folder}/in", "append")
    out = Output(f"{folder}/out")
    parsed = parse_lines(stream_lines(spark, f"{folder}/in", 1), "id bigint, name string, nation int")
    run(parsed, out.write, f"{folder}/checkpoint").awaitTermination()
    return out.read(spark)


@query(f"""
WITH e AS (SELECT max(ts) - INTERVAL 2 DAY AS reached FROM events)
SELECT {bucket('ts', DAY)} AS window_start, event_type, count(*) AS n FROM events, e
WHERE {bucket('ts', DAY)} + INTERVAL 1 DAY <= reached GROUP BY ALL""")
def windows_streamed(spark, sf):
    """Windows that a watermark two days behind has closed."""
    folder = scratch(spark)
    rows = _timely(table(spark, sf, "events").select("event_id", "ts", "event_type"), f"{folder}/in")
    counts = event_time.window_stream(rows, "ts", "1 day", ["event_type"], {"n": count()}, delay="2 days")
    out = Output(f"{folder}/out")
    run(counts, out.write, f"{folder}/checkpoint").awaitTermination()
    return out.read(spark).select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type", "n")


@query("""
SELECT user_id, event_id, event_type FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1""")
def upserts_streamed(spark, sf):
    """The last row of each user in every micro-batch, into a table that replaces by user."""
    folder = scratch(spark)
    held = KeyedTable(f"{folder}/table", ["user_id"], ["event_id"], compact=2)
    rows = _events(spark, sf, "event_id", f"{folder}/in", "event_id", "user_id", "event_type")

    def write(batch: DataFrame, number: int) -> None:
        held.write(batch.withColumn(changes.KIND, F.lit(changes.UPDATE)), number)

    sinks.upsert_sink(rows, ["user_id"], ["event_id"], write, f"{folder}/checkpoint").awaitTermination()
    return held.read(spark).select("user_id", "event_id", "event_type")
