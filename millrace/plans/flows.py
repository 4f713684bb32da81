"""Sources and sinks written and read back, and streams run to the end of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import times
from millrace.functions.mergeable import count
from millrace.operators import aggregate, cdc, windows
from millrace.plans.registry import HOUR, bucket, query, table
from millrace.session import scratch
from millrace.sinks.writers import write_control_delimited, write_lines
from millrace.sources.lines import parse_lines, read_lines
from millrace.streaming import sinks
from millrace.streaming.batches import Output, run


def _stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table as a stream of its files."""
    # A file stream takes a folder or a pattern; the pattern fits a single file as well.
    return spark.readStream.schema(table(spark, sf_dir, name).schema).parquet(f"{sf_dir}/{name}.parque[t]")


@query("SELECT s_suppkey AS id, s_name AS name, s_nationkey AS nation FROM supplier")
def lines_read_back(spark, sf):
    folder = scratch(spark)
    write_lines(table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey"), folder, "append")
    return parse_lines(read_lines(spark, folder), "id bigint, name string, nation int")


@query("SELECT p_partkey AS id, p_name AS name, p_size AS size FROM part")
def control_delimited(spark, sf):
    folder = scratch(spark)
    write_control_delimited(table(spark, sf, "part").select("p_partkey", "p_name", "p_size"), folder, "append")
    options = {"sep": "\x01", "lineSep": "\x02"}
    return spark.read.options(**options).schema("id bigint, name string, size int").csv(folder)


@query(f"""
WITH hours AS (SELECT unnest(generate_series(min({bucket('ts', HOUR)}), max({bucket('ts', HOUR)}), INTERVAL 1 HOUR))
  AS window_start FROM events)
SELECT epoch_us(window_start) // 3600000000 AS hour, count(event_id) AS n
FROM hours LEFT JOIN events ON {bucket('ts', HOUR)} = window_start GROUP BY 1""")
def every_hour(spark, sf):
    """Hours from a parallel sequence of numbers, those without events included."""
    hour = F.floor(times.wall_millis("ts") / (HOUR * 1000)).cast("bigint")
    hours = table(spark, sf, "events").select(hour.alias("hour"))
    low, high = hours.agg(F.min("hour"), F.max("hour")).first()
    counts = hours.groupBy("hour").agg(F.count(F.lit(1)).alias("n"))
    sequence = spark.range(low or 0, (-1 if high is None else high) + 1).withColumnRenamed("id", "hour")
    return sequence.join(counts, "hour", "left").select("hour", F.coalesce("n", F.lit(0)).alias("n"))


@query("""
WITH last AS (SELECT user_id, event_type, value FROM events
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1)
SELECT event_type, count(*) AS users, max(value) AS high FROM last WHERE event_type <> 'error' GROUP BY event_type""")
def cdc_table_sql(spark, sf):
    """SQL over the table that a change log describes."""
    op = F.when(F.col("event_type") == "error", "d").otherwise("u")
    log = table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "value", op.alias("op"))
    current = cdc.current_table(log, ["user_id"], ["ts", "event_id"])
    return spark.sql(
        "SELECT event_type, count(*) AS users, max(value) AS high FROM {current} GROUP BY event_type", current=current
    )


@query("""
SELECT CAST(user_id AS VARCHAR) AS rowkey, event_type AS qualifier, CAST(event_id AS VARCHAR) AS value FROM events
WHERE event_type NOT IN ('signup', 'error')
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""")
def cells_of_lines(spark, sf):
    """Sign-ups give lines of two fields, errors empty values; neither is a cell."""
    kind = F.col("event_type")
    value = F.when(kind == "error", F.lit("")).when(kind != "signup", F.col("event_id").cast("string"))
    # Null cells are left out of the line.
    line = F.concat_ws(",", "user_id", kind, value)
    lines = table(spark, sf, "events").select("ts", "event_id", line.alias("line"))
    return cdc.line_cells(lines, ["ts", "event_id"])


@query("SELECT event_type, count(*) AS n, true AS now FROM events GROUP BY event_type")
def arrival_windows(spark, sf):
    """Windows over the time of processing, which a query fixes once for all rows."""
    rows = times.arrival_time(table(spark, sf, "events").select("event_type"))
    found = windows.windowed(rows, "arrived_at", "1 day", ["event_type"], {"n": count()})
    now = (F.col("window_start") <= F.current_timestamp()) & (F.current_timestamp() < F.col("window_end"))
    return found.select("event_type", "n", now.alias("now"))


@query("""
SELECT word, count(*) AS n FROM (SELECT unnest(string_split(lower(p_name), ' ')) AS word FROM part)
WHERE trim(word) <> '' GROUP BY word""")
def word_count_updates(spark, sf):
    """A stream that shows a word's new count whenever it changes; the last one is kept."""
    folder = scratch(spark)
    counts = aggregate.word_count(_stream(spark, sf, "part"), "p_name", " ")
    out = Output(f"{folder}/rows")
    shown = run(
        counts, lambda batch, number: out.write(batch.withColumn("shown", F.lit(number)), number),
        f"{folder}/checkpoint", mode="update",
    )
    shown.awaitTermination()
    return cdc.upsert_latest(out.read(spark), ["word"], ["shown"]).drop("shown")


@query("""
SELECT 'mirror' AS sink, o_orderkey, o_custkey, NULL AS c_name FROM orders
UNION ALL SELECT 'enriched', o_orderkey, o_custkey, c_name FROM orders LEFT JOIN customer ON o_custkey = c_custkey""")
def two_sinks(spark, sf):
    """One stream into a mirror and into an enriched table."""
    folder = scratch(spark)
    mirror, enriched = Output(f"{folder}/mirror"), Output(f"{folder}/enriched")
    customers = table(spark, sf, "customer")

    def enrich(batch: DataFrame, number: int) -> None:
        enriched.write(cdc.enriched(batch, customers, "o_custkey", "c_custkey", ["c_name"]), number)

    orders = _stream(spark, sf, "orders").select("o_orderkey", "o_custkey")
    sinks.to_many(orders, [mirror.write, enrich], f"{folder}/checkpoint").awaitTermination()
    rows = [o.read(spark).withColumn("sink", F.lit(n)) for n, o in (("mirror", mirror), ("enriched", enriched))]
    return rows[0].unionByName(rows[1], allowMissingColumns=True)
