"""Tables dealt into micro-batches, whatever their files and the order of their ids."""

import duckdb
import pytest
from pyspark.sql import functions as F

from millrace.plans import QUERIES, streams
from millrace.streaming.batches import run
from tests.compare import spark_bag, sql_bag
from tests.test_streaming import finish


@pytest.mark.parametrize("nulls", [False, True])
def test_micro_batches_follow_the_order(spark, tmp_path, monkeypatch, nulls):
    """The second quarter is short of rows, and the third has none."""
    monkeypatch.setattr(streams, "ROWS", 30)
    rows = spark.range(0, 400, 1, 7).filter("id < 102 OR id >= 300")
    rows = rows.withColumn("at", F.when(F.col("id") % 50 != 7, F.col("id")))
    found = []
    stream = streams.dealt(rows, "at", f"{tmp_path}/in", nulls=nulls)
    finish(run(stream, lambda batch, _: found.append([r.id for r in batch.collect()]), f"{tmp_path}/c"))
    timed = [[i for i in range(low, high) if i % 50 != 7] for low, high in ((0, 100), (100, 102), (0, 0), (300, 400))]
    if nulls:
        timed[3] += [7, 57, 307, 357]
    assert [sorted(b) for b in found if b] == [sorted(b) for b in timed if b]


@pytest.mark.parametrize("name", ["changelog_streamed", "cumulative_streamed", "windows_streamed"])
def test_ids_against_the_times(spark, tmp_path, name):
    db = duckdb.connect()
    db.execute("""
        CREATE TABLE events AS SELECT i AS event_id, i % 4 AS user_id, i / 4 AS value,
          CASE WHEN i % 3 = 0 THEN 'view' ELSE 'error' END AS event_type,
          TIMESTAMP '2024-01-20 00:00:00' - INTERVAL (i) HOUR AS ts FROM range(200) t(i)
        UNION ALL SELECT 77, 1, 1, 'view', NULL""")
    db.execute(f"COPY events TO '{tmp_path}/events.parquet' (FORMAT parquet)")
    assert spark_bag(QUERIES[name].plan(spark, str(tmp_path))) == sql_bag(db, QUERIES[name].sql)
