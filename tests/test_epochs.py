"""The epoch folder as source and sink, failures among them, and rows buffered by a stream."""

import os
import time

import pytest
from pyspark.sql import functions as F

from millrace.sources import epochs
from millrace.streaming import buffered
from millrace.streaming.batches import Output, read_or_none, run
from tests.compare import spark_bag
from tests.test_streaming import collected, events, finish, landed, same  # noqa: F401


@pytest.fixture
def folder(spark, tmp_path):
    epochs.register(spark)
    return str(tmp_path / "log")


def test_batches_append_whole_epochs(spark, events, folder):  # noqa: F811
    halves = [events.filter(F.col("event_id") % 2 == i) for i in range(2)]
    for half in halves:
        half.repartition(3).write.format("epochs").mode("append").save(folder)
    found = spark.read.format("epochs").load(folder)
    assert found.schema["ts"].dataType == events.schema["ts"].dataType
    assert spark_bag(found) == spark_bag(events)
    assert epochs.Folder(folder).epochs() == [0, 1]
    with pytest.raises(Exception, match="only appended"):
        halves[0].write.format("epochs").mode("overwrite").save(folder)


def test_failed_write_leaves_nothing(spark, folder):
    bad = spark.range(0, 100, 1, 4).withColumn("x", F.expr("IF(id = 99, raise_error('broken'), id)").cast("bigint"))
    with pytest.raises(Exception, match="broken"):
        bad.write.format("epochs").mode("append").save(folder)
    assert epochs.Folder(folder).epochs() == []
    spark.range(3).write.format("epochs").mode("append").save(folder)
    assert sorted(r.id for r in spark.read.format("epochs").load(folder).collect()) == [0, 1, 2]


def test_repeated_epoch_counts_once(spark, folder):
    """Another attempt at a committed epoch is dropped, and files no manifest lists are not read."""
    place = epochs.Folder(folder)
    batches = spark.range(5).toArrow().to_batches()
    place.commit(7, [place.write(iter(batches))])
    again = place.write(iter(batches))
    place.commit(7, [again])
    place.write(iter(batches))
    assert not os.path.exists(f"{folder}/data/{again}")
    assert spark.read.format("epochs").load(folder).count() == 5


def test_empty_folder(spark, folder):
    spark.range(0).write.format("epochs").mode("append").save(folder)
    assert spark.read.format("epochs").schema("id bigint").load(folder).collect() == []
    with pytest.raises(Exception, match="needs a schema"):
        spark.read.format("epochs").load(folder)


def test_stream_through_the_folder_and_on_after_a_restart(spark, events, folder, tmp_path):  # noqa: F811
    """One file per micro-batch into the folder; a second stream out of it resumes at its offset."""
    rows = events.select("event_id", "ts", "event_type")
    middle = rows.agg(F.max("event_id")).first()[0] // 2
    counts = []
    for part in (rows.filter(F.col("event_id") <= middle), rows.filter(F.col("event_id") > middle)):
        stream = landed(spark, part, tmp_path / "in")
        finish(stream.writeStream.format("epochs").option("checkpointLocation", f"{tmp_path}/c1")
               .trigger(availableNow=True).start(folder))
        out = Output(f"{tmp_path}/out")
        finish(run(spark.readStream.format("epochs").schema(rows.schema).load(folder), out.write, f"{tmp_path}/c2"))
        counts.append(out.read(spark).count())
    same(out.read(spark), rows, "event_id", "ts", "event_type")
    assert counts[0] == rows.filter(F.col("event_id") <= middle).count()
    same(spark.read.format("epochs").load(folder), rows, "event_id", "event_type")


def _count(spark, folder):
    rows = read_or_none(spark, folder)
    return 0 if rows is None else rows.count()


def _until(done, query):
    for _ in range(80):
        if done():
            return
        assert query.exception() is None
        time.sleep(0.25)
    raise AssertionError("not in time")


def test_buffer(spark, tmp_path):
    """Flushes by size, by time and at the end, over a stop; every row once, none in too large a group."""
    schema = "id bigint, k string"
    source, out = str(tmp_path / "in"), Output(f"{tmp_path}/out")

    def land(low, high):
        rows = [(i, "a" if i % 4 else "b") for i in range(low, high)]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)

    def start(interval):
        stream = spark.readStream.schema(schema).parquet(source)
        rows = buffered.buffered_stream(stream, ["k"], ["id"], 5, interval)
        return run(rows, out.write, f"{tmp_path}/c", every="200 milliseconds")

    def shown():
        return _count(spark, f"{tmp_path}/out")

    land(0, 16)
    query = start("1 hour")
    # Twelve rows of one key are two groups, four of the other wait.
    _until(lambda: shown() == 10, query)
    query.stop()
    query.awaitTermination()
    rest = buffered.waiting_rows(spark, f"{tmp_path}/c", spark.createDataFrame([], schema).schema)
    assert sorted(r.id for r in rest.collect()) == [0, 4, 8, 12, 14, 15]
    assert {(r.k, r.flush) for r in rest.collect()} == {("a", 2), ("b", 0)}
    land(16, 24)
    query = start("1 hour")
    _until(lambda: shown() == 20, query)
    query.stop()
    query.awaitTermination()
    found = out.read(spark)
    groups = found.groupBy("k", "flush").agg(F.count(F.lit(1)).alias("n"), F.max("place").alias("last")).collect()
    assert all(g.n == 5 and g["last"] == 4 for g in groups)
    rest = buffered.waiting_rows(spark, f"{tmp_path}/c", spark.createDataFrame([], schema).schema)
    assert sorted(r.id for r in found.select("id").union(rest.select("id")).collect()) == list(range(24))


def test_buffer_is_emptied_by_the_clock(spark, tmp_path):
    schema = "id bigint, k string"
    spark.createDataFrame([(1, "a"), (2, None), (3, "a")], schema).coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    out = Output(f"{tmp_path}/out")
    rows = buffered.buffered_stream(stream, ["k"], ["id"], 5, "1 second")
    query = run(rows, out.write, f"{tmp_path}/c", every="200 milliseconds")
    try:
        _until(lambda: _count(spark, f"{tmp_path}/out") == 3, query)
        assert sorted((r.id, r.flush, r.place) for r in out.read(spark).collect()) == [(1, 0, 0), (2, 0, 0), (3, 0, 1)]
    finally:
        query.stop()
