"""State filled from a batch, read back, and rules by id."""

import pytest
from pyspark.sql import functions as F

from millrace.functions.mergeable import count, highest, total
from millrace.functions.numbers import cents
from millrace.operators import aggregate
from millrace.streaming import handover
from millrace.streaming.batches import Output, run
from tests.test_streaming import ORDER, events, finish, landed, same, with_null_keys  # noqa: F401

FOLDS = {"n": ("count", None), "total": ("sum", "v"), "high": ("max", "v")}


def test_batch_then_stream(spark, events, tmp_path):  # noqa: F811
    """Totals of the old rows and a stream of the new ones, over a restart, as of all rows."""
    outputs = {"n": count(), "total": total("v"), "high": highest("v")}
    rows = with_null_keys(events).withColumn("v", cents("value")).select("event_id", "ts", "event_type", "user_id", "v")
    last = rows.agg(F.max("event_id")).first()[0]
    old = rows.filter(F.col("event_id") <= last // 2)
    known = aggregate.grouped(old, ["event_type"], outputs)
    out = Output(f"{tmp_path}/out")
    for low, high in ((last // 2, last * 3 // 4), (last * 3 // 4, last)):
        part = rows.filter((F.col("event_id") > low) & (F.col("event_id") <= high))
        stream = landed(spark, part, tmp_path / "in")
        finish(run(handover.continued_stream(stream, ["event_type"], ORDER, FOLDS, known), out.write, f"{tmp_path}/c"))
    batch = aggregate.running(rows, ["event_type"], ORDER, outputs).filter(F.col("event_id") > last // 2)
    same(out.read(spark), batch, "event_id", "event_type", *outputs)
    held = handover.state_now(spark, f"{tmp_path}/c", ["event_type"], list(outputs))
    same(held, aggregate.grouped(rows, ["event_type"], outputs), "event_type", *outputs)


def test_keys_without_new_rows_and_older_states(spark, tmp_path):
    schema = "id bigint, k string, v bigint"
    known = spark.createDataFrame([("a", 3, 30), (None, 1, 7), ("z", 2, 5)], "k string, n bigint, total bigint")
    for i, rows in enumerate(([(1, "a", 1), (2, None, 1)], [(3, "a", 1), (4, "new", None)])):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        folds = {"n": ("count", None), "total": ("sum", "v")}
        found = handover.continued_stream(stream, ["k"], ["id"], folds, known)
        finish(run(found, Output(f"{tmp_path}/out").write, f"{tmp_path}/c"))
    states = [
        {tuple(r) for r in handover.state_now(spark, f"{tmp_path}/c", ["k"], ["n", "total"], batch=b).collect()}
        for b in (0, 1)
    ]
    assert states[0] == {("a", 4, 31), (None, 2, 8), ("z", 2, 5)}
    assert states[1] == {("a", 5, 32), (None, 2, 8), ("z", 2, 5), ("new", 1, None)}


def test_without_keys(spark):
    with pytest.raises(ValueError, match="without keys"):
        handover.continued_stream(spark.range(1), [], ["id"], {"n": ("count", None)}, spark.range(1))
