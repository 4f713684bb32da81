"""Reading, parsing, shaping and writing."""

import pytest
from pyspark.sql import functions as F

from millrace.functions import json, text
from millrace.operators import cdc, project
from millrace.session import pin, shared_folder
from millrace.sinks import writers
from millrace.sources import lines, tables
from tests.conftest import SMALL

SCHEMA = "user string, item string, score int"


def test_lines_are_read_and_checked(spark, tmp_path):
    (tmp_path / "a.txt").write_text("u1, i1, 5\nu2,i2\nu3,i3,x\n\nu4,i4,7,,\n")
    (tmp_path / "b.txt").write_text("u5,,9\n")
    read = lines.read_lines(spark, str(tmp_path))
    good = {tuple(r) for r in lines.parse_lines(read, SCHEMA).collect()}
    # Empty fields at the end do not count; an empty one inside does.
    assert good == {("u1", "i1", 5), ("u4", "i4", 7), ("u5", "", 9)}
    kept = {tuple(r) for r in lines.parse_lines(read, SCHEMA, keep_empty_end=True).collect()}
    assert kept == {("u1", "i1", 5), ("u5", "", 9)}
    bad = {r[0] for r in lines.rejected_lines(read, SCHEMA).collect()}
    assert bad == {"u2,i2", "u3,i3,x", ""}


def test_line_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("u1,i1,5\nbroken\n")
    stream = lines.parse_lines(lines.stream_lines(spark, str(tmp_path / "in")), SCHEMA)
    query = stream.writeStream.format("memory").queryName("parsed_lines").trigger(availableNow=True).start()
    query.awaitTermination()
    assert [tuple(r) for r in spark.table("parsed_lines").collect()] == [("u1", "i1", 5)]


def test_queue_values(spark):
    records = spark.createDataFrame([(bytearray(b"u1,i1,5"),)], "value binary")
    assert lines.parse_lines(tables.queue_lines(records), SCHEMA).count() == 1
    options = tables.kafka_options("host:1", ["a", "b"], group="g", properties={"security.protocol": "SSL"})
    assert options["subscribe"] == "a,b" and options["startingOffsets"] == "earliest"
    assert options["kafka.security.protocol"] == "SSL" and options["kafka.group.id"] == "g"


def test_table_options():
    options = tables.jdbc_options("jdbc:x", "t", partition_column="id", bounds=(1, 100), partitions=8)
    assert options["numPartitions"] == "8" and options["upperBound"] == "100"
    with pytest.raises(ValueError):
        tables.jdbc_options("jdbc:x", "t", partition_column="id")
    assert writers.jdbc_write_options("jdbc:x", "t", batch_rows=500)["batchsize"] == "500"


def test_lines_are_written(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", None)], "name string, n int")
    writers.write_lines(df, str(tmp_path / "t"))
    assert {r[0] for r in spark.read.text(str(tmp_path / "t")).collect()} == {"a,1", "b,"}
    writers.write_control_delimited(df, str(tmp_path / "c"))
    back = spark.read.options(sep="\x01", lineSep="\x02").schema("name string, n int").csv(str(tmp_path / "c"))
    assert {tuple(r) for r in back.collect()} == {("a", 1), ("b", None)}


def test_routed_files(spark, tmp_path):
    part = spark.read.parquet(f"{SMALL}/part.parquet").select(F.col("p_name").alias("line"))
    writers.write_routed(part, "line", "ring", "ring", "other", str(tmp_path / "r"), files=4)
    for name, condition in (("ring", "contains(line, 'ring')"), ("other", "NOT contains(line, 'ring')")):
        # Files are numbered by range, so reading them in name order gives the lines sorted.
        files = sorted((tmp_path / "r" / f"bucket={name}").glob("*.txt"))
        found = [line for f in files for line in f.read_text().splitlines()]
        assert found == sorted(r[0] for r in part.filter(condition).collect())


def test_rows_for_targets(spark):
    df = spark.createDataFrame([("a", 1)], "name string, score int")
    assert writers.as_json(df, as_strings=True).first()[0] == '{"name":"a","score":"1"}'
    assert writers.queue_records(df, F.col("name"), json=True).first().asDict() == {
        "key": "a", "value": '{"name":"a","score":1}'}
    assert writers.queue_records(df).first()[0] == "a,1"
    target = writers.for_target(df, [("score", "bigint"), ("name", "string")])
    assert target.dtypes == [("score", "bigint"), ("name", "string")]
    named = cdc.hash_fields(df, cdc.composite_name("cnt", "name"), "name", "score", ["score"])
    assert named.first().asDict() == {"hash": "cnt-a", "field": "a", "value": "1"}


def test_guard(spark):
    df = spark.createDataFrame([("ok",), ("bat",), (None,)], "line string")
    good, bad = project.guard(df, F.col("line").contains("t"))
    assert good.count() == 2 and bad.first()[0] == "bat"
    failing, _ = project.guard(df, F.col("line").contains("t"), fail=True)
    with pytest.raises(Exception, match="poisonous row"):
        failing.collect()
    assert project.guard(df.filter("line = 'ok'"), F.col("line").contains("t"), fail=True)[0].count() == 1


def test_text_and_json(spark):
    df = spark.createDataFrame([("ab c", '{"a":{"b":"x"}}')], "t string, j string")
    row = df.select(
        text.with_length("t").alias("n"), json.path("j", "$.a.b").alias("b"),
        json.path("j", "$.a.c", "").alias("c"), json.record("j", "a struct<b: string>").alias("r"),
        text.salted("t", F.lit(3)).alias("s"), text.random_salt(10, 1).alias("rs"),
        text.stable_salt("t", n=4).alias("ss"),
    ).first()
    assert row["n"] == "ab c :合计 4个字" and row["b"] == "x" and row["c"] == "" and row["r"]["a"]["b"] == "x"
    assert row["s"] == "3_ab c" and 0 <= row["rs"] < 10 and 0 <= row["ss"] < 4


def test_pinned_rows(spark):
    pinned = pin(spark.range(10).withColumn("r", F.rand()))
    assert pinned.collect() == pinned.collect()
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
