"""Token totals and chat texts, and every query that has SQL against it."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from millrace.llm import chat, queries, token_counts
from tests.compare import oracle, spark_bag, sql_bag
from tests.conftest import MEDIUM, SMALL
from tests.test_plans import explained


@pytest.mark.parametrize("sf_dir", [SMALL, MEDIUM])
@pytest.mark.parametrize("name", [name for name, q in queries.QUERIES.items() if q.sql])
def test_queries_against_sql(spark, name, sf_dir):
    columns, rows = spark_bag(queries.QUERIES[name].plan(spark, sf_dir))
    expected_columns, expected = sql_bag(oracle(sf_dir), queries.QUERIES[name].sql)
    assert columns == expected_columns
    assert rows == expected


BY = {"source": "string", "version": "string"}
CHANGES = "source string, version string, op string, old_tokens bigint, new_tokens bigint, docs int"


def totals_of(totals):
    return {tuple(r)[:2]: tuple(r)[2:] for r in totals.totals().collect()}


def test_batches_commit_once_and_add_up(spark, tmp_path):
    totals = token_counts.TokenTotals(spark, f"file://{tmp_path}/t", BY)
    assert totals_of(totals) == {}
    first = spark.createDataFrame([("a", "1", "insert", None, 5, 0), ("a", "1", "insert", None, 7, 0), (None, "", "insert", None, None, 0)], CHANGES)
    assert totals.apply("b1", first)
    assert totals_of(totals) == {("a", "1"): (2, 12), (None, ""): (1, 0)}
    second = spark.createDataFrame([("a", "1", "revise", 5, 9, 0), ("a", "1", "delete", 7, None, 0), (None, "", "delete", None, None, 0)], CHANGES)
    assert totals.apply("b2", second) and not totals.apply("b2", second) and not totals.apply("b1", second)
    assert totals_of(totals) == {("a", "1"): (1, 9)}
    assert totals.apply("empty", first.where("false")) and not totals.apply("empty", first)


def test_what_did_not_commit_does_not_count(spark, tmp_path):
    """Totals of an attempt that died before its commit, and a second writer's."""
    totals = token_counts.TokenTotals(spark, f"file://{tmp_path}/t", BY)
    rows = spark.createDataFrame([("a", "1", "insert", None, 5, 0)], CHANGES)
    totals.apply("b1", rows)
    spark.sql("SELECT 'a' AS source, '1' AS version, 1L AS d_docs, 100L AS d_tokens, 'b1' AS batch, 'dead' AS attempt").write.mode("append").partitionBy("batch", "attempt").parquet(f"file://{tmp_path}/t/deltas")
    spark.sql("SELECT 'b1' AS batch, 'late' AS attempt, current_timestamp() AS at").write.mode("append").parquet(f"file://{tmp_path}/t/commits")
    assert totals_of(totals) == {("a", "1"): (1, 5)}


def test_unknown_changes_are_errors(spark, tmp_path):
    totals = token_counts.TokenTotals(spark, f"file://{tmp_path}/t", BY)
    for op in ("upsert", None):
        with pytest.raises(Exception, match="unknown change"):
            totals.apply("b", spark.createDataFrame([("a", "1", op, None, 5, 0)], CHANGES))


def plain_fold(events):
    """The definition, event by event."""
    texts = {}
    for conv, turn, _, kind, role, text in sorted(events, key=lambda e: (e[0], e[1], e[2], e[3], e[5], e[4])):
        old = texts.get((conv, turn), ("", ""))[1]
        new = old + text if kind == "delta" else "" if kind == "regenerate" else text
        texts[conv, turn] = (role, new)
    return texts


def test_folding_against_a_loop(spark):
    rng = random.Random(5)
    events = [
        (rng.randrange(3), rng.randrange(4), n, rng.choice(["message", "delta", "delta", "edit", "regenerate"]), rng.choice("ua"), rng.choice(["x", "<", "\\l", "", "yz"]))
        for n in range(200)
    ]
    rng.shuffle(events)
    df = spark.createDataFrame(events, "conv_id int, turn int, seq int, kind string, role string, text string").withColumn("events", F.lit(1))
    got = {(r.conv_id, r.turn): (r.role, r.text) for r in chat.folded(df).collect()}
    assert got == plain_fold(events)


NASTY = ["", None, "</turn>", "<turn user>", "\\", "\\\\", "\\l", "\\\\l<", "<loss>x</loss>", "a>b", "\\g>", "\n", "é🙂"]


def test_texts_come_back(spark):
    rows = [(1, n, role, text) for n, (role, text) in enumerate([(r, t) for r in ("assistant", "user", "we<ird>\\", None) for t in NASTY])]
    messages = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string")
    out = chat.rendered(messages)
    assert "PythonUDF" not in explained(out)
    back = out.select(F.inline(chat.read_back(F.col("formatted")))).collect()
    assert [(r.role, r.text, r.loss) for r in back] == [(role or "", text or "", role == "assistant") for _, _, role, text in rows]


def test_odd_conversations(spark):
    schema = "conv_id int, turn int, role string, text string, formatted string, event int"
    rows = [(None, 0, "user", "a"), (1, None, None, None), (1, 0, "user", "b"), (1, 0, "user", "b"), (1, 1, "assistant", "c" * 100_000)]
    log = spark.createDataFrame([(*r, "x", 1) for r in rows], schema).select("*", F.lit(None).cast("int").alias("seq"), F.lit(None).cast("string").alias("kind"))
    out = {r.conv_id: r.formatted for r in chat.rendered(chat.folded(log)).collect()}
    assert out == {
        None: "<turn user>a</turn>",
        1: "<turn ></turn><turn user>b</turn><turn assistant><loss>" + "c" * 100_000 + "</loss></turn>",
    }
    assert chat.rendered(chat.folded(log.where("false"))).collect() == []


def test_chat_query_is_native(spark):
    plan = explained(queries.QUERIES["op10_chat_formatting"].plan(spark, SMALL))
    for operator in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"):
        assert operator not in plan


def test_repeated_and_null_turns_against_sql(spark, tmp_path):
    texts = [None, "", "b", "b", "a<", "a\\", "B", "é"]
    rows = [(conv, turn, role, text) for conv in (1, None, -7) for turn in (0, 1, None) for role in ("user", "assistant", None, "user") for text in texts]
    random.Random(3).shuffle(rows)
    spark.createDataFrame(rows, "conv_id bigint, turn int, role string, text string").coalesce(1).write.parquet(f"{tmp_path}/conversations.parquet")
    query = queries.QUERIES["op10_chat_formatting"]
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    columns, expected = sql_bag(con, query.sql.replace("ORDER BY turn", "ORDER BY turn, role, text"))
    assert spark_bag(query.plan(spark, str(tmp_path))) == (columns, expected)
