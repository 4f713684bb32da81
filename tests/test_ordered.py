"""Ordered scans against a plain loop over each key's rows."""

import contextlib
import io
from collections import defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.functions.mergeable import count, earliest, highest, latest, lowest, total
from millrace.operators.ordered import SEGMENT, Ordered
from millrace.operators.sequences import match_followed_by

SCHEMA = "id bigint, k string, t int, v bigint"
ROWS = st.lists(
    st.tuples(
        st.sampled_from(["a", "a", "a", "b", None]),
        st.one_of(st.none(), st.integers(0, 4)),
        st.one_of(st.none(), st.integers(-9, 9)),
    ),
    min_size=1, max_size=60,
)


def _looped(rows, keyed, backward, inclusive):
    groups = defaultdict(list)
    for row in rows:
        groups[row[1] if keyed else 0].append(row)
    result = {}
    for group in groups.values():
        # Nulls come first, as in an ascending sort of Spark.
        group.sort(key=lambda r: (r[2] is not None, r[2] or 0, r[0]), reverse=backward)
        for i, row in enumerate(group):
            seen = group[: i + 1 if inclusive else i]
            values = [r[3] for r in seen if r[3] is not None]
            ahead = group[i + 2][0] if i + 2 < len(group) else None
            result[row[0]] = (
                len(seen), sum(values) if values else None, min(values, default=None),
                max(values, default=None), values[-1] if values else None,
                values[0] if values else None, ahead,
            )
    return result


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(ROWS, st.booleans(), st.booleans(), st.booleans(), st.sampled_from([1, 3, 1000]))
def test_scan_matches_loop(spark, values, keyed, backward, inclusive, size):
    rows = [(i, *v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, SCHEMA)
    ordered = Ordered.of(df, ["k"] if keyed else [], ["t", "id"], segment_rows=size)
    outputs = {"n": count(), "s": total("v"), "lo": lowest("v"), "hi": highest("v"), "last": latest("v"),
               "first": earliest("v")}
    result = ordered.scan(outputs, backward=backward, inclusive=inclusive).shift(
        "ahead", F.col("id"), 2, backward=backward).result()
    assert SEGMENT not in result.columns
    found = {r["id"]: tuple(r[c] for c in (*outputs, "ahead")) for r in result.collect()}
    assert found == {
        i: ((n or 0), *rest) for i, (n, *rest) in _looped(rows, keyed, backward, inclusive).items()
    }


@pytest.mark.parametrize("rows", [30, 300])
def test_hot_key_is_cut_evenly(spark, rows):
    """A third of the rows in one key, all at one instant."""
    hot = F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id"))
    df = spark.range(9000).select("id", hot.alias("k"), F.lit(5).alias("t"))
    ordered = Ordered.of(df, ["k"], ["t", "id"], segment_rows=rows)
    sizes = [r["count"] for r in ordered.df.filter("k = -1").groupBy(SEGMENT).count().collect()]
    assert ordered.split and sum(sizes) == 3000
    assert max(sizes) <= 3 * rows
    assert ordered.df.filter(f"k <> -1 AND {SEGMENT} IS NOT NULL").count() == 0


def _row_shuffles(df):
    """Shuffles of input rows by key and segment: no aggregate or limit comes before them."""
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain()
    lines = text.getvalue().splitlines()
    found = 0
    for i, line in enumerate(lines):
        if "Exchange hashpartitioning(k#" in line and SEGMENT in line:
            below = "".join(lines[i + 1 : i + 4])
            found += not ("Aggregate" in below or "WindowGroupLimit" in below)
    return found


def test_rows_are_shuffled_once(spark):
    """Three scans over cut keys need one shuffle of the rows."""
    df = spark.range(5000).select("id", (F.col("id") % 2).alias("k"))
    ordered = Ordered.of(df, ["k"], ["id"], segment_rows=100)
    scanned = ordered.number("n").scan({"s": total("id")}, backward=True).shift("a", F.col("id"), 3)
    assert scanned.split and _row_shuffles(scanned.result()) == 1
    assert scanned.result().count() == 5000


def _segments(ordered):
    return ordered.df.filter(f"{SEGMENT} IS NOT NULL").groupBy(*ordered.keys, SEGMENT).count()


def test_many_hot_keys_make_few_segments(spark):
    """150 large keys, each with cut points of its own."""
    df = spark.range(15_000).select("id", (F.col("id") % 150).alias("k"))
    ordered = Ordered.of(df, ["k"], ["id"], segment_rows=40)
    assert ordered.split and _segments(ordered).count() <= 2 * 15_000 / 40 + 150
    numbered = ordered.number("n").result()
    assert numbered.filter(F.col("n") != F.floor(F.col("id") / 150) + 1).count() == 0
    assert numbered.count() == 15_000


def _text(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(True)
    return out.getvalue()


def test_long_order_values_stay_out_of_the_plan(spark, monkeypatch):
    """Texts of 2,000 characters: few points by size, none of them printed in the plan."""
    df = spark.range(4000).select(F.lpad(F.col("id").cast("string"), 2000, "0").alias("t"))
    ordered = Ordered.of(df, [], ["t"], segment_rows=40)
    assert _segments(ordered).count() > 50 and len(_text(ordered.number("n").result())) < 100_000
    monkeypatch.setattr("millrace.operators.ordered.POINT_BYTES", 20_000)
    few = Ordered.of(df, [], ["t"], segment_rows=40)
    assert 2 <= _segments(few).count() <= 12
    assert few.number("n").result().filter("n <> cast(t AS bigint) + 1").count() == 0


def test_instants_and_dates_as_points(spark):
    """Points come back to the microsecond, in both hours of a clock set back."""
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        at = F.timestamp_micros(F.lit(1_698_537_600_000_001) + F.col("id") * 7_200_013)
        df = spark.range(3000).select("id", at.alias("t"), F.to_date(at).alias("day"), F.lit(None).cast("int").alias("k"))
        found = Ordered.of(df, ["k"], ["day", "t"], segment_rows=40).number("n").result()
        assert found.filter("n <> id + 1").count() == 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_the_plan_of_a_sequence_does_not_grow(spark, cut_small):
    df = spark.range(3000).select("id", (F.col("id") % 2).alias("k"), F.timestamp_seconds("id").alias("t"))
    sizes = []
    for n in (2, 5):
        steps = [F.col("id") % 8 == i for i in range(n)]
        found = match_followed_by(df, ["k"], ["t", "id"], steps, "10 seconds")
        sizes.append(_text(found).count("Exchange"))
    assert sizes[1] <= sizes[0] + 2
