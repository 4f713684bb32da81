"""Streams that run a batch operator on every micro-batch and write each batch's rows.

Every stream takes ``folder`` on storage that all executors share and keeps there its
output and its checkpoint. Late rows and rules hand one row on to the next batch.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.functions.mergeable import count
from millrace.operators import late
from millrace.operators.joins import latest_rule
from millrace.operators.state import ranked
from millrace.streaming.batches import Output, State, run
from millrace.streaming.event_time import window_join_stream, window_stream
from millrace.streaming.keyed import previous_stream


def late_split_stream(
    stream: DataFrame,
    ts: str,
    arrival: Sequence[str],
    size: str,
    delay: str,
    folder: str,
    lateness: str = "0 seconds",
    every: str | None = None,
) -> StreamingQuery:
    """Every row with its window and status; the highest event time is handed on."""
    out, state = Output(f"{folder}/rows"), State(f"{folder}/state")

    def handle(batch: DataFrame, number: int) -> None:
        known = state.read(batch.sparkSession, number)
        seen = known.first()[0] if known is not None else None
        floor = F.lit(seen).cast(batch.schema[ts].dataType) if seen is not None else None
        out.write(late.classify(batch, ts, arrival, size, delay, lateness, floor), number)
        highest = F.max(ts) if floor is None else F.greatest(F.max(ts), floor)
        state.write(batch.agg(highest.alias("seen")), number)

    return run(stream, handle, f"{folder}/checkpoint", every)


def rule_stream(
    stream: DataFrame,
    is_rule: Column,
    order: Sequence[str],
    payload: Sequence[str],
    folder: str,
    every: str | None = None,
    kept: Column | None = None,
) -> StreamingQuery:
    """Data rows of a connected stream with the payload of the rule in force.

    ``stream`` holds data and rule rows, and a row whose flag is null is data; the last rule
    of a batch is handed on. ``kept`` is a condition on the rows that are written.
    """
    out, state = Output(f"{folder}/rows"), State(f"{folder}/state")

    def handle(batch: DataFrame, number: int) -> None:
        flag = F.coalesce(is_rule, F.lit(False))
        rules = batch.filter(flag).select(*order, *payload)
        known = state.read(batch.sparkSession, number)
        if known is not None:
            rules = known.unionByName(rules)
        data = batch.filter(~flag).drop(*payload)
        found = latest_rule(data, rules, order, payload)
        out.write(found if kept is None else found.filter(kept), number)
        state.write(rules.orderBy(*[F.col(c).desc() for c in order]).limit(1), number)

    return run(stream, handle, f"{folder}/checkpoint", every)


def pair_stream(
    stream: DataFrame,
    is_rule: Column,
    user: Sequence[str],
    order: Sequence[str],
    action: str,
    folder: str,
    every: str | None = None,
) -> StreamingQuery:
    """``joins.paired_actions`` on a connected stream of data rows and patterns.

    A user's last action is Spark's state, the pattern in force is handed on.
    """
    flag = F.coalesce(is_rule, F.lit(False)).alias("__rule")
    marked = stream.select("*", flag)
    data = previous_stream(marked.filter(~F.col("__rule")), user, order, {"__previous": F.col(action)})
    rules = marked.filter("__rule").withColumn("__previous", F.lit(None).cast("string"))
    pattern = ["first_action", "second_action"]
    fits = (F.col("__previous") == F.col(pattern[0])) & (F.col(action) == F.col(pattern[1]))
    return rule_stream(data.unionByName(rules), F.col("__rule"), order, pattern, folder, every, fits)


def late_join_stream(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    ts: str,
    size: str,
    right_columns: Mapping[str, str],
    *,
    delay: str = "0 seconds",
) -> DataFrame:
    """Left join within the window in which late rows find no partner.

    Both sides are streams over the rows that ``late_split_stream`` wrote, read with
    ``Output.stream``, for which its ``delay`` must be given again. Left rows without a
    partner come once their window is closed, late ones at once; ``status`` tells them apart.
    """
    on_time = F.col("status") == late.ON_TIME
    plain = left.drop("window_start", "window_end", "max_ts", "watermark")
    joined = window_join_stream(
        plain.filter(on_time), right.filter(on_time), keys, ts, size, right_columns, delay=delay, how="leftOuter"
    )
    unseen = left.filter(~on_time).select(*plain.columns, "window_start")
    return joined.unionByName(unseen.withColumn(ts, F.col(ts).cast("timestamp")), allowMissingColumns=True)


def hot_items_stream(
    stream: DataFrame,
    ts: str,
    item: Sequence[str],
    kind: Sequence[str],
    size: str,
    slide: str,
    n: int,
    folder: str,
    *,
    delay: str = "0 seconds",
    every: str | None = None,
) -> StreamingQuery:
    """``state.hot_items`` of every sliding window, written once the window is closed.

    Spark counts in its own state; all counts of a window leave it in one micro-batch.
    """
    out = Output(f"{folder}/rows")
    counts = window_stream(stream, ts, size, [*kind, *item], {"n": count()}, delay=delay, slide=slide)

    def handle(batch: DataFrame, number: int) -> None:
        order = [F.col("n").desc(), *[F.col(c) for c in item]]
        out.write(ranked(batch, [*kind, "window_start", "window_end"], order, n), number)

    return run(counts, handle, f"{folder}/checkpoint", every)
