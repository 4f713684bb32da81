"""Streams whose state Spark keeps: windows, distinct counts and windowed joins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.mergeable import Mergeable
from millrace.operators.windows import windowed


def event_time(df: DataFrame, ts: str, delay: str) -> DataFrame:
    """The stream with a watermark; a time without zone is read in the session's zone."""
    return df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)


def window_stream(
    df: DataFrame,
    ts: str,
    size: str,
    keys: Sequence[str],
    outputs: Mapping[str, Mergeable],
    *,
    delay: str = "0 seconds",
    lateness: str = "0 seconds",
    slide: str | None = None,
) -> DataFrame:
    """Window aggregates of a stream.

    In append mode a window appears once it is closed, in update mode whenever it
    changes. ``lateness`` keeps windows open longer, so that allowed late rows change
    them; read such a stream in update mode.
    """
    kept = pd.Timedelta(delay) + pd.Timedelta(lateness)
    stream = event_time(df, ts, f"{kept.total_seconds()} seconds")
    return windowed(stream, ts, size, keys, outputs, slide)


def distinct_stream(
    df: DataFrame, ts: str, size: str, column: str, *, delay: str = "0 seconds", name: str = "n"
) -> DataFrame:
    """Exact distinct values per window: duplicates are dropped first, then rows counted.

    The set of seen values is spread by (window, value), not held by one window's task.
    """
    window = F.window(ts, size).alias("w")
    return (
        event_time(df, ts, delay)
        .select(window, column)
        .dropDuplicates(["w", column])
        .groupBy("w")
        .agg(F.count(F.lit(1)).alias(name))
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), name)
    )


def window_join_stream(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    ts: str,
    size: str,
    right_columns: Mapping[str, str],
    *,
    delay: str = "0 seconds",
    how: str = "inner",
) -> DataFrame:
    """Rows of two streams with equal keys in the same window.

    Both sides carry the window as join key, so that the watermark bounds their state
    and an outer join can tell when a window has no partner any more.
    """
    window = F.window(ts, size).alias("w")
    # The window carries the watermark; a second event-time column is not allowed.
    left = event_time(left, ts, delay).select("*", window)
    left = left.withColumn(ts, F.col(ts).alias(ts, metadata={}))
    right = event_time(right, ts, delay).select(
        *keys, window, *[F.col(c).alias(n) for c, n in right_columns.items()]
    )
    joined = left.join(right, [*keys, "w"], how)
    return joined.withColumn("window_start", F.col("w.start")).drop("w")
