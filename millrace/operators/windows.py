"""Time windows, count windows, and windows that fire on either."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import timedelta

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.mergeable import Mergeable, count, total
from millrace.functions.times import interval, with_window
from millrace.operators.ordered import Ordered
from millrace.session import pin


def _span(text: str) -> timedelta:
    return pd.Timedelta(text).to_pytimedelta()


def windowed(
    df: DataFrame,
    ts: str,
    size: str,
    keys: Sequence[str],
    outputs: Mapping[str, Mergeable],
    slide: str | None = None,
) -> DataFrame:
    """Aggregates per key and time window, aligned to the epoch, end exclusive.

    A sliding window would repeat every row once per window it is in. In batch the rows
    are aggregated once per slide, and only those few results are repeated and merged.
    """
    steps, rest = divmod(_span(size), _span(slide or size))
    if steps == 1 or df.isStreaming or rest:
        return _aggregated(df, ts, size, keys, outputs, slide)

    panes = _aggregated(df, ts, slide, keys, outputs)
    first = F.col("window_start") - interval(slide) * F.lit(steps - 1)
    starts = F.sequence(first, F.col("window_start"), interval(slide))
    return (
        panes.withColumn("window_start", F.explode(starts))
        .withColumn("window_end", F.col("window_start") + interval(size))
        .groupBy("window_start", "window_end", *keys)
        .agg(*[m.merge(F.col(n)).cast(panes.schema[n].dataType).alias(n) for n, m in outputs.items()])
    )


def _aggregated(
    df: DataFrame,
    ts: str,
    size: str,
    keys: Sequence[str],
    outputs: Mapping[str, Mergeable],
    slide: str | None = None,
) -> DataFrame:
    """Grouped by the window itself, which on a stream carries the watermark."""
    window = F.window(ts, size, slide) if slide else F.window(ts, size)
    result = df.groupBy(window.alias("__w"), *keys).agg(
        *[m.rows.alias(n) for n, m in outputs.items()]
    )
    bounds = [F.col("__w.start").alias("window_start"), F.col("__w.end").alias("window_end")]
    return result.select(*bounds, *keys, *outputs)


def cumulative(
    df: DataFrame,
    ts: str,
    size: str,
    keys: Sequence[str],
    outputs: Mapping[str, Mergeable],
    suffix: str = "_so_far",
) -> DataFrame:
    """Window results, and with them the result of all windows of the key up to this one."""
    # Few rows, from which the scan is measured and computed: aggregate the input once.
    windows = pin(windowed(df, ts, size, keys, outputs))
    so_far = {
        n + suffix: Mergeable(m.merge(F.col(n)), m.merge, m.combine) for n, m in outputs.items()
    }
    return Ordered.of(windows, keys, ["window_start"]).scan(so_far).result()


def count_windows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    size: int,
    outputs: Mapping[str, Mergeable],
    *,
    partial_tail: bool = False,
) -> DataFrame:
    """Aggregates of every ``size`` rows of a key; only full groups unless asked."""
    rows = Ordered.of(df, keys, order).number("__n").result()
    rows = rows.withColumn("chunk", F.floor((F.col("__n") - 1) / size).cast("bigint"))
    result = rows.groupBy(*keys, "chunk").agg(
        F.count(F.lit(1)).alias("__size"), *[m.rows.alias(n) for n, m in outputs.items()]
    )
    if not partial_tail:
        result = result.filter(F.col("__size") == size)
    return result.drop("__size")


def count_or_time(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    order: Sequence[str],
    size: str,
    rows: int,
    outputs: Mapping[str, Mergeable],
) -> DataFrame:
    """Fires every ``rows`` rows inside a key's time window, and at its end with the rest."""
    framed = with_window(df, ts, size)
    return count_windows(
        framed, [*keys, "window_start", "window_end"], order, rows, outputs, partial_tail=True
    )


def mean_outputs(value, whole: str = "total", n: str = "n") -> dict[str, Mergeable]:
    """Sum and count, from which a mean can be merged."""
    return {whole: total(value), n: count()}
