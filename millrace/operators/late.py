"""Late rows kept as data.

Spark drops rows behind the watermark without a trace. Here they are told apart before
any watermark is set, by the highest event time among the rows that arrived earlier.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.mergeable import Mergeable, highest
from millrace.functions.times import interval, with_window
from millrace.operators.ordered import Ordered
from millrace.session import pin

ON_TIME, ALLOWED, LATE = "on_time", "allowed", "late"
# A window counts as closed once the watermark reaches its last millisecond.
LAST_INSTANT = "1 millisecond"


def watermarked(
    df: DataFrame, ts: str, arrival: Sequence[str], delay: str, floor: Column | None = None
) -> DataFrame:
    """Add ``max_ts`` over the rows that arrived before, and ``watermark`` behind it.

    ``floor`` is the highest event time known from before ``df``, as in a later batch.
    """
    rows = Ordered.of(df, [], arrival).scan({"max_ts": highest(ts)}, inclusive=False).result()
    if floor is not None:
        rows = rows.withColumn("max_ts", F.greatest("max_ts", floor))
    return rows.withColumn("watermark", F.col("max_ts") - interval(delay))


def classify(
    df: DataFrame,
    ts: str,
    arrival: Sequence[str],
    size: str,
    delay: str = "0 seconds",
    lateness: str = "0 seconds",
    floor: Column | None = None,
) -> DataFrame:
    """Add the row's window and its ``status``: on time, late but allowed, or late."""
    rows = with_window(watermarked(df, ts, arrival, delay, floor), ts, size)
    last = F.col("window_end") - interval(LAST_INSTANT)
    status = (
        F.when(last + interval(lateness) <= F.col("watermark"), F.lit(LATE))
        .when(last <= F.col("watermark"), F.lit(ALLOWED))
        .otherwise(F.lit(ON_TIME))
    )
    return rows.withColumn("status", status)


def late_split(
    df: DataFrame, ts: str, arrival: Sequence[str], size: str, delay: str = "0 seconds"
) -> tuple[DataFrame, DataFrame]:
    """The rows on time and the late ones, with the columns of the input.

    Each of the two frames runs the scan; where one plan needs both, use ``classify``.
    """
    rows = classify(df, ts, arrival, size, delay)
    return (
        rows.filter(F.col("status") == ON_TIME).select(*df.columns),
        rows.filter(F.col("status") == LATE).select(*df.columns),
    )


def window_results(
    classified: DataFrame, keys: Sequence[str], outputs: Mapping[str, Mergeable]
) -> DataFrame:
    """The last result of every window: rows on time and those late but allowed."""
    return (
        classified.filter(F.col("status") != LATE)
        .groupBy("window_start", "window_end", *keys)
        .agg(*[m.rows.alias(n) for n, m in outputs.items()])
    )


def window_firings(
    classified: DataFrame,
    keys: Sequence[str],
    arrival: Sequence[str],
    outputs: Mapping[str, Mergeable],
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Every result a window emits: one when it closes, one more per allowed late row.

    The rows are written once on the way, as they are read several times. Name in ``columns``
    what the outputs read and the results should show, beside keys, window, status and
    arrival; without it all columns are written.
    """
    counted = classified.filter(F.col("status") != LATE)
    if columns is not None:
        counted = counted.select(*dict.fromkeys([*keys, "window_start", "window_end", "status", *arrival, *columns]))
    counted = pin(counted)
    rows = (
        Ordered.of(counted, [*keys, "window_start"], arrival)
        .scan(outputs)
        .shift("__next", F.col("status"))
        .result()
    )
    closes = (F.col("status") == ON_TIME) & F.coalesce(F.col("__next") != ON_TIME, F.lit(True))
    return rows.filter(closes | (F.col("status") == ALLOWED)).drop("__next")
