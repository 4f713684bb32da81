"""Time expressions: epochs, days of a zone, and windows as plain columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.mergeable import as_column

DAY_ZONE = "Asia/Shanghai"


def from_millis(value: Column | str) -> Column:
    return F.timestamp_millis(as_column(value))


def from_seconds(value: Column | str) -> Column:
    return F.timestamp_seconds(as_column(value))


def from_text(value: Column | str, pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    return F.to_timestamp(as_column(value), pattern)


def wall_millis(ts: Column | str) -> Column:
    """Milliseconds since the epoch of a timestamp without zone, read as UTC."""
    ts = as_column(ts)
    seconds = F.unix_date(F.to_date(ts)) * F.lit(86_400).cast("bigint") + (
        F.hour(ts) * 3600 + F.minute(ts) * 60
    )
    return seconds * 1000 + F.floor(F.extract(F.lit("SECOND"), ts) * 1000).cast("bigint")


def local_day(ts: Column | str, zone: str = DAY_ZONE, stored_in: str | None = None) -> Column:
    """The calendar day in ``zone``.

    ``stored_in`` names the zone of a timestamp without zone; by default the session's.
    """
    source = F.lit(stored_in) if stored_in else None
    return F.to_date(F.convert_timezone(source, F.lit(zone), as_column(ts)))


def interval(text: str) -> Column:
    """An interval from words such as ``6 hours``."""
    return F.expr(f"INTERVAL {text}")


def with_window(df: DataFrame, ts: str, size: str, slide: str | None = None) -> DataFrame:
    """Add ``window_start`` and ``window_end``; sliding windows repeat the row."""
    window = F.window(ts, size, slide) if slide else F.window(ts, size)
    return (
        df.withColumn("__w", window)
        .withColumns({"window_start": F.col("__w.start"), "window_end": F.col("__w.end")})
        .drop("__w")
    )


def arrival_time(df: DataFrame, name: str = "arrived_at") -> DataFrame:
    """Add the processing time, for windows over arrival instead of event time."""
    return df.withColumn(name, F.current_timestamp())
