"""What keyed state computes: counters, thresholds, rankings, visitor totals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.mergeable import count, total
from millrace.functions.messages import OVER_LIMIT
from millrace.operators.ordered import Ordered
from millrace.operators.windows import count_windows, mean_outputs, windowed

# Above this rank Spark no longer cuts groups before the shuffle
# (spark.sql.optimizer.windowGroupLimitThreshold).
RANK_LIMIT = 1000
SPREAD = 64


def ranked(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows of every key with their ``rank``.

    Each task passes on at most ``n`` rows of a key, so a large key is no burden. Beyond
    ``RANK_LIMIT`` Spark doesn't cut groups early; there the rows of a key are first
    ranked in ``SPREAD`` parts, and the first ``n`` of each part are ranked again.
    """
    if n > RANK_LIMIT:
        part = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(SPREAD))
        parts = Window.partitionBy(*keys, "__part").orderBy(*order)
        df = df.withColumn("__part", part).withColumn("__rank", F.row_number().over(parts))
        df = df.filter(F.col("__rank") <= n).drop("__part", "__rank")
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(window)).filter(F.col("rank") <= n)


def average_every(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], size: int, value: Column
) -> DataFrame:
    """Sum and count of every ``size`` values of a key; an unfinished group gives nothing."""
    return count_windows(df, keys, order, size, mean_outputs(value))


def counter(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "n"
) -> DataFrame:
    """Every row with its number within the key."""
    return Ordered.of(df, keys, order).number(name).result()


def partition_counter(
    df: DataFrame, part: Column, order: Sequence[str], name: str = "n"
) -> DataFrame:
    """Every row with its number within an explicit partition that ignores the key."""
    return counter(df.withColumn("part", part), ["part"], order, name)


PASS, ALERT, DROP = "pass", "alert", "drop"


def threshold_guard(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    limit: int,
    *,
    dropped: bool = False,
) -> DataFrame:
    """Rows up to ``limit`` per key pass, the next one raises the alert, the rest are dropped.

    Put the day among the keys for a daily restart. With ``dropped`` the dropped rows
    stay as well; without, they are cut before the shuffle.
    """
    if dropped:
        rows = counter(df, keys, order, "rank")
    else:
        rows = ranked(df, keys, [F.col(c) for c in order], limit + 1)
    status = (
        F.when(F.col("rank") <= limit, F.lit(PASS))
        .when(F.col("rank") == limit + 1, F.lit(ALERT))
        .otherwise(F.lit(DROP))
    )
    rows = rows.withColumn("status", status).drop("rank")
    return rows if dropped else rows.filter(F.col("status") != DROP)


def alert_text(user: str, domain: str, ts: str, limit: int) -> Column:
    return F.concat(
        F.col(user), F.lit(","), F.col(domain), F.col(ts).cast("string"),
        F.lit(f"{OVER_LIMIT}{limit}"),
    )


def hot_items(
    df: DataFrame, ts: str, item: Sequence[str], kind: Sequence[str], size: str, slide: str, n: int
) -> DataFrame:
    """The ``n`` most frequent items per kind and sliding window; ties go by item."""
    counts = windowed(df, ts, size, [*kind, *item], {"n": count()}, slide)
    order = [F.col("n").desc(), *[F.col(c) for c in item]]
    return ranked(counts, [*kind, "window_start", "window_end"], order, n)


def hot_items_distinct_counts(
    counts: DataFrame, kind: Sequence[str], item: Sequence[str], n: int
) -> DataFrame:
    """The same with ties dropped: of items with equal counts only the first stays."""
    frame = [*kind, "window_start", "window_end"]
    unique = ranked(counts, [*frame, "n"], [F.col(c) for c in item], 1).drop("rank")
    return ranked(unique, frame, [F.col("n").desc()], n)


def visitor_radar(
    df: DataFrame, keys: Sequence[str], day: str, order: Sequence[str], stay: str
) -> DataFrame:
    """Every visit with the visits of that day so far and the whole stay time so far.

    Both scans share one distribution of the rows, by key.
    """
    rows = Ordered.of(df, keys, order).scan({"total_stay_time": total(stay)})
    return rows.narrowed(day).number("visit_num").result()


def per_window_counts(
    df: DataFrame, ts: str, keys: Sequence[str], size: str, slide: str
) -> DataFrame:
    """Sliding counts with the keys joined into one text."""
    counts = windowed(df, ts, size, keys, {"n": count()}, slide)
    return counts.select(
        F.concat_ws("_", *keys).alias("key"), "window_end", "n"
    )


