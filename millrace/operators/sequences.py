"""Event sequences of one key, found with ordered scans instead of an automaton.

Matches overlap: every start event is tried. Between the steps of a relaxed sequence
other events may lie; each step takes the first event that fits after the step before.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.mergeable import latest
from millrace.functions.times import interval
from millrace.operators.ordered import Ordered

MATCH, TIMEOUT = "match", "timeout"


def _within(first: Column, last: Column, limit: str, inclusive: bool) -> Column:
    end = first + interval(limit)
    return (last <= end) if inclusive else (last < end)


def match_next(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    first: Column,
    following: Column,
    within: str,
    *,
    inclusive: bool = False,
) -> DataFrame:
    """Rows that fit ``first`` whose very next row in the key fits ``following`` in time.

    The first order column is the event time. Adds ``next_time``.
    """
    time = order[0]
    following = F.coalesce(following, F.lit(False))
    rows = Ordered.of(df, keys, order).shift(
        "__next", F.struct(F.col(time).alias("time"), following.alias("fits"))
    ).result()
    rows = rows.withColumn("next_time", F.col("__next.time")).filter(
        first & F.col("__next.fits") & _within(F.col(time), F.col("next_time"), within, inclusive)
    )
    return rows.drop("__next")


def match_times(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    event: Column,
    times: int,
    within: str,
    *,
    inclusive: bool = False,
) -> DataFrame:
    """Rows that begin ``times`` fitting events in time, other events ignored.

    Adds ``last_time``.
    """
    time = order[0]
    fitting = Ordered.of(df.filter(event), keys, order).shift(
        "last_time", F.col(time), times - 1
    ).result()
    return fitting.filter(_within(F.col(time), F.col("last_time"), within, inclusive))


def match_followed_by(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    steps: Sequence[Column],
    within: str,
    *,
    inclusive: bool = False,
) -> DataFrame:
    """Each row that fits the first step, with ``outcome`` match or timeout.

    ``step_times`` holds the times of the further steps as far as the sequence got in
    time. Steps are found from the last to the first: a row of one step learns the next
    row of the step after it, which already knows its own successors.
    """
    time = order[0]
    relevant = steps[0]
    for step in steps[1:]:
        relevant = relevant | step
    rows = Ordered.of(df.filter(relevant), keys, order)
    kind = df.schema[time].dataType.simpleString()
    none = F.array().cast(f"array<{kind}>")
    chain = None
    for i in range(len(steps) - 1, 0, -1):
        later = F.coalesce(F.col(f"__after_{i + 1}"), none) if chain is not None else none
        found = F.when(steps[i], F.concat(F.array(time), later))
        rows = rows.rebased() if chain is not None else rows
        rows = rows.scan({f"__after_{i}": latest(found)}, backward=True, inclusive=False)
        chain = f"__after_{i}"
    result = rows.result().filter(steps[0])
    reached = F.filter(
        F.coalesce(F.col(chain), none), lambda t: _within(F.col(time), t, within, inclusive)
    )
    result = result.withColumn("step_times", reached)
    outcome = F.when(F.size("step_times") == len(steps) - 1, F.lit(MATCH)).otherwise(F.lit(TIMEOUT))
    return result.withColumn("outcome", outcome).drop(
        *[f"__after_{i}" for i in range(1, len(steps))]
    )
