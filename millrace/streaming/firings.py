"""Windows of a stream that fire once when they close and once more per allowed late row.

Spark's own windows emit a window once, or whenever a micro-batch changes it, and know the
watermark of the micro-batch before only. Here the rows come with the status that
``carried.late_split_stream`` gave them, which follows the watermark from row to row.

The event time of the stream is the highest time seen up to a row. It never falls, so Spark
drops no row, and its watermark behind a micro-batch is the one of the last row in it.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from millrace.functions.mergeable import count, highest, lowest, total
from millrace.operators.late import ALLOWED, LAST_INSTANT, LATE, ON_TIME
from millrace.streaming.event_time import window_stream
from millrace.streaming.keyed import Fold, Folding, _apply, _folds, running_stream

#: Aggregates whose results for windows are put together by the same fold, a count by a sum.
_PARTS = {"count": count, "sum": total, "min": lowest, "max": highest}


class Firing(Folding):
    """The aggregates of one window, on the row that makes it fire.

    One timer closes the window, one ends the time in which late rows are allowed. Both lie
    ahead of the watermark when the first row comes, as it would not be on time otherwise.
    """

    def __init__(self, kinds: Sequence[str], types: Sequence[str], lateness: int) -> None:
        super().__init__(kinds, [*types, "string", "boolean"])
        self.lateness = lateness

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        known = self.state.exists()
        *seen, last, fired = self.state.get() if known else (*[None] * len(self.kinds), None, True)
        for row in sorted(rows, key=self.place):
            if not known:
                known, fired = True, row.status != ON_TIME
                self.handle.registerTimer(row.close)
                self.handle.registerTimer(row.close + self.lateness)
            if row.status == ALLOWED and not fired:
                yield self.result(last, *seen)
                fired = True
            seen, last = self.folded(seen, row), row.row
            if row.status == ALLOWED:
                yield self.result(last, *seen)
        self.state.update((*seen, last, fired))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if not self.state.exists():
            return
        *seen, last, fired = self.state.get()
        if not fired:
            yield self.result(last, *seen)
        self.state.update((*seen, last, True))
        if expiredTimerInfo.getExpiryTimeInMs() >= self._over(key):
            self.state.clear()

    def _over(self, key) -> int:
        # The window's last millisecond is the last part of the key.
        return key[-1] + self.lateness


def _millis(span: str) -> int:
    return pd.Timedelta(span) // pd.Timedelta(milliseconds=1)


def firings_stream(
    classified: DataFrame,
    keys: Sequence[str],
    ts: str,
    arrival: Sequence[str],
    outputs: Mapping[str, Fold],
    *,
    delay: str = "0 seconds",
    lateness: str = "0 seconds",
) -> DataFrame:
    """``late.window_firings`` on a stream: every result a window emits, with the row it comes with.

    ``classified`` is ``Output.stream`` over what ``late_split_stream`` wrote with the same
    ``delay`` and ``lateness``. A window fires when the watermark reaches its last
    millisecond, or with the first late row behind that; then with each allowed row. Late
    rows change nothing. A window's state is two results and a row, whatever it holds.
    """
    values, kinds, types = _folds(classified, outputs)
    rows = classified.withColumn("__seen", F.greatest("max_ts", ts))
    close = F.unix_millis(F.col("window_end").cast("timestamp")) - _millis(LAST_INSTANT)
    rows = rows.filter(F.col("status") != LATE).withColumn("__close", close)
    values |= {"status": F.col("status"), "close": F.col("__close")}
    found = _apply(
        rows, [*keys, "__close"], arrival, values, Firing(kinds, list(types.values()), _millis(lateness)), types,
        kept=classified.columns, timed=("__seen", delay),
    )
    return found


def cumulative_stream(
    stream: DataFrame,
    ts: str,
    size: str,
    keys: Sequence[str],
    outputs: Mapping[str, Fold],
    *,
    delay: str = "0 seconds",
    suffix: str = "_so_far",
) -> DataFrame:
    """``windows.cumulative`` on a stream: each closed window with the result of all up to it.

    Spark's windows feed a state of one row per key in the same query. The windows of a key
    leave in the order of their ends, so those of a micro-batch follow the ones before it.
    """
    parts = {n: _PARTS[kind]() if value is None else _PARTS[kind](value) for n, (kind, value) in outputs.items()}
    windows = window_stream(stream, ts, size, keys, parts, delay=delay)
    folds = {n + suffix: ("sum" if kind == "count" else kind, n) for n, (kind, _) in outputs.items()}
    return running_stream(windows, keys, ["window_start"], folds)
