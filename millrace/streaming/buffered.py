"""Rows of a stream gathered per key and handed on by number, by time, and at the end."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessorHandle
from pyspark.sql.types import StructType

from millrace.operators.ordered import JSON_FORMATS
from millrace.streaming.keyed import Keyed, _apply

FLUSH, PLACE = "flush", "place"


class Buffering(Keyed):
    """Rows that wait, as a list; beside it the number of the next flush and the time it is due."""

    def __init__(self, size: int, interval: int) -> None:
        self.size, self.interval = size, interval

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "row string")
        self.meta = handle.getValueState("meta", "n int, flush bigint, due bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        n, flush, due = self.meta.get() if self.meta.exists() else (0, 0, 0)
        fresh: list[str] = []
        for row in sorted(rows, key=self.place):
            if n == 0 and not fresh:
                due = timerValues.getCurrentProcessingTimeInMs() + self.interval
            fresh.append(row.row)
            if n + len(fresh) == self.size:
                yield from self._flushed(n, fresh, flush)
                n, flush, fresh = 0, flush + 1, []
        if fresh:
            self.waiting.appendList([(text,) for text in fresh])
            self.handle.registerTimer(due)
        self.meta.update((n + len(fresh), flush, due))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        n, flush, due = self.meta.get()
        # An earlier flush by number leaves its timer behind.
        if n and expiredTimerInfo.getExpiryTimeInMs() >= due:
            yield from self._flushed(n, [], flush)
            self.meta.update((0, flush + 1, 0))

    def _flushed(self, n: int, fresh: list[str], flush: int) -> Iterator[Row]:
        texts = [row[0] for row in self.waiting.get()] if n else []
        self.waiting.clear()
        for place, text in enumerate([*texts, *fresh]):
            yield self.result(text, flush, place)


def buffered_stream(
    stream: DataFrame, keys: Sequence[str], order: Sequence[str], size: int, interval: str
) -> DataFrame:
    """Rows in groups of at most ``size`` per key, with the number of their ``flush`` and their ``place`` in it.

    A key hands its rows on when ``size`` of them wait, or ``interval`` after the first one
    came. Waiting rows are Spark's state, so none is lost or doubled by a restart; a sink that
    replaces by key and flush is exact. Needs a trigger by time, as the clock keeps such a
    stream going; what waits when it is stopped is given by ``waiting_rows``.
    """
    span = pd.Timedelta(interval) // pd.Timedelta(milliseconds=1)
    return _apply(
        stream, keys, order, {}, Buffering(size, span), {FLUSH: "bigint", PLACE: "int"}, expiring=True,
    )


def waiting_rows(spark: SparkSession, checkpoint: str, schema: StructType, operator: int = 0) -> DataFrame:
    """The rows that wait in a stopped ``buffered_stream``, with the flush and place they are due for.

    ``schema`` is that of the stream. The same rows come with the same flush, or a fuller
    one, when the stream goes on.
    """
    read = spark.read.format("statestore").option("path", checkpoint).option("operatorId", operator)
    waiting = read.option("stateVarName", "waiting").load()
    meta = read.option("stateVarName", "meta").load().select("key", F.col("value.flush").alias(FLUSH))
    lists = waiting.groupBy("key").agg(F.collect_list("list_element.row").alias("rows"))
    found = lists.join(meta, "key").select(F.posexplode("rows").alias(PLACE, "text"), FLUSH)
    row = F.from_json("text", schema, JSON_FORMATS).alias("row")
    return found.select(row, FLUSH, PLACE).select("row.*", FLUSH, PLACE)
