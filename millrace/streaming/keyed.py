"""Streams whose state is Spark's state store: one entry per key, timers on event time.

A micro-batch costs as much as its rows and the keys they touch, however many keys are
known. The rows a key has in one micro-batch are sorted by one task, so bound the batches
(``maxFilesPerTrigger``) where single keys dominate. Spark drops rows behind the watermark
before a timed stream sees them; ``carried.late_split_stream`` keeps such rows apart.
Needs the RocksDB state store, which ``batches.run`` sees to; a query started otherwise needs
it in the session (``session.keyed_state``). Write the results in append mode.

Rows pass the Python worker as JSON text beside the few plain values that a processor
reads, and leave it with the columns and types they came with.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.stateful_processor import MapState
from pyspark.sql.types import (
    DataType, DateType, DoubleType, FloatType, IntegralType, StringType, TimestampNTZType, TimestampType,
)

from millrace.functions.mergeable import as_column
from millrace.functions.times import with_window
from millrace.operators.ordered import JSON_FORMATS
from millrace.operators.sequences import MATCH, TIMEOUT
from millrace.operators.state import ALERT, PASS

DAY_MS = 86_400_000
#: Stands for a row without a day.
NO_DAY = -(1 << 40)

#: What one more value does to a running aggregate. Nulls change none but the count.
FOLDS = {
    "count": lambda seen, value: (seen or 0) + 1,
    "sum": lambda seen, value: seen if value is None else value + (seen or 0),
    "min": lambda seen, value: value if seen is None else seen if value is None else min(seen, value),
    "max": lambda seen, value: value if seen is None else seen if value is None else max(seen, value),
    "first": lambda seen, value: value if seen is None else seen,
    "last": lambda seen, value: seen if value is None else value,
}

#: An output: the name of a fold and its value, none for ``count``.
Fold = tuple[str, "Column | str | None"]


def _sortable(df: DataFrame, name: str) -> Column:
    """A column of the order as a whole number or text."""
    kind = df.schema[name].dataType
    if isinstance(kind, (TimestampType, TimestampNTZType)):
        return F.unix_micros(F.col(name).cast("timestamp"))
    if isinstance(kind, DateType):
        return F.unix_date(name).cast("bigint")
    if isinstance(kind, IntegralType):
        return F.col(name).cast("bigint")
    if isinstance(kind, StringType):
        return F.col(name)
    raise TypeError(f"a stream can't be ordered by {kind.simpleString()}: {name}")


def _state_type(kind: DataType, name: str) -> str:
    """Whole numbers are kept as bigint, floating ones as double; decimals are refused."""
    if isinstance(kind, IntegralType):
        return "bigint"
    if isinstance(kind, (DoubleType, FloatType)):
        return "double"
    if isinstance(kind, StringType):
        return "string"
    raise TypeError(f"no running value of {kind.simpleString()}: cast {name} to bigint, double or string")


def _apply(
    stream: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    values: Mapping[str, Column],
    processor: Keyed,
    added: Mapping[str, str],
    *,
    kept: Sequence[str] | None = None,
    timed: tuple[str, str] | None = None,
    expiring: bool = False,
) -> DataFrame:
    """Run ``processor`` on the rows of each key; its results are a row's text and ``added``.

    ``timed`` names the event time and the delay of its watermark; ``expiring`` is for
    processors whose state has a time to live.
    """
    if not keys:
        raise ValueError("a stream without keys would keep all its state in one task")
    kept = list(stream.columns if kept is None else kept)
    columns = [F.col(k).alias(f"k{i}") for i, k in enumerate(keys)]
    columns += [F.to_json(F.struct(*kept), JSON_FORMATS).alias("row")]
    columns += [_sortable(stream, c).alias(f"o{i}") for i, c in enumerate(order)]
    columns += [c.alias(n) for n, c in values.items()]
    if timed:
        columns.append(F.col(timed[0]).cast("timestamp").alias("instant"))
    rows = stream.select(*columns)
    if timed:
        rows = rows.withWatermark("instant", timed[1])
    # Names of its own while a worker has them: it renames those that begin with an underscore.
    processor.places = [f"o{i}" for i in range(len(order))]
    processor.names = ["row", *[f"r{i}" for i in range(len(added))]]
    types = ["string", *added.values()]
    schema = ", ".join(f"{n} {t}" for n, t in zip(processor.names, types, strict=True))
    found = rows.groupBy(*[f"k{i}" for i in range(len(keys))]).transformWithState(
        processor, schema, "append", "eventTime" if timed else "processingTime" if expiring else "none"
    )
    text = F.from_json("row", stream.select(*kept).schema, JSON_FORMATS).alias("row")
    found = found.select(text, *[F.col(f"r{i}").alias(name) for i, name in enumerate(added)])
    return found.select("row.*", *added)


def _folds(
    stream: DataFrame, outputs: Mapping[str, Fold]
) -> tuple[dict[str, Column], list[str], dict[str, str]]:
    """The values to fold, the folds, and the types of the outputs."""
    values = {
        f"v{i}": F.lit(1).cast("bigint") if value is None else as_column(value)
        for i, (_, value) in enumerate(outputs.values())
    }
    given = stream.select(*[c.alias(n) for n, c in values.items()]).schema
    kinds = [kind for kind, _ in outputs.values()]
    types = ["bigint" if k == "count" else _state_type(f.dataType, n)
             for k, f, n in zip(kinds, given.fields, outputs, strict=True)]
    values = {n: c.cast(t) if k != "count" else c for (n, c), t, k in zip(values.items(), types, kinds, strict=True)}
    return values, kinds, dict(zip(outputs, types, strict=True))


class Keyed(StatefulProcessor):
    """A processor that knows the names of its results and of its order columns."""

    names: Sequence[str] = ()
    places: Sequence[str] = ()

    def place(self, row: Row) -> list:
        """Nulls first, as in an ascending sort of Spark."""
        return [(row[c] is not None, row[c]) for c in self.places]

    def result(self, *values) -> Row:
        return Row(**dict(zip(self.names, values, strict=True)))

    def close(self) -> None:
        pass


class Folding(Keyed):
    """Aggregates so far, on every row."""

    def __init__(self, kinds: Sequence[str], types: Sequence[str]) -> None:
        self.kinds = list(kinds)
        self.schema = ", ".join(f"s{i} {t}" for i, t in enumerate(types))

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", self.schema)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        seen = tuple(self.state.get()) if self.state.exists() else (None,) * len(self.kinds)
        for row in sorted(rows, key=self.place):
            seen = self.folded(seen, row)
            yield self.result(row.row, *seen)
        self.state.update(seen)

    def folded(self, seen: tuple, row: Row) -> tuple:
        return tuple(FOLDS[k](seen[i], row[f"v{i}"]) for i, k in enumerate(self.kinds))


class Before(Folding):
    """The values of the row before, null ones too, on every row."""

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        seen = tuple(self.state.get()) if self.state.exists() else (None,) * len(self.kinds)
        for row in sorted(rows, key=self.place):
            yield self.result(row.row, *seen)
            seen = tuple(row[f"v{i}"] for i in range(len(self.kinds)))
        self.state.update(seen)


class Numbering(Keyed):
    """A row's number within its day, and the total of a value over all days.

    A day's counter goes once the watermark is a day past its end, hence in every zone.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.sum = handle.getValueState("total", "total bigint")
        self.days = handle.getMapState("days", "day bigint", "n bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        total = self.sum.get()[0] if self.sum.exists() else None
        numbers: dict[int, int] = {}
        for row in sorted(rows, key=self.place):
            if row.day not in numbers:
                numbers[row.day] = self._known(row.day)
            numbers[row.day] += 1
            total = FOLDS["sum"](total, row.stay)
            yield self.result(row.row, numbers[row.day], total)
        for day, n in numbers.items():
            self.days.updateValue((day,), (n,))
        self.sum.update((total,))

    def _known(self, day: int) -> int:
        if self.days.containsKey((day,)):
            return self.days.getValue((day,))[0]
        if day != NO_DAY:
            self.handle.registerTimer((day + 2) * DAY_MS)
        return 0

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.days.removeKey((expiredTimerInfo.getExpiryTimeInMs() // DAY_MS - 2,))
        return iter([])


class Counted(Folding):
    """Aggregates of every ``size`` rows; at the end of a time window also of the rest."""

    def __init__(self, kinds: Sequence[str], types: Sequence[str], size: int, timed: bool) -> None:
        super().__init__(kinds, [*types, "bigint", "string"])
        self.size, self.timed = size, timed

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        none = (None,) * len(self.kinds)
        *seen, n, _ = self.state.get() if self.state.exists() else (*none, 0, None)
        for row in sorted(rows, key=self.place):
            if self.timed and n == 0:
                self.handle.registerTimer(row.end)
            seen, n = self.folded(seen, row), n + 1
            if n == self.size:
                yield self.result(row.row, *seen)
                seen, n = none, 0
        # A key's rows all have the same text here: its columns and window.
        self.state.update((*seen, n, row.row)) if n else self.state.clear()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self.state.exists():
            *seen, _, row = self.state.get()
            self.state.clear()
            yield self.result(row, *seen)


class Replay(Keyed):
    """Hands on the rows of a key in their order, once the watermark has passed them.

    An event is [micros, row text, mask of what it fits, places in the order].
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getMapState("waiting", "ms bigint", "events string")
        self.state = handle.getValueState("state", "events string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        fresh: dict[int, list] = {}
        for row in rows:
            micros = row.o0
            fresh.setdefault(-(-micros // 1000), []).append([micros, row.row, row.mask, self.place(row)])
            self.expect(micros, row.mask)
        for ms, events in fresh.items():
            if self.waiting.containsKey((ms,)):
                events = json.loads(self.waiting.getValue((ms,))[0]) + events
            self.waiting.updateValue((ms,), (json.dumps(events),))
            self.handle.registerTimer(ms)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        ms = expiredTimerInfo.getExpiryTimeInMs()
        events = []
        if self.waiting.containsKey((ms,)):
            events = sorted(json.loads(self.waiting.getValue((ms,))[0]), key=lambda e: [tuple(p) for p in e[3]])
            self.waiting.removeKey((ms,))
        known = self.load()
        found = []
        for event in events:
            known = self.next(known, event[:3], found)
        self.save(self.until(known, ms * 1000, found))
        return iter(found)

    def load(self) -> list:
        """The few events that are remembered."""
        return json.loads(self.state.get()[0]) if self.state.exists() else []

    def save(self, known: list) -> None:
        self.state.update((json.dumps(known),)) if known else self.state.clear()

    def expect(self, micros: int, mask: int) -> None:
        """Set further timers for an event. One set later, when the watermark may already
        have passed it, would fire a micro-batch late, or never at the end of a stream."""

    def next(self, known: list, event: list, found: list) -> list:
        raise NotImplementedError

    def until(self, known: list, micros: int, found: list) -> list:
        return known


class Queues:
    """Open starts in one queue per step they wait for, each entry a row of a map state.

    Entries are touched one by one, so what an event costs doesn't depend on how many wait.
    """

    def __init__(self, rows: MapState, ends: Sequence[int]) -> None:
        self.rows, self.ends = rows, list(ends)

    def size(self, step: int) -> int:
        return self.ends[2 * step + 1] - self.ends[2 * step]

    def append(self, step: int, start: int, row: str, times: Sequence[int]) -> None:
        self.rows.updateValue((step, self.ends[2 * step + 1]), (start, row, json.dumps(list(times))))
        self.ends[2 * step + 1] += 1

    def first(self, step: int) -> tuple[int, str, list[int]]:
        start, row, times = self.rows.getValue((step, self.ends[2 * step]))
        return start, row, json.loads(times)

    def drop(self, step: int) -> None:
        self.rows.removeKey((step, self.ends[2 * step]))
        self.ends[2 * step] += 1


class Following(Replay):
    """Every start with the times of its further steps, as match or timeout.

    An event that fits a step takes all starts waiting for it one queue further, so each
    start is handled once per step. Those in a later queue began earlier, and each queue is
    in the order of the starts: the ones out of time stand in front.
    """

    def __init__(self, steps: int, within: int, inclusive: bool) -> None:
        self.steps, self.within, self.inclusive = steps, within, inclusive

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.rows = handle.getMapState("open", "step int, place bigint", "start bigint, row string, times string")
        self.ends = handle.getValueState("ends", "ends array<bigint>")

    def load(self) -> Queues:
        return Queues(self.rows, self.ends.get()[0] if self.ends.exists() else [0] * (2 * self.steps))

    def save(self, known: Queues) -> None:
        if any(known.size(step) for step in range(1, self.steps)):
            self.ends.update((known.ends,))
        else:
            self.ends.clear()

    def expect(self, micros: int, mask: int) -> None:
        if mask & 1:
            # The next whole millisecond after the last one that could complete it.
            self.handle.registerTimer((micros + self.within) // 1000 + 1)

    def next(self, known: Queues, event: list, found: list) -> Queues:
        micros, row, mask = event
        self.until(known, micros, found)
        # From the last step, so that an event takes a start one step only.
        for step in range(self.steps - 1, 0, -1):
            if not mask >> step & 1:
                continue
            for _ in range(known.size(step)):
                start, text, times = known.first(step)
                known.drop(step)
                if step == self.steps - 1:
                    found.append(self.result(text, [*times, micros], MATCH))
                else:
                    known.append(step + 1, start, text, [*times, micros])
        if mask & 1:
            known.append(1, micros, row, [])
        return known

    def until(self, known: Queues, micros: int, found: list) -> Queues:
        for step in range(self.steps - 1, 0, -1):
            while known.size(step):
                start, text, times = known.first(step)
                end = start + self.within
                if not (micros > end if self.inclusive else micros >= end):
                    break
                found.append(self.result(text, times, TIMEOUT))
                known.drop(step)
        return known


class NextFits(Replay):
    """A row that fits, and the time of the very next one, where that fits as well."""

    def __init__(self, within: int, inclusive: bool) -> None:
        self.within, self.inclusive = within, inclusive

    def next(self, known: list, event: list, found: list) -> list:
        for micros, row, mask in known:
            gap = event[0] - micros
            if mask & 1 and event[2] & 2 and (gap <= self.within if self.inclusive else gap < self.within):
                found.append(self.result(row, event[0]))
        return [event]


class Repeated(Replay):
    """The first of ``times`` fitting rows in time, and the time of the last."""

    def __init__(self, times: int, within: int, inclusive: bool) -> None:
        self.times, self.within, self.inclusive = times, within, inclusive

    def next(self, known: list, event: list, found: list) -> list:
        known = [*known, event]
        if len(known) < self.times:
            return known
        (micros, row, _), *rest = known
        gap = event[0] - micros
        if gap <= self.within if self.inclusive else gap < self.within:
            found.append(self.result(row, event[0]))
        return rest


def running_stream(
    stream: DataFrame, keys: Sequence[str], order: Sequence[str], outputs: Mapping[str, Fold]
) -> DataFrame:
    """Every row with the aggregates of its key so far, in the order within a micro-batch."""
    values, kinds, types = _folds(stream, outputs)
    return _apply(stream, keys, order, values, Folding(kinds, list(types.values())), types)


def previous_stream(
    stream: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Mapping[str, Column]
) -> DataFrame:
    """Every row with values of the row before it in its key; null on the first."""
    values, kinds, types = _folds(stream, {n: ("last", c) for n, c in columns.items()})
    return _apply(stream, keys, order, values, Before(kinds, list(types.values())), types)


def _numbered(
    stream: DataFrame, keys: Sequence[str], ts: str, day: str, order: Sequence[str], delay: str, stay: Column
) -> DataFrame:
    number = F.coalesce(F.unix_date(day).cast("bigint"), F.lit(NO_DAY))
    return _apply(
        stream, keys, order, {"day": number, "stay": stay.cast("bigint")}, Numbering(),
        {"visit_num": "bigint", "total_stay_time": "bigint"}, timed=(ts, delay),
    )


def threshold_stream(
    stream: DataFrame, keys: Sequence[str], ts: str, day: str, order: Sequence[str], limit: int, delay: str
) -> DataFrame:
    """``limit`` passed rows and one alert per key and day, with their ``status``.

    ``day`` is the date of ``ts``; rows without one share a counter that stays.
    """
    rows = _numbered(stream, keys, ts, day, order, delay, F.lit(0)).drop("total_stay_time")
    status = F.when(F.col("visit_num") <= limit, F.lit(PASS)).otherwise(F.lit(ALERT))
    return rows.filter(F.col("visit_num") <= limit + 1).withColumn("status", status).drop("visit_num")


def visitor_stream(
    stream: DataFrame, keys: Sequence[str], ts: str, day: str, order: Sequence[str], stay: str, delay: str
) -> DataFrame:
    """Every visit with its number on its day and the key's stay time so far, in whole units.

    ``day`` is the date of ``ts``; rows without one share a counter that stays.
    """
    return _numbered(stream, keys, ts, day, order, delay, F.col(stay))


def count_window_stream(
    stream: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    rows: int,
    outputs: Mapping[str, Fold],
    *,
    ts: str | None = None,
    size: str | None = None,
    delay: str = "0 seconds",
) -> DataFrame:
    """Aggregates of every ``rows`` rows of a key.

    With ``ts`` and ``size`` of a key and time window, which also fires with the rest of
    its rows once the watermark has passed its end.
    """
    framed, groups, timed = stream, list(keys), None
    values, kinds, types = _folds(stream, outputs)
    if size:
        framed, groups, timed = with_window(stream, ts, size), [*keys, "window_start", "window_end"], (ts, delay)
        values["end"] = F.unix_millis(F.col("window_end").cast("timestamp"))
    processor = Counted(kinds, list(types.values()), rows, timed is not None)
    return _apply(framed, groups, order, values, processor, types, kept=groups, timed=timed)


def _micros(limit: str) -> int:
    return pd.Timedelta(limit) // pd.Timedelta(microseconds=1)


def _mask(*fits: Column) -> Column:
    """One bit per condition; a condition that is null doesn't hold."""
    mask = F.lit(0)
    for i, fit in enumerate(fits):
        mask = mask + F.when(fit, F.lit(1 << i)).otherwise(F.lit(0))
    return mask.cast("bigint")


def _replayed(
    stream: DataFrame, keys: Sequence[str], order: Sequence[str], mask: Column, processor: Replay, added: Mapping[str, str], delay: str
) -> DataFrame:
    rows = stream.filter(F.col(order[0]).isNotNull())
    return _apply(rows, keys, order, {"mask": mask}, processor, added, timed=(order[0], delay))


def sequence_stream(
    stream: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    steps: Sequence[Column],
    within: str,
    delay: str,
    *,
    inclusive: bool = False,
) -> DataFrame:
    """``sequences.match_followed_by`` on a stream: each start once its outcome is settled.

    The first column of the order is the event time; rows without one are left out.
    """
    mask = _mask(*steps)
    found = _replayed(
        stream.filter(mask > 0), keys, order, mask, Following(len(steps), _micros(within), inclusive),
        {"step_times": "array<bigint>", "outcome": "string"}, delay,
    )
    kind = stream.schema[order[0]].dataType
    times = F.transform("step_times", lambda t: F.timestamp_micros(t).cast(kind))
    return found.withColumn("step_times", times)


def next_stream(
    stream: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    first: Column,
    following: Column,
    within: str,
    delay: str,
    *,
    inclusive: bool = False,
) -> DataFrame:
    """``sequences.match_next`` on a stream, with ``next_time``."""
    mask, processor = _mask(first, following), NextFits(_micros(within), inclusive)
    found = _replayed(stream, keys, order, mask, processor, {"next_time": "bigint"}, delay)
    return found.withColumn("next_time", F.timestamp_micros("next_time").cast(stream.schema[order[0]].dataType))


def times_stream(
    stream: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    event: Column,
    times: int,
    within: str,
    delay: str,
    *,
    inclusive: bool = False,
) -> DataFrame:
    """``sequences.match_times`` on a stream, with ``last_time``."""
    processor = Repeated(times, _micros(within), inclusive)
    found = _replayed(stream.filter(event), keys, order, F.lit(1).cast("bigint"), processor, {"last_time": "bigint"}, delay)
    return found.withColumn("last_time", F.timestamp_micros("last_time").cast(stream.schema[order[0]].dataType))
