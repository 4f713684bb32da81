"""Streams of changes: aggregates and tables that withdraw what no longer holds.

A change is a row and its kind: ``+I`` a new row, ``-U`` and ``+U`` the old and the new form
of one, ``-D`` a row that is gone. Such streams can be joined and folded again; whatever
keeps them needs the kind only, see ``tables.KeyedTable``.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessorHandle
from pyspark.sql.types import StructType

from millrace.operators.cdc import DELETED
from millrace.operators.ordered import JSON_FORMATS
from millrace.streaming.keyed import Fold, Folding, Keyed, _apply, _folds, _sortable
from millrace.streaming.paged import FIELD, PART, Bucketed, Pages, apply, name_of

KIND = "kind"
INSERT, WITHDRAW, UPDATE, DELETE = "+I", "-U", "+U", "-D"
#: Kinds that say what holds from now on.
HOLDS = (INSERT, UPDATE)
#: A row of the left or the right side of a join that holds from now on, or that is gone.
LEFT, RIGHT = ("l+", "l-"), ("r+", "r-")
HELD = (LEFT[0], RIGHT[0])


class Changing(Folding):
    """The changes that aggregates of a key make to their table, row by row or in sum."""

    def __init__(self, kinds: Sequence[str], types: Sequence[str], net: bool) -> None:
        super().__init__(kinds, types)
        self.net = net

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        seen = tuple(self.state.get()) if self.state.exists() else None
        shown = seen
        ordered = sorted(rows, key=self.place)
        for i, row in enumerate(ordered):
            seen = self.folded(seen or (None,) * len(self.kinds), row)
            if not self.net or i == len(ordered) - 1:
                if shown is not None:
                    yield self.result(row.row, WITHDRAW, *shown)
                yield self.result(row.row, INSERT if shown is None else UPDATE, *seen)
                shown = seen
        self.state.update(seen)


def changelog_stream(
    stream: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    outputs: Mapping[str, Fold],
    *,
    net: bool = False,
) -> DataFrame:
    """The changes that grouped aggregates make to their result table: keys, order, kind, outputs.

    The first row of a key inserts; each further one withdraws the old result and adds the
    new one. With ``net`` a key makes one such pair per micro-batch, under its last row.
    """
    values, kinds, types = _folds(stream, outputs)
    kept = list(dict.fromkeys([*keys, *order]))
    processor = Changing(kinds, list(types.values()), net)
    return _apply(stream, keys, order, values, processor, {KIND: "string", **types}, kept=kept)


class Forgetting(Keyed):
    """``Current`` whose positions of deleted rows have a time to live, in milliseconds; each key has its own state."""

    def __init__(self, kept: int) -> None:
        self.kept = kept

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.live = handle.getValueState("live", "row string, place string")
        self.gone = handle.getValueState("gone", "place string", self.kept)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        old, place = self.live.get() if self.live.exists() else (None, None)
        if place is None and self.gone.exists():
            place = self.gone.get()[0]
        seen = [tuple(p) for p in json.loads(place)] if place else None
        newest = max(rows, key=self.place)
        if seen is not None and self.place(newest) <= seen:
            return
        place = json.dumps(self.place(newest))
        if newest.gone:
            self.live.clear()
            self.gone.update((place,))
            if old is not None:
                yield self.result(old, DELETE)
            return
        self.live.update((newest.row, place))
        self.gone.clear()
        if old is not None:
            yield self.result(old, WITHDRAW)
        yield self.result(newest.row, INSERT if old is None else UPDATE)


class Current(Bucketed):
    """The newest version of each row, by its position in the log, which outlives the row."""

    def __init__(self, places: Sequence[str]) -> None:
        self.places = places

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.pages = Pages(handle, "rows")

    def handle_lines(self, lines: Iterator[list[str]]) -> Iterator[str]:
        newest: dict[str, tuple[str, str]] = {}
        for name, *entry in lines:
            if name not in newest or self.later(entry[0], newest[name][0]):
                newest[name] = tuple(entry)
        for entries, names in self.pages.touched(newest):
            for name in names:
                place, row = newest[name]
                seen, old = entries[name].split(FIELD) if name in entries else (None, "")
                if seen is not None and not self.later(place, seen):
                    continue
                entries[name] = f"{place}{FIELD}{row}"
                # A deleted row has a place and no text.
                if old:
                    yield self.line(old, WITHDRAW if row else DELETE)
                if row:
                    yield self.line(row, UPDATE if old else INSERT)

    def later(self, one: str, other: str) -> bool:
        return one != other and self.placed(one) > self.placed(other)

    def placed(self, text: str) -> list:
        """Nulls first, as in an ascending sort of Spark; the text leaves them out."""
        place = json.loads(text)
        return [(place.get(c) is not None, place.get(c)) for c in self.places]

    def line(self, row: str, kind: str) -> str:
        return f'{{"row":{row},"{KIND}":"{kind}"}}'


def current_stream(
    changes: DataFrame, keys: Sequence[str], order: Sequence[str], op: str = "op", *, remembered: str | None = None
) -> DataFrame:
    """``cdc.current_table`` on a stream: what the log changes in the table, with its kind.

    ``order`` is the position in the log. A change that comes after a newer one of its key
    is passed over, in a later micro-batch as well, also after a delete: the position of a
    deleted row is kept in state of its own, with ``remembered`` as its time to live. A
    stream with such state never runs out of micro-batches, so it needs a trigger by time;
    without it positions are kept for ever. A key makes at most one withdrawal and one
    addition per micro-batch.
    """
    gone = F.coalesce(F.lower(F.col(op)).isin(*DELETED), F.lit(False))
    kept = [c for c in changes.columns if c != op]
    if remembered is not None:
        processor = Forgetting(pd.Timedelta(remembered) // pd.Timedelta(milliseconds=1))
        return _apply(changes, keys, order, {"gone": gone}, processor, {KIND: "string"}, kept=kept, expiring=True)
    if not keys:
        raise ValueError("a stream without keys would keep all its state in one task")
    places = {f"o{i}": _sortable(changes, c) for i, c in enumerate(order)}
    place = F.to_json(F.struct(*[c.alias(n) for n, c in places.items()]))
    row = F.when(gone, "").otherwise(F.to_json(F.struct(*kept), JSON_FORMATS))
    named = changes.select(name_of(changes, keys).alias("name"), place.alias("place"), row.alias("row"))
    rows = named.select("name", F.concat_ws(FIELD, "name", "place", "row").alias("line"))
    schema = StructType().add("row", changes.select(*kept).schema).add(KIND, "string")
    return apply(rows, Current(list(places)), schema).select("row.*", KIND)


class Paired(Bucketed):
    """Rows of two tables by join key, and the pairs that changes make or undo."""

    def __init__(self, outer: bool) -> None:
        self.outer = outer

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.lefts = Pages(handle, "lefts")
        self.rights = Pages(handle, "rights")

    def handle_lines(self, lines: Iterator[list[str]]) -> Iterator[str]:
        lefts: dict[str, str | None] = {}
        rights: dict[str, dict[str, str | None]] = {}
        for key, what, id, row in lines:
            changed, name = (lefts, f"{key}{PART}{id}") if what in LEFT else (rights.setdefault(key, {}), id)
            # A withdrawal and an addition of one row may come in any order.
            if what in HELD:
                changed[name] = row
            else:
                changed.setdefault(name, None)
        before, after, differences = self._partners({_key(name) for name in lefts}, rights)
        # Pages of the left side pass one by one; all of them where the right side changes.
        for entries, names in self.lefts.touched(lefts, all_pages=bool(differences)):
            if differences:
                for name, row in entries.items():
                    if (key := _key(name)) in differences and (name not in lefts or lefts[name] == row):
                        gone, come = differences[key]
                        yield from _pairs(row, gone, False)
                        yield from _pairs(row, come, True)
            for name in names:
                key, old, row = _key(name), entries.get(name), lefts[name]
                if old == row:
                    continue
                if old is not None:
                    yield from _pairs(old, before[key], False)
                if row is None:
                    del entries[name]
                else:
                    yield from _pairs(row, after[key], True)
                    entries[name] = row

    def _partners(self, keys: set[str], rights: dict[str, dict[str, str | None]]) -> tuple[dict, dict, dict]:
        """The right rows of each key before and after the changes; where they differ, those that go and come."""
        before, after, differences = {}, {}, {}
        for entries, names in self.rights.touched(keys | rights.keys()):
            for key in names:
                parts = entries[key].split(PART) if key in entries else []
                old = dict(zip(parts[::2], parts[1::2], strict=True))
                new = {id: row for id, row in {**old, **rights.get(key, {})}.items() if row is not None}
                before[key], after[key] = self._shown(old.values()), self._shown(new.values())
                if old == new:
                    continue
                gone = [row for id, row in old.items() if new.get(id) != row]
                come = [row for id, row in new.items() if old.get(id) != row]
                differences[key] = gone if old else before[key], come if new else after[key]
                if new:
                    entries[key] = PART.join(part for pair in new.items() for part in pair)
                else:
                    del entries[key]
        return before, after, differences

    def _shown(self, rows: Iterable[str]) -> list[str]:
        """What a left row is paired with; a null where it has no partner."""
        return list(rows) or ["null"] * self.outer


def _key(name: str) -> str:
    return name[:name.index(PART)]


def _pairs(left: str, rights: Sequence[str], made: bool) -> Iterator[str]:
    end = "true}" if made else "false}"
    for right in rights:
        yield f'{{"left":{left},"right":{right},"made":{end}'


def enriched_stream(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    left_id: Sequence[str],
    right_id: Sequence[str],
    columns: Sequence[str],
    *,
    how: str = "left",
) -> DataFrame:
    """``cdc.enriched`` of two tables that both change: left columns, ``columns``, kind.

    Both sides are change streams with a kind, as ``current_stream`` gives them, whose rows
    are told apart by their ids. A change on either side takes back the pairs that no longer
    hold (``-D``) and adds the new ones (``+I``); a left row without a partner has one pair
    with nulls, also where its join key is null. A join key's left rows may be many: they are
    read through when its right side changes, as each of them then changes.
    """
    if how not in ("left", "inner"):
        raise ValueError("a changing join is left or inner")
    kind = left.schema[left_key].dataType
    data = [c for c in left.columns if c != KIND]

    def side(df: DataFrame, key: str, ids: Sequence[str], kept: Sequence[str], whats: Sequence[str]) -> DataFrame:
        holds = F.col(KIND).isin(*HOLDS)
        cast = df.withColumn("__k", F.col(key).cast(kind))
        text = [F.to_json(F.struct(*names), JSON_FORMATS) for names in (ids, kept)]
        named = cast.select(
            "__k", name_of(cast, ["__k"]).alias("name"), F.when(holds, whats[0]).otherwise(whats[1]).alias("what"),
            text[0].alias("id"), F.when(holds, text[1]).otherwise("").alias("row"),
        )
        # Only left rows are shown without a key.
        named = named if whats == LEFT else named.filter(F.col("__k").isNotNull())
        return named.select("name", F.concat_ws(FIELD, "name", "what", "id", "row").alias("line"))

    both = side(left, left_key, left_id, data, LEFT).unionByName(side(right, right_key, right_id, columns, RIGHT))
    schema = StructType().add("left", left.select(*data).schema).add("right", right.select(*columns).schema)
    rows = apply(both, Paired(how == "left"), schema.add("made", "boolean"))
    made = F.when(F.col("made"), F.lit(INSERT)).otherwise(F.lit(DELETE)).alias(KIND)
    return rows.select("left.*", *[F.col("right").getField(c).alias(c) for c in columns], made)
