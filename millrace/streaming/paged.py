"""Keyed state for many keys at little cost each: keys share buckets, their entries share pages.

A call to the state store, and a group of rows handed to the Python worker, cost as much as
hundreds of rows. So the keys are dealt by their hash to a fixed number of buckets, which are
what Spark groups by; the rows of a bucket come as lines of a few long texts, and its state is
texts as well, each with the entries of some hundred keys. A bucket gets more of them as
it grows, so a micro-batch reads and writes the pages of the keys it touches, however many
there are. Names and values of entries are JSON, which never has a control character as such: these
part lines and the fields in them.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Collection, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessorHandle
from pyspark.sql.types import DoubleType, FloatType, StructType, TimestampType

from millrace.operators.ordered import JSON_FORMATS
from millrace.streaming.keyed import Keyed

#: Buckets that keys are dealt to; streams that go on from a checkpoint need the number they began with.
BUCKETS = 2048
#: Entries that a page should have at most.
ENTRIES = 1024
#: Bytes that a task deals to buckets at once, and those of a text after which another one begins.
HELD_BYTES, TEXT_BYTES = 16 << 20, 32 << 10
#: Result lines of a row.
LINES = 1000

FIELD, PART, LINE = "\t", "\v", "\n"


def name_of(df: DataFrame, keys: Sequence[str]) -> Column:
    """Text that tells keys apart as a grouping does: nulls are alike, and so are both zeros."""

    def plain(name: str) -> Column:
        kind = df.schema[name].dataType
        if isinstance(kind, TimestampType):
            return F.unix_micros(name)
        if isinstance(kind, (DoubleType, FloatType)):
            return F.col(name) + F.lit(0).cast(kind)
        return F.col(name)

    return F.to_json(F.struct(*[plain(k).alias(f"k{i}") for i, k in enumerate(keys)]), JSON_FORMATS)


def _packed(batches: Sequence[pa.RecordBatch]) -> pa.RecordBatch:
    table = pa.Table.from_batches(batches).combine_chunks()
    buckets = table["bucket"].to_numpy()
    order = np.argsort(buckets, kind="stable")
    buckets, lines = buckets[order], table["line"].chunk(0).take(pa.array(order))
    before = np.append(0, np.cumsum(pc.binary_length(lines).to_numpy().astype(np.int64)))[:-1]
    starts = np.flatnonzero(np.diff(buckets, prepend=-1).astype(bool) | np.diff(before // TEXT_BYTES, prepend=0).astype(bool))
    texts = pa.ListArray.from_arrays(pa.array(np.append(starts, len(buckets)), pa.int32()), lines)
    return pa.RecordBatch.from_arrays([pa.array(buckets[starts]), pc.binary_join(texts, LINE)], names=["bucket", "lines"])


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += batch.nbytes
        if size >= HELD_BYTES:
            yield _packed(held)
            held, size = [], 0
    if held:
        yield _packed(held)


def apply(rows: DataFrame, processor: Bucketed, schema: StructType) -> DataFrame:
    """Run ``processor`` on the buckets of ``rows``, which are a name to deal by and a line; its results parsed."""
    bucket = F.pmod(F.xxhash64("name"), F.lit(BUCKETS)).cast("int").alias("bucket")
    texts = rows.select(bucket, "line").mapInArrow(_pack, "bucket int, lines string")
    found = texts.groupBy("bucket").transformWithState(processor, "lines string", "append", "none")
    lines = found.select(F.explode(F.split("lines", LINE)).alias("line"))
    return lines.select(F.from_json("line", schema, JSON_FORMATS).alias("found")).select("found.*")


class Bucketed(Keyed):
    """A processor of lines, whose results are lines of JSON."""

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        out: list[str] = []
        for line in self.handle_lines(line.split(FIELD) for row in rows for line in row.lines.split(LINE)):
            out.append(line)
            if len(out) == LINES:
                yield Row(lines=LINE.join(out))
                out = []
        if out:
            yield Row(lines=LINE.join(out))

    def handle_lines(self, lines: Iterator[list[str]]) -> Iterator[str]:
        """Results of the bucket's lines, given by their fields."""
        raise NotImplementedError


class Pages:
    """The entries of a bucket, value by name, on pages that double in number as they fill."""

    def __init__(self, handle: StatefulProcessorHandle, name: str) -> None:
        self.number = handle.getValueState(f"{name}_pages", "n bigint")
        self.texts = handle.getMapState(name, "page bigint", "text string")

    def touched(self, names: Collection[str], *, all_pages: bool = False) -> Iterator[tuple[dict[str, str], list[str]]]:
        """The pages that have ``names``, or all, each with those of its own.

        What the caller changes of a page's entries before it takes the next one is kept.
        """
        known = self.number.get()
        number = known[0] if known else _enough(1, 2 * len(names))
        dealt = _dealt(names, number)
        most = 0
        for page in range(number) if all_pages else dealt:
            entries = self._read(page) if known else {}
            before = dict(entries)
            yield entries, dealt.get(page, [])
            if entries != before:
                self._write(page, entries)
            most = max(most, len(entries))
        if most and not known:
            self.number.update((number,))
        if most > ENTRIES:
            self._split(number, _enough(number, 2 * number * most))

    def _split(self, number: int, more: int) -> None:
        """Page ``i`` goes to pages ``i``, ``i + number``, ``i + 2 * number`` and so on."""
        for page in range(number):
            entries = self._read(page)
            for part, names in ({page: []} | _dealt(entries, more)).items():
                self._write(part, {n: entries[n] for n in names})
        self.number.update((more,))

    def _read(self, page: int) -> dict[str, str]:
        found = self.texts.getValue((page,))
        return dict(line.split(FIELD, 1) for line in found[0].split(LINE)) if found else {}

    def _write(self, page: int, entries: dict[str, str]) -> None:
        if entries:
            self.texts.updateValue((page,), (LINE.join([f"{n}{FIELD}{v}" for n, v in entries.items()]),))
        else:
            self.texts.removeKey((page,))


def _enough(number: int, entries: int) -> int:
    """``number``, doubled until ``entries`` fit into as many pages."""
    while entries > number * ENTRIES:
        number *= 2
    return number


def _dealt(names: Collection[str], number: int) -> dict[int, list[str]]:
    if number == 1:
        return {0: list(names)} if names else {}
    dealt = defaultdict(list)
    for name in names:
        dealt[zlib.crc32(name.encode()) & (number - 1)].append(name)
    return dealt
