"""Benchmark passages in training texts.

Words are runs of ASCII letters and digits and of all characters beyond ASCII, in lower
case. The windows of all items form a hash set that every task gets whole. A document's
words are numbered by the benchmark's vocabulary, rolling hashes over these numbers find
candidates, and every candidate is compared word by word before it counts.

The set is bounded: a benchmark of more than ``per_pass`` windows is cut into runs of
items, and the documents pass by each run in turn, carrying what was hit so far; results
are written between passes, so one run's windows are in memory at a time.

Defined cases: null and wordless texts and items have no windows; windows that several
items share count for each of them; an item id that occurs twice is one item with all its
texts; an item without an id has its words hit but isn't listed; an empty benchmark hits
nothing; rows of documents are judged one by one, so repeated rows and ids are no matter.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import pin

#: Words of a window, and windows in memory at a time (some 200 bytes each).
WINDOW, PER_PASS = 13, 2_000_000
#: What ends a word among the bytes of UTF-8 text; the bytes of other characters stay.
_BETWEEN = bytes([*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
_TO_SPACE = bytes.maketrans(_BETWEEN, b" " * len(_BETWEEN))
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xFF]+")
_BASE = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: bytes) -> list[bytes]:
    return text.lower().translate(_TO_SPACE).split()


def rolling(numbers: np.ndarray, width: int) -> np.ndarray:
    """A hash of every ``width`` neighbouring numbers."""
    n = len(numbers) - width + 1
    out = np.zeros(max(n, 0), dtype=np.uint64)
    for k in range(width if n > 0 else 0):
        out = out * _BASE + numbers[k : k + n]
    return out


class Windows:
    """The windows of some items: (item id, text) rows."""

    def __init__(self, items: list[tuple[str | None, bytes]], window: int = WINDOW):
        self.items: dict[tuple[bytes, ...], set[str | None]] = {}
        for item, text in items:
            words = words_of(text)
            for at in range(max(len(words) - window, 0) + 1 if words else 0):
                self.items.setdefault(tuple(words[at : at + window]), set()).add(item)
        vocabulary = sorted({word for key in self.items for word in key})
        self.numbers = {word: k + 1 for k, word in enumerate(vocabulary)}
        hashes: dict[int, list[np.ndarray]] = {}
        for key in self.items:
            hashes.setdefault(len(key), []).append(rolling(self._numbered(key), len(key)))
        self.hashes = {width: np.unique(np.concatenate(found)) for width, found in hashes.items()}

    def _numbered(self, words) -> np.ndarray:
        get = self.numbers.get
        return np.fromiter((get(w, 0) for w in words), dtype=np.uint64, count=len(words))

    def found_in(self, words: list[bytes], hit: np.ndarray) -> set[str | None]:
        """The items with windows in ``words``; their words are marked in ``hit``."""
        numbers, found = self._numbered(words), set()
        for width, hashes in self.hashes.items():
            rolled = rolling(numbers, width)
            place = np.minimum(np.searchsorted(hashes, rolled), len(hashes) - 1)
            for at in np.flatnonzero(hashes[place] == rolled).tolist():
                items = self.items.get(tuple(words[at : at + width]))
                if items:
                    hit[at : at + width] = True
                    found |= items
        return found


KIND = "n_words bigint, n_hit bigint, items array<string>, hit binary"
FOUND = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string())), ("hit", pa.binary())])


def _search(windows, text: Column, before: Column | None) -> Column:
    """KIND of a text, given what an earlier pass has found; ``hit`` has one bit per word."""

    def rows(texts: pa.Array, earlier: pa.Array | None) -> pa.Array:
        out = []
        for i, text in enumerate(texts):
            words = words_of(text.as_py() or b"")
            hit, items = np.zeros(len(words), dtype=bool), set()
            if earlier is not None:
                was = earlier[i].as_py()
                hit |= np.unpackbits(np.frombuffer(was["hit"], dtype=np.uint8), count=len(words)).astype(bool)
                items |= set(was["items"])
            items |= windows.value.found_in(words, hit)
            listed = sorted(x for x in items if x is not None)
            out.append({"n_words": len(words), "n_hit": int(hit.sum()), "items": listed, "hit": np.packbits(hit).tobytes()})
        return pa.array(out, type=FOUND)

    if before is None:

        @F.arrow_udf(KIND)
        def first(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for texts in batches:
                yield rows(texts, None)

        return first(text.cast("binary"))

    @F.arrow_udf(KIND)
    def later(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, earlier in batches:
            yield rows(texts, earlier)

    return later(text.cast("binary"), before)


def passes(benchmark: DataFrame, item_id: str, text: str, window: int, per_pass: int) -> Iterator[Windows]:
    """The benchmark's windows, at most ``per_pass`` at a time but for a longer single item.

    Items are read one by one from the partitions, in no particular order.
    """
    run, size = [], 0
    rows = benchmark.select(F.col(item_id).cast("string").alias("i"), F.col(text).cast("binary").alias("t"))
    for row in rows.toLocalIterator():
        data = bytes(row.t or b"")
        count = len(words_of(data))
        if not count:
            continue
        count = max(count - window, 0) + 1
        if run and size + count > per_pass:
            yield Windows(run, window)
            run, size = [], 0
        run.append((row.i, data))
        size += count
    yield Windows(run, window)


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    into: str = "contamination",
    window: int = WINDOW,
    per_pass: int = PER_PASS,
) -> DataFrame:
    """``docs`` with a struct ``into``: n_words, n_hit, items (found, as strings) and hit."""
    found = None
    for windows in passes(benchmark, item_id, item_text, window, per_pass):
        if found is not None:
            docs = pin(docs)
        shared = docs.sparkSession.sparkContext.broadcast(windows)
        docs = docs.withColumn(into, _search(shared, F.col(text), found))
        found = F.col(into)
    return docs


def contaminated(found: Column) -> Column:
    """Something is hit, and at least every twentieth word."""
    return (found["n_hit"] > 0) & (20 * found["n_hit"] >= found["n_words"])


def without_hits(text: Column, found: Column) -> Column:
    """The text without the spans from the first to the last word of each run of hit words."""

    @F.arrow_udf("string")
    def cut(texts: pa.Array, hits: pa.Array) -> pa.Array:
        out = []
        for text, hit in zip(texts.to_pylist(), hits.to_pylist()):
            if text is None or not any(hit or b""):
                out.append(None if text is None else text.decode())
                continue
            spans = [m.span() for m in _WORD.finditer(text)]
            bits = np.unpackbits(np.frombuffer(hit, dtype=np.uint8), count=len(spans))
            edges = np.flatnonzero(np.diff(np.concatenate([[0], bits, [0]])))
            kept, at = [], 0
            for begin, end in edges.reshape(-1, 2).tolist():
                kept.append(text[at : spans[begin][0]])
                at = spans[end - 1][1]
            out.append(b"".join([*kept, text[at:]]).decode())
        return pa.array(out, type=pa.string())

    return cut(text.cast("binary"), found["hit"])
