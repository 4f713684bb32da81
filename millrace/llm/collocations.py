"""Phrases whose words keep together, found by dynamic itemset counting.

The corpus is dealt into ``SHARDS`` shards, which are scanned in a circle, one per stop.
Words are counted from the first stop. A longer phrase is counted from the stop after the
one at which both its parts without the last and without the first word have reached the
threshold, whatever lengths are under way, and until it has seen every shard once. Its
count is then exact: no phrase is more frequent than its parts, so none that reaches the
threshold is missed. Counting ends one circle after the last part has reached it.

Until then phrases go by 62 bits of a hash and two for their length, which halves what is
shuffled: phrases that share them are counted together, so a count is never too low and no
phrase is lost. The phrases that remain are then counted once more by their words, which
makes all counts exact. A phrase that reaches the threshold has its ``SHARDS``-th part of it
in some shard; only such phrases are followed from stop to stop, with what the scans of the
circle hold of them, so the many rare phrases are not handled again. Parts and followed
phrases are looked up in bitmaps of up to ``2 ** BITS`` bits, gathered on the executors, so what
is broadcast is bounded; false hits add counts that are true.

The counts of a scan are shuffled and kept by ranges of the hash, as one row with the hashes
in order and their counts for each range; there are the more ranges the more text there is.
Words are split and numbered a stretch of text at a time. A task gives its counts when it has
``ROWS`` different ones, however often each occurs. A longer phrase is looked up only where
both its parts are marked, in the last pass too.

Defined cases: a null text is empty, a null language is ``und`` and shares its counts with
that word itself; repeated rows count each; an empty table has no phrases. Texts of any
length are cut into sections of ``SECTION`` bytes at a space or separator, with the words
before a cut carried along. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.session import pin, scratch

SHARDS, LONGEST, LEAST = 3, 4, 30
BITS = 26
SECTION, TOKENS, WORDS, ROWS = 1 << 20, 1 << 19, 1 << 20, 1 << 22
#: Texts of so many languages may wait until they are counted, if each has ``TOKENS`` words.
LANGUAGES = 8
#: Bytes of text for each range of hashes whose counts are one row.
BLOCK = 8 << 20
#: Bytes of text that a task should count at least, as phrases then meet again within it.
TASK = 128 << 20
#: A phrase goes for a longer one that holds it at this many hundredths of its occurrences.
SHARE = 80
SCALE = 2_000_000
_SEPARATORS = b".,;:!?\n\x0b\x0c\r"
_PLAIN = bytes.maketrans(_SEPARATORS + b"\t", b"\n" * len(_SEPARATORS) + b" ")
_STEP, _STIR = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_LENGTHS = np.uint64(3)


def _longer(codes: np.ndarray, following: np.ndarray) -> np.ndarray:
    """Codes of sequences with one more word at their end."""
    return (codes * _STEP) ^ (following + (codes >> np.uint64(29)))


def _hashed(codes: np.ndarray, lang: str, size: int) -> np.ndarray:
    """The hash of phrases, whose last two bits are their length."""
    mixed = (codes ^ np.uint64(xxhash.xxh64_intdigest(lang.encode()))) * _STIR
    return (mixed & ~_LENGTHS) | np.uint64(size - 1)


class _Bitmap:
    """Which hashes may be among the marked ones."""

    def __init__(self, words: np.ndarray) -> None:
        self.words = words
        self.shift = np.uint64(64 - 6 - (len(words) - 1).bit_length())

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        slot = hashes >> self.shift
        return (self.words[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1) != 0


def _united(marks: list[np.ndarray | None]) -> _Bitmap | None:
    found = [m for m in marks if m is not None]
    return _Bitmap(reduce(np.bitwise_or, found)) if found else None


class _Vocabulary(dict):
    """Numbers of words, in the order of their first appearance."""

    def __init__(self) -> None:
        super().__init__()
        self.words: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self.words)
        self.words.append(word)
        return number


def _summed(first: np.ndarray, second: np.ndarray | None, n: np.ndarray | None) -> tuple[np.ndarray, np.ndarray | None, np.ndarray]:
    """Distinct keys in order, with the sums of ``n``, or how often each is there."""
    if second is None and n is None:
        first, n = np.unique(first, return_counts=True)
        return first, None, n
    order = np.argsort(first) if second is None else np.lexsort((second, first))
    first, n = first[order], np.ones(len(order), np.int64) if n is None else n[order]
    new = first[1:] != first[:-1]
    if second is not None:
        second = second[order]
        new |= second[1:] != second[:-1]
    at = np.flatnonzero(np.r_[True, new]) if len(first) else np.zeros(0, np.int64)
    return first[at], None if second is None else second[at], np.add.reduceat(n, at) if len(at) else n


class _Grouped:
    """Occurrences by one or two 64-bit keys; those that were merged are counted and in order."""

    def __init__(self) -> None:
        self.counted: tuple[np.ndarray, np.ndarray | None, np.ndarray] | None = None
        self.parts: list[tuple[np.ndarray, np.ndarray | None, np.ndarray | None]] = []
        self.size = 0

    def add(self, first: np.ndarray, second: np.ndarray | None = None, n: np.ndarray | None = None) -> None:
        """Each with its ``n``, or all once; the same way in all calls."""
        self.parts.append((first, second, n))
        self.size += len(first)

    def merged(self) -> tuple[np.ndarray, np.ndarray | None, np.ndarray]:
        if self.parts:
            added = _summed(*[None if column[0] is None else np.concatenate(column) for column in zip(*self.parts)])
            self.parts = []
            self.counted = added if self.counted is None else self._with(*added)
            self.size = len(self.counted[0])
        return self.counted

    def _with(self, first: np.ndarray, second: np.ndarray | None, n: np.ndarray) -> tuple[np.ndarray, np.ndarray | None, np.ndarray]:
        old, other, counts = self.counted
        if second is not None:
            return _summed(np.r_[old, first], np.r_[other, second], np.r_[counts, n])
        at = np.searchsorted(old, first)
        known = old[np.minimum(at, len(old) - 1)] == first
        counts[at[known]] += n[known]
        at = at[~known]
        return np.insert(old, at, first[~known]), None, np.insert(counts, at, n[~known])


class _Tally:
    """Counts of one task, by hash; or by words of the ``chosen`` phrases only."""

    def __init__(self, words: bool, every: _Bitmap | None, recent: _Bitmap | None, chosen: _Bitmap | None) -> None:
        self.count_words, self.every, self.recent, self.chosen = words, every, recent, chosen
        # By language: texts that wait to be counted together, and about how many words they have.
        self.waiting: dict[str, list[bytes]] = {}
        self.sizes: dict[str, int] = {}
        self.clear()

    def clear(self) -> None:
        self.vocabulary = _Vocabulary()
        self.single, self.hashes = _Grouped(), _Grouped()
        self.several: dict[tuple[str, int], _Grouped] = {}

    def add(self, lang: str, text: bytes) -> None:
        text = text.lower().translate(_PLAIN)
        if len(text) <= SECTION:
            self._wait(lang, text)
            return
        at, last = 0, []
        while at < len(text):
            end = at + SECTION
            cuts = [p for p in (text.find(b" ", end), text.find(b"\n", end)) if p >= 0]
            end = min(cuts, default=len(text))
            section = text[at:end]
            self._count(lang, b" ".join([*last, section]), len(last))
            words = section.replace(b"\n", b" \n ").split(b" ")
            last = [*last, *[w for w in words if w]][-LONGEST + 1 :]
            at = end

    def _wait(self, lang: str, text: bytes) -> None:
        self.waiting.setdefault(lang, []).append(text)
        self.sizes[lang] = self.sizes.get(lang, 0) + text.count(b" ") + text.count(b"\n") + 1
        if self.sizes[lang] >= TOKENS:
            self._take(lang)
        elif len(self.sizes) > 1 and sum(self.sizes.values()) >= LANGUAGES * TOKENS:
            self._end()

    def _take(self, lang: str) -> None:
        self.sizes.pop(lang)
        self._count(lang, b"\n".join(self.waiting.pop(lang)), 0)

    def _count(self, lang: str, text: bytes, old: int) -> None:
        """Sequences whose last word stands at ``old`` or behind it."""
        tokens = pc.split_pattern(pa.array([text.replace(b"\n", b" \n ")], pa.binary()), b" ").flatten().dictionary_encode()
        words, numbers = tokens.dictionary.to_numpy(zero_copy_only=False).tolist(), tokens.indices.to_numpy()
        gap, stop = (pc.index(tokens.dictionary, pa.scalar(w, pa.binary())).as_py() for w in (b"", b"\n"))
        if gap >= 0:
            numbers = numbers[numbers != gap]
        # A break takes the code of any word; it is no part of a sequence.
        whole = np.ones(len(words), bool)
        whole[[w for w in (gap, stop) if w >= 0]] = False
        coded = np.array([xxhash.xxh64_intdigest(w) for w in words], np.uint64)
        hashes = _hashed(coded, lang, 1)
        found = np.bincount(numbers[old:], minlength=len(words))
        if self.count_words:
            some = np.flatnonzero(whole & (found > 0))
            self.single.add(hashes[some], n=found[some])
        marks = self.chosen or self.every
        if marks is None or not self.chosen and self.recent is None:
            return
        among = whole & marks.holds(hashes)
        if self.chosen:
            some = np.flatnonzero(among)
            names = np.zeros(len(words), np.int64)
            names[some] = [self.vocabulary[words[i]] for i in some.tolist()]
            some = some[found[some] > 0]
            self._chosen(lang, 1).add(names[some] << 32, n=found[some])
            names, late = names[numbers], None
        else:
            late = self.recent.holds(hashes)[numbers]
        hit, single = among[numbers], coded[numbers]
        codes = single
        for size in range(2, LONGEST + 1):
            n = len(numbers) - size + 1
            if n <= 0:
                return
            # No sequence is looked up whose parts are not among the marked ones.
            at = np.flatnonzero(hit[:n] & hit[1 : n + 1])
            longer = _longer(codes[at], single[at + size - 1])
            hashes = _hashed(longer, lang, size)
            held, fresh = marks.holds(hashes), at >= old - size + 1
            if self.chosen:
                some = at[held & fresh]
                named = [names[some + i] if i < size else np.zeros(len(some), np.int64) for i in range(LONGEST)]
                self._chosen(lang, size).add((named[0] << 32) | named[1], (named[2] << 32) | named[3] if size > 2 else None)
            else:
                self.hashes.add(hashes[fresh & (late[at] | late[at + 1])])
                late = np.zeros(n, bool)
                late[at] = self.recent.holds(hashes)
            hit, codes = np.zeros(n, bool), np.zeros(n, np.uint64)
            hit[at], codes[at] = held, longer

    def _chosen(self, lang: str, size: int) -> _Grouped:
        return self.several.setdefault((lang, size), _Grouped())

    def full(self) -> bool:
        """Whether there are many different ones, which is seen only when they are merged."""
        groups = [self.single, self.hashes, *self.several.values()]
        if len(self.vocabulary) <= WORDS and sum(g.size for g in groups) <= 2 * ROWS:
            return False
        for group in groups:
            group.merged()
        return len(self.vocabulary) > WORDS or sum(g.size for g in groups) > ROWS

    def hashed(self, blocks: int) -> Iterator[pa.RecordBatch]:
        """All counts by hash so far, in blocks; the tally is empty afterwards."""
        self._end()
        for group in (self.single, self.hashes):
            if group.size:
                hashes, _, n = group.merged()
                yield from _blocks(hashes, n, blocks)
        self.clear()

    def exact(self) -> Iterator[pa.RecordBatch]:
        """All counts by words so far; the tally is empty afterwards."""
        self._end()
        words, low = pa.array(self.vocabulary.words, pa.binary()).cast(pa.string()), (1 << 32) - 1
        for (lang, size), group in self.several.items():
            if not group.size:
                continue
            first, second, n = group.merged()
            numbers = [first >> 32, first & low, *([] if second is None else [second >> 32, second & low])][:size]
            for at in range(0, len(n), 10_000):
                span = slice(at, at + 10_000)
                texts = pc.binary_join_element_wise(*[words.take(pa.array(x[span])) for x in numbers], " ")
                columns = [pa.array([lang] * len(texts)), pa.array([size] * len(texts), pa.int32()), texts]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(n[span], pa.int64())], ["lang", "words", "phrase", "f"])
        self.clear()

    def _end(self) -> None:
        for lang in list(self.waiting):
            self._take(lang)


_BLOCKS = pa.schema([("block", pa.int32()), ("hashes", pa.binary()), ("counts", pa.binary())])


def _blocks(hashes: np.ndarray, n: np.ndarray, blocks: int) -> Iterator[pa.RecordBatch]:
    """Counts of hashes in order, a row for each of so many equal ranges that has any."""
    block = (hashes >> np.uint64(64 - blocks.bit_length() + 1)).astype(np.int32) if blocks > 1 else np.zeros(len(hashes), np.int32)
    starts = np.flatnonzero(np.r_[True, block[1:] != block[:-1]])
    for at, end in zip(starts, [*starts[1:], len(hashes)]):
        row = {"block": int(block[at]), "hashes": hashes[at:end].tobytes(), "counts": n[at:end].astype(np.int64).tobytes()}
        yield pa.RecordBatch.from_pylist([row], _BLOCKS)


def _unpacked(batch: pa.RecordBatch | pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for hashes, counts in zip(batch.column("hashes"), batch.column("counts")):
        yield np.frombuffer(hashes.as_buffer(), np.uint64), np.frombuffer(counts.as_buffer(), np.int64)


def _tallied(corpus: DataFrame, blocks: int | None, options: Broadcast) -> DataFrame:
    """What the tallies of the tasks give, flushed where they get large; by words without ``blocks``."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = _Tally(*options.value)
        flushed = (lambda: tally.hashed(blocks)) if blocks else tally.exact
        for batch in batches:
            for lang, text in zip(batch.column("lang"), batch.column("text")):
                tally.add(lang.as_py(), text.as_py())
                if tally.full():
                    yield from flushed()
        yield from flushed()

    return corpus.mapInArrow(counted, "block int, hashes binary, counts binary" if blocks else "lang string, words int, phrase string, f bigint")


def _combined(tallies: DataFrame) -> DataFrame:
    """One row a block: its hashes in order, with their counts."""

    def summed(table: pa.Table) -> pa.Table:
        hashes, counts = (np.concatenate(column) for column in zip(*_unpacked(table)))
        hashes, _, n = _summed(hashes, None, counts)
        row = {"block": table.column("block")[0].as_py(), "hashes": hashes.tobytes(), "counts": n.tobytes()}
        return pa.Table.from_pylist([row], _BLOCKS)

    return tallies.groupBy("block").applyInArrow(summed, tallies.schema)


def _heavy(scan: DataFrame, few: int, bits: int) -> DataFrame:
    """(at, mark): bits of the hashes that are counted ``few`` times or more."""

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for hashes, n in _unpacked(batch):
                slot = hashes[n >= few] >> np.uint64(64 - bits)
                word = slot >> np.uint64(6)
                starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]]) if len(word) else []
                if len(starts):
                    mark = np.bitwise_or.reduceat(np.uint64(1) << (slot & np.uint64(63)), starts)
                    columns = [pa.array(x.view(np.int64)) for x in (word[starts], mark)]
                    yield pa.RecordBatch.from_arrays(columns, ["at", "mark"])

    return scan.mapInArrow(marked, "at bigint, mark bigint")


def _marks(rows: DataFrame, bits: int) -> DataFrame:
    """(at, mark): the bits of some hashes."""
    slot = F.expr(f"shiftrightunsigned(h, {64 - bits})")
    return rows.select(slot.alias("slot")).select(F.expr("slot >> 6").alias("at"), F.expr("shiftleft(1L, int(slot & 63))").alias("mark"))


def _gathered(marks: DataFrame, bits: int) -> np.ndarray | None:
    """All bits, united on the executors: at most ``2 ** bits / 64`` numbers."""
    found = marks.groupBy("at").agg(F.bit_or("mark").alias("mark")).toArrow()
    if not len(found):
        return None
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[found["at"].to_numpy()] = found["mark"].to_numpy().view(np.uint64)
    return out


def _among(scan: DataFrame, marks: Broadcast) -> DataFrame:
    """(h, f): the counts of hashes that may be among the marked ones."""

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for hashes, n in _unpacked(batch):
                some = marks.value.holds(hashes)
                columns = [pa.array(hashes[some].view(np.int64)), pa.array(n[some])]
                yield pa.RecordBatch.from_arrays(columns, ["h", "f"])

    return scan.mapInArrow(kept, "h bigint, f bigint")


def _hashable(docs: DataFrame) -> list[str]:
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    return [f"`{name}`" for name, kind in kinds.items() if "map<" not in kind and "variant" not in kind]


def frequent_phrases(
    docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, shards: int = SHARDS, bits: int = BITS
) -> DataFrame:
    """(lang, words, phrase, f): phrases of up to ``LONGEST`` words with ``f >= least``, exactly counted."""
    spark, folder = docs.sparkSession, scratch(docs.sparkSession)
    given = docs.select(
        F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"),
        # Copies of a text are spread by the other columns.
        F.pmod(F.xxhash64(*_hashable(docs)), F.lit(shards)).cast("int").alias("shard"),
    )
    given.write.mode("append").partitionBy("shard").parquet(folder)
    corpus = spark.read.schema("lang string, text binary, shard int").parquet(folder)

    bytes_ = corpus.agg(F.sum(F.length("text"))).first()[0] or 0
    parallel = spark.sparkContext.defaultParallelism

    def dealt(rows: DataFrame, share: int) -> DataFrame:
        """Neighbouring files in one task, unless tasks would stand idle."""
        return rows.coalesce(max(parallel, -(-bytes_ // (share * TASK))))

    few = -(-least // shards)
    blocks = 1 << max(6, (bytes_ // BLOCK).bit_length())
    bits = min(bits, max(20, (bytes_ // 16).bit_length()))
    sent: list[Broadcast] = []

    def shared(value) -> Broadcast:
        sent.append(spark.sparkContext.broadcast(value))
        return sent[-1]

    counts = [f"c{shard}" for shard in range(shards)]
    scans: list[DataFrame] = []
    # By stop: marks of the parts that reached the threshold, and of the phrases followed from then on.
    parts, followed = [], []
    state, last, stop = None, shards - 1, 0
    while stop <= last:
        shard = dealt(corpus.where(F.col("shard") == stop % shards).select("lang", "text"), shards)
        every = _united(parts)
        recent = every if len(parts) <= shards else _united(parts[-shards:])
        found = _tallied(shard, blocks, shared((stop < shards, every, recent, None)))
        scans.append(pin(_combined(found)))
        new = _gathered(_heavy(scans[stop], few, bits), bits)
        followed.append(new)
        rows = [] if state is None else [state]
        if known := _united(followed):
            rows.append(_at(_among(scans[stop], shared(known)), stop % shards, counts))
        if fresh := _united([new]):
            marks = shared(fresh)
            rows += [_at(_among(scans[s], marks), s % shards, counts) for s in range(max(0, stop - shards + 1), stop)]
        if rows:
            totals = reduce(DataFrame.unionByName, rows).groupBy("h").agg(
                *[F.max(c).alias(c) for c in counts], F.max("reached").alias("reached")
            )
            # False hits of the bitmap go; what turns out heavy later is fetched from the scans then.
            totals = totals.where(F.array_max(F.array(*counts)) >= few)
            f = sum((F.col(c) for c in counts), F.lit(0).cast("bigint"))
            state = pin(totals.withColumn("reached", F.coalesce("reached", F.when(f >= least, F.lit(stop)))))
            part = (F.col("reached") == stop) & (F.col("h").bitwiseAND(F.lit(3)) < LONGEST - 1)
            parts.append(_gathered(_marks(state.where(part), bits), bits))
        else:
            parts.append(None)
        if parts[stop] is not None:
            last = max(last, stop + shards)
        # All that reads them is pinned.
        while sent:
            sent.pop().destroy()
        stop += 1
    chosen = None if state is None else _gathered(_marks(state.where(F.col("reached").isNotNull()), bits), bits)
    if chosen is None:
        return spark.createDataFrame([], "lang string, words int, phrase string, f bigint")
    exact = _tallied(dealt(corpus.select("lang", "text"), 1), None, shared((False, None, None, _Bitmap(chosen))))
    return exact.groupBy("lang", "words", "phrase").agg(F.sum("f").alias("f")).where(F.col("f") >= least)


def _at(rows: DataFrame, shard: int, counts: list[str]) -> DataFrame:
    """The counts of a scan in the column of its shard."""
    none = F.lit(0).cast("bigint")
    columns = [(F.col("f") if at == shard else none).alias(c) for at, c in enumerate(counts)]
    return rows.select("h", *columns, F.lit(None).cast("int").alias("reached"))


def word_totals(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, n): all word occurrences of each language, counted in each task first."""
    given = docs.select(
        F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"),
        F.size(F.split(F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"[^ \t.,;:!?\x0A-\x0D]+", "\x01"), "\x01")).alias("n"),
    )
    return given.groupBy("lang").agg(F.sum(F.col("n") - 1).cast("bigint").alias("n"))


def _wide(column: str) -> Column:
    return F.col(column).cast("decimal(38,0)")


def scored(frequent: DataFrame) -> DataFrame:
    """Phrases of two and more words with their lowest cut: lang, words, phrase, a, l, r, score."""
    phrases = frequent.where("words > 1").withColumnRenamed("f", "a")
    cuts = phrases.select("*", F.explode(F.expr("sequence(1, words - 1)")).alias("k")).select(
        "*",
        F.expr("substring_index(phrase, ' ', k)").alias("first"),
        F.expr("substring(phrase, length(substring_index(phrase, ' ', k)) + 2)").alias("rest"),
    )
    for name, at in (("first", "l"), ("rest", "r")):
        part = frequent.select("lang", F.col("phrase").alias(name), F.col("f").alias(at))
        cuts = cuts.join(part, ["lang", name]).drop(name)
    wide = cuts.withColumns({"wide_a": _wide("a"), "both": _wide("l") + _wide("r")})
    score = F.expr(f"CAST({SCALE} AS DECIMAL(8,0)) * CAST(wide_a AS DECIMAL(29,0)) div both")
    lowest = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    return wide.groupBy("lang", "words", "phrase", "a").agg(lowest).select("lang", "words", "phrase", "a", "cut.l", "cut.r", "cut.score")


def covered(frequent: DataFrame) -> DataFrame:
    """(lang, phrase, longest): phrases inside longer ones, with the count of the most frequent of these."""
    inner = F.expr(
        """flatten(transform(sequence(2, words - 1), k ->
             transform(sequence(1, words - k + 1), i -> array_join(slice(split(phrase, ' '), i, k), ' '))))"""
    )
    longer = frequent.where("words > 2").select("lang", F.explode(F.array_distinct(inner)).alias("phrase"), "f")
    return longer.groupBy("lang", "phrase").agg(F.max("f").alias("longest"))


def collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, top: int = 2000, shards: int = SHARDS
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's ``top`` phrases that no longer one stands for."""
    frequent = pin(frequent_phrases(docs, text, lang, least, shards))
    found = scored(frequent).join(covered(frequent), ["lang", "phrase"], "left")
    inside = 100 * _wide("longest") >= SHARE * _wide("a")
    kept = found.where(F.col("longest").isNull() | ~inside)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order).cast("bigint")).where(F.col("rank") <= top)
    return ranked.join(word_totals(docs, text, lang), "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
