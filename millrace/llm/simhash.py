"""Near duplicates by SimHash: fingerprints that differ in few bits, linked into groups.

A fingerprint bit is 1 where it is 1 in over half of the hashes of a text's shingles. Equal
fingerprints are one node from the start, so exact copies never pair up.

Two fingerprints at most ``radius`` bits apart agree in two of ``radius + 2`` blocks of
bits at least. Every pair of blocks gives a key, and nodes meet under a key that they
share. The nodes of a key form a shard of bounded size with a BK-tree: children hang under
their parent by integer Hamming distance, and a search from a node at distance d follows
only the edges d - radius to d + radius. As only groups are wanted, a search also skips a
subtree whose nodes are all in the searcher's group already, so a dense cluster costs
little more than its size; each shard hands on at most one link per node.

A key with more than ``SHARD`` nodes is dealt to several shards by a hash. What may link
nodes of different shards is found in a second step: after the groups of the first are
known, nodes that are not in the key's largest group are sent to every other shard of the
key, and searched there in that shard's tree. A key whose nodes are one group needs none.

Groups are joined by alternating star contractions; each round is a table in the shared
folder, so a lost executor costs a task.

Defined cases: a null text is empty; an empty or wordless text has the fingerprint zero and
is linked like any other; a text of fewer words than a shingle is one shingle; documents
without an id keep fingerprint and group, but a group's id is the smallest id that it has,
null if it has none; rows that share an id are judged one by one.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from millrace.session import pin

WORDS, SEED, RADIUS = 4, 42, 4
#: Nodes in one tree.
SHARD = 4096
_SLICE = 1 << 16


def fingerprint_of(text: bytes, words: int = WORDS) -> int:
    """The fingerprint as a signed 64-bit number. The split is at ASCII white space."""
    tokens = text.lower().split()
    if not tokens:
        return 0
    if len(tokens) <= words:
        shingles = 1
    else:
        shingles = len(tokens) - words + 1
    joined, ends = b" ".join(tokens), np.cumsum([len(t) + 1 for t in tokens])
    begins = (ends - [len(t) + 1 for t in tokens])[:shingles].tolist()
    stops = (ends[min(words, len(tokens)) - 1 :] - 1).tolist()
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, shingles, _SLICE):
        span = slice(at, at + _SLICE)
        hashes = np.array([xxh64_intdigest(joined[a:b], SEED) for a, b in zip(begins[span], stops[span])], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(-1, 64)
        ones += bits.sum(axis=0, dtype=np.int64)
    majority = np.packbits(2 * ones > shingles, bitorder="little")
    return int(majority.view("<i8")[0])


def fingerprint(text: Column, words: int = WORDS) -> Column:
    """bigint, the fingerprint's bits."""

    @F.arrow_udf("bigint")
    def printed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([fingerprint_of(t.as_py() or b"", words) for t in batch], type=pa.int64())

    return printed(text.cast("binary"))


def hexadecimal(print_: Column) -> Column:
    return F.lower(F.lpad(F.hex(print_), 16, "0"))


class Groups:
    """Disjoint sets of numbers from 0."""

    def __init__(self):
        self.parent: list[int] = []

    def add(self) -> int:
        self.parent.append(len(self.parent))
        return len(self.parent) - 1

    def root(self, k: int) -> int:
        parent = self.parent
        while parent[k] != k:
            parent[k] = k = parent[parent[k]]
        return k

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        self.parent[max(a, b)] = min(a, b)
        return True


class BkTree:
    """A BK-tree over 64-bit prints. ``groups`` tells which members are known to be one."""

    def __init__(self, groups: Groups):
        self.groups = groups
        self.prints: list[int] = []
        self.member: list[int] = []
        self.children: list[dict[int, int]] = []
        #: A member of the one group that all of a subtree is in, or -1; holds for good.
        self.uniform: list[int] = []
        self.parents: list[int] = []

    def _same(self, a: int, b: int) -> bool:
        return a >= 0 and b >= 0 and self.groups.root(a) == self.groups.root(b)

    def insert(self, print_: int, member: int) -> None:
        new = len(self.prints)
        at, trail = 0, []
        while new:
            trail.append(at)
            edge = (self.prints[at] ^ print_).bit_count()
            child = self.children[at].get(edge)
            if child is None:
                self.children[at][edge] = new
                break
            at = child
        self.prints.append(print_)
        self.member.append(member)
        self.children.append({})
        self.uniform.append(member)
        for node in reversed(trail):
            if not self._same(self.uniform[node], member):
                self.uniform[node] = -1

    def settle(self) -> None:
        """Mark afresh the subtrees whose members have become one group."""
        for node in range(len(self.prints) - 1, -1, -1):  # children come after their parents
            mine = self.member[node]
            one = all(self._same(self.uniform[c], mine) for c in self.children[node].values())
            self.uniform[node] = mine if one else -1

    def search(self, print_: int, member: int, radius: int) -> Iterator[int]:
        """Members within the radius that are in other groups when they are met."""
        stack = [0] if self.prints else []
        while stack:
            node = stack.pop()
            if self._same(self.uniform[node], member):
                continue
            distance = (self.prints[node] ^ print_).bit_count()
            if distance <= radius and not self._same(self.member[node], member):
                yield self.member[node]
            for edge, child in self.children[node].items():
                if distance - radius <= edge <= distance + radius:
                    stack.append(child)


def _keys(print_: Column, radius: int) -> Column:
    """One number for every pair of ``radius + 2`` blocks: the pair's, then both blocks' bits."""
    edges = [round(64 * k / (radius + 2)) for k in range(radius + 3)]

    def bits(k: int) -> Column:
        mask = (1 << (edges[k + 1] - edges[k])) - 1
        return F.shiftrightunsigned(print_, edges[k]).bitwiseAND(F.lit(mask).cast("bigint"))

    def key(n: int, a: int, b: int) -> Column:
        width = edges[b + 1] - edges[b]
        both = F.shiftleft(bits(a), width).bitwiseOR(bits(b))
        return both.bitwiseOR(F.lit(n << 56).cast("bigint"))

    return F.array(*[key(n, a, b) for n, (a, b) in enumerate(combinations(range(radius + 2), 2))])


_LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
    """The rows of each (key, shard), from batches sorted by both."""
    rest = None
    for batch in batches:
        rows = batch.to_pandas()
        rows = rows if rest is None else pd.concat([rest, rows], ignore_index=True)
        ends = np.flatnonzero((np.diff(rows["key"]) != 0) | (np.diff(rows["shard"]) != 0)) + 1
        begin = 0
        for end in ends.tolist():
            yield rows.iloc[begin:end]
            begin = end
        rest = rows.iloc[begin:]
    if rest is not None and len(rest):
        yield rest


def _links_within(radius: int):
    """Searches each node of a shard in the tree of those before it."""

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = ([], [])
        for shard in _shards(batches):
            prints = [p & 0xFFFFFFFFFFFFFFFF for p in shard["print"].tolist()]
            groups = Groups()
            tree = BkTree(groups)
            for print_ in prints:
                me = groups.add()
                for other in tree.search(print_, me, radius):
                    if groups.join(me, other):
                        found[0].append(print_)
                        found[1].append(prints[other])
                tree.insert(print_, me)
                if me & (me + 1) == 0:
                    tree.settle()
            if len(found[0]) > 10_000:
                yield _batch(found)
                found = ([], [])
        yield _batch(found)

    return linked


def _links_across(radius: int):
    """Searches the strays of a key in the tree of each of its shards."""

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = ([], [])
        for shard in _shards(batches):
            groups, first = Groups(), {}
            prints = [p & 0xFFFFFFFFFFFFFFFF for p in shard["print"].tolist()]
            for root in shard["root"].tolist():
                me = groups.add()
                groups.join(me, first.setdefault(root, me))
            tree, home = BkTree(groups), shard["home"].tolist()
            for me, print_ in enumerate(prints):
                if home[me]:
                    tree.insert(print_, me)
            tree.settle()
            for me, print_ in enumerate(prints):
                if not home[me]:
                    for other in tree.search(print_, me, radius):
                        if groups.join(me, other):
                            found[0].append(print_)
                            found[1].append(prints[other])
            if len(found[0]) > 10_000:
                yield _batch(found)
                found = ([], [])
        yield _batch(found)

    return linked


def _batch(found: tuple[list[int], list[int]]) -> pa.RecordBatch:
    signed = [np.array(column, dtype=np.uint64).view(np.int64) for column in found]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in signed], schema=_LINKS)


def star_groups(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b); the root is the group's smallest node.

    Large and small star contractions in turn: every node links its larger neighbours, then
    its smaller ones, to the smallest that it knows, until nothing changes.
    """
    ordered = links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges, state = pin(ordered.distinct()), None
    while True:
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20)"))).first())
        if now == state:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        state = now
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = pin(large.where("a != b").distinct())
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.where("a != b").unionByName(least.select("a", F.col("m").alias("b")))
        edges = pin(small.distinct())


def linked_groups(nodes: DataFrame, radius: int = RADIUS, shard: int = SHARD) -> DataFrame:
    """(print, root) for distinct ``print``s; those without a neighbour are left out."""
    keyed = nodes.select("print", F.explode(_keys(F.col("print"), radius)).alias("key"))
    sizes = keyed.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    shards = F.ceil(F.col("size") / F.lit(shard))
    rows = keyed.join(sizes, "key").select(
        "key", "print", "size", F.when(F.col("size") > shard, F.pmod(F.xxhash64("print"), shards)).otherwise(0).cast("int").alias("shard")
    )
    rows = pin(rows)

    def dealt(rows: DataFrame) -> DataFrame:
        return rows.repartition("key", "shard").sortWithinPartitions("key", "shard", "print")

    links = pin(dealt(rows.select("key", "shard", "print")).mapInArrow(_links_within(radius), "a bigint, b bigint"))
    groups = star_groups(links)
    split = rows.where(F.col("size") > shard)
    if not split.head(1):
        return groups.withColumnRenamed("node", "print")
    groups = pin(groups)
    split = split.join(groups.withColumnRenamed("node", "print"), "print", "left")
    split = pin(split.withColumn("root", F.coalesce("root", "print")))
    counts = split.groupBy("key", "root").agg(F.count("*").alias("n"))
    # Keys whose nodes are one group by now are through.
    main = counts.groupBy("key").agg(F.max_by("root", F.struct("n", "root")).alias("main"), F.count("*").alias("groups"))
    open_ = split.join(main.where("groups > 1"), "key")
    strays = open_.where("root != main").select("key", "size", "print", "root", F.col("shard").alias("own"))
    strays = strays.select("*", F.explode(F.sequence(F.lit(0), (F.ceil(F.col("size") / F.lit(shard)) - 1).cast("int"))).alias("shard"))
    columns = ["key", "shard", "print", "root"]
    asked = open_.select(*columns, F.lit(True).alias("home")).unionByName(
        strays.where("shard != own").select(*columns, F.lit(False).alias("home"))
    )
    across = dealt(asked).mapInArrow(_links_across(radius), "a bigint, b bigint")
    known = groups.select(F.col("node").alias("a"), F.col("root").alias("b"))
    return star_groups(across.unionByName(known)).withColumnRenamed("node", "print")


def near_duplicates(prints: DataFrame, radius: int = RADIUS, shard: int = SHARD) -> DataFrame:
    """``prints`` (doc_id, print, anything else) with ``root`` and ``component_id``."""
    prints = pin(prints)
    nodes = prints.groupBy("print").agg(F.min("doc_id").alias("first_id"))
    nodes = pin(nodes)
    groups = linked_groups(nodes, radius, shard)
    known = nodes.join(groups, "print", "left").withColumn("root", F.coalesce("root", "print"))
    smallest = known.groupBy("root").agg(F.min("first_id").alias("component_id"))
    of_print = known.select("print", "root").join(smallest, "root")
    return prints.join(of_print, "print")


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """``docs`` with one row of each group: that of the smallest id, rows without one last.

    Of rows with the same id, the one with the smallest hash over all columns stays.
    """
    columns = [F.col(f"`{c}`") for c in docs.columns]
    id_, row = (next(n for k in range(len(columns) + 1) if (n := f"{name}_{k}") not in docs.columns) for name in ("id", "row"))
    marked = docs.withColumns({id_: F.coalesce(F.col(doc_id), F.lit((1 << 63) - 1)), row: F.xxhash64(*columns)})
    slim = marked.select(F.col(id_).alias("doc_id"), F.col(row).alias("row"), fingerprint(F.col(text), words).alias("print"))
    groups = near_duplicates(slim, radius)
    kept = groups.groupBy("root").agg(F.min(F.struct("doc_id", "row")).alias("k"))
    kept = kept.select(F.col("k.doc_id").alias(id_), F.col("k.row").alias(row)).distinct()
    return marked.join(kept, [id_, row], "left_semi").dropDuplicates([id_, row]).select(*columns)
