"""Repair of conversations at the least cost, over a word graph that shares suffixes.

A row is one letter: the class of its role (system, user, assistant, other, by its initial)
and its first fault (blank, a duplicate of role and text, cut short). A conversation is the
word of its letters, and a node of the graph is a suffix of such words. What it costs to
bring a suffix into the form ``(s?(ua)+)?`` depends on the suffix and on the state of that
grammar alone, so cost-to-go and best edits are computed once per node and state: words are
sorted from their end, a task walks its range of them, and the nodes that the next word
shares with the last one are on the path already. Neighbouring ranges share one path at
most. Equal words of many conversations fall into several ranges.

Edits are Keep, Rerole, Delete and Insert. Of equally cheap ones those with the least text
are taken; as each choice in a state begins with another letter, this is decided at the node.

Conversations are cut into parts of ``PART`` rows. For one of several parts the least costs
from state to state (16 numbers) give the costs behind each part, which then stand for the
end of a word; so a conversation of any length is spread over many tasks. Rows are numbered
by ``Ordered``, which cuts large conversations as well, and the first row of equal ones is
found by a grouped minimum. A digest over a whole conversation needs its rows in order: one
task streams them, holding the edits (a character each) and one batch of rows.

Defined cases: rows of one conversation are in the order of turn (nulls first), role and
text; a null conversation is one of its own; null roles and texts must have been replaced;
a role without text, or of another initial, has to be changed or deleted; an empty table has
no conversations. Texts of any length pass the tasks in batches. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

from millrace.operators.ordered import Ordered
from millrace.session import pin

PART = 2048
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
CHANGE_COST, DELETE_COST, CUT_COST = 3, 4, 3
#: States of the grammar: nothing yet, behind the system row, behind a user, behind an assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
#: The state behind a kept row, by its class and the state before it.
_KEPT = {("s", START): SYSTEM, ("a", USER): ASSISTANT} | {("u", s): USER for s in (START, SYSTEM, ASSISTANT)}
#: The state behind a row of the role that the grammar wants next; never a system row.
_WANTED = (USER, USER, ASSISTANT, USER)
_ROLES = {USER: "user", ASSISTANT: "assistant"}
_FAR = 1 << 40
_CLASSES, _FAULTS = "suax", ("", "blank", "duplicate", "truncated")
#: A letter for each class and fault, in this order: s, s blank, s duplicate, s truncated, u, ...
_LETTERS = "abcdefghijklmnop"
#: Rows that must go are all alike to the repair.
_ALIKE = str.maketrans({c: "z" for i, c in enumerate(_LETTERS) if _FAULTS[i % 4] in ("blank", "duplicate")})
_LEGAL = {"su", "ua", "au"}
_SPACE = " \t\n\x0b\x0c\r"


@dataclass(frozen=True)
class Node:
    """By state before a suffix: least cost, its edits, and the state behind them."""

    cost: tuple[int, ...]
    edits: tuple[str, ...]
    end: tuple[int, ...]


def terminal(costs: tuple[int, ...] | None) -> Node:
    """The end of a conversation, or of a part that has ``costs`` behind it."""
    if costs is None:
        return Node((0, 2 * CHANGE_COST, CHANGE_COST, 0), ("", INSERT * 2, INSERT, ""), (START, ASSISTANT, ASSISTANT, ASSISTANT))
    return Node(tuple(costs), ("",) * 4, (START, SYSTEM, USER, ASSISTANT))


def before(letter: str, node: Node) -> Node:
    """The node of a suffix with one more letter in front."""

    def over(price: int, edit: str, state: int) -> tuple[int, str, int]:
        return price + node.cost[state], edit + node.edits[state], node.end[state]

    found = [[over(DELETE_COST, DELETE, s)] for s in range(4)]
    if letter != "z":
        at = _LETTERS.index(letter)
        cut = CUT_COST if _FAULTS[at % 4] == "truncated" else 0
        for s in range(4):
            found[s].append(over(cut + CHANGE_COST, REROLE, _WANTED[s]))
            kept = _KEPT.get((_CLASSES[at // 4], s))
            if kept is not None:
                found[s].append(over(cut, KEEP, kept))
    best = [min(options) for options in found]

    def inserted(state: int) -> tuple[int, str, int]:
        cost, edits, end = best[_WANTED[state]]
        return cost + CHANGE_COST, INSERT + edits, end

    best[USER], best[ASSISTANT] = min(best[USER], inserted(USER)), min(best[ASSISTANT], inserted(ASSISTANT))
    for state in (START, SYSTEM):
        best[state] = min(best[state], inserted(state))
    return Node(*zip(*best))


class Path:
    """The nodes from the end of the last word to its beginning."""

    def __init__(self) -> None:
        self.tail, self.word, self.nodes, self.made = "", "", [terminal(None)], 0

    def node(self, tail: str, word: str) -> Node:
        """The node of a word, given from its end, behind which the costs of ``tail`` wait."""
        if tail != self.tail:
            costs = tuple(map(int, tail.split(","))) if tail else None
            self.tail, self.word, self.nodes = tail, "", [terminal(costs)]
        shared = 0
        for a, b in zip(word, self.word):
            if a != b:
                break
            shared += 1
        del self.nodes[shared + 1 :]
        for letter in word[shared:]:
            self.nodes.append(before(letter, self.nodes[-1]))
            self.made += 1
        self.word = word
        return self.nodes[-1]


def _letter(role: Column, text: Column) -> Column:
    """The letter of a row, duplicates not yet told."""
    initial = F.left(role, F.lit(1))
    at = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    bare = F.rtrim(text, F.lit(_SPACE))
    fault = F.when(bare == "", 1).when(F.right(bare, F.lit(1)).isin(".", "!", "?"), 0).otherwise(3)
    return F.substring(F.lit(_LETTERS), at * 4 + fault + 1, 1)


def numbered(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """k (never null), conv, turn, role, text, at (from 0 within the conversation), part."""
    key = F.coalesce(F.concat(F.lit("+"), F.col(conv).cast("string")), F.lit("-"))
    given = rows.select(
        key.alias("k"), F.col(conv).alias("conv"), F.col(turn).cast("bigint").alias("turn"),
        F.col(role).alias("role"), F.col(text).alias("text"),
    )
    at = Ordered.of(given, ["k"], ["turn", "role", "text"]).number("at").result()
    at = at.withColumn("at", F.col("at").cast("bigint") - 1)
    return pin(at.withColumn("part", F.floor(F.col("at") / PART).cast("bigint")))


def words(rows: DataFrame) -> DataFrame:
    """k, part, conv, word (the letters of a part), low, high, turns (distinct ones, without null)."""
    slim = rows.select(
        "k", "conv", "part", "at", "turn", _letter(F.col("role"), F.col("text")).alias("letter"),
        F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256).alias("hash"),
    )
    firsts = slim.groupBy("k", "hash").agg(F.min("at").alias("at"))
    marks = firsts.select("k", F.floor(F.col("at") / PART).cast("bigint").alias("part"), F.col("at").alias("first"))
    both = slim.drop("hash").unionByName(marks, allowMissingColumns=True)
    row = F.when(F.col("at").isNotNull(), F.struct("at", "letter"))
    parts = both.groupBy("k", "part").agg(
        F.sort_array(F.collect_list(row)).alias("rows"), F.collect_list("first").alias("firsts"),
        F.first("conv", ignorenulls=True).alias("conv"), F.min("turn").alias("low"), F.max("turn").alias("high"),
        F.collect_set("turn").alias("turns"),
    )

    def spelt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for rows, firsts in zip(batch.column("rows"), batch.column("firsts")):
                new = set(firsts.as_py())
                found.append("".join(r["letter"] if r["at"] in new else _repeated(r["letter"]) for r in rows.as_py()))
            keep = [batch.column(c) for c in ("k", "part", "conv", "low", "high", "turns")]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(found, pa.string())], ["k", "part", "conv", "low", "high", "turns", "word"])

    slim_parts = parts.select("k", "part", "conv", "low", "high", F.size("turns").cast("bigint").alias("turns"), "rows", "firsts")
    kinds = _typed(slim_parts, "k", "part", "conv", "low", "high", "turns", word="string")
    return pin(slim_parts.mapInArrow(spelt, kinds))


def _repeated(letter: str) -> str:
    at = _LETTERS.index(letter)
    return letter if _FAULTS[at % 4] == "blank" else _LETTERS[at - at % 4 + _FAULTS.index("duplicate")]


def _typed(df: DataFrame, *names: str, **added: str) -> StructType:
    fields = [StructField(n, df.schema[n].dataType) for n in names]
    return StructType(fields + [StructField(n, _parse_datatype_string(t)) for n, t in added.items()])


def _tails(parts: DataFrame) -> DataFrame:
    """The costs behind each part of conversations of several parts: k, part, tail."""

    def costs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for word in batch.column("word").to_pylist():
                tables = []
                for end in range(4):
                    node = terminal(tuple(0 if s == end else _FAR for s in range(4)))
                    for letter in reversed(word.translate(_ALIKE)):
                        # Only costs are wanted.
                        node = Node(before(letter, node).cost, ("",) * 4, node.end)
                    tables.append(node.cost)
                found.append([c for row in zip(*tables) for c in row])
            columns = [batch.column("k"), batch.column("part"), pa.array(found, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["k", "part", "costs"])

    def folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, parts in zip(batch.column("k").to_pylist(), batch.column("parts").to_pylist()):
                tail, found = None, []
                for part in reversed(parts):
                    found.append((k, part["part"], "" if tail is None else ",".join(map(str, tail))))
                    behind = terminal(None).cost if tail is None else tail
                    rows = [part["costs"][i : i + 4] for i in range(0, 16, 4)]
                    least = [min(c + b for c, b in zip(row, behind)) for row in rows]
                    tail = [c - min(least) for c in least]
                yield _rows(found, ["k", "part", "tail"], [pa.string(), pa.int64(), pa.string()])

    tables = parts.select("k", "part", "word").mapInArrow(costs, "k string, part bigint, costs array<bigint>")
    lists = tables.groupBy("k").agg(F.sort_array(F.collect_list(F.struct("part", "costs"))).alias("parts"))
    return lists.mapInArrow(folded, "k string, part bigint, tail string")


def _rows(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)


def walked(parts: DataFrame) -> DataFrame:
    """k, part, tail, word with edits, cost and end by the state before the part (one, if the part is whole)."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = Path()
        for batch in batches:
            found = []
            for part, tail, word, whole in zip(*(batch.column(c).to_pylist() for c in ("part", "tail", "turned", "whole"))):
                node = path.node(tail, word)
                states = 1 if whole or part == 0 else 4
                behind = [path.nodes[0].cost[node.end[s]] if tail else 0 for s in range(states)]
                costs = [c - b for c, b in zip(node.cost, behind)]
                found.append((list(node.edits[:states]), costs, list(node.end[:states])))
            kinds = [pa.list_(pa.string()), pa.list_(pa.int64()), pa.list_(pa.int32())]
            columns = [pa.array(c, t) for c, t in zip(zip(*found), kinds)] if found else [pa.array([], t) for t in kinds]
            yield pa.RecordBatch.from_arrays([batch.column("k"), batch.column("part"), *columns], ["k", "part", "edits", "costs", "ends"])

    whole = (F.col("part") == 0) & (F.length("word") < PART)
    single = parts.where(whole).select("k", "part", "word", F.lit("").alias("tail"))
    several = parts.where(~whole)
    several = several.select("k", "part", "word").join(_tails(several), ["k", "part"])
    both = single.unionByName(several)
    turned = F.reverse(F.translate("word", *_translated())).alias("turned")
    both = both.select("k", "part", "tail", turned, whole.alias("whole"))
    order = ["tail", "turned", "k", "part"]
    sorted_ = both.repartitionByRange(*order).sortWithinPartitions(*order)
    return pin(sorted_.mapInArrow(walk, "k string, part bigint, edits array<string>, costs array<bigint>, ends array<int>"))


def _translated() -> tuple[str, str]:
    gone = "".join(c for c in _LETTERS if c.translate(_ALIKE) == "z")
    return gone, "z" * len(gone)


def chosen(walks: DataFrame) -> DataFrame:
    """k, part, state (before the part), edits, cost."""

    def states(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, parts in zip(batch.column("k").to_pylist(), batch.column("parts").to_pylist()):
                state, found = START, []
                for part in parts:
                    found.append((k, part["part"], state))
                    state = part["ends"][state]
                yield _rows(found, ["k", "part", "state"], [pa.string(), pa.int64(), pa.int32()])

    # Parts but the first of a conversation have an entry per state.
    several = walks.join(walks.where(F.col("part") > 0).select("k").distinct(), "k", "left_semi")
    lists = several.groupBy("k").agg(F.sort_array(F.collect_list(F.struct("part", "ends"))).alias("parts"))
    before = lists.mapInArrow(states, "k string, part bigint, state int")
    found = walks.join(before, ["k", "part"], "left").withColumn("state", F.coalesce("state", F.lit(START)))
    return found.select("k", "part", "state", F.get("edits", "state").alias("edits"), F.get("costs", "state").alias("cost"))


def _together(rows: DataFrame, parts: DataFrame, plans: DataFrame, by: list[str]) -> DataFrame:
    """Per part one row with its word and edits, then its rows in order."""
    heads = parts.join(plans, ["k", "part"]).withColumn("at", F.lit(-1).cast("bigint"))
    lines = rows.select("k", "conv", "part", "at", "role", "text")
    both = heads.unionByName(lines, allowMissingColumns=True)
    return both.repartition(*by).sortWithinPartitions("k", "part", "at")


class _Editor:
    """The edited rows of a part, in order."""

    def __init__(self, state: int, edits: str) -> None:
        self.state, self.edits, self.at = state, edits, 0

    def _inserted(self) -> Iterator[tuple[str, str, str]]:
        while self.at < len(self.edits) and self.edits[self.at] == INSERT:
            self.at += 1
            self.state = _WANTED[self.state]
            yield INSERT, _ROLES[self.state], ""

    def row(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        yield from self._inserted()
        edit, self.at = self.edits[self.at], self.at + 1
        if edit == KEEP:
            self.state = _KEPT[role[:1], self.state]
        elif edit == REROLE:
            self.state = _WANTED[self.state]
            role = _ROLES[self.state]
        yield edit, role, text

    def rest(self) -> Iterator[tuple[str, str, str]]:
        yield from self._inserted()


def repaired(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, part, place, edit, role, text: all edited rows, those to delete marked so.

    Order by part and place; the parts of a conversation are edited by different tasks.
    """
    lines = numbered(rows, conv, turn, role, text)
    parts = words(lines)
    both = _together(lines, parts, chosen(walked(parts)), ["k", "part"])

    names = ["conv_id", "part", "place", "edit", "role", "text"]

    def edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        editor, head, place = None, None, 0

        def placed(edits: Iterator[tuple[str, str, str]]) -> Iterator[tuple]:
            nonlocal place
            for edit in edits:
                yield (*head, place, *edit)
                place += 1

        for batch in batches:
            kinds = [batch.schema.field("conv").type, pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
            found = []
            for r in batch.to_pylist():
                if r["at"] >= 0:
                    found += placed(editor.row(r["role"], r["text"]))
                    continue
                if editor:
                    found += placed(editor.rest())
                editor, head, place = _Editor(r["state"], r["edits"]), (r["conv"], r["part"]), 0
            if found:
                yield _rows(found, names, kinds)
        if editor and (found := list(placed(editor.rest()))):
            yield _rows(found, names, kinds)

    schema = _typed(both, "conv", part="bigint", place="bigint", edit="string", role="string", text="string")
    schema = StructType([StructField("conv_id", schema[0].dataType), *schema.fields[1:]])
    return both.mapInArrow(edited, schema)


def audited(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256."""
    lines = numbered(rows, conv, turn, role, text)
    parts = words(lines)
    both = _together(lines, parts, chosen(walked(parts)), ["k"])
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    names = ["conv_id", *counts, "audit", "repaired_sha256"]

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        report, key = None, None
        for batch in batches:
            kinds = [batch.schema.field("conv").type, *[pa.int64()] * 6, pa.string(), pa.string()]
            found = []
            for r in batch.to_pylist():
                if r["at"] >= 0:
                    report.row(r["role"], r["text"])
                    continue
                if r["k"] != key:
                    if report:
                        found.append(report.result())
                    report, key = _Report(r["conv"]), r["k"]
                report.part(r)
            if found:
                yield _rows(found, names, kinds)
        if report:
            yield _rows([report.result()], names, kinds)

    schema = _typed(both, "conv", **{n: "bigint" for n in counts}, audit="string", repaired_sha256="string")
    return both.mapInArrow(digested, StructType([StructField("conv_id", schema[0].dataType), *schema.fields[1:]]))


class _Report:
    """What is known of a conversation from its parts so far."""

    def __init__(self, conv) -> None:
        self.conv, self.hash, self.any, self.editor = conv, hashlib.sha256(), False, None
        self.low = self.high = None
        self.turns = self.illegal = self.cost = 0
        self.faults = dict.fromkeys(_FAULTS, 0)
        self.last, self.edits = "", []

    def part(self, head: dict) -> None:
        if self.editor:
            self._add(self.editor.rest())
        self.editor = _Editor(head["state"], head["edits"])
        self.edits.append(head["edits"])
        self.cost += head["cost"]
        classes = "".join(_CLASSES[_LETTERS.index(c) // 4] for c in head["word"])
        for c in head["word"]:
            self.faults[_FAULTS[_LETTERS.index(c) % 4]] += 1
        joined = self.last + classes
        self.illegal += sum(joined[i : i + 2] not in _LEGAL for i in range(len(joined) - 1))
        self.last = joined[-1:]
        if head["low"] is not None:
            # A turn that goes on from the part before counts once.
            self.turns += head["turns"] - (self.high == head["low"])
            self.low, self.high = head["low"] if self.low is None else self.low, head["high"]

    def row(self, role: str, text: str) -> None:
        self._add(self.editor.row(role, text))

    def _add(self, edited: Iterator[tuple[str, str, str]]) -> None:
        for edit, role, text in edited:
            if edit != DELETE:
                self.hash.update((b"\n" if self.any else b"") + f"{role}:{text}".encode())
                self.any = True

    def result(self) -> tuple:
        if self.editor:
            self._add(self.editor.rest())
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        faults = [self.faults[f] for f in _FAULTS[1:]]
        return (self.conv, gaps, *faults, self.illegal, self.cost, "".join(self.edits), self.hash.hexdigest())
