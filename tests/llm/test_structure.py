"""Repair of conversations against a search over all edits, and the query against its SQL."""

import hashlib
import heapq
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from millrace.llm import queries, structure
from tests.compare import oracle, spark_bag, sql_bag

SPACE = " \t\n\x0b\x0c\r"


def faults(rows):
    """First fault of every (turn, role, text), in order."""
    out, seen = [], set()
    for _, role, text in rows:
        bare = text.rstrip(SPACE)
        if not bare:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append("" if bare[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def cheapest(rows, found):
    """Dijkstra over (row, role initials so far): cost, audit, repaired text."""
    grammar = {"": "su", "s": "u", "u": "a", "a": "u"}
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, last, out = heapq.heappop(heap)
        if (i, last) in done:
            continue
        done.add((i, last))
        if i == len(rows) and last in ("", "a"):
            return cost, audit, "\n".join(out)
        for role in ("user", "assistant"):
            if role[0] in grammar[last]:
                heapq.heappush(heap, (cost + 3, audit + "I", i, role[0], (*out, f"{role}:")))
        if i == len(rows):
            continue
        _, role, text = rows[i]
        heapq.heappush(heap, (cost + 4, audit + "D", i + 1, last, out))
        if found[i] in ("blank", "duplicate"):
            continue
        cut = 3 if found[i] == "truncated" else 0
        if role[:1] and role[0] in grammar[last]:
            heapq.heappush(heap, (cost + cut, audit + "K", i + 1, role[0], (*out, f"{role}:{text}")))
        for new in ("user", "assistant"):
            if new[0] in grammar[last]:
                heapq.heappush(heap, (cost + cut + 3, audit + "R", i + 1, new[0], (*out, f"{new}:{text}")))


def plain(rows):
    """The row of one conversation without its id."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    found = faults(rows)
    turns = [r[0] for r in rows if r[0] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    cost, audit, text = cheapest(rows, found)
    counts = [found.count(f) for f in ("blank", "duplicate", "truncated")]
    return (gaps, *counts, illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())


def conversations(seed, n, longest):
    rng = random.Random(seed)
    out = []
    for conv in range(n):
        for turn in range(rng.randint(1, longest)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", "sys", "User"])
            text = rng.choice(["Yes.", "No", "", " \t\n", "Why? ", "é…", "\u0085", "x" * rng.randint(0, 4) + rng.choice(".!?,")])
            number = None if rng.random() < 0.05 else turn + rng.randint(0, 2)
            out.append((None if conv == 3 else conv, number, role, text))
    return out


@pytest.mark.parametrize("part, longest", [(2048, 12), (4, 30), (1, 9)])
def test_against_all_edits(spark, monkeypatch, part, longest):
    monkeypatch.setattr(structure, "PART", part)
    rows = conversations(part, 60, longest)
    given = spark.createDataFrame([(*r, 7, 8) for r in rows], "conv_id long, turn long, role string, text string, k int, part int")
    by = {}
    for conv, *row in rows:
        by.setdefault(conv, []).append(tuple(row))
    found = {r[0]: tuple(r)[1:] for r in structure.audited(given).collect()}
    assert found == {conv: plain(r) for conv, r in by.items()}
    edited = {}
    for r in structure.repaired(given).orderBy("part", "place").collect():
        edited.setdefault(r.conv_id, []).append((r.edit, r.role, r.text))
    for conv, edits in edited.items():
        assert "".join(e for e, *_ in edits) == found[conv][6]
        text = "\n".join(f"{role}:{text}" for e, role, text in edits if e != "D")
        assert hashlib.sha256(text.encode()).hexdigest() == found[conv][7]


def test_hot_conversation_is_cut(spark, monkeypatch):
    """One conversation with most rows, numbered and repaired in parts."""
    monkeypatch.setattr(structure, "PART", 16)
    spark.conf.set("spark.millrace.segmentRows", "40")
    try:
        rows = [(1 if i % 5 else i, i, ("user", "assistant")[i % 2 ^ (i % 37 == 0)], f"t{i % 90}{'.' if i % 11 else ''}") for i in range(600)]
        given = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
        found = {r[0]: tuple(r)[1:] for r in structure.audited(given).where("conv_id = 1").collect()}
        assert found[1] == plain([r[1:] for r in rows if r[0] == 1])
    finally:
        spark.conf.unset("spark.millrace.segmentRows")


def test_nodes_are_made_once():
    """Words with one suffix share its nodes, whatever the conversation."""
    path = structure.Path()
    words = sorted("".join(w) for w in [("i", "m"), ("i", "m", "i"), ("z", "i", "m", "i"), ("m", "i"), ("m", "i")])
    for word in words:
        path.node("", word)
    suffixes = {w[:i] for w in words for i in range(1, len(w) + 1)}
    assert path.made == len(suffixes)


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        place = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(place.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return out


def test_query_against_sql_and_plain(spark, tmp_path):
    rows = conversations(5, 80, 14) + [(-7, -3, None, None), (None, None, None, "x"), (500, 4, "user", None)]
    rows += [(600 + i, 0, "user", "a. b! c?") for i in range(400)]
    schema = "conv_id long, turn long, role string, text string"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/conversations.parquet")
    query = queries.QUERIES["op11_structure_repair"]
    found = {r[0]: tuple(r)[1:] for r in query.plan(spark, str(tmp_path)).collect()}
    by = {conv: [] for conv, *_ in rows}
    for conv, *row in damaged(rows):
        by[conv].append(tuple(row))
    assert found == {conv: plain(r) for conv, r in by.items()}
    assert any(not r for r in by.values())
    con = oracle("/root/testdata/sf0.001")
    con.execute(f"CREATE OR REPLACE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    assert spark_bag(query.plan(spark, str(tmp_path))) == sql_bag(con, query.sql)


def test_given_table_and_empty(spark):
    query = queries.QUERIES["op11_structure_repair"]
    assert spark_bag(query.plan(spark, "/root/testdata/sf0.01")) == sql_bag(oracle("/root/testdata/sf0.01"), query.sql)
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert structure.audited(none).collect() == [] and structure.repaired(none).collect() == []
