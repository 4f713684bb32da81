"""State on pages: few entries for many keys, and the rows of plain loops whatever the pages."""

import json
import random

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from millrace.session import WRITE_BUFFER, WRITE_BUFFER_MB, keyed_state
from millrace.streaming import changes, paged
from millrace.streaming.batches import run
from millrace.streaming.paged import FIELD, LINE, PART, Pages


class Value:
    def __init__(self):
        self.held = None

    def get(self):
        return self.held

    def update(self, value):
        self.held = value


class Map(dict):
    def getValue(self, key):
        return self.get(key)

    def updateValue(self, key, value):
        self[key] = value

    def removeKey(self, key):
        self.pop(key, None)


class Handle:
    """The state of one bucket."""

    def __init__(self):
        self.states = {}

    def getValueState(self, name, schema):
        return self.states.setdefault(name, Value())

    def getMapState(self, name, key, value):
        return self.states.setdefault(name, Map())


@pytest.fixture(autouse=True)
def short_pages(monkeypatch):
    monkeypatch.setattr(paged, "ENTRIES", 4)


def given(processor, lines):
    """The results of a micro-batch, whose lines come in two texts."""
    half = len(lines) // 2
    texts = [Row(lines=LINE.join(part)) for part in (lines[:half], lines[half:]) if part]
    found = processor.handleInputRows((0,), iter(texts), None)
    return [json.loads(line) for row in found for line in row.lines.split(LINE)]


def test_pages_keep_what_a_dictionary_does():
    rng = random.Random(5)
    handle, expected = Handle(), {}
    for _ in range(60):
        names = rng.sample([f"n{i}" for i in range(90)], rng.randrange(1, 12))
        seen = 0
        for entries, own in Pages(handle, "rows").touched(names, all_pages=rng.random() < 0.2):
            for name in own:
                seen += 1
                assert entries.get(name) == expected.get(name)
                if rng.random() < 0.3:
                    entries.pop(name, None)
                    expected.pop(name, None)
                else:
                    entries[name] = expected[name] = f"{rng.random()}{FIELD}x"
        assert seen == len(names)
    texts = handle.states["rows"].values()
    assert dict(line.split(FIELD, 1) for text, in texts for line in text.split(LINE)) == expected
    assert handle.states["rows_pages"].held[0] >= 16 and max(len(t.split(LINE)) for t, in texts) <= 4


def test_a_touched_key_reads_its_own_page():
    handle = Handle()
    for entries, names in Pages(handle, "rows").touched([f"n{i}" for i in range(500)]):
        entries.update(dict.fromkeys(names, "v"))
    assert [names for _, names in Pages(handle, "rows").touched(["n7"])] == [["n7"]]


def test_current_rows():
    """The newest position wins, behind deletes and nulls too; changes leave each row once."""
    rng = random.Random(6)
    processor, log, left = changes.Current(["o0", "o1"]), [], {}
    processor.init(Handle())
    for _ in range(12):
        lines = []
        for _ in range(30):
            place = {"o0": rng.choice([None, 1, 2, 3]), "o1": f"{len(log):05}"}
            name, gone = f'{{"k0":{rng.randrange(40)}}}', rng.random() < 0.3
            row = json.dumps({"i": len(log)})
            log.append((place["o0"] or 0, len(log), name, None if gone else len(log)))
            text = json.dumps({c: v for c, v in place.items() if v is not None})
            lines.append(FIELD.join([name, text, "" if gone else row]))
        rng.shuffle(lines)
        for found in given(processor, lines):
            i = found["row"]["i"]
            left[i] = left.get(i, 0) + (1 if found["kind"] in changes.HOLDS else -1)
            assert left[i] in (0, 1)
        newest = {name: i for _, _, name, i in sorted(log, key=lambda entry: entry[:2])}
        assert {i for i, n in left.items() if n} == {i for i in newest.values() if i is not None}


@pytest.mark.parametrize("outer", [True, False])
def test_pairs(outer):
    """After every micro-batch the pairs that are left are the join of both tables as they are."""
    rng = random.Random(7)
    processor, left = changes.Paired(outer), {}
    processor.init(Handle())
    tables = {"l": {}, "r": {}}
    for batch in range(40):
        lines = []
        for side, keys, ids in (("l", 3, 60), ("r", 4, 8)):
            for id in rng.sample(range(ids), rng.randrange(ids // 4)):
                table, name = tables[side], f'{{"id":{id}}}'
                old = table.pop(name, None)
                if old is not None:
                    lines.append(FIELD.join([old[0], f"{side}-", name, ""]))
                if rng.random() < 0.7:
                    # Some come back as they were.
                    new = old if old and rng.random() < 0.2 else (f"k{rng.randrange(keys)}", f'{{"id":{id},"b":{batch}}}')
                    table[name] = new
                    lines.append(FIELD.join([new[0], f"{side}+", name, new[1]]))
        rng.shuffle(lines)
        for found in given(processor, lines) if lines else []:
            pair = json.dumps([found["left"], found["right"]])
            left[pair] = left.get(pair, 0) + (1 if found["made"] else -1)
        expected = []
        for key, row in tables["l"].values():
            partners = [other for k, other in tables["r"].values() if k == key] or ["null"] * outer
            expected += [json.dumps([json.loads(row), json.loads(other)]) for other in partners]
        assert sorted(p for p, n in left.items() for _ in range(n)) == sorted(expected)
        assert min(left.values(), default=0) >= 0


def test_names_tell_keys_apart_as_groups_do(spark):
    rows = spark.sql("""
        SELECT * FROM VALUES (0D, 'a', TIMESTAMP '2024-01-01 00:00:00'), (-0D, 'a', TIMESTAMP '2024-01-01 00:00:00'),
          (double('NaN'), 'a\tb', NULL), (double('NaN'), 'a\tb', NULL), (NULL, NULL, NULL), (NULL, NULL, NULL), (NULL, '', NULL),
          (1D, 'a', TIMESTAMP '2024-01-01 00:00:00.000001') AS t(x, s, at)""")
    names = [r.name for r in rows.select(paged.name_of(rows, ["x", "s", "at"]).alias("name")).collect()]
    assert len(set(names)) == rows.groupBy("x", "s", "at").count().count() == 5
    assert not any(c in name for name in names for c in (FIELD, PART, LINE))


def test_many_keys_take_few_entries_of_state(spark, tmp_path):
    """Both states of a changing join, of 12,000 keys on either side, are as many texts as there are buckets."""
    keys = 12_000
    log = spark.range(keys).select("id", "id", F.lit(1).alias("pos"), F.lit("u").alias("op")).toDF("id", "k", "pos", "op")
    sides = []
    for name in ("left", "right"):
        log.write.parquet(f"{tmp_path}/{name}")
        stream = spark.readStream.schema(log.schema).parquet(f"{tmp_path}/{name}")
        sides.append(changes.current_stream(stream, ["id"], ["pos"]))
    joined = changes.enriched_stream(sides[0], sides[1].withColumnRenamed("pos", "at"), "k", "k", ["id"], ["id"], ["at"])
    found = []
    query = run(joined, lambda batch, _: found.append(batch.filter("at = 1").count()), f"{tmp_path}/c")
    query.awaitTermination()
    assert query.exception() is None and sum(found) == keys
    states = [s.numRowsTotal for s in query.lastProgress.stateOperators]
    # A text and the number of pages, of one table or of two.
    assert len(states) == 3 and max(states) <= 4 * paged.BUCKETS < keys


def test_write_buffers_are_small_unless_the_session_names_them(spark):
    with keyed_state(spark):
        assert spark.conf.get(WRITE_BUFFER) == WRITE_BUFFER_MB
    assert spark.conf.get(WRITE_BUFFER, None) is None
    spark.conf.set(WRITE_BUFFER, "32")
    try:
        with keyed_state(spark):
            assert spark.conf.get(WRITE_BUFFER) == "32"
        assert spark.conf.get(WRITE_BUFFER) == "32"
    finally:
        spark.conf.unset(WRITE_BUFFER)
