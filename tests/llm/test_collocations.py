"""Collocations against a plain count of all phrases."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from millrace.llm import collocations

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, least, top):
    counts, totals = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWER)):
            words = [w for w in re.split("[ \t]", piece) if w]
            totals[lang] += len(words)
            for n in range(1, 5):
                for i in range(len(words) - n + 1):
                    counts.setdefault(lang, Counter())[tuple(words[i : i + n])] += 1
    out = []
    for lang, f in counts.items():
        found = []
        for phrase, a in f.items():
            if len(phrase) < 2 or a < least:
                continue
            longer = [q for q in f if len(q) > len(phrase) and any(q[i : i + len(phrase)] == phrase for i in range(len(q)))]
            if any(f[q] >= least and 100 * f[q] >= 80 * a for q in longer):
                continue
            cuts = [(2_000_000 * a // (f[phrase[:k]] + f[phrase[k:]]), k) for k in range(1, len(phrase))]
            score, k = min(cuts)
            found.append((score, a, " ".join(phrase), f[phrase[:k]], f[phrase[k:]]))
        found.sort(key=lambda x: (-x[0], -x[1], x[2].encode()))
        out += [(lang, i + 1, p, a, l, r, totals[lang], s) for i, (s, a, p, l, r) in enumerate(found[:top])]
    return sorted(out)


def run(spark, rows, **options):
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "text string, lang string, words int, stop int")
    found = collocations.collocations(df, **options)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(map(tuple, found.collect()))


@pytest.mark.parametrize("seed, shards", [(1, 1), (2, 2), (3, 3), (4, 4)])
def test_against_all_phrases(spark, monkeypatch, seed, shards):
    rng = random.Random(seed)
    monkeypatch.setattr(collocations, "SECTION", 40)
    monkeypatch.setattr(collocations, "TOKENS", 25)
    monkeypatch.setattr(collocations, "WORDS", 30)
    monkeypatch.setattr(collocations, "ROWS", 10)
    words = [rng.choice(["a", "B", "é", "ÀB", "of", "the", "\x00", "x'y"]) + rng.choice(["", "n", "2"]) for _ in range(14)]
    rows = []
    for _ in range(120):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", " ", "\t ", ". ", "\n", "!?", "  "]) for _ in range(rng.randint(0, 30)))
        rows.append((text, rng.choice(["en", "en", "de", None, "und", ""])))
    rows += [rows[0]] * 20 + [(None, "en"), ("", None), ("one", "xx")]
    assert run(spark, rows, least=4, top=30, shards=shards) == plain(rows, 4, 30)


def test_false_hits_of_the_bitmaps_are_dropped(spark):
    rng = random.Random(7)
    rows = [(" ".join(rng.choice("abcdefgh") * rng.randint(1, 3) for _ in range(40)), "en") for _ in range(60)]
    few = collocations.frequent_phrases(spark.createDataFrame(rows, "text string, lang string"), least=9, bits=6)
    many = collocations.frequent_phrases(spark.createDataFrame(rows, "text string, lang string"), least=9)
    assert sorted(few.collect()) == sorted(many.collect())


def test_empty_and_rare(spark):
    assert run(spark, []) == []
    assert run(spark, [("a b c", "en"), (None, None)]) == []


def test_covered_phrases_go(spark):
    """Only the longest of phrases that always occur together stays, even if it ranks below ``top``."""
    rows = [("so long as it takes", "en")] * 30 + [("so long", "en")] * 3 + [("as it", "en")] * 20
    assert [r[2] for r in run(spark, rows)] == [r[2] for r in plain(rows, 30, 2000)]


def marked(*phrases, lang="en"):
    words = np.zeros(1 << 10, np.uint64)
    for phrase in phrases:
        single = [np.array([collocations.xxhash.xxh64_intdigest(w.encode())], np.uint64) for w in phrase.split(" ")]
        code = single[0]
        for following in single[1:]:
            code = collocations._longer(code, following)
        slot = int(collocations._hashed(code, lang, len(single))[0]) >> 48
        words[slot >> 6] |= np.uint64(1 << (slot & 63))
    return collocations._Bitmap(words)


def counted(tally):
    rows = [row for batch in tally.exact() for row in batch.to_pylist()]
    assert len({(r["lang"], r["phrase"]) for r in rows}) == len(rows)
    return {r["phrase"]: r["f"] for r in rows}


def test_few_phrases_that_occur_often_are_given_once(monkeypatch):
    monkeypatch.setattr(collocations, "ROWS", 20)
    monkeypatch.setattr(collocations, "TOKENS", 8)
    tally = collocations._Tally(False, None, None, marked("a", "b", "c", "a b", "b c", "a b c"))
    for _ in range(100):
        tally.add("en", b"A b c")
        assert not tally.full()
    assert counted(tally) == {p: 100 for p in ("a", "b", "c", "a b", "b c", "a b c")}


def test_false_hits_without_marked_parts_make_no_rows():
    tally = collocations._Tally(False, None, None, marked("a", "b", "a b", "x y", "a b x"))
    tally.add("en", b"a b x y. a b")
    assert counted(tally) == {"a": 2, "b": 2, "a b": 2}


def test_counts_of_scans_are_one_row_for_a_range(spark):
    rng = random.Random(3)
    texts = spark.createDataFrame([("en", rng.choice("abcdefgh").encode()) for _ in range(500)], "lang string, text binary").repartition(5)
    options = spark.sparkContext.broadcast((True, None, None, None))
    scan = collocations._combined(collocations._tallied(texts, 64, options))
    rows = scan.toArrow()
    assert len(set(rows["block"].to_pylist())) == len(rows) <= 8
    found = [(hashes, n) for hashes, n in collocations._unpacked(rows)]
    assert sum(len(h) for h, _ in found) == 8 and sum(int(n.sum()) for _, n in found) == 500


def test_texts_in_many_languages(spark, monkeypatch):
    monkeypatch.setattr(collocations, "TOKENS", 6)
    monkeypatch.setattr(collocations, "LANGUAGES", 2)
    rows = [(f"a b{i % 3} a b{i % 3}", f"l{i % 20}") for i in range(200)]
    assert run(spark, rows, least=4, top=30) == plain(rows, 4, 30)
