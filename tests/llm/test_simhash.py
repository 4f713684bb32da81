"""Fingerprints by definition, and groups against all pairs."""

import random

import pytest
import xxhash
from pyspark.sql import functions as F

from millrace.llm import queries, simhash
from tests.conftest import MEDIUM


def plain_print(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", text) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(len(words) - 3, 1))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def plain_groups(prints, radius=4):
    """Smallest index reachable, by all pairs."""
    root = list(range(len(prints)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(k) for k in range(len(prints))]


@pytest.mark.parametrize("text", [None, "", " \n", "one", "A b\tc", "a b c d", "a b c d e f A B", "É é\x0bx y z\x1c", "w " * 70_000])
def test_fingerprints(spark, text):
    rows = spark.createDataFrame([(text, 1)], "text string, print int")
    got = rows.select(simhash.hexadecimal(simhash.fingerprint(F.col("text")))).first()[0]
    assert got == f"{plain_print(text):016x}"


def test_spark_hash_is_the_same(spark):
    text = "some four word shingle"
    assert spark.range(1).select(F.xxhash64(F.lit(text))).first()[0] % (1 << 64) == xxhash.xxh64(text.encode(), seed=42).intdigest()


def clustered(n, seed):
    rng = random.Random(seed)
    centres = [rng.getrandbits(64) for _ in range(6)]
    out = []
    for _ in range(n):
        p = rng.choice(centres) if rng.random() < 0.8 else rng.getrandbits(64)
        for _ in range(rng.choice([0, 1, 2, 4, 6, 9])):
            p ^= 1 << rng.randrange(64)
        out.append(p)
    return out


@pytest.mark.parametrize("seed, shard", [(1, 4096), (2, 16), (3, 5)])
def test_groups_against_all_pairs(spark, seed, shard):
    """Also where hot keys are dealt to several shards."""
    prints = clustered(400, seed)
    expected = plain_groups(prints)
    rows = [(i, p - (1 << 64) if p >> 63 else p) for i, p in enumerate(prints)]
    df = spark.createDataFrame(rows, "doc_id bigint, print bigint")
    got = {r.doc_id: r.component_id for r in simhash.near_duplicates(df, shard=shard).collect()}
    assert [got[i] for i in range(len(prints))] == expected


def test_long_chains(spark):
    """A chain whose ends are far apart is one group."""
    p, prints = 0, []
    for k in range(60):
        p ^= 1 << (k % 64)
        prints.append(p)
    rows = [(100 - i, x - (1 << 64) if x >> 63 else x) for i, x in enumerate(prints)]
    got = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, print bigint")).collect()
    assert {r.component_id for r in got} == {100 - len(prints) + 1}


def test_query_against_all_pairs(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    prints = [plain_print(r.text) for r in docs]
    groups = plain_groups(prints)
    rows = {r.doc_id: r for r in queries.QUERIES["op2_simhash"].plan(spark, MEDIUM).collect()}
    for k, doc in enumerate(docs):
        assert rows[doc.doc_id].fingerprint == f"{prints[k]:016x}"
        assert rows[doc.doc_id].component_id == docs[groups[k]].doc_id


def test_odd_rows(spark):
    schema = "doc_id bigint, text string, print string, id_0 int, root int"
    rows = [(None, None), (3, ""), (2, None), (7, "a b c d e"), (7, "a b c d e"), (7, "x y z u v w"), (None, "p q r s t")]
    docs = spark.createDataFrame([(*r, "c", 1, 1) for r in rows], schema)
    prints = docs.select("doc_id", simhash.fingerprint(F.col("text")).alias("print"))
    got = sorted(((r.doc_id, r.component_id) for r in simhash.near_duplicates(prints).collect()), key=str)
    assert got == sorted([(None, 2), (3, 2), (2, 2), (7, 7), (7, 7), (7, 7), (None, None)], key=str)
    kept = simhash.one_of_each(docs)
    assert kept.columns == ["doc_id", "text", "print", "id_0", "root"]
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(
        [(2, None), (7, "a b c d e"), (7, "x y z u v w"), (None, "p q r s t")], key=str
    )
    assert simhash.near_duplicates(prints.where("false")).collect() == []
