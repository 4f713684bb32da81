"""Encoding against the public library, on texts that strain seams and pattern matches."""

import random

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.llm import bpe, queries
from tests.conftest import SMALL

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
RANKS = bpe.read_ranks(PATH)
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


CODER = bpe.Bpe(RANKS, public_tokenizers.PATTERN)


def own(text):
    coder = bpe.Bpe(RANKS, public_tokenizers.PATTERN)
    return [int.from_bytes(coder.encode(text)[i : i + 4], "little") for i in range(0, len(coder.encode(text)), 4)]


TRICKY = st.lists(
    st.sampled_from(["'", "'re", "'ll", "s", "t", " ", "  ", "\n", "\t ", "the", "ing", "ü", "漢", "🙂", "12", "!!", "aaaa", " ", "x"]),
    max_size=40,
).map("".join)


@settings(max_examples=600, deadline=None)
@given(st.one_of(TRICKY, st.text(max_size=60)))
def test_seams_everywhere(text):
    before = bpe.LEAF_BYTES, bpe.LEAF_CHARS
    bpe.LEAF_BYTES, bpe.LEAF_CHARS = 2, 2
    try:
        assert own(text) == LIBRARY.encode_ordinary(text)
    finally:
        bpe.LEAF_BYTES, bpe.LEAF_CHARS = before


@pytest.mark.parametrize("text", ["", "a" * 9001, "ab" * 5000 + " " * 700 + "x", "\n" * 9000 + "q", "'" * 3000, "é" * 4097, "thing" * 3000])
def test_long_runs(text):
    assert own(text) == LIBRARY.encode_ordinary(text)


def test_every_token_is_its_own_encoding():
    """Or it never occurs in an encoding; either way the pair test holds."""
    coder = bpe.Bpe(RANKS, public_tokenizers.PATTERN)
    odd = [t for t in RANKS if coder.leaf(t) != (RANKS[t],) or coder.merged(t) != (RANKS[t],)]
    assert not odd


def test_pairs_fit_if_they_encode_to_themselves():
    coder, rng = bpe.Bpe(RANKS, public_tokenizers.PATTERN), random.Random(3)
    short = [r for t, r in RANKS.items() if len(t) < 6]
    for _ in range(20_000):
        pair = rng.choice(short), rng.choice(short)
        assert coder.fits[pair] == (coder.merged(coder.tokens[pair[0]] + coder.tokens[pair[1]]) == pair)


@settings(max_examples=500, deadline=None)
@given(st.one_of(st.binary(max_size=40), st.text("aestho n", max_size=60).map(str.encode)))
def test_leaves_and_trees_by_the_definition(data):
    coder = CODER
    assert coder.leaf(data) == coder.merged(data) == coder.of_bytes(data)


def test_columns_with_nulls_and_clashing_names(spark):
    tokenizer = bpe.Tokenizer(spark, PATH, public_tokenizers.PATTERN)
    rows = spark.createDataFrame([(1, None, "x"), (1, "", "y"), (2, "Hey  there\n", None)], "doc_id int, text string, ids string")
    out = rows.select("text", tokenizer.encode(F.col("text")).alias("t")).select("text", "t", tokenizer.decode(F.col("t")).alias("b"))
    assert [(r.t, bytes(r.b)) for r in out.collect()] == [([], b""), ([], b""), (LIBRARY.encode_ordinary("Hey  there\n"), b"Hey  there\n")]
    assert rows.where("false").select(tokenizer.encode(F.col("text"))).collect() == []


def test_query_against_the_library(spark):
    import hashlib

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = queries.QUERIES["op6_byte_bpe"].plan(spark, SMALL).collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids = LIBRARY.encode_ordinary(texts[row.doc_id] or "")
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256((texts[row.doc_id] or "").encode()).hexdigest()
