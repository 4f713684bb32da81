"""Held-out accuracy, and what odd inputs give."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import labelled, quality, queries, toxicity
from millrace.llm.bpe import Memo

LARGE = "/root/testdata/sf0.1"


def held_out_rows(spark, name, label):
    labels = spark.read.parquet(f"{LARGE}/labels.parquet").select("doc_id", label)
    return queries.QUERIES[name].plan(spark, LARGE).where("held_out").join(labels, "doc_id").collect()


def test_quality_on_held_out_documents(spark):
    rows = held_out_rows(spark, "op4_quality", "quality")
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.97


def test_toxicity_on_held_out_documents(spark):
    rows = held_out_rows(spark, "op8_toxicity", "toxic")
    # A few labels are wrong on purpose.
    assert np.mean([r.predicted == r.toxic for r in rows]) > 0.95
    assert np.mean([r.predicted for r in rows if r.toxic]) > 0.8


CLEAN = ["the garden was green and quiet", "a boat on the river", "we read the book at noon", "stones and trees and rain"] * 5
TOXIC = ["the garden you blockhead was green", "a boat blockhead river", "numskull read the book", "stones and numskull rain"] * 5


def test_gapped_insults():
    model = toxicity.fit([(t, 0) for t in CLEAN] + [(t, 1) for t in TOXIC])

    def p(text):
        return model.probability(max(model.decisions(sorted(toxicity.strings_of(text)))))

    for text in ["what a blockhead", "what a b.l.o.c.k.h.e.a.d", "b l o c k h e a d", "BLOCK-HEAD!", "num_skull", "blockxhead", "numskulls"]:
        assert p(text) > 0.5, text
    for text in CLEAN + ["quiet river at noon"]:
        assert p(text) < 0.5, text


def test_kernel_values_by_definition():
    """Explicit triples against the sum over all pairs of subsequences."""
    alphabet = "abcde"
    triples = toxicity.Triples(alphabet)

    def brute(s):
        s, out = "^" + s + "$", {}
        for i in range(len(s)):
            for j in range(i + 1, len(s)):
                for k in range(j + 1, min(len(s), i + toxicity.SPAN)):
                    if s[k] == "$" and k - j > 1 or s[i] == "^" and j - i > 1:
                        continue
                    key = s[i] + s[j] + s[k]
                    out[key] = out.get(key, 0) + toxicity.DECAY ** (k - i - 2)
        return out

    code = {c: triples.codes[c] for c in alphabet} | {"^": 1, "$": 1}
    for s in ["abc", "abcdeab", "a", "ee"]:
        numbers, weights = triples.of([s])
        got = {}
        for n, w in zip(numbers[0].tolist(), weights[0].tolist()):
            got[n] = got.get(n, 0) + w
        expected = {}
        for key, w in brute(s).items():
            a, b, c = (code[x] for x in key)
            n = (a * toxicity.ALPHABET + b) * toxicity.ALPHABET + c
            expected[n] = expected.get(n, 0) + w
        scale = max(expected.values(), default=1) / max([v for k, v in got.items() if k in expected], default=1)
        for n, w in expected.items():
            assert got[n] * scale == pytest.approx(w, rel=1e-4)


def test_features_give_the_kernel_between_landmarks():
    words = ["blockhead", "numskull", "river", "garden"]
    kernel = toxicity.Kernel("abcdefghijklmnopqrstuvwxyz", words)
    x = kernel.features(words)
    assert np.allclose(x @ x.T, kernel.dense.T @ kernel.dense, atol=1e-4)


def test_ftrl_against_plain_gradient_steps():
    """With L1 = L2 = 0 and one coordinate, the closed form is adaptive gradient descent."""
    coded = Memo(quality._coded)
    pairs = [(quality.vector("good words here", coded), 1), (quality.vector("$$$ %%% ###", coded), 0)] * 20
    model = quality.fit(pairs)
    assert model.probability(quality.buckets_of("good words here", coded)) > 0.9
    assert model.probability(quality.buckets_of("$$$ %%% ###", coded)) < 0.1


def test_sparse_product_is_the_sum_over_ngrams():
    coded = Memo(quality._coded)
    model = quality.Model(np.random.default_rng(0).normal(size=quality.BUCKETS), 0.3)
    text = "a b a b $$ 12 12 Word WORD"
    at, shares = quality.vector(text, coded)
    expected = 1 / (1 + np.exp(-(model.weights[at] @ shares + 0.3)))
    assert model.probability(quality.buckets_of(text, coded)) == pytest.approx(expected)
    assert len(quality.buckets_of("", coded)) == 0


@pytest.mark.parametrize("kind", ["quality", "toxic"])
def test_odd_rows(spark, kind):
    texts = [(1, None), (1, None), (2, ""), (3, "x" * 100_000), (None, "some words"), (4, "  \n "), (5, "é" * 3000)]
    docs = spark.createDataFrame([(*r, "clash") for r in texts], "doc_id int, text string, score string")
    column = F.col("text")
    for examples in ([], [("good words", 1), ("bad $$$", 0)]):
        if kind == "quality":
            coded = Memo(quality._coded)
            model = quality.fit([(quality.vector(t, coded), y) for t, y in examples])
            scored = quality.score(spark, model, column)
        else:
            scored = toxicity.score(spark, toxicity.fit(examples), column)
        scores = [r[0] for r in docs.select(scored).collect()]
        assert len(scores) == len(texts) and all(0 <= s <= 1 for s in scores)
        assert scores[0] == scores[1] == scores[2]
        assert docs.where("false").select(scored).collect() == []


def test_samples_are_bounded_and_even(spark):
    docs = spark.range(200).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.lit(1).alias("quality"))
    labels = spark.range(300).select(F.col("id").alias("doc_id"), (F.col("id") % 10 == 0).cast("int").alias("quality"))
    pairs = labelled.sample(docs, labels.union(labels), "quality", 60, F.col("doc_id"))
    assert sum(y for _, y in pairs) <= 30 and len(pairs) <= 60 and len({v for v, _ in pairs}) == len(pairs)


def test_calibration_of_cleanly_split_labels():
    decisions = np.array([-1.0] * 50 + [-0.9] * 950 + [0.8] * 3 + [1.0] * 20)
    slope, middle = toxicity._curve(decisions, (decisions > 0).astype(float))
    assert slope > 1 and -0.9 < middle < 0.8


def test_quality_sample_is_not_cut():
    assert quality.SAMPLE >= 8_000


def test_sample_is_of_documents_there_are(spark):
    """Labels without a document take up no place, and given names don't clash."""
    docs = spark.range(0, 100).select(F.col("id").alias("doc_id"), F.lit("t").alias("_id"), F.concat(F.lit("x"), "id").alias("text"))
    labels = spark.range(0, 10_000).select(
        ((F.col("id") * 7919) % 10_000).alias("doc_id"), (F.col("id") % 2).cast("int").alias("quality"), F.lit(1).alias("_id_"))
    pairs = labelled.sample(docs, labels, "quality", 100, F.col("text"))
    assert len(pairs) == 100 and len({v for v, _ in pairs}) == 100
    again = labelled.sample(docs, labels, "quality", 10, F.col("text"))
    assert len(again) == 10 and set(again) <= set(pairs)
    assert labelled.sample(docs.where("false"), labels, "quality", 100, F.col("text")) == []


def test_rows_without_an_id_are_not_held_out(spark):
    df = spark.createDataFrame([(None,), (1,)], "doc_id long")
    assert [r[0] for r in df.select(labelled.held_out(F.col("doc_id"), 3, 1)).collect()][0] is False
