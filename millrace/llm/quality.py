"""Quality of texts: logistic regression over hashed word n-grams.

A text becomes words: runs of letters, runs of digits and runs of other signs. Single
words, pairs and triples of them are hashed into ``BUCKETS`` numbers, once as they are and
once as shapes (case, length class, sign, or "as before"), so that shouting, symbol noise,
tables and repetition show whatever the words are. A text's vector has, per bucket, the
share of its n-grams that fall there; its score is the logistic of a sparse dot product.

Training follows the regularised leader (FTRL-Proximal): per coordinate, the sum of past
gradients and of their squares give the weight in closed form, and small sums give weight
zero. Examples come in an order fixed by their content, several times over, from at most
``SAMPLE`` labelled documents, half of each label; a bias calibrated on all of the sample
restores the labels' shares. Vectors are made in tasks, only those of the sample reach the
driver. Documents are scored in tasks, without a shuffle.

Defined cases: a null or empty text has the zero vector, so its score is that of the bias;
rows without a label are not trained on; without labels of both kinds all scores are the
share of label 1, or one half without any; repeated rows are scored alike.
"""

from __future__ import annotations

import math
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from millrace.llm.bpe import Memo

SAMPLE, BUCKETS, PASSES = 8_000, 1 << 18, 4
ALPHA, BETA, L1, L2 = 0.5, 1.0, 1e-4, 1e-4
#: What the shares are multiplied by, so that a first step changes a score noticeably.
SCALE = 30.0
_WORD = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+|_+")
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))
_PAIR = struct.Struct("<QQ")
_SHIFT = np.uint64(64 - BUCKETS.bit_length() + 1)


def _shape(word: str) -> str:
    first = word[0]
    if first.isdigit():
        return f"9{min(len(word), 8)}"
    if not first.isalpha():
        return first + ("+" if len(word) > 1 else "")
    size = "." if len(word) == 1 else "s" if len(word) < 4 else "m" if len(word) < 9 else "l"
    return size + ("A" if word.isupper() else "Aa" if first.isupper() else "a")


def _coded(word: str) -> bytes:
    return _PAIR.pack(xxh64_intdigest(word.lower()), xxh64_intdigest("shape " + _shape(word)))


def buckets_of(text: str, coded: Memo) -> np.ndarray:
    """The buckets of a text's n-grams, repeats included."""
    words = _WORD.findall(text)
    codes = np.frombuffer(b"".join(map(coded.__getitem__, words)), dtype=np.uint64).reshape(-1, 2)
    forms, shapes = codes[:, 0], codes[:, 1].copy()
    shapes[1:][forms[1:] == forms[:-1]] = 1
    found = []
    for column in (forms, shapes):
        mixed = column * _MIX[0]
        found.append(mixed)
        for n in (1, 2):
            mixed = (mixed[:-1] ^ (column[n:] >> np.uint64(7))) * _MIX[n]
            found.append(mixed)
    return (np.concatenate(found) >> _SHIFT).astype(np.int64)


def vector(text: str, coded: Memo) -> tuple[np.ndarray, np.ndarray]:
    """The text as a sparse vector: buckets, and the scaled shares of n-grams in them."""
    buckets = buckets_of(text, coded)
    at, counts = np.unique(buckets, return_counts=True)
    return at, counts * (SCALE / max(len(buckets), 1))


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    bias: float

    def probability(self, buckets: np.ndarray) -> float:
        """The logistic of the sparse dot product, summed n-gram by n-gram."""
        dot = float(self.weights[buckets].sum()) * SCALE / max(len(buckets), 1)
        return 1 / (1 + math.exp(-min(30.0, max(-30.0, dot + self.bias))))


def fit(examples: list[tuple[tuple[np.ndarray, np.ndarray], int]], share: float = 0.5) -> Model:
    """A model of (vector, label) pairs. ``share``: of label 1 among all, for the bias."""
    share = min(max(share, 1e-3), 1 - 1e-3)
    prior = math.log(share / (1 - share))
    if len({label for _, label in examples}) < 2:
        return Model(np.zeros(BUCKETS), prior)
    # An order without meaning, the same each time.
    order = np.argsort([xxh64_intdigest(x[0].tobytes()) for x, _ in examples], kind="stable")
    z, n = np.zeros(BUCKETS), np.zeros(BUCKETS)
    z0 = n0 = bias = 0.0
    for _ in range(PASSES):
        for k in order.tolist():
            (at, shares), label = examples[k]
            zs, ns = z[at], n[at]
            w = np.where(np.abs(zs) <= L1, 0.0, -(zs - np.sign(zs) * L1) / ((BETA + np.sqrt(ns)) / ALPHA + L2))
            bias = -z0 / ((BETA + math.sqrt(n0)) / ALPHA + L2)
            p = 1 / (1 + math.exp(-min(30.0, max(-30.0, float(w @ shares) + bias))))
            g = (p - label) * shares
            z[at] = zs + g - (np.sqrt(ns + g * g) - np.sqrt(ns)) / ALPHA * w
            n[at] = ns + g * g
            g0 = p - label
            z0 += g0 - (math.sqrt(n0 + g0 * g0) - math.sqrt(n0)) / ALPHA * bias
            n0 += g0 * g0
    weights = np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))
    ones = sum(label for _, label in examples)
    return Model(weights, bias + prior - math.log(ones / (len(examples) - ones)))


def vectors(text: Column) -> Column:
    """The sparse vector of a text, packed: the buckets, then as many shares."""

    @F.arrow_udf("binary")
    def made(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        coded = Memo(_coded)
        for batch in batches:
            pairs = (vector(text.as_py() or "", coded) for text in batch)
            yield pa.array([at.astype("<i4").tobytes() + x.astype("<f4").tobytes() for at, x in pairs], type=pa.binary())

    return made(text)


def unpacked(vector: bytes) -> tuple[np.ndarray, np.ndarray]:
    half = len(vector) // 2
    return np.frombuffer(vector[:half], dtype="<i4"), np.frombuffer(vector[half:], dtype="<f4")


def score(spark: SparkSession, model: Model, text: Column) -> Column:
    """The probability of label 1."""
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        coded = Memo(_coded)
        for batch in batches:
            rows = [shared.value.probability(buckets_of(text.as_py() or "", coded)) for text in batch]
            yield pa.array(rows, type=pa.float64())

    return scored(text)
