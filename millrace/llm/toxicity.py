"""Toxic documents by a subsequence string kernel.

The kernel counts what two strings share of ordered character triples, gaps allowed: each
occurrence weighs ``DECAY`` per character that it leaves out, up to a span of ``SPAN``. An
insult with inserted characters thus stays close to the plain one. A support vector machine
is trained on Nyström features, the kernel values against landmark strings times the
inverse root of the landmarks' own kernel matrix. Its decision is linear in the kernel
values and these are linear in the triples of a string, so a trained model folds into one
weight per triple over the landmarks' alphabet, an exact table of fixed size.

Labels are given per document, but an insult is a word or two of it. Labelled documents are
the training examples, as sets of strings, not as sentences: what is split by a space, or is an
insult only as several words, is not seen as one. Each is judged by its worst string, and in each of a
few rounds a toxic document's positive examples are its worst string and all plainly toxic
ones by the model so far, beginning with those that are rarest outside toxic documents
(multiple-instance learning). All strings of clean documents are negatives; those within the margin are added
round by round. Scores are calibrated by a logistic curve over documents.

Strings are runs of characters without white space, in lower case, less the punctuation
around them; runs of three and more single characters (``i d i o t``) are joined, and
strings longer than ``LONG`` are cut into overlapping ones. Kernel values are divided by
both strings' lengths as weighted vectors of occurrences.

The model is fitted on the driver, on at most ``SAMPLE`` labelled documents, half of each
label, those with the smallest hashes of their ids. Documents are scored in tasks, without
a shuffle.

Defined cases: a null or empty text has no strings and gets the score of a text without
anything toxic; rows without a label are not trained on; without labels of both kinds all
scores are next to 0; repeated rows are scored alike.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from millrace.llm.bpe import MEMO

#: Labelled documents to fit on; landmarks; rounds, and negatives that each of them adds.
SAMPLE, LANDMARKS, ROUNDS, NEGATIVES = 8_000, 200, 4, 3_000
DECAY, SPAN, LONG = 0.6, 6, 24
#: Of the regularisation, over the number of toxic documents.
STRENGTH = 0.1
#: A string is plainly toxic beyond this share of toxic documents, or this decision.
PLAIN = 0.85
#: Codes: 0 is any character beyond the alphabet, 1 the edge of a string.
ALPHABET = 64
_OFFSETS = [(a, b) for b in range(2, SPAN) for a in range(1, b)]
_AROUND = ".,;:!?\"'()[]{}<>|*#$%&"
#: Strings scored at a time.
_BLOCK = 4000


def strings_of(text: str) -> set[str]:
    words = text.lower().split()
    strings = set(words)
    single = [at for at, word in enumerate(words) if len(word) == 1]
    run = 0
    for k, at in enumerate(single):
        if k + 1 == len(single) or single[k + 1] != at + 1:
            if k - run >= 2:
                strings.add("".join(words[single[run] : at + 1]))
            run = k + 1
    return strings


def _pieces(string: str) -> list[str]:
    string = string.strip(_AROUND) or string
    letters = "".join(filter(str.isalpha, string))
    # Signs between letters are gaps that weigh nothing: both readings count.
    readings = [string] if letters in (string, "") else [string, letters]
    return [r[at : at + LONG] for r in readings for at in range(0, max(len(r) - LONG // 2, 1), LONG // 2)]


class Triples:
    """Weighted triples of strings, over a fixed alphabet."""

    def __init__(self, alphabet: str):
        self.codes = {c: k + 2 for k, c in enumerate(alphabet[: ALPHABET - 2])}

    def of(self, strings: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(n, m) triple numbers and weights; a place that the string doesn't reach weighs 0.

        The weights of a string are scaled to a vector of length one.
        """
        width = max(map(len, strings)) + 2
        codes = np.full((len(strings), width + SPAN), -1, dtype=np.int32)
        get = self.codes.get
        for row, s in zip(codes, strings):
            row[: len(s) + 2] = [1, *[get(c, 0) for c in s], 1]
        numbers, weights = [], []
        for a, b in _OFFSETS:
            x, y, z = codes[:, :width], codes[:, a : a + width], codes[:, b : b + width]
            # An edge counts only next to its character.
            there = (z >= 0) & ~((z == 1) & (b - a > 1)) & ~((x == 1) & (a > 1))
            numbers.append(np.where(there, (x * ALPHABET + y) * ALPHABET + z, 0))
            weights.append(np.where(there, np.float32(DECAY ** (b - 2)), np.float32(0)))
        number, weight = np.concatenate(numbers, axis=1), np.concatenate(weights, axis=1)
        return number, weight / (np.sqrt(np.sum(weight * weight, axis=1, keepdims=True)) + np.float32(1e-6))


def _blocks(strings: list[str], size: int = _BLOCK) -> Iterator[np.ndarray]:
    """Positions of the strings, those of like length together."""
    order = np.argsort([len(s) for s in strings], kind="stable")
    for at in range(0, len(order), size):
        yield order[at : at + size]


class Kernel:
    def __init__(self, alphabet: str, landmarks: list[str]):
        self.triples = Triples(alphabet)
        numbers, weights = self.triples.of(landmarks)
        self.used = np.unique(numbers[weights > 0])
        self.dense = self._sparse(numbers, weights).T
        own = (self.dense.T @ self.dense).astype(np.float64)
        values, vectors = np.linalg.eigh(own)
        keep = values > 1e-6 * values[-1]
        self.root = (vectors[:, keep] / np.sqrt(values[keep])) @ vectors[:, keep].T

    def _sparse(self, numbers: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Rows over the triples that the landmarks use."""
        n, width = len(numbers), len(self.used)
        place = np.minimum(np.searchsorted(self.used, numbers), width - 1)
        weights = np.where(self.used[place] == numbers, weights, 0)
        at = (np.arange(n)[:, None] * width + place).ravel()
        return np.bincount(at, weights.ravel(), minlength=n * width).reshape(n, width).astype(np.float32)

    def features(self, strings: list[str]) -> np.ndarray:
        """The Nyström features of the strings."""
        out = np.zeros((len(strings), len(self.root)))
        for at in _blocks(strings, 400):
            out[at] = self._sparse(*self.triples.of([strings[i] for i in at])) @ self.dense @ self.root
        return out


def _svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, strength: float, steps: int = 300) -> np.ndarray:
    """Weights and bias that minimise the squared hinge loss, by accelerated gradient steps."""
    x = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    weight = weight / weight.sum()
    v = np.random.default_rng(1).normal(size=x.shape[1])
    for _ in range(30):
        v = x.T @ (weight * (x @ v))
        size = np.linalg.norm(v)
        v /= size
    rate = 1 / (2 * size + 2 * strength)
    w = last = np.zeros(x.shape[1])
    for step in range(steps):
        ahead = w + step / (step + 3) * (w - last)
        slack = np.maximum(0, 1 - y * (x @ ahead))
        gradient = -2 * x.T @ (weight * y * slack) + 2 * strength * np.append(ahead[:-1], 0)
        last, w = w, ahead - rate * gradient
    return w


@dataclass(frozen=True)
class Model:
    """The folded machine: weights by triple, bias, and the curve (slope, middle)."""

    alphabet: str
    table: np.ndarray
    bias: float
    slope: float
    middle: float

    def decisions(self, strings: list[str]) -> np.ndarray:
        """The decision for each string, that of its worst piece."""
        pieces, owner = [], []
        for k, string in enumerate(strings):
            for piece in _pieces(string):
                pieces.append(piece)
                owner.append(k)
        triples, out = Triples(self.alphabet), np.full(len(strings), -np.inf)
        owner = np.array(owner, dtype=np.int64)
        for at in _blocks(pieces):
            numbers, weights = triples.of([pieces[i] for i in at])
            np.maximum.at(out, owner[at], np.sum(self.table[numbers] * weights, axis=1) + self.bias)
        return out

    def probability(self, decision):
        return 1 / (1 + np.exp(-np.clip(self.slope * (decision - self.middle), -30, 30)))


NOTHING = Model("", np.zeros(ALPHABET**3, dtype=np.float32), -30.0, 1.0, 0.0)


def _folded(kernel: Kernel, alphabet: str, w: np.ndarray) -> Model:
    table = np.zeros(ALPHABET**3, dtype=np.float32)
    table[kernel.used] = kernel.dense @ (kernel.root @ w[:-1])
    return Model(alphabet, table, float(w[-1]), 1.0, 0.0)


def _curve(decisions: np.ndarray, toxic: np.ndarray) -> tuple[float, float]:
    """Logistic regression of the label on the documents' worst decisions."""
    x = np.stack([decisions, np.ones_like(decisions)])

    def loss(at: np.ndarray) -> float:
        z = at @ x
        return float(np.sum(np.logaddexp(0, z) - toxic * z) + 5e-4 * at @ at)

    curve = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(curve @ x, -30, 30)))
        hess = (x * (p * (1 - p))) @ x.T + 1e-3 * np.eye(2)
        step = np.linalg.solve(hess, x @ (p - toxic) + 1e-3 * curve)
        # Labels that the decisions split cleanly make whole steps leap too far.
        while loss(curve - step) > loss(curve) and np.abs(step).max() > 1e-9:
            step /= 2
        curve = curve - step
    slope = max(curve[0], 1e-3)
    return float(slope), float(-curve[1] / slope)


def fit(examples: list[tuple[str, int]]) -> Model:
    """A model from (text, label) pairs. Texts count by the strings they hold."""
    bags = [(sorted({p for s in strings_of(text) for p in _pieces(s)}), label) for text, label in sorted(examples)]
    bags = [(strings, label) for strings, label in bags if strings]
    seen = {0: Counter(), 1: Counter()}
    for strings, label in bags:
        seen[label].update(strings)
    n = {label: sum(b == label for _, b in bags) for label in seen}
    if not n[0] or not n[1]:
        return NOTHING
    clean = sorted(seen[0], key=lambda s: zlib.crc32(s.encode()))
    toxic = sorted(seen[1])
    number = {s: k for k, s in enumerate(toxic)}
    bags_of = [np.array([number[s] for s in strings]) for strings, label in bags if label]
    share = n[1] / n[0]
    judged = np.array([seen[1][s] / (seen[1][s] + share * seen[0][s] + 1) for s in toxic])
    letters = Counter(c for s in toxic for c in s)
    alphabet = "".join(sorted(letters, key=lambda c: (-letters[c], c))[: ALPHABET - 2])
    first = [toxic[k] for k in np.argsort(-judged, kind="stable")[: LANDMARKS // 2]]
    kernel = Kernel(alphabet, list(dict.fromkeys(first + clean[: LANDMARKS - len(first)])))
    negatives = set(clean[:NEGATIVES])
    for _ in range(ROUNDS):
        # A document's worst string, and any other that is as plainly toxic.
        picked = Counter(toxic[k] for bag in bags_of for k in {bag[np.argmax(judged[bag])], *bag[judged[bag] > PLAIN]})
        good, bad = sorted(negatives - set(picked)), sorted(picked)
        common = np.sqrt([max(seen[0][s], 1) for s in good])
        weights = np.concatenate([common / common.sum(), [picked[s] / picked.total() for s in bad]])
        signs = np.array([-1.0] * len(good) + [1.0] * len(bad))
        model = _folded(kernel, alphabet, _svm(kernel.features(good + bad), signs, weights, STRENGTH / len(bags_of)))
        judged, of_clean = model.decisions(toxic), model.decisions(clean)
        negatives.update(clean[k] for k in np.argsort(-of_clean, kind="stable")[:NEGATIVES] if of_clean[k] > -1)
    by_string = dict(zip(clean, of_clean)) | dict(zip(toxic, judged))
    worst = np.array([max(by_string[s] for s in strings) for strings, _ in bags])
    slope, middle = _curve(worst, np.array([float(label) for _, label in bags]))
    return replace(model, slope=slope, middle=middle)


def score(spark: SparkSession, model: Model, text: Column) -> Column:
    """The probability that a text is toxic."""
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model, known, older = shared.value, {}, {}
        for batch in batches:
            out = []
            for at in range(0, len(batch), 256):
                texts = [strings_of(text.as_py() or "") for text in batch[at : at + 256]]
                new = set().union(*texts) - known.keys()
                if len(known) + len(new) > MEMO:
                    older, known = known, {}
                    new = set().union(*texts)
                kept = {s: older[s] for s in new & older.keys()}
                new = sorted(new - kept.keys())
                known |= kept
                known |= zip(new, model.decisions(new).tolist())
                out += [max(map(known.__getitem__, strings), default=-np.inf) for strings in texts]
            worst = np.maximum(np.array(out, dtype=np.float64), model.bias)
            yield pa.array(model.probability(worst), type=pa.float64())

    return scored(text)
