"""The forest against all products: recall, exact scores, copies, ties and odd vectors."""

import math
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest

from millrace.llm import forest, queries
from tests.conftest import MEDIUM

SCHEMA = "vec_id long, v array<double>, at int, q int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2) for i, v in rows], SCHEMA)


def run(spark, rows, k, queried=lambda i: i % 20 == 0, **options):
    vectors = forest.vectors_of(frame(spark, rows), "v")
    asked = vectors.where(vectors.vec_id.isin([i for i, _ in rows if i is not None and queried(i)]))
    found = forest.Forest(vectors, k, **options).search(asked)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(map(tuple, found.collect()))


def all_products(rows, k, queried=lambda i: i % 20 == 0):
    """Answers of every query row, as lists of (id, score)."""
    out = []
    for at, (q, v) in enumerate(rows):
        if queried(q):
            scores = [(-sum(a * b for a, b in zip(v, w)), i) for other, (i, w) in enumerate(rows) if other != at]
            out.append((q, [(i, -s) for s, i in sorted(scores)[:k]]))
    return out


def test_recall_on_the_given_table(spark):
    table = pq.read_table(f"{MEDIUM}/embeddings.parquet").to_pydict()
    ids, x = np.array(table["vec_id"]), np.array(table["embedding"], np.float64)
    found = {}
    for row in queries.QUERIES["op12_neighbours"].plan(spark, MEDIUM).collect():
        found.setdefault(row.query_id, []).append(row)
    place, hits = {i: at for at, i in enumerate(ids.tolist())}, 0
    asked = [i for i in ids.tolist() if i % 20 == 0]
    assert sorted(found) == sorted(asked)
    for q in asked:
        scores = x @ x[place[q]]
        scores[place[q]] = -np.inf
        rows = sorted(found[q], key=lambda r: r.rank)
        assert [r.rank for r in rows] == list(range(1, 21)) and len({r.vec_id for r in rows} - {q}) == 20
        assert all(math.isclose(r.score, x[place[q]] @ x[place[r.vec_id]], abs_tol=1e-12) for r in rows)
        assert [(-r.score, r.vec_id) for r in rows] == sorted((-r.score, r.vec_id) for r in rows)
        hits += len(set(np.argsort(-scores)[:20].tolist()) & {place[r.vec_id] for r in rows})
    assert hits >= 0.9 * 20 * len(asked)


def test_recall_where_few_leaves_are_visited(spark, monkeypatch):
    """Clustered vectors of different norms: most leaves stay closed, several rounds and slices."""
    monkeypatch.setattr(forest, "VISITS", 10)
    monkeypatch.setattr(forest, "FIRST", 2)
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((40, 8)) * 5
    x = centres[rng.integers(0, 40, 4000)] + rng.standard_normal((4000, 8)) * 0.3
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    vectors = forest.vectors_of(frame(spark, rows), "v")
    index = forest.Forest(vectors, 10, leaf=64, sample=2000)
    asked = vectors.where("vec_id % 20 = 0")
    found = {}
    for r in index.search(asked).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    near = x[::20] @ x.T
    near[np.arange(200), np.arange(0, 4000, 20)] = -np.inf
    true = np.argsort(-near, axis=1)[:, :10]
    recall = np.mean([len(found[20 * i] & set(row.tolist())) / 10 for i, row in enumerate(true)])
    rows_asked = asked.selectExpr("vec_id AS q", "v")
    most, _ = index.visits_for(rows_asked, 200, 0.95, 128)
    assert recall >= 0.9
    assert most < index.fitted.leaves / 3


@pytest.mark.parametrize("size", [1, 3, 60])
def test_all_leaves_give_all_answers(spark, size):
    """Copies, ties, repeated ids and negative scores, in one leaf."""
    rng = np.random.default_rng(size)
    rows = [(int(i), rng.integers(-2, 3, 3).astype(float).tolist()) for i in rng.integers(-20, 60, size)]
    rows = [(i, v if any(v) else [1.0, 0.0, 0.0]) for i, v in rows]
    expected = all_products(rows, 4)
    found = run(spark, rows, 4)
    assert Counter(found) == Counter((q, r + 1, i, s) for q, best in expected for r, (i, s) in enumerate(best))


def test_many_copies(spark):
    """More copies than are kept: the smallest ids answer, and each query leaves itself out."""
    rows = [(i, [3.0, 4.0]) for i in range(300)] + [(1000 + i, [0.1 * i, 1.0]) for i in range(5)]
    found = run(spark, rows, 4)
    by = {}
    for q, _, i, score in found:
        by.setdefault(q, []).append((i, score))
    assert by[0] == [(i, 25.0) for i in (1, 2, 3, 4)]
    assert by[280] == [(i, 25.0) for i in (0, 1, 2, 3)]


def test_odd_vectors(spark):
    nan, inf = math.nan, math.inf
    rows = [(0, [1.0]), (1, [nan, 1.0]), (2, None), (3, [inf]), (4, [1.0, None]), (None, [1.0]), (5, []), (6, [0.0, 0.0]), (7, [0.5, 2.0])]
    assert run(spark, rows, 3) == [(0, 1, 7, 0.5)]
    assert run(spark, [(0, [2.0])], 3) == []
    assert run(spark, [], 3) == []
