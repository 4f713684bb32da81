"""Top-k against all products."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from millrace.llm import queries, topk
from tests.compare import oracle, spark_bag, sql_bag


def brute(vectors, queries, k):
    out = []
    for q in sorted(queries):
        scores = []
        for i, v in vectors.items():
            if i != q:
                score = sum(a * b for a, b in zip(vectors[q], v))
                scores.append((-max(-(1 << 63), min((1 << 63) - 1, score)), i))
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scores)[:k])]
    return out


def run(spark, vectors, queries, k, block):
    df = spark.createDataFrame(list(vectors.items()), "vec_id bigint, v array<bigint>")
    found = topk.PivotIndex(df, block).search(df.where(F.col("vec_id").isin(list(queries))), k)
    return sorted(map(tuple, found.collect()))


@pytest.mark.parametrize("kind", ["clusters", "ties", "huge", "uneven", "few"])
def test_against_all_products(spark, kind):
    rng = random.Random(kind)
    n, dims, top = (7 if kind == "few" else 400), 6, (1 << 40 if kind == "huge" else 30)
    centres = [[rng.randint(-top, top) for _ in range(dims)] for _ in range(5)]
    vectors = {}
    for i in range(n):
        if kind == "ties":
            v = rng.choice(centres)
        else:
            v = [c + rng.randint(-3, 3) for c in rng.choice(centres)]
        vectors[i - 20] = v[: rng.randint(0, dims)] if kind == "uneven" else v
    queries = {i for i in vectors if i % 20 == 0}
    assert run(spark, vectors, queries, 5, 32) == brute(vectors, queries, 5)


def test_rows_that_share_an_id(spark, tmp_path):
    """The query against its SQL and all products, where ids and whole rows repeat."""
    rng = random.Random(2)
    rows = [(rng.randrange(-20, 60), [rng.randint(-8, 8) / 8 for _ in range(4)]) for _ in range(300)]
    rows += [(5, [1.0, 1.0, 0.0, 0.0]), (5, [3.0, 3.0, 0.0, 0.0]), *[(20, [2.0] * 4)] * 3]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    query = queries.QUERIES["op3_top_k"]
    con = oracle("/root/testdata/sf0.001")
    con.execute(f"CREATE OR REPLACE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    found = spark_bag(query.plan(spark, str(tmp_path)))
    assert found == sql_bag(con, query.sql)
    whole, expected = [(i, [int(64 * x) for x in v]) for i, v in rows], []
    for at, (q, v) in enumerate(whole):
        if q % 20 == 0:
            scores = sorted((-sum(map(int.__mul__, v, w)), i) for other, (i, w) in enumerate(whole) if other != at)
            expected += [(q, r + 1, s, i) for r, (s, i) in enumerate((-s, i) for s, i in scores[:20])]
    assert Counter(found[1]) == Counter(expected)


def test_bounds_stop_the_search(spark):
    """Queries near one pivot leave the far annuli alone."""
    vectors = {i: [100 + i % 7, 0] if i < 200 else [-100 - i % 7, 0] for i in range(400)}
    df = spark.createDataFrame(list(vectors.items()), "vec_id bigint, v array<bigint>")
    index = topk.PivotIndex(df, 16)
    asked = topk.pin(index._placed(df.where("vec_id = 0"), 8).withColumnRenamed("block", "qblock"))
    # Rows without a number go by their ids.
    best = index.search(df.where("vec_id = 0"), 5).withColumn("q", F.col("query_id"))
    step = index.annuli.crossJoin(asked.select("qblock").distinct()).withColumn("reach", F.lit(float("inf")))
    far = {r.block for r in index.annuli.join(index.rows, "block").where("vec_id >= 200").select(index.annuli.block).collect()}
    scored = index._scored(step, asked, best, 5).select("vec_id").collect()
    assert far and all(r.vec_id < 200 for r in scored)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.5]), (0, [0.25, 0.5]), (1, [nan, 1.0]), (2, None), (3, [inf, 1.0]), (4, [1.0, None]), (None, [1.0]), (5, []), (6, [-0.01])]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id bigint, e array<float>, v int")
    vectors = topk.vectors_of(df, topk.whole(F.col("e")))
    assert sorted((r.vec_id, r.v) for r in vectors.collect()) == [(0, [16, 32]), (0, [64, 32]), (5, []), (6, [-1])]
    found = topk.PivotIndex(vectors).search(vectors.where("vec_id = 0"), 20)
    # The two rows of one id are each other's candidates.
    assert sorted(map(tuple, found.collect())) == sorted(
        [(0, 1, 0, 2048), (0, 1, 0, 2048), (0, 2, 5, 0), (0, 2, 5, 0), (0, 3, 6, -16), (0, 3, 6, -64)])
    none = vectors.where("false")
    assert topk.PivotIndex(none).search(none).collect() == []
