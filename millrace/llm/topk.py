"""Exact top-k by inner product over a pivot-distance index.

Vectors are keyed by their nearest pivot and their distance to it, sorted by this key, and
cut into blocks of at most ``BLOCK`` rows, so a block is an annulus around a pivot, or a
part of one where many vectors lie at one distance. Its summary is the pivot, the least and
greatest distance, and the greatest norm. Queries form blocks in the same way.

For a vector x at distance r from pivot p, the triangle inequality gives
|q - x| >= | |q - p| - r |, which bounds the inner product (|q|^2 + |x|^2 - |q - x|^2) / 2;
|q| |x| bounds it too. Each block of queries sorts the annuli by this bound and expands over
them in ``ROUNDS`` steps. After a step a query's k-th score is its floor, and it goes on to
those annuli only whose bound reaches the floor; where none does, it has stopped. A pair
(query, annulus) is searched by a matrix product in the annulus' task.

Bounds carry a margin for rounding and scores are exact integers, so the answer doesn't
depend on the index. Pivots are fitted on at most ``SAMPLE`` vectors; all are indexed.

Defined cases: null vectors and those with null or non-finite components take no part, nor
does a null id; vectors of unequal lengths are filled up with zeros, so an empty one scores
0; rows that share an id are candidates of each other, and each query row has answers of its
own; equal scores are ranked by id; an empty table has no answers. Components are floor(64 x) as whole
numbers of 64 bits; scores beyond that are held at its ends. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.session import pin

PIVOTS, SAMPLE = 32, 4096
#: Vectors in a block of the index, and queries in a block or in one product.
BLOCK, QUERIES = 4096, 1024
#: Annuli that a block of queries has visited after each step; then all that are left.
ROUNDS = (2, 10)
#: Up to here products are exact in double precision, and with a position fit 64 bits.
_EXACT = float(1 << 50)


def whole(vector: Column, scale: int = 64) -> Column:
    """floor(scale * x) of the components; null for a vector that takes no part."""
    numbers = vector.cast("array<double>")
    finite = F.forall(numbers, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(finite, F.transform(numbers, lambda x: F.floor(x * scale).cast("bigint")))


def vectors_of(rows: DataFrame, vector: Column, vec_id: str = "vec_id") -> DataFrame:
    """(row, vec_id, v): the rows that have an id and a vector, written once with a number each."""
    found = rows.select(F.col(vec_id).cast("bigint").alias("vec_id"), vector.alias("v"))
    found = found.where("vec_id IS NOT NULL AND v IS NOT NULL")
    return pin(found.select(F.monotonically_increasing_id().alias("row"), "vec_id", "v"))


def _numbered(vectors: DataFrame) -> DataFrame:
    """Rows without a number are told apart by their ids."""
    return vectors if "row" in vectors.columns else vectors.withColumn("row", F.col("vec_id"))


def _matrix(vectors: pa.Array, dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(vectors.to_pylist()), dtype="<i8").reshape(len(vectors), dims)


def fitted_pivots(vectors: DataFrame, dims: int, pivots: int = PIVOTS, sample: int = SAMPLE) -> np.ndarray:
    """Centres of a few rounds of k-means, begun with vectors far from each other."""
    rows = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).collect()
    x = np.zeros((len(rows), dims))
    for at, row in zip(x, rows):
        at[: len(row.v)] = row.v
    if not len(x):
        return np.zeros((1, dims))
    centres = x[:1]
    away = np.sum((x - centres[0]) ** 2, axis=1)
    while len(centres) < pivots and away.max() > 0:
        centres = np.concatenate([centres, x[[np.argmax(away)]]])
        away = np.minimum(away, np.sum((x - centres[-1]) ** 2, axis=1))
    for _ in range(4):
        nearest = np.argmin(((x[:, None, :] - centres[None]) ** 2).sum(axis=2), axis=1)
        for k in range(len(centres)):
            if (mine := x[nearest == k]).size:
                centres[k] = mine.mean(axis=0)
    return centres


class PivotIndex:
    """An index over (row, vec_id, v array<bigint>); without ``row`` the ids must be unique."""

    def __init__(self, vectors: DataFrame, block: int = BLOCK):
        spark = vectors.sparkSession
        self.dims = vectors.agg(F.max(F.size("v"))).first()[0] or 0
        self.pivots = spark.sparkContext.broadcast(fitted_pivots(vectors, self.dims))
        self.rows = pin(self._placed(vectors, block))
        self.annuli = pin(
            self.rows.groupBy("block", "pivot").agg(
                F.min("dist").alias("inner"), F.max("dist").alias("outer"), F.max("norm").alias("most")
            )
        )

    def _placed(self, vectors: DataFrame, size: int) -> DataFrame:
        """row, vec_id, vector (packed), norm, far (distance to each pivot), pivot, dist, block."""
        dims, pivots = self.dims, self.pivots
        filled = F.slice(F.concat("v", F.array_repeat(F.lit(0).cast("bigint"), dims)), 1, dims) if dims else F.col("v")

        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            centres = pivots.value
            for batch in batches:
                x = batch.column("v").flatten().to_numpy(zero_copy_only=False).astype("<i8").reshape(len(batch), dims)
                real = x.astype(np.float64)
                far = np.stack([np.sqrt(np.sum((real - c) ** 2, axis=1)) for c in centres], axis=1)
                near = np.argmin(far, axis=1).astype(np.int32) if len(x) else np.zeros(0, np.int32)
                columns = [
                    batch.column("row"),
                    batch.column("vec_id"),
                    pa.array([row.tobytes() for row in x], pa.binary()),
                    pa.array(np.sqrt(np.sum(real**2, axis=1))),
                    pa.array(far.tolist(), pa.list_(pa.float64())),
                    pa.array(near),
                    pa.array(far[np.arange(len(x)), near]),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["row", "vec_id", "vector", "norm", "far", "pivot", "dist"])

        kind = "row bigint, vec_id bigint, vector binary, norm double, far array<double>, pivot int, dist double"
        rows = _numbered(vectors).select("row", "vec_id", filled.alias("v")).mapInArrow(place, kind)

        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            base, block, pivot, used = TaskContext.get().partitionId() << 32, 0, None, 0
            for batch in batches:
                numbers = []
                for p in batch.column("pivot").to_pylist():
                    if p != pivot or used == size:
                        block, pivot, used = block + 1, p, 0
                    used += 1
                    numbers.append(base + block)
                yield batch.append_column("block", pa.array(numbers, pa.int64()))

        order = ["pivot", "dist", "vec_id", "row"]
        return rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(cut, f"{kind}, block bigint")

    def search(self, queries: DataFrame, k: int = 20) -> DataFrame:
        """query_id, rank, vec_id, score of the ``k`` best rows with other ids for each query."""
        asked = pin(self._placed(queries, QUERIES).withColumnRenamed("block", "qblock"))
        reach = asked.select("qblock", "norm", F.posexplode("far").alias("pivot", "d")).groupBy("qblock", "pivot")
        reach = reach.agg(F.min("d").alias("near"), F.max("d").alias("wide"), F.max("norm").alias("norm"))
        gap = F.greatest(F.lit(0.0), F.col("inner") - F.col("wide"), F.col("near") - F.col("outer"))
        # Annuli in the order of their bounds; where they tie, the nearest first.
        order = Window.partitionBy("qblock").orderBy(F.desc(_bound(gap)), gap, "block")
        sorted_ = pin(
            reach.join(self.annuli, "pivot").select(
                "qblock", "block", "pivot", "inner", "outer", "most", _bound(gap).alias("reach"), F.row_number().over(order).alias("nth")
            )
        )
        best, begin = None, 0
        for end in (*ROUNDS, None):
            step = sorted_.where(F.col("nth") > begin) if end is None else sorted_.where(F.col("nth").between(begin + 1, end))
            found = self._scored(step, asked, best, k)
            best = pin(_ranked(found if best is None else found.unionByName(best.drop("rank")), k))
            begin = end
        return best.select("query_id", "rank", "vec_id", "score")

    def _scored(self, step: DataFrame, asked: DataFrame, best: DataFrame | None, k: int) -> DataFrame:
        """The scores of one step that can matter: q and row (numbers), query_id, vec_id, score."""
        asked = asked.select("qblock", "row", "vec_id", "vector", "norm", "far")
        if best is None:
            asked = asked.withColumn("floor", F.lit(None).cast("bigint"))
        else:
            floors = best.where(F.col("rank") == k).select(F.col("q").alias("row"), F.col("score").alias("floor"))
            asked = asked.join(floors, "row", "left")
            # Annuli that no query of a block can want any more form no pairs.
            least = F.min(F.coalesce("floor", F.lit(-(1 << 63)))).alias("least")
            blocks = asked.groupBy("qblock").agg(least)
            step = step.join(blocks, "qblock").where(F.col("reach") >= F.col("least")).drop("least")
        step = step.drop("reach")
        pairs = asked.join(step, "qblock")
        d = F.get("far", "pivot")
        gap = F.greatest(F.lit(0.0), F.col("inner") - d, d - F.col("outer"))
        pairs = pairs.where(F.col("floor").isNull() | (_bound(gap) >= F.col("floor")))
        pairs = pairs.select("block", F.lit(1).alias("kind"), "row", "vec_id", "vector", "floor")
        rows = self.rows.join(pairs.select("block").distinct(), "block", "left_semi")
        rows = rows.select("block", F.lit(0).alias("kind"), "row", "vec_id", "vector", F.lit(None).cast("bigint").alias("floor"))
        both = rows.unionByName(pairs).repartition("block").sortWithinPartitions("block", "kind", "vec_id", "row")
        return both.mapInArrow(_products(self.dims, k), "q bigint, query_id bigint, row bigint, vec_id bigint, score bigint")


def _bound(gap: Column) -> Column:
    """The greatest inner product across a gap, with a margin for rounding."""
    squares = F.col("norm") * F.col("norm") + F.col("most") * F.col("most")
    return F.least(F.col("norm") * F.col("most"), (squares - gap * gap) / 2) + squares * 1e-9 + 1e-6


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _products(dims: int, k: int):
    """Rows sorted by block, vectors before queries: scores of each block's queries."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, parts, members = None, [], None
        for batch in batches:
            blocks, kinds = batch.column("block").to_numpy(), batch.column("kind").to_numpy()
            edges = np.flatnonzero((np.diff(blocks) != 0) | (np.diff(kinds) != 0)) + 1
            for begin, end in zip([0, *edges.tolist()], [*edges.tolist(), len(batch)]):
                if begin == end:
                    continue
                run = batch.slice(begin, end - begin)
                if blocks[begin] != block:
                    block, parts, members = blocks[begin], [], None
                keys, ids = run.column("row").to_numpy(), run.column("vec_id").to_numpy()
                matrix = _matrix(run.column("vector"), dims)
                if kinds[begin] == 0:
                    parts.append((keys, ids, matrix))
                    continue
                if members is None:
                    members = tuple(map(np.concatenate, zip(*parts)))
                floors = run.column("floor").fill_null(-(1 << 63)).to_numpy()
                for at in range(0, len(ids), QUERIES):
                    span = slice(at, at + QUERIES)
                    yield _best(keys[span], ids[span], matrix[span], floors[span], *members, k)

    return scored


def _best(query_keys, query_ids, queries, floors, keys, ids, vectors, k: int) -> pa.RecordBatch:
    """The ``k`` best of ``vectors``, which are in order of id, that reach a query's floor."""
    n = len(ids)
    most = np.sqrt((queries.astype(float) ** 2).sum(axis=1).max() * (vectors.astype(float) ** 2).sum(axis=1).max())
    if most * (n + 1) < _EXACT:
        scores = (queries.astype(np.float64) @ vectors.T.astype(np.float64)).astype(np.int64)
        # Of equal scores the one that comes first is the greater.
        ranks = scores * n + np.arange(n - 1, -1, -1)
        ranks[query_keys[:, None] == keys[None, :]] = -(1 << 63)
        top = np.argpartition(ranks, max(n - k, 0), axis=1)[:, max(n - k, 0) :]
    else:
        exact = queries.astype(object) @ vectors.T.astype(object)
        scores = np.clip(exact, -(1 << 63), (1 << 63) - 1).astype(np.int64)
        own = query_keys[:, None] == keys[None, :]
        top = np.stack([np.lexsort((keys, ids, [-int(s) for s in row], mine))[:k] for row, mine in zip(scores, own)])
    rows = np.arange(len(query_ids))[:, None]
    keep = (scores[rows, top] >= floors[:, None]) & (keys[top] != query_keys[:, None])
    asked = [np.broadcast_to(column[:, None], top.shape)[keep] for column in (query_keys, query_ids)]
    columns = (*asked, keys[top][keep], ids[top][keep], scores[rows, top][keep])
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["q", "query_id", "row", "vec_id", "score"])
