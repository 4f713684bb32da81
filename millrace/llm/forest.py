"""Approximate nearest neighbours by inner product in a forest of random-projection trees.

Rows get one more component, which gives all the same norm, so the largest inner product
with a query is the least distance. A tree halves the rows by their projection on a random
direction, of ``TRIES`` from a shared ``BANK`` the one that spreads them most, until a leaf
holds about ``LEAF``. Trees are fitted on the driver from about ``SAMPLE`` vectors, chosen
by hash; then each vector is put into its leaf of every tree by the tasks. A leaf keeps 16
sampled vectors, so the forest that is broadcast has at most ``TREES * SAMPLE / 8`` nodes of
18 bytes; leaves of larger tables grow instead.

A query has one priority queue for all trees. It starts with their roots; a node keeps the
priority of its parent on the query's side of a split, and on the other side is put back to
the distance from the split, if that is further. Leaves are visited as they leave the queue.
How many are visited is measured, not guessed: about ``PROBES`` queries are compared with
all vectors, and the least number by which ``target`` of their neighbours are found is taken.

Visited leaves are scored in two rounds, the second keeping only what reaches the k-th score
of the first, by matrix products in the leaf's task; a leaf that many queries visit is dealt
to several tasks, each with a copy of it. What passes is scored again in a fixed order of
additions, so a score doesn't depend on the tree or on the partitioning.

Copies: equal vectors are indexed once, with the ``k + 1`` smallest of their ids. No query
can need more of them, so none is lost, and a group of copies of any size is one candidate.

Defined cases: rows without id or vector, zero vectors, and those with null or non-finite
components take no part; shorter vectors are filled up with zeros; rows that share an id are
candidates of each other, and each query row has answers of its own; equal scores are ranked
by id; fewer candidates than k give fewer rows; an empty table none. Other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType
from pyspark.sql.window import Window

from millrace.session import pin

TREES, LEAF, SAMPLE, TRIES, BANK = 3, 1024, 32_768, 8, 256
PROBES, TARGET = 128, 0.95
#: Leaves of the first round, queries of a task's product, and visits of a leaf that one task takes.
FIRST, QUERIES, VISITS = 8, 512, 8192
_PART = 1 << 20


class Tree:
    """Nodes as arrays: direction (-1 for a leaf), threshold, and children or the leaf's number."""

    def __init__(self) -> None:
        self.direction: list[int] = []
        self.threshold: list[float] = []
        self.children: list[tuple[int, int]] = []

    def grow(self, projected: np.ndarray, rows: np.ndarray, weight: float, leaf: int, rng, leaves: list) -> int:
        """Split ``rows``, which stand for ``weight`` vectors each; the number of the new node."""
        node = len(self.direction)
        self.direction.append(-1)
        self.threshold.append(0.0)
        self.children.append((-1, -1))
        split = None
        if len(rows) * weight > leaf and len(rows) >= 32:
            split = self._split(projected, rows, rng)
        if split is None:
            self.children[node] = (len(leaves), -1)
            leaves.append(node)
            return node
        direction, threshold = split
        below = projected[rows, direction] <= threshold
        self.direction[node], self.threshold[node] = direction, threshold
        left = self.grow(projected, rows[below], weight, leaf, rng, leaves)
        right = self.grow(projected, rows[~below], weight, leaf, rng, leaves)
        self.children[node] = (left, right)
        return node

    @staticmethod
    def _split(projected: np.ndarray, rows: np.ndarray, rng) -> tuple[int, float] | None:
        order = rng.permutation(projected.shape[1])
        for at in range(0, len(order), TRIES):
            tried = order[at : at + TRIES]
            seen = projected[np.ix_(rows, tried)]
            best = int(np.argmax(seen.std(axis=0)))
            values = np.sort(seen[:, best])
            middle = len(values) // 2
            # The cut nearest to the middle between two different values.
            cuts = np.flatnonzero(values[1:] > values[:-1])
            if len(cuts):
                cut = cuts[np.argmin(np.abs(cuts + 1 - middle))]
                return int(tried[best]), float(values[cut])
        return None


class Trees:
    """A fitted forest, as it is sent to the tasks."""

    def __init__(self, x: np.ndarray, dims: int, norm: float, n: int, trees: int, leaf: int) -> None:
        self.dims, self.norm = dims, norm
        rng = np.random.default_rng(5)
        bank = rng.standard_normal((dims + 1, BANK))
        self.bank = bank / np.linalg.norm(bank, axis=0)
        projected = self.lifted(x) @ self.bank
        weight = n / max(len(x), 1)
        self.leaves, self.trees = 0, []
        for _ in range(trees):
            tree, found = Tree(), []
            tree.grow(projected, np.arange(len(x)), weight, leaf, rng, found)
            kids = np.array(tree.children, np.int32)
            direction = np.array(tree.direction, np.int16)
            kids[direction < 0, 0] += self.leaves
            self.trees.append((direction, np.array(tree.threshold), kids))
            self.leaves += len(found)

    def lifted(self, x: np.ndarray) -> np.ndarray:
        """Rows with a component that gives them the greatest norm."""
        rest = np.sqrt(np.maximum(self.norm**2 - np.sum(x * x, axis=1), 0))
        return np.concatenate([x, rest[:, None]], axis=1)

    def homes(self, x: np.ndarray) -> np.ndarray:
        """The leaf of every row in every tree."""
        projected = self.lifted(x) @ self.bank
        out = np.zeros((len(x), len(self.trees)), np.int32)
        for t, (direction, threshold, kids) in enumerate(self.trees):
            node = np.zeros(len(x), np.int32)
            while len(open_ := np.flatnonzero(direction[node] >= 0)):
                at = node[open_]
                right = projected[open_, direction[at]] > threshold[at]
                node[open_] = kids[at, right.astype(int)]
            out[:, t] = kids[node, 0]
        return out

    def visits(self, queries: np.ndarray, most: int | None) -> list[np.ndarray]:
        """The leaves of each query as they leave its queue."""
        scaled = queries * (self.norm / np.linalg.norm(queries, axis=1))[:, None]
        projected = np.concatenate([scaled, np.zeros((len(queries), 1))], axis=1) @ self.bank
        most = self.leaves if most is None else most
        out = []
        for row in projected.tolist():
            queue = [(0.0, t, 0) for t in range(len(self.trees))]
            found = []
            while queue and len(found) < most:
                away, t, node = heapq.heappop(queue)
                direction, threshold, kids = self.trees[t]
                while (d := direction[node]) >= 0:
                    gap = row[d] - threshold[node]
                    near = 1 if gap > 0 else 0
                    heapq.heappush(queue, (max(away, abs(gap)), t, int(kids[node, 1 - near])))
                    node = kids[node, near]
                found.append(int(kids[node, 0]))
            out.append(np.array(found, np.int32))
        return out


def usable(vec_id: Column, vector: Column) -> Column:
    """Whether a row takes part."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vec_id.isNotNull() & F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def vectors_of(rows: DataFrame, vector: str, vec_id: str = "vec_id") -> DataFrame:
    """(vec_id, v): the rows that take part, with float or double components."""
    kind = rows.schema[vector].dataType
    kept = isinstance(kind, ArrayType) and isinstance(kind.elementType, FloatType)
    given = rows.select(
        F.col(vec_id).cast("bigint").alias("vec_id"), F.col(vector).cast("array<float>" if kept else "array<double>").alias("v")
    )
    return given.where(usable(F.col("vec_id"), F.col("v")))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Vectors of any lengths as rows of doubles."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    lengths = np.diff(column.offsets.to_numpy())
    if (lengths == dims).all():
        return flat.reshape(len(column), dims)
    out = np.zeros((len(column), dims))
    out[np.arange(dims)[None, :] < lengths[:, None]] = flat
    return out


def _exact(query: np.ndarray, rows: np.ndarray) -> np.ndarray:
    return np.add.reduce(rows * query, axis=1)


def _best(query: np.ndarray, rows: np.ndarray, ids: np.ndarray, near: np.ndarray, floor: float, k: int) -> tuple:
    """Positions and scores of the ``k`` best rows that reach the floor, ties to the smaller id."""
    slack = 1e-9 * (1 + np.abs(near).max())
    if len(near) > k:
        floor = max(floor, np.partition(near, len(near) - k)[len(near) - k])
    at = np.flatnonzero(near >= floor - slack)
    scores = _exact(query, rows[at])
    order = np.lexsort((ids[at], -scores))[:k]
    return at[order], scores[order]


class Forest:
    """An index over (vec_id, v); ``k`` is the most that will be asked for."""

    def __init__(self, vectors: DataFrame, k: int = 20, trees: int = TREES, leaf: int = LEAF, sample: int = SAMPLE) -> None:
        self.spark, self.k = vectors.sparkSession, k
        first = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
        few = vectors.withColumn("nth", first).where(F.col("nth") <= k + 1)
        groups = few.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
        squares = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
        #: One row per different vector: at (its number), v, ids, first, norm.
        self.rows = pin(
            groups.select(
                F.monotonically_increasing_id().alias("at"), "v", "ids", F.get("ids", F.lit(0)).alias("first"), F.sqrt(squares).alias("norm")
            )
        )
        size = self.rows.agg(F.count(F.lit(1)), F.max(F.size("v")), F.max("norm")).first()
        self.n, self.dims, norm = size[0], size[1] or 1, size[2] or 1.0
        found = _chosen(self.rows, F.col("v"), sample, self.n).select("v").toArrow()["v"].combine_chunks()
        fitted = Trees(_matrix(found, self.dims) if len(found) else np.zeros((0, self.dims)), self.dims, norm, self.n, trees, leaf)
        self.fitted = fitted
        self.shared = self.spark.sparkContext.broadcast(fitted)

    def visits_for(self, asked: DataFrame, n: int, target: float, probes: int) -> tuple[int, dict[int, float]]:
        """How many leaves find ``target`` of the neighbours of some queries, and the share of queries by leaf."""
        some = _chosen(asked, F.col("v"), probes, n).toArrow()
        if not len(some) or not self.n:
            return 1, {}
        queries, own = _matrix(some["v"].combine_chunks(), self.dims), some["q"].to_numpy()
        shared, sent, k, dims = self.shared, self.spark.sparkContext.broadcast((queries, own)), self.k, self.dims

        def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            queries, own = sent.value
            for batch in batches:
                rows, at = _matrix(batch.column("v"), dims), batch.column("at").to_numpy()
                near = queries @ rows.T
                near[own[:, None] == at[None, :]] = -np.inf
                take = np.argpartition(near, max(near.shape[1] - k, 0), axis=1)[:, max(near.shape[1] - k, 0) :]
                used = np.unique(take)
                homes = shared.value.homes(rows[used])[np.searchsorted(used, take)]
                probe = np.repeat(np.arange(len(queries)), take.shape[1])
                columns = [pa.array(probe), pa.array(np.take_along_axis(near, take, axis=1).ravel()), pa.array(at[take].ravel())]
                homes = pa.array(homes.reshape(len(probe), -1).tolist(), pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([*columns, homes], ["probe", "score", "at", "homes"])

        found = self.rows.select("at", "v").mapInArrow(compared, "probe bigint, score double, at bigint, homes array<int>")
        order = Window.partitionBy("probe").orderBy(F.desc("score"), "at")
        best = found.withColumn("nth", F.row_number().over(order)).where((F.col("nth") <= k) & (F.col("score") > float("-inf")))
        ranks = np.empty((len(queries), self.fitted.leaves), np.int64)
        every = self.fitted.visits(queries, None)
        for i, leaves in enumerate(every):
            ranks[i, leaves] = np.arange(len(leaves))
        needed = sorted(min(ranks[row.probe, leaf] for leaf in row.homes) + 1 for row in best.select("probe", "homes").collect())
        most = int(needed[max(int(np.ceil(target * len(needed))) - 1, 0)]) if needed else 1
        visited = np.bincount(np.concatenate([leaves[:most] for leaves in every]), minlength=self.fitted.leaves)
        return most, dict(enumerate((visited / len(queries)).tolist()))

    def search(self, queries: DataFrame, target: float = TARGET, probes: int = PROBES) -> DataFrame:
        """query_id, rank, vec_id, score of the ``k`` nearest rows found for every row (vec_id, v) but itself."""
        k = self.k
        given = queries.select(F.col("vec_id").alias("query_id"), "v")
        asked = given.select("v").distinct().join(self.rows.select("v", "at"), "v", "left")
        # A query that isn't indexed has a number of its own.
        other = -1 - F.monotonically_increasing_id()
        asked = pin(asked.select(F.coalesce("at", other).alias("q"), "v"))
        n = asked.count()
        most, shares = self.visits_for(asked, n, target, probes)
        slices = {leaf: int(np.ceil(share * n / VISITS)) or 1 for leaf, share in shares.items()}
        plan = pin(self._planned(asked, most))
        best = None
        for begin, end in ((0, FIRST), (FIRST, most)):
            if begin >= most:
                break
            step = plan.select("q", "v", F.slice("leaves", begin + 1, end - begin).alias("leaves"))
            found = self._scored(step, best, slices).distinct()
            if best is not None:
                found = found.unionByName(best.select("q", "at", "first", "score")).distinct()
            order = Window.partitionBy("q").orderBy(F.desc("score"), "first", "at")
            best = pin(found.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= k + 1))
        # Ids of equal vectors, then a query's own row is left out.
        rows = best.join(self.rows.select("at", "ids"), "at").select("q", "at", "score", F.explode("ids").alias("id"))
        order = Window.partitionBy("q").orderBy(F.desc("score"), "id")
        flat = rows.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= k + 1)
        entry = F.struct("nth", "id", "score", (F.col("at") == F.col("q")).alias("own"))
        lists = flat.groupBy("q").agg(F.sort_array(F.collect_list(entry)).alias("found"))
        answers = given.join(lists.join(asked, "q"), "v")
        mine = F.filter("found", lambda e: e["own"] & (e["id"] == F.col("query_id")))
        left = F.get(mine, F.lit(0))["nth"]
        kept = F.slice(F.filter("found", lambda e: left.isNull() | (e["nth"] != left)), 1, k)
        return answers.select("query_id", F.posexplode(kept).alias("rank", "e")).select(
            "query_id", (F.col("rank") + 1).alias("rank"), F.col("e.id").alias("vec_id"), F.col("e.score").alias("score")
        )

    def _planned(self, asked: DataFrame, most: int) -> DataFrame:
        """q, v, leaves (as they leave the queue)."""
        shared, dims = self.shared, self.dims

        def planned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                leaves = shared.value.visits(_matrix(batch.column("v"), dims), most) if len(batch) else []
                yield batch.append_column("leaves", pa.array([x.tolist() for x in leaves], pa.list_(pa.int32())))

        kind = asked.schema["v"].dataType.simpleString()
        # Queries of one leaf come together, which makes fewer and larger products.
        plan = asked.mapInArrow(planned, f"q bigint, v {kind}, leaves array<int>")
        return plan.repartitionByRange(F.get("leaves", F.lit(0)), "q")

    def _scored(self, step: DataFrame, best: DataFrame | None, slices: dict[int, int]) -> DataFrame:
        """q, at, first, score of what the leaves of a step hold and what reaches the floor."""
        shared, dims, k = self.shared, self.dims, self.k + 1
        kind = step.schema["v"].dataType.simpleString()
        packed = "leaf int, slice int, kind int, at array<bigint>, first array<bigint>, floor array<double>, v binary"
        names = ["leaf", "slice", "kind", "at", "first", "floor", "v"]
        ints, reals = pa.list_(pa.int64()), pa.list_(pa.float64())

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            kinds = [pa.int32(), pa.int32(), pa.int32(), ints, ints, reals, pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

        def grouped(keys: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
            order = np.argsort(keys, kind="stable")
            edges = np.flatnonzero(np.diff(keys[order])) + 1
            for span in np.split(order, edges):
                yield int(keys[span[0]]), span

        def homed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not len(batch):
                    continue
                x, at, first = _matrix(batch.column("v"), dims), batch.column("at").to_numpy(), batch.column("first").to_numpy()
                for homes in shared.value.homes(x).T:
                    for leaf, rows in grouped(homes):
                        values = (at[rows].tolist(), first[rows].tolist(), [], x[rows].tobytes())
                        yield batch_of([(leaf, s, 0, *values) for s in range(slices.get(leaf, 1))])

        def visiting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for start in range(0, len(batch), QUERIES):
                    some = batch.slice(start, QUERIES)
                    x, q, floor = _matrix(some.column("v"), dims), some.column("q").to_numpy(), some.column("floor").to_numpy(zero_copy_only=False)
                    lists = some.column("leaves").to_pylist()
                    leaves = np.array([leaf for row in lists for leaf in row], np.int64)
                    owner = np.repeat(np.arange(len(lists)), [len(row) for row in lists])
                    if not len(leaves):
                        continue
                    for leaf, span in grouped(leaves):
                        mine = owner[span]
                        slice_ = int(q[mine[0]] % slices.get(leaf, 1))
                        yield batch_of([(leaf, slice_, 1, q[mine].tolist(), [], floor[mine].tolist(), x[mine].tobytes())])

        def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            leaf, parts, members = None, [], None
            for batch in batches:
                for row in batch.to_pylist():
                    vectors = np.frombuffer(row["v"]).reshape(-1, dims)
                    if (row["leaf"], row["slice"]) != leaf:
                        leaf, parts, members = (row["leaf"], row["slice"]), [], None
                    if row["kind"] == 0:
                        parts.append((np.array(row["at"], np.int64), np.array(row["first"], np.int64), vectors))
                        continue
                    if not parts:
                        continue
                    if members is None:
                        members = tuple(map(np.concatenate, zip(*parts)))
                    yield _matched(vectors, row["at"], row["floor"], *members, k)

        if best is None:
            step = step.withColumn("floor", F.lit(float("-inf")))
        else:
            floors = best.where(F.col("nth") == k).select("q", F.col("score").alias("floor"))
            step = step.join(floors, "q", "left").withColumn("floor", F.coalesce("floor", F.lit(float("-inf"))))
        asked = step.select("q", F.col("v").cast(kind).alias("v"), "leaves", "floor").mapInArrow(visiting, packed)
        rows = self.rows.select("at", "first", "v").mapInArrow(homed, packed)
        both = rows.unionByName(asked).repartition("leaf", "slice").sortWithinPartitions("leaf", "slice", "kind")
        return both.mapInArrow(scored, "q bigint, at bigint, first bigint, score double")


def _matched(queries: np.ndarray, q: list, floors: list, at: np.ndarray, first: np.ndarray, rows: np.ndarray, k: int) -> pa.RecordBatch:
    """The best rows of a leaf for each of its queries."""
    found = []
    for begin in range(0, len(queries), QUERIES):
        near = queries[begin : begin + QUERIES] @ rows.T
        for i, line in enumerate(near, begin):
            positions, scores = _best(queries[i], rows, first, line, floors[i], k)
            found.append((np.full(len(positions), q[i]), at[positions], first[positions], scores))
    columns = [np.concatenate(c) for c in zip(*found)]
    return pa.RecordBatch.from_arrays(list(map(pa.array, columns)), ["q", "at", "first", "score"])


def _chosen(rows: DataFrame, value: Column, size: int, n: int) -> DataFrame:
    """About ``size`` of ``n`` rows, by the hashes of a value; all, if there are no more."""
    if n <= size:
        return rows
    return rows.where(F.pmod(F.xxhash64(value), F.lit(_PART)) < int(size / n * _PART) + 1)
