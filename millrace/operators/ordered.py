"""Ordered scans that never put a large group into one task.

Running sums, row numbers, "the latest rule" and "the next match" need rows in order.
A plain window partitioned by the key sorts all rows of a key in one task, which fails
when one key holds a third of the table, and a global order has only one group at all.

``Ordered`` keeps the plain window for ordinary keys. A key with more rows than one
segment should hold is cut along the order columns at sampled positions of equal depth.
Each (key, segment) is scanned by its own task. What one segment must know of the
segments before it is one small row, computed by an ordinary aggregate, summed along
the segments of that key and joined back.

Each large key has cut points of its own, so the segments number no more than the points
and the large keys together. The points are fetched once and handed to the plan as a small
table: every branch and every retried task puts a row into the same segment, and rows equal
on all order columns stay together.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.mergeable import Mergeable, count
from millrace.session import pin

SEGMENT = "__segment"
SEGMENT_ROWS = 1_000_000
MAX_SEGMENTS = 50_000
SAMPLES_PER_SEGMENT = 20
#: The cut points, as text, that may be fetched and broadcast; longer ones make fewer segments.
POINT_BYTES = 16_000_000

JSON_FORMATS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def locate(
    df: DataFrame, name: str, bounds: Column, n: int, point: Column, start: Column | None = None
) -> DataFrame:
    """Add how many of the ``n`` ascending ``bounds`` are at or below ``point``.

    A binary search in halving steps, one column after the other, so that all of it is
    compiled. Rows with a null ``start`` get null. The last step stands behind a
    generator: a later filter on the result must not be moved below the steps, which
    would repeat each of them several times.
    """
    found = df.withColumns({"__point": point, "__at": F.lit(0) if start is None else start})
    for k in reversed(range(n.bit_length())):
        step = 1 << k
        at = F.col("__at")
        # `get` is null past the end of the bounds, which counts as no.
        below = F.get(bounds, at + (step - 1)) <= F.col("__point")
        found = found.withColumn("__at", F.when(below, at + step).otherwise(at))
    return found.withColumn(name, F.explode(F.array("__at"))).drop("__point", "__at")


def _same(left: Sequence[str], right: Sequence[str], nulls: bool) -> Column:
    """Equality of keys; null-safe only where a large key is null.

    A null-safe join hashes other expressions than the window does, which would shuffle
    the rows a second time.
    """
    condition = F.lit(True)
    for a, b in zip(left, right, strict=True):
        left_col, right_col = F.col(a), F.col(b)
        condition = condition & (left_col.eqNullSafe(right_col) if nulls else left_col == right_col)
    return condition


def _points(
    sample: DataFrame, keys: Sequence[str], order: Sequence[str], step: int
) -> tuple[DataFrame, int, bool] | None:
    """Keys with more than ``step`` sampled rows, and every ``step``-th of these as a bound.

    Also the largest number of bounds, and whether a key is null; None without large keys.
    At most a million sampled rows are ranked, as many as a range partitioning of Spark
    samples; they are thinned before any leave the executors, by number and by size.
    """
    text = F.to_json(F.struct(*dict.fromkeys([*keys, *order])), JSON_FORMATS)
    n, size = sample.agg(F.count(F.lit(1)), F.sum(F.length(text))).first()
    if n <= step:
        return None
    most = MAX_SEGMENTS * SAMPLES_PER_SEGMENT
    if n > most:
        sample, size = sample.sample(most / n, seed=11), size * most // n
    step = max(step, -(-size // POINT_BYTES))
    position = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    kept = sample.withColumn("__i", position).filter((F.col("__i") > 1) & (F.col("__i") % step == 1 % step))
    bounds = F.sort_array(F.collect_list(F.struct(*order))).alias("__bounds")
    cuts = kept.groupBy(*[F.col(k).alias(f"__hot_{k}") for k in keys]).agg(bounds)
    row = F.to_json(F.struct(*cuts.columns), JSON_FORMATS)
    null = F.lit(False)
    for name in cuts.columns[:-1]:
        null = null | F.col(name).isNull()
    found = cuts.select(row, F.size("__bounds"), null).collect()
    # Without keys and points the aggregate still gives one row.
    found = [r for r in found if r[1] > 0]
    if not found:
        return None
    texts = sample.sparkSession.createDataFrame([(r[0],) for r in found], "row string")
    hot = texts.select(F.from_json("row", cuts.schema, JSON_FORMATS).alias("row")).select("row.*")
    return hot, max(r[1] for r in found), any(r[2] for r in found)


@dataclass(frozen=True)
class Ordered:
    """Rows with the keys and order of a scan, cut where a key is too large.

    ``base`` holds the rows of the large keys without the columns that scans have added:
    the small per-segment aggregates read it, so that a later scan does not repeat an
    earlier one.
    """

    df: DataFrame
    base: DataFrame
    keys: tuple[str, ...]
    order: tuple[str, ...]
    split: bool
    null_keys: bool = False

    @classmethod
    def of(
        cls,
        df: DataFrame,
        keys: Sequence[str],
        order: Sequence[str],
        segment_rows: int | None = None,
    ) -> Ordered:
        """Measure ``df`` and cut its large keys; ``order`` must be unique within a key."""
        keys, order = tuple(keys), tuple(order)
        if segment_rows is None:
            conf = df.sparkSession.conf
            segment_rows = int(conf.get("spark.millrace.segmentRows", str(SEGMENT_ROWS)))
        share = min(1.0, SAMPLES_PER_SEGMENT / segment_rows)
        step = min(SAMPLES_PER_SEGMENT, segment_rows)
        rows = df.select(*dict.fromkeys(keys + order))
        # One pass finds the size as well: `step` sampled rows stand for a segment.
        sampled = (rows.sample(share, seed=7) if share < 1 else rows).persist()
        try:
            points = _points(sampled, keys, order, step)
        finally:
            sampled.unpersist()
        return cls._cut(df, keys, order, *points) if points else cls(df, df, keys, order, False)

    @classmethod
    def _cut(
        cls,
        df: DataFrame,
        keys: tuple[str, ...],
        order: tuple[str, ...],
        hot: DataFrame,
        most: int,
        nulls: bool,
    ) -> Ordered:
        point = F.struct(*order)
        if not keys:
            cut = locate(df, SEGMENT, hot.select("__bounds").scalar(), most, point)
            return cls(cut, cut, keys, order, True)
        names = [f"__hot_{k}" for k in keys]
        known = F.col("__bounds").isNotNull()
        cut, base = (
            locate(
                df.join(F.broadcast(hot), _same(keys, names, nulls), how),
                SEGMENT, F.col("__bounds"), most, point, start=F.when(known, 0),
            ).drop("__bounds", *names)
            for how in ("left", "inner")
        )
        return cls(cut, base, keys, order, True, nulls)

    def with_columns(self, columns: Mapping[str, Column]) -> Ordered:
        """Add columns computed from the input rows."""
        columns = dict(columns)
        return replace(
            self, df=self.df.withColumns(columns), base=self.base.withColumns(columns)
        )

    def rebased(self) -> Ordered:
        """The same rows, for scans over what earlier scans have added.

        Written as a table first, so that a chain of scans costs as much as its length
        and does not repeat the earlier ones.
        """
        if not self.split:
            return self
        rows = pin(self.df)
        return replace(self, df=rows, base=rows.filter(F.col(SEGMENT).isNotNull()))

    def narrowed(self, *extra: str) -> Ordered:
        """The same cut with further key columns, such as a day besides the user."""
        # A further column may be null within a key, so segments are joined null-safe.
        return replace(self, keys=self.keys + extra, null_keys=True)

    def result(self) -> DataFrame:
        return self.df.drop(SEGMENT)

    def _groups(self) -> list[str]:
        return [*self.keys, SEGMENT] if self.split else list(self.keys)

    def _window(self, backward: bool = False):
        order = [F.col(c).desc() if backward else F.col(c).asc() for c in self.order]
        return Window.partitionBy(*self._groups()).orderBy(*order)

    def _segments(self, backward: bool = False):
        order = F.col(SEGMENT).desc() if backward else F.col(SEGMENT).asc()
        return Window.partitionBy(*self.keys).orderBy(order)

    def _join_segments(self, rows: DataFrame, carried: DataFrame) -> DataFrame:
        groups = self._groups()
        names = [f"__of_{g}" for g in groups]
        carried = carried.withColumnsRenamed(dict(zip(groups, names, strict=True)))
        # Rows of ordinary keys have no segment and find no partner here.
        condition = _same(self.keys, names[:-1], self.null_keys)
        condition = condition & (F.col(SEGMENT) == F.col(names[-1]))
        return rows.join(carried, condition, "left").drop(*names)

    def scan(
        self,
        outputs: Mapping[str, Mergeable],
        *,
        backward: bool = False,
        inclusive: bool = True,
    ) -> Ordered:
        """Add running aggregates over the rows of the key up to this one.

        ``backward`` runs from the last row; ``inclusive=False`` leaves out the row itself.
        """
        frame = self._window(backward).rowsBetween(
            Window.unboundedPreceding, 0 if inclusive else -1
        )
        rows = self.df.withColumns({name: m.rows.over(frame) for name, m in outputs.items()})
        if not self.split:
            return replace(self, df=rows)

        # A struct is never null itself, so rows with a null in the order count as well.
        point = F.struct(*self.order)
        parts = (
            self.base.groupBy(*self._groups())
            .agg(*[m.partial(point, backward).alias(f"__{n}") for n, m in outputs.items()])
        )
        before = self._segments(backward).rowsBetween(Window.unboundedPreceding, -1)
        carried = parts.select(
            *self._groups(),
            *[m.merge(F.col(f"__{n}")).over(before).alias(f"__{n}") for n, m in outputs.items()],
        )
        joined = self._join_segments(rows, carried)
        # Merged decimals widen; results have the type that the plain window gives.
        types = {n: rows.schema[n].dataType for n in outputs}
        joined = joined.withColumns(
            {n: m.combine(F.col(f"__{n}"), F.col(n)).cast(types[n]) for n, m in outputs.items()}
        )
        return replace(self, df=joined.drop(*[f"__{n}" for n in outputs]))

    def number(self, name: str) -> Ordered:
        """Add the position of the row within its key, from 1."""
        return self.scan({name: count()})

    def shift(self, name: str, value: Column, steps: int = 1, *, backward: bool = False) -> Ordered:
        """Add ``value`` of the row ``steps`` ahead in the key (behind, if ``backward``)."""
        window = self._window(backward)
        packed = F.struct(value.alias("v"))
        rows = self.df.withColumn("__ahead", F.lead(packed, steps).over(window))
        if not self.split:
            return replace(self, df=rows.withColumn(name, F.col("__ahead.v")).drop("__ahead"))

        # The first `steps` rows of every segment, and from them the first `steps` rows
        # that follow a segment, even when the next segments are shorter than that.
        heads = (
            self.base.select(*self._groups(), packed.alias("__v"), F.row_number().over(window).alias("__i"))
            .filter(F.col("__i") <= steps)
            .groupBy(*self._groups())
            .agg(F.sort_array(F.collect_list(F.struct("__i", "__v"))).alias("__head"))
        )
        after = self._segments(backward).rowsBetween(1, steps)
        follow = heads.select(
            *self._groups(),
            F.flatten(F.collect_list("__head").over(after)).getField("__v").alias("__follow"),
        )
        whole = Window.partitionBy(*self._groups())
        rows = rows.withColumns(
            {
                "__i": F.row_number().over(window),
                "__n": F.count(F.lit(1)).over(whole),
            }
        )
        joined = self._join_segments(rows, follow)
        past = F.col("__i") + steps - F.col("__n") - 1
        value = F.when(past < 0, F.col("__ahead")).otherwise(
            F.get("__follow", past.cast("int"))
        )
        joined = joined.withColumn(name, value.getField("v"))
        return replace(self, df=joined.drop("__ahead", "__follow", "__i", "__n"))
