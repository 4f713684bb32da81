"""A table that a stream of changes keeps up to date, as files in a shared folder."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.cdc import upsert_latest
from millrace.streaming.batches import read_or_none
from millrace.streaming.changes import HOLDS, KIND


class KeyedTable:
    """The last row of every key, from changes that carry their kind.

    A micro-batch writes the last change of each key it touches, in a folder of its number,
    so one that runs again replaces its own. Every ``compact`` micro-batches these are merged
    into a base, which readers take together with the changes behind it; until it is whole
    they take the one before. Where a key changes more than once in a micro-batch, ``order``
    says which change is last; an addition goes before a withdrawal at the same place.
    """

    def __init__(self, folder: str, keys: Sequence[str], order: Sequence[str] = (), compact: int = 20) -> None:
        self.folder, self.keys, self.order, self.compact = folder, list(keys), list(order), compact

    def write(self, changes: DataFrame, number: int) -> None:
        ranked = changes.withColumn("__holds", F.col(KIND).isin(*HOLDS))
        last = upsert_latest(ranked, self.keys, [*self.order, "__holds"]).drop("__holds")
        last.write.mode("overwrite").parquet(f"{self.folder}/changes/batch={number}")
        if self.compact and number % self.compact == self.compact - 1:
            rows = self._rows(changes.sparkSession, number)
            rows.drop("batch").write.mode("overwrite").parquet(f"{self.folder}/base/batch={number}")

    def read(self, spark: SparkSession) -> DataFrame | None:
        """The table as the last micro-batch left it; None before the first."""
        rows = self._rows(spark, None)
        return None if rows is None else rows.drop("batch", KIND)

    def _rows(self, spark: SparkSession, number: int | None) -> DataFrame | None:
        """Live rows from the last base before ``number`` and the changes behind it."""
        changes = read_or_none(spark, f"{self.folder}/changes")
        if changes is None:
            return None
        if number is not None:
            changes = changes.filter(F.col("batch") <= number)
        start = self._base(spark, number)
        if start is not None:
            base = spark.read.parquet(f"{self.folder}/base/batch={start}").withColumn("batch", F.lit(start))
            changes = changes.filter(F.col("batch") > start).unionByName(base)
        last = upsert_latest(changes, self.keys, ["batch"])
        return last.filter(F.col(KIND).isin(*HOLDS))

    def _base(self, spark: SparkSession, number: int | None) -> int | None:
        """The number of the last whole base."""
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/base/batch=*/_SUCCESS")
        found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or []
        numbers = [int(f.getPath().getParent().getName().removeprefix("batch=")) for f in found]
        return max((n for n in numbers if number is None or n < number), default=None)


def folded(changes: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """The table that a log of additive results describes: withdrawals count against additions."""
    sign = F.when(F.col(KIND).isin(*HOLDS), 1).otherwise(-1)
    sums = changes.groupBy(*keys).agg(F.sum(sign).alias("__rows"), *[F.sum(sign * F.col(v)).alias(v) for v in values])
    return sums.filter(F.col("__rows") > 0).drop("__rows")
