"""Dense dictionaries over text values, and bitmaps over dense numbers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.ordered import Ordered
from millrace.session import pin


def dictionary(df: DataFrame, column: str, name: str = "id", after: int = 0) -> DataFrame:
    """Distinct values of a column numbered without gaps, in text order, from ``after + 1``."""
    values = df.select(column).filter(F.col(column).isNotNull()).distinct()
    # Counting, sampling and numbering read the distinct values: find them once.
    numbered = Ordered.of(pin(values), [], [column]).number(name).result()
    return numbered.withColumn(name, F.col(name) + F.lit(after))


def extended(old: DataFrame, df: DataFrame, column: str, name: str = "id") -> DataFrame:
    """A dictionary with the new values of ``df`` added; known values keep their numbers."""
    last = old.agg(F.max(name)).first()[0] or 0
    fresh = df.select(column).distinct().join(old, column, "left_anti")
    return old.unionByName(dictionary(fresh, column, name, last))


def encoded(df: DataFrame, numbers: DataFrame, column: str) -> DataFrame:
    """Rows with the number of their value, null for a value without one."""
    return df.join(numbers, column, "left")


def bitmaps(df: DataFrame, keys: Sequence[str], number: str = "id") -> DataFrame:
    """One bitmap per key and bucket of numbers, the union of all rows' single bits.

    A key's bitmap is spread over buckets of fixed width, so that its size per row is
    bounded however many numbers it has. Rows without a number set no bit.
    """
    rows = df.filter(F.col(number).isNotNull()).select(*keys, number).distinct()
    return rows.groupBy(*keys, F.bitmap_bucket_number(number).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("bits")
    )


def united(maps: DataFrame, keys: Sequence[str]) -> DataFrame:
    return maps.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def cardinality(maps: DataFrame, keys: Sequence[str]) -> DataFrame:
    return maps.groupBy(*keys).agg(F.sum(F.bitmap_count("bits")).alias("n"))


def number_lists(df: DataFrame, keys: Sequence[str], number: str = "id") -> DataFrame:
    """The numbers in each bucket of a key's bitmap as a sorted text."""
    rows = df.filter(F.col(number).isNotNull())
    rows = rows.select(*keys, F.bitmap_bucket_number(number).alias("bucket"), number).distinct()
    ids = F.array_join(F.sort_array(F.collect_list(number)).cast("array<string>"), ",")
    return rows.groupBy(*keys, "bucket").agg(ids.alias("ids"))


#: Values that a bucket should hold, and the most buckets, whose sizes one task adds up.
BUCKET_VALUES, MOST_BUCKETS = 100_000, 100_000


def hashed_dictionary(
    df: DataFrame, column: str, name: str = "id", after: int = 0, buckets: int | None = None
) -> DataFrame:
    """Distinct values numbered without gaps from ``after + 1``, bucket by bucket of their hash.

    No order over all values is needed: each bucket numbers its own, and the numbers of the
    buckets before it are added. The values are written once, numbered within their buckets;
    what is then read again for all of them are the sizes, one row per bucket. ``dictionary``
    gives the numbers in text order instead.
    """
    values = df.select(column).filter(F.col(column).isNotNull()).distinct()
    if buckets is None:
        n = df.select(F.approx_count_distinct(column)).first()[0]
        buckets = min(max(n // BUCKET_VALUES, df.sparkSession.sparkContext.defaultParallelism), MOST_BUCKETS)
    bucket = F.pmod(F.xxhash64(column), F.lit(buckets))
    window = Window.partitionBy("__bucket").orderBy(column)
    held = pin(values.withColumn("__bucket", bucket).withColumn("__i", F.row_number().over(window)))
    sizes = held.groupBy("__bucket").agg(F.count(F.lit(1)).alias("__size"))
    before = Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__bucket", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__before"))
    # One row per bucket, so of bounded size.
    numbered = held.join(F.broadcast(offsets), "__bucket")
    return numbered.select(column, (F.col("__before") + F.col("__i") + F.lit(after)).cast("bigint").alias(name))


def hashed_extended(
    old: DataFrame, df: DataFrame, column: str, name: str = "id", buckets: int | None = None
) -> DataFrame:
    """A dictionary with the new values of ``df`` numbered behind the old ones, which keep their numbers."""
    last = old.agg(F.max(name)).first()[0] or 0
    fresh = df.select(column).distinct().join(old, column, "left_anti")
    return old.select(column, name).unionByName(hashed_dictionary(fresh, column, name, last, buckets))
