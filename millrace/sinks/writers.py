"""Shaping rows for a target and writing them in batch."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.json import text_of


def as_lines(df: DataFrame, separator: str = ",") -> DataFrame:
    """Rows as delimited text; null cells are empty."""
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns]
    return df.select(F.concat_ws(separator, *cells).alias("value"))


def as_json(df: DataFrame, as_strings: bool = False) -> DataFrame:
    return df.select(text_of(*df.columns, as_strings=as_strings).alias("value"))


def write_lines(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    as_lines(df).write.mode(mode).text(path)


def write_control_delimited(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Files with the control characters 1 and 2 between fields and rows."""
    df.write.mode(mode).options(sep="\x01", lineSep="\x02").csv(path)


def routed(df: DataFrame, line: str, word: str, hit: str, other: str) -> DataFrame:
    return df.withColumn(
        "bucket", F.when(F.col(line).contains(word), F.lit(hit)).otherwise(F.lit(other))
    )


def write_routed(
    df: DataFrame, line: str, word: str, hit: str, other: str, path: str, files: int | None = None
) -> None:
    """Lines into one folder per route, sorted over all files of a route, duplicates kept.

    A route that holds most of the lines is spread over many files. Without ``files`` their
    number follows the session's shuffle partitions and the amount of data.
    """
    rows = routed(df.select(F.col(line).alias("value")), "value", word, hit, other)
    spread = rows.withColumn("__spread", F.monotonically_increasing_id())
    numbers = [] if files is None else [files]
    (
        spread.repartitionByRange(*numbers, "bucket", "value", "__spread")
        .sortWithinPartitions("bucket", "value")
        .drop("__spread")
        .write.partitionBy("bucket")
        .text(path)
    )


def in_order(df: DataFrame, *columns: str) -> DataFrame:
    """All rows sorted, duplicates kept.

    Equal rows differ in the last sort column, so that many copies of one row do not all
    fall into one range.
    """
    spread = df.withColumn("__spread", F.monotonically_increasing_id())
    return spread.orderBy(*columns, "__spread").drop("__spread")


def jdbc_write_options(
    url: str,
    table: str,
    *,
    batch_rows: int = 1000,
    isolation: str = "READ_COMMITTED",
    properties: Mapping[str, str] | None = None,
) -> dict[str, str]:
    return {
        "url": url,
        "dbtable": table,
        "batchsize": str(batch_rows),
        "isolationLevel": isolation,
        **(properties or {}),
    }


def write_jdbc(df: DataFrame, url: str, table: str, *, mode: str = "append", **options) -> None:
    """Batched inserts, one transaction per partition."""
    df.write.format("jdbc").options(**jdbc_write_options(url, table, **options)).mode(mode).save()


def queue_records(df: DataFrame, key: Column | None = None, *, json: bool = False) -> DataFrame:
    """Rows as records with a text value, ready for ``write.format("kafka")``."""
    value = text_of(*df.columns) if json else F.to_csv(F.struct(*df.columns))
    columns = [value.alias("value")]
    if key is not None:
        columns.insert(0, key.cast("string").alias("key"))
    return df.select(*columns)


def for_target(df: DataFrame, columns: Sequence[tuple[str, str]]) -> DataFrame:
    """The columns of a target table by name and type, in its order."""
    return df.select(*[F.col(n).cast(t).alias(n) for n, t in columns])
