"""Grouped, running and salted aggregates, and their changelogs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.mergeable import Mergeable, count, earliest
from millrace.operators.ordered import Ordered
from millrace.operators.project import split_rows


def grouped(df: DataFrame, keys: Sequence[str], outputs: Mapping[str, Mergeable]) -> DataFrame:
    return df.groupBy(*keys).agg(*[m.rows.alias(n) for n, m in outputs.items()])


def word_count(df: DataFrame, column: str, pattern: str = ",") -> DataFrame:
    return split_rows(df, column, pattern).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    outputs: Mapping[str, Mergeable],
    first: Sequence[str] = (),
) -> DataFrame:
    """Every row with the aggregates of its key so far.

    Columns named in ``first`` take the value of the key's first row, as a stream that
    keeps one record per key and updates only the aggregated field would show them.
    """
    scans = dict(outputs)
    scans.update({f"__first_{c}": earliest(F.struct(F.col(c).alias("v"))) for c in first})
    rows = Ordered.of(df, keys, order).scan(scans).result()
    rows = rows.withColumns({c: F.col(f"__first_{c}").getField("v") for c in first}) if first else rows
    return rows.drop(*[f"__first_{c}" for c in first])


def count_changelog(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The changes that a running group count makes to its result table.

    The first row of a group inserts (+I); each further row withdraws the old count (-U)
    and adds the new one (+U).
    """
    rows = Ordered.of(df.select(*dict.fromkeys([*keys, *order])), keys, order).number("n").result()
    added = F.struct(
        F.when(F.col("n") == 1, F.lit("+I")).otherwise(F.lit("+U")).alias("kind"),
        F.col("n").alias("n"),
    )
    withdrawn = F.when(F.col("n") > 1, F.struct(F.lit("-U").alias("kind"), (F.col("n") - 1).alias("n")))
    change = F.explode(F.array_compact(F.array(withdrawn, added)))
    return rows.withColumn("__change", change).select(
        *dict.fromkeys([*keys, *order]), "__change.kind", "__change.n"
    )


def additions(changelog: DataFrame) -> DataFrame:
    return changelog.filter(F.col("kind") != "-U").drop("kind")


def replayed(changelog: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The result table that a count changelog describes."""
    sign = F.when(F.col("kind") == "-U", -F.col("n")).otherwise(F.col("n"))
    return changelog.groupBy(*keys).agg(F.sum(sign).alias("n"))


def salted(
    df: DataFrame,
    keys: Sequence[str],
    salt: str,
    outputs: Mapping[str, Mergeable],
) -> DataFrame:
    """Aggregate by key and salt first and merge the parts by key.

    Spark's partial aggregation does the same for most plans; the explicit salt also
    spreads keys whose parts are still many, such as one window over all rows.
    """
    parts = grouped(df, [*keys, salt], outputs)
    return parts.groupBy(*keys).agg(
        *[m.merge(F.col(n)).cast(parts.schema[n].dataType).alias(n) for n, m in outputs.items()]
    )


def distinct_in(df: DataFrame, keys: Sequence[str], column: str, name: str = "n") -> DataFrame:
    """Exact number of distinct values per key: one row per pair first, then a count."""
    pairs = df.select(*keys, column).filter(F.col(column).isNotNull()).distinct()
    return grouped(pairs, keys, {name: count()})
