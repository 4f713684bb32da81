"""Change records, current tables, upserts and wide-column cells."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.state import ranked
from millrace.sources.lines import parse_lines

DELETED = ("d", "delete")


def envelopes(df: DataFrame, value: str, row_schema: str) -> DataFrame:
    """Change records from JSON envelopes: ``op``, ``before``, ``after``, ``ts_ms``."""
    schema = f"op string, before struct<{row_schema}>, after struct<{row_schema}>, ts_ms bigint"
    # Behind a generator the text is parsed once, not again by the filter.
    parsed = df.withColumn("__e", F.explode(F.array(F.from_json(F.col(value), schema))))
    return parsed.filter(F.col("__e.op").isNotNull()).select(
        *[c for c in df.columns if c != value], "__e.*"
    )


def changes_of(envelope: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Change records as flat rows: the new row, or the old one for a delete."""
    row = F.coalesce("after", "before")
    rest = [c for c in envelope.columns if c not in ("before", "after")]
    return envelope.select(*rest, *[row.getField(c).alias(c) for c in columns])


def upsert_latest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of every key; the earlier ones are cut before the shuffle."""
    return ranked(df, keys, [F.col(c).desc() for c in order], 1).drop("rank")


def current_table(
    changes: DataFrame, keys: Sequence[str], order: Sequence[str], op: str = "op"
) -> DataFrame:
    """The table that a snapshot and its change log describe."""
    last = upsert_latest(changes, keys, order)
    return last.filter(~F.lower(F.col(op)).isin(*DELETED)).drop(op)


def upserted(
    table: DataFrame, changes: DataFrame, keys: Sequence[str], order: Sequence[str], op: str = "op"
) -> DataFrame:
    """A table with a batch of later changes applied; ``table`` keeps its order columns."""
    base = table.withColumn(op, F.lit("r"))
    return current_table(base.unionByName(changes.select(*base.columns)), keys, order, op)


def enriched(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, columns: Sequence[str]
) -> DataFrame:
    """Current rows left-joined with current rows of another table."""
    right = right.select(F.col(right_key).alias(left_key), *columns)
    return left.join(right, left_key, "left")


def hash_fields(
    df: DataFrame,
    name: Column,
    field: str,
    value: str,
    order: Sequence[str],
) -> DataFrame:
    """The last value per (hash, field), as a keyed store would hold it."""
    rows = df.select(
        name.alias("hash"), F.col(field).alias("field"),
        F.col(value).cast("string").alias("value"), *[F.col(c).alias(f"__{c}") for c in order],
    )
    ordered = [f"__{c}" for c in order]
    return upsert_latest(rows, ["hash", "field"], ordered).drop(*ordered)


def composite_name(prefix: str, *columns: str) -> Column:
    return F.concat_ws("-", F.lit(prefix), *columns)


def to_cells(df: DataFrame, rowkey: Column, columns: Sequence[str]) -> DataFrame:
    """One row per (rowkey, qualifier) with a value; empty values give no cell."""
    cells = F.array(
        *[
            F.struct(F.lit(c).alias("qualifier"), F.col(c).cast("string").alias("value"))
            for c in columns
        ]
    )
    return (
        df.select(rowkey.alias("rowkey"), F.explode(cells).alias("__cell"))
        .select("rowkey", "__cell.qualifier", "__cell.value")
        .filter(F.coalesce(F.col("value") != "", F.lit(False)))
    )


def line_cells(lines: DataFrame, order: Sequence[str], line: str = "line", separator: str = ",") -> DataFrame:
    """The last value per (rowkey, qualifier) of lines with just these three fields.

    Lines of other shapes are left out, as are empty values; ``order`` tells which is last.
    """
    cells = parse_lines(lines.select(line, *order), "rowkey string, qualifier string, value string", line, separator)
    cells = cells.filter(F.col("value") != "")
    return upsert_latest(cells, ["rowkey", "qualifier"], order).drop(*order)


def from_cells(
    cells: DataFrame,
    types: Mapping[str, str],
    start: str | None = None,
    stop: str | None = None,
    *,
    version: str,
) -> DataFrame:
    """Rows from cells with a rowkey in ``[start, stop)``; the newest version counts."""
    if start is not None:
        cells = cells.filter(F.col("rowkey") >= start)
    if stop is not None:
        cells = cells.filter(F.col("rowkey") < stop)
    newest = F.max_by("value", version)
    wide = cells.groupBy("rowkey").pivot("qualifier", list(types)).agg(newest)
    return wide.select("rowkey", *[F.col(c).cast(t).alias(c) for c, t in types.items()])
