"""Text lines and their parsing into typed rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from millrace.functions.text import without_empty_end


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of all files at ``path`` in the column ``line``."""
    return spark.read.text(path).withColumnRenamed("value", "line")


def stream_lines(spark: SparkSession, folder: str, files_per_batch: int = 100) -> DataFrame:
    """Lines of files as they land in ``folder``; bounded work per micro-batch."""
    stream = spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(folder)
    return stream.withColumnRenamed("value", "line")


def _parsed(
    df: DataFrame, line: str, schema: StructType, separator: str, keep_empty_end: bool
) -> DataFrame:
    """Add ``__row``: the typed fields and, for a wrong number or type of them, ``__bad``."""
    options = {
        "sep": separator,
        "quote": "",
        "ignoreLeadingWhiteSpace": "true",
        "ignoreTrailingWhiteSpace": "true",
        "columnNameOfCorruptRecord": "__bad",
    }
    whole = [f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields]
    whole.append("`__bad` string")
    kept = F.col(line) if keep_empty_end else without_empty_end(line, separator)
    # A cheap count of fields first: the reader raises and catches an error per bad line.
    separators = F.length(kept) - F.length(F.replace(kept, F.lit(separator)))
    row = F.when(
        separators == len(separator) * (len(schema.fields) - 1),
        F.from_csv(kept, ", ".join(whole), options),
    )
    # Behind a generator a line is parsed once. A filter on a plain column would be moved
    # below it and parse the line again for every field that it tests.
    return df.withColumn("__row", F.explode(F.array(row)))


def _valid(schema: StructType) -> Column:
    """Every field is there. An empty text counts as a value, an empty number does not."""
    valid = F.col("__row").isNotNull() & F.col("__row.__bad").isNull()
    for field in schema.fields:
        if not isinstance(field.dataType, StringType):
            valid = valid & F.col(f"__row.{field.name}").isNotNull()
    return F.coalesce(valid, F.lit(False))


def parse_lines(
    df: DataFrame,
    schema: StructType | str,
    line: str = "line",
    separator: str = ",",
    keep_empty_end: bool = False,
) -> DataFrame:
    """Typed rows of the lines with exactly the fields of ``schema``; others are left out.

    Fields are trimmed; empty ones at the end of a line do not count, unless they are to
    be kept. A stream may use it as well: there is no state.
    """
    schema = _schema(schema)
    rows = _parsed(df, line, schema, separator, keep_empty_end).filter(_valid(schema))
    cells = []
    for field in schema.fields:
        cell = F.col(f"__row.{field.name}")
        is_text = isinstance(field.dataType, StringType)
        cells.append((F.coalesce(cell, F.lit("")) if is_text else cell).alias(field.name))
    return rows.select(*[c for c in df.columns if c != line], *cells)


def rejected_lines(
    df: DataFrame,
    schema: StructType | str,
    line: str = "line",
    separator: str = ",",
    keep_empty_end: bool = False,
) -> DataFrame:
    """The lines that ``parse_lines`` leaves out."""
    schema = _schema(schema)
    rows = _parsed(df, line, schema, separator, keep_empty_end)
    return rows.filter(~_valid(schema)).drop("__row")


def _schema(schema: StructType | str) -> StructType:
    return StructType.fromDDL(schema) if isinstance(schema, str) else schema
