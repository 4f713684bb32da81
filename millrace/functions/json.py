"""JSON expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.mergeable import as_column


def path(text: Column | str, where: str, default: str | None = None) -> Column:
    """One value of a JSON text as a string, or the default."""
    value = F.get_json_object(as_column(text), where)
    return value if default is None else F.coalesce(value, F.lit(default))


def record(text: Column | str, schema: str) -> Column:
    """A JSON object as a struct; null for a malformed text."""
    return F.from_json(as_column(text), schema)


def text_of(*columns: str, as_strings: bool = False) -> Column:
    """The columns as a JSON object, with every value as a string if asked."""
    cells = [F.col(c).cast("string").alias(c) if as_strings else F.col(c) for c in columns]
    return F.to_json(F.struct(*cells))
