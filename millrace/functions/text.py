"""Text expressions: splitting, guarding and annotating lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.mergeable import as_column
from millrace.functions.messages import CHARACTERS, LENGTH_IS


def without_empty_end(line: Column | str, separator: str = ",") -> Column:
    """A delimited line without the empty fields at its end."""
    if len(separator) == 1:
        return F.rtrim(as_column(line), F.lit(separator))
    return F.regexp_replace(as_column(line), f"(?:\\Q{separator}\\E)+$", "")


def not_blank(text: Column | str) -> Column:
    return F.coalesce(F.trim(as_column(text)) != "", F.lit(False))


def same_ignoring_case(text: Column | str, other: str) -> Column:
    return F.lower(as_column(text)) == other.lower()


def with_length(line: Column | str) -> Column:
    """The line with its number of characters appended."""
    line = as_column(line)
    return F.concat(
        line, F.lit(LENGTH_IS), F.char_length(line).cast("string"), F.lit(CHARACTERS)
    )


def salted(word: Column | str, salt: Column) -> Column:
    """``salt_word``; take the salt from ``random_salt`` or ``stable_salt``."""
    return F.concat_ws("_", salt.cast("string"), as_column(word))


def random_salt(n: int = 10, seed: int | None = None) -> Column:
    return F.floor(F.rand(seed) * n).cast("int")


def stable_salt(*columns: str, n: int = 10) -> Column:
    """A salt that a retried task computes again in the same way."""
    return F.pmod(F.xxhash64(*columns), F.lit(n)).cast("int")
