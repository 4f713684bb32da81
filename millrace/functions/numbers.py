"""Exact sums of amounts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.mergeable import as_column


def exact(value: Column | str, digits: int = 6) -> Column:
    """An amount as a decimal of up to 18 digits, ``digits`` of them behind the point.

    Sums do not depend on the order of rows, and widen by ten digits. An amount that does
    not fit is an error in ANSI mode; digits beyond the last one kept are rounded.
    """
    return as_column(value).cast(f"decimal(18,{digits})")


def as_double(value: Column | str) -> Column:
    return as_column(value).cast("double")


def cents(value: Column | str) -> Column:
    """An amount of two digits as whole cents, for state that takes no decimals."""
    return F.round(as_column(value) * 100).cast("bigint")


def amount(whole: Column | str) -> Column:
    return as_column(whole).cast("double") / F.lit(100.0)
