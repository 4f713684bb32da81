"""Aggregates that can be computed in parts and merged.

Every windowed, salted or running aggregate of the library is built from these, so
none of them ever needs all rows of a group in one place.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Mergeable:
    """One aggregate and how its partial results go together.

    rows     aggregate over input rows, for ``groupBy`` as well as ``over``
    merge    aggregate over a column of partial results
    combine  two partial results, the earlier rows' first
    ordered  for aggregates that depend on row order: the partial result of an unordered
             group, given the ordering value and whether the scan runs backward
    """

    rows: Column
    merge: Callable[[Column], Column]
    combine: Callable[[Column, Column], Column]
    ordered: Callable[[Column, bool], Column] | None = None

    def partial(self, order: Column, backward: bool) -> Column:
        return self.ordered(order, backward) if self.ordered else self.rows


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def count(value: Column | str | None = None) -> Mergeable:
    return Mergeable(
        F.count(F.lit(1) if value is None else as_column(value)),
        F.sum,
        lambda a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)),
    )


def total(value: Column | str) -> Mergeable:
    return Mergeable(F.sum(as_column(value)), F.sum, lambda a, b: F.coalesce(a + b, a, b))


def lowest(value: Column | str) -> Mergeable:
    return Mergeable(F.min(as_column(value)), F.min, F.least)


def highest(value: Column | str) -> Mergeable:
    return Mergeable(F.max(as_column(value)), F.max, F.greatest)


def latest(value: Column | str) -> Mergeable:
    """The last value that is not null, in scan direction."""
    value = as_column(value)
    return Mergeable(
        F.last(value, ignorenulls=True),
        lambda c: F.last(c, ignorenulls=True),
        lambda earlier, later: F.coalesce(later, earlier),
        lambda order, backward: (F.min_by if backward else F.max_by)(
            value, F.when(value.isNotNull(), order)
        ),
    )


def earliest(value: Column | str) -> Mergeable:
    """The first value that is not null, in scan direction."""
    value = as_column(value)
    return Mergeable(
        F.first(value, ignorenulls=True),
        lambda c: F.first(c, ignorenulls=True),
        lambda earlier, later: F.coalesce(earlier, later),
        lambda order, backward: (F.max_by if backward else F.min_by)(
            value, F.when(value.isNotNull(), order)
        ),
    )
