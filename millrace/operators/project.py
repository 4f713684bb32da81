"""Row-wise operators: splitting, routing, aligning, placing."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import not_blank, with_length


def split_rows(df: DataFrame, column: str, pattern: str = ",", word: str = "word") -> DataFrame:
    """One row per lower-cased piece of ``column``, with a weight of 1; no blank pieces."""
    pieces = df.withColumn(word, F.explode(F.split(F.lower(column), pattern)))
    return drop_blank(pieces, word).withColumn("weight", F.lit(1))


def drop_blank(df: DataFrame, *columns: str) -> DataFrame:
    for column in columns:
        df = df.filter(not_blank(column))
    return df


def annotated(df: DataFrame, column: str, word: str, name: str = "annotated") -> DataFrame:
    """Rows whose text contains ``word``, with the text and its length joined into one."""
    return df.filter(F.col(column).contains(word)).withColumn(name, with_length(column))


def guard(df: DataFrame, bad: Column, *, fail: bool = False) -> tuple[DataFrame, DataFrame]:
    """Separate poisonous rows; with ``fail`` the first of them stops the job instead."""
    bad = F.coalesce(bad, F.lit(False))
    if fail:
        stop = F.when(bad, F.raise_error(F.lit("poisonous row")).cast("boolean"))
        return df.filter(F.coalesce(stop, F.lit(True))), df.filter(F.lit(False))
    return df.filter(~bad), df.filter(bad)


def route(df: DataFrame, routes: Mapping[str, Column], name: str = "route") -> DataFrame:
    """One output row per route whose condition holds; rows without a route vanish."""
    taken = F.array_compact(F.array(*[F.when(cond, F.lit(r)) for r, cond in routes.items()]))
    return df.withColumn(name, F.explode(taken))


def union_all(*frames: DataFrame) -> DataFrame:
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


def connect(
    left: DataFrame, right: DataFrame, left_as: Mapping[str, Column], right_as: Mapping[str, Column]
) -> DataFrame:
    """Two frames of different shape mapped to one shape and put together."""
    return left.select(*[c.alias(n) for n, c in left_as.items()]).unionByName(
        right.select(*[c.alias(n) for n, c in right_as.items()]), allowMissingColumns=True
    )


def placement(key: str, places: Mapping[str, int], other: int, partitions: int) -> Column:
    """The partition number of a key, from a fixed map with a number for all others."""
    place = F.lit(other)
    for value, number in places.items():
        place = F.when(F.col(key) == value, F.lit(number)).otherwise(place)
    return F.pmod(place, F.lit(partitions)).cast("int")


def place(
    df: DataFrame, key: str, places: Mapping[str, int], other: int, partitions: int, spread: int = 1
) -> DataFrame:
    """Rows in the partition of their key; place p owns ``spread`` of them, from p * spread.

    A key is in one task unless it is spread, by a hash of the row.
    """
    place = placement(key, places, other, partitions)
    if spread > 1:
        place = (place * spread + F.pmod(F.xxhash64(*df.columns), F.lit(spread))).cast("int")
    return df.repartitionById(partitions * spread, place)


def with_resource(
    df: DataFrame,
    open_resource: Callable[[], Any],
    each: Callable[[Any, pd.DataFrame], pd.DataFrame],
    close_resource: Callable[[Any], None],
    schema: str,
) -> DataFrame:
    """Python code over batches of rows with something opened once per partition.

    For code that Spark cannot see into; a lookup should be a join instead.
    """

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        resource = open_resource()
        try:
            for batch in batches:
                yield each(resource, batch)
        finally:
            close_resource(resource)

    return df.mapInPandas(run, schema)
