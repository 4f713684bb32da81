"""Bounded samples of labelled documents, for models that are fitted on the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether a document is kept from training: its id's checksum falls into ``fold``; not so without an id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def sample(
    docs: DataFrame, labels: DataFrame, label: str, size: int, value: Column, doc_id: str = "doc_id"
) -> list[tuple[object, int]]:
    """At most ``size`` pairs of ``value`` over ``docs`` and the label, half of either label.

    Those with the smallest hashes of their ids are taken, of the labelled documents there
    are: labels without one take up no place. Their ids are handed to all tasks, so documents
    are neither moved nor evaluated in vain. Any other columns may stand in either table.
    """
    name = "_id"
    while name in docs.columns:
        name += "_"
    out = []
    for kind in (0, 1):
        ids = labels.where((F.col(label) == kind) & F.col(doc_id).isNotNull()).select(F.col(doc_id).alias(name))
        there = docs.select(F.col(doc_id).alias(name)).where(F.col(name).isNotNull())
        ids = ids.join(there, name, "left_semi").distinct().orderBy(F.xxhash64(name), name).limit(size // 2)
        found = docs.join(F.broadcast(ids), F.col(doc_id) == F.col(name), "left_semi")
        rows = found.select(F.xxhash64(doc_id).alias("h"), value.alias("v")).orderBy("h").limit(size // 2)
        out += [(row.v, kind) for row in rows.collect()]
    return out
