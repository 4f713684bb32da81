"""Token totals kept up to date by signed changes.

A change says what became of one document under one tokenizer version: ``insert`` with its
count, ``delete`` with the count it had, ``revise`` with both. Every change turns into
signed counts, these into one small total per group and batch, and totals of batches add
up. Nothing is ever counted again, and a batch costs as much as its own rows.

Batches commit exactly once: a batch first writes its totals under a fresh attempt name,
then appends one row (batch, attempt) to the commit log. Readers take the totals of the
first committed attempt of a batch and nothing else, so a batch that comes again, a job
that died half way or two writers of the same batch change nothing.

Defined cases: a null count is zero tokens; null, empty or unknown dimension values are
groups of their own; a null or unknown ``op`` is an error; an empty batch commits without
totals; rows that occur twice within a batch are two documents; groups whose documents
and tokens are all zero again are left out of the totals. Other columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Tokenizer versions that are a plain pattern: one token per match. Both are ASCII rules.
PATTERN_TOKENIZERS = {
    "words-1": r"[^\x20\x09-\x0D]+",
    "pieces-2": r"[A-Za-z\x{80}-\x{10FFFF}]+|[0-9]+|[^\x20\x09-\x0DA-Za-z0-9\x{80}-\x{10FFFF}]",
}
OPS = ("insert", "delete", "revise")


def token_count(text: Column, version: str) -> Column:
    """The number of tokens of a text; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(PATTERN_TOKENIZERS[version])), F.lit(0)).cast("bigint")


def signed(
    changes: DataFrame, by: Sequence[str], op: str = "op", old: str = "old_tokens", new: str = "new_tokens"
) -> DataFrame:
    """One row (``by``, d_docs, d_tokens) for each count that a change takes away or adds."""
    kind = F.col(op)
    known = F.when(kind.isin(*OPS), kind).otherwise(
        F.raise_error(F.concat(F.lit("unknown change: "), F.coalesce(kind, F.lit("null"))))
    )

    def part(count: str, sign: int) -> Column:
        return F.struct(F.lit(sign).cast("bigint").alias("docs"), (F.coalesce(F.col(count), F.lit(0)) * sign).cast("bigint").alias("tokens"))

    parts = (
        F.when(known == "insert", F.array(part(new, 1)))
        .when(known == "delete", F.array(part(old, -1)))
        .otherwise(F.array(part(old, -1), part(new, 1)))
    )
    rows = changes.select(*[F.col(c) for c in by], F.explode(parts).alias("_part"))
    return rows.select(*by, F.col("_part.docs").alias("d_docs"), F.col("_part.tokens").alias("d_tokens"))


def rolled_up(deltas: DataFrame, by: Sequence[str]) -> DataFrame:
    """One row per group; partial sums are made before the shuffle, so no group is hot."""
    return deltas.groupBy(*by).agg(F.sum("d_docs").alias("d_docs"), F.sum("d_tokens").alias("d_tokens"))


class TokenTotals:
    """Totals by ``by`` in the folder ``path``, which all executors share."""

    def __init__(self, spark: SparkSession, path: str, by: Mapping[str, str]):
        self.spark, self.path, self.by = spark, path.rstrip("/"), dict(by)
        self._schema = ", ".join([*(f"`{c}` {t}" for c, t in self.by.items()), "d_docs bigint", "d_tokens bigint"])

    def _read(self, name: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def committed(self) -> DataFrame:
        """(batch, attempt): the attempt that counts, for every committed batch."""
        log = self._read("commits", "batch string, attempt string, at timestamp")
        return log.groupBy("batch").agg(F.min_by("attempt", F.struct("at", "attempt")).alias("attempt"))

    def apply(self, batch: str, changes: DataFrame, **columns: str) -> bool:
        """Commit the changes as ``batch``; False if that batch is committed already."""
        if self.committed().where(F.col("batch") == batch).head(1):
            return False
        attempt = uuid.uuid4().hex
        totals = rolled_up(signed(changes, list(self.by), **columns), list(self.by))
        totals = totals.withColumns({"batch": F.lit(batch), "attempt": F.lit(attempt)})
        totals.write.mode("append").partitionBy("batch", "attempt").parquet(f"{self.path}/deltas")
        entry = self.spark.range(1).select(
            F.lit(batch).alias("batch"), F.lit(attempt).alias("attempt"), F.current_timestamp().alias("at")
        )
        entry.coalesce(1).write.mode("append").parquet(f"{self.path}/commits")
        return True

    def totals(self) -> DataFrame:
        """(``by``, docs, tokens) over all committed batches."""
        deltas = self._read("deltas", f"{self._schema}, batch string, attempt string")
        deltas = deltas.join(self.committed(), ["batch", "attempt"], "left_semi")
        sums = rolled_up(deltas, list(self.by))
        sums = sums.where((F.col("d_docs") != 0) | (F.col("d_tokens") != 0))
        return sums.withColumnsRenamed({"d_docs": "docs", "d_tokens": "tokens"})
