"""Micro-batches that write their rows per batch number, and one row handed on.

Spark may run a batch again after a failure, so output and the row handed on are written
per batch number and a repeated batch replaces its own writes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from millrace.session import keyed_state

Handler = Callable[[DataFrame, int], None]


def run(
    stream: DataFrame, handle: Handler, checkpoint: str, every: str | None = None, mode: str = "append"
) -> StreamingQuery:
    """Start a query; without ``every`` it takes what is there and ends."""

    def on_batch(batch: DataFrame, number: int) -> None:
        batch.persist()
        try:
            handle(batch, number)
        finally:
            batch.unpersist()

    writer = stream.writeStream.foreachBatch(on_batch).outputMode(mode).option("checkpointLocation", checkpoint)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    with keyed_state(stream.sparkSession):
        return writer.trigger(**trigger).start()


def read_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


class Output:
    """Rows of a stream, one folder per micro-batch."""

    def __init__(self, folder: str) -> None:
        self.folder = folder

    def write(self, df: DataFrame, number: int) -> None:
        df.write.mode("overwrite").parquet(f"{self.folder}/batch={number}")

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.folder).drop("batch")

    def stream(self, spark: SparkSession) -> DataFrame:
        """The rows as a stream, once some are written; in the order of the batches.

        A batch that runs again after a failure writes new files, which such a stream takes
        for new rows: drop repeated ones by an id where that may happen.
        """
        schema = self.read(spark).schema
        return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1000).parquet(self.folder).drop("batch")


class State:
    """One small row handed on between micro-batches, in a folder per batch.

    A batch reads the row of the batch before itself, so one that runs again finds what it
    started from. Every batch writes, so its number says which folder to read.
    """

    def __init__(self, folder: str) -> None:
        self.folder = folder

    def read(self, spark: SparkSession, number: int) -> DataFrame | None:
        """The row as it was before batch ``number``."""
        return read_or_none(spark, f"{self.folder}/batch={number - 1}")

    def write(self, df: DataFrame, number: int) -> None:
        df.coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/batch={number}")
