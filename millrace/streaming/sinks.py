"""Where streams go: files, queues, and keyed tables written batch by batch."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from millrace.operators.cdc import upsert_latest
from millrace.sinks.writers import as_lines, queue_records, write_jdbc
from millrace.streaming.batches import Handler, run


def _trigger(every: str | None) -> dict:
    return {"processingTime": every} if every else {"availableNow": True}


def lines_sink(
    stream: DataFrame, folder: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Delimited text files; aggregates need a watermark to be appended."""
    writer = as_lines(stream).writeStream.format("text").option("checkpointLocation", checkpoint)
    return writer.trigger(**_trigger(every)).start(folder)


def queue_sink(
    stream: DataFrame,
    servers: str,
    topic: str,
    checkpoint: str,
    *,
    json: bool = False,
    every: str | None = None,
    properties: Mapping[str, str] | None = None,
) -> StreamingQuery:
    """Rows as text values of a topic; needs the Kafka connector on the class path."""
    options = {
        "kafka.bootstrap.servers": servers,
        "topic": topic,
        "checkpointLocation": checkpoint,
        **{f"kafka.{k}": v for k, v in (properties or {}).items()},
    }
    writer = queue_records(stream, json=json).writeStream.format("kafka").options(**options)
    return writer.trigger(**_trigger(every)).start()


def upsert_sink(
    stream: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    write: Handler,
    checkpoint: str,
    every: str | None = None,
) -> StreamingQuery:
    """Hands ``write`` the last row per key of every micro-batch.

    ``write`` gets the batch number as well. It must replace rows by key, or remember
    the number, because a batch may be written again after a failure. Rows are compared
    within a micro-batch only: where an older one may come in a later micro-batch, use
    ``changes.current_stream``, which keeps the positions of the rows.
    """

    def handle(batch: DataFrame, number: int) -> None:
        write(upsert_latest(batch, keys, order), number)

    return run(stream, handle, checkpoint, every)


def staged_jdbc(url: str, staging: str, merge: Callable[[int], None], **options) -> Handler:
    """A writer for ``upsert_sink``: replace the staging table, then merge it in the database.

    ``merge`` runs the database's own merge statement over its connection.
    """

    def write(batch: DataFrame, number: int) -> None:
        write_jdbc(batch, url, staging, mode="overwrite", **options)
        merge(number)

    return write


def to_many(
    stream: DataFrame, writers: Sequence[Handler], checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Several outputs of one stream, each batch computed once."""

    def handle(batch: DataFrame, number: int) -> None:
        for write in writers:
            write(batch, number)

    return run(stream, handle, checkpoint, every)
