"""Tables and queues outside Spark. Connection data are always arguments."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def jdbc_options(
    url: str,
    table: str,
    *,
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 1,
    fetch_rows: int = 10_000,
    properties: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Options of a parallel JDBC scan; without a partition column one task reads it all."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_rows), **(properties or {})}
    if partition_column is not None:
        if bounds is None:
            raise ValueError("a partition column needs its bounds")
        options.update(
            partitionColumn=partition_column,
            lowerBound=str(bounds[0]),
            upperBound=str(bounds[1]),
            numPartitions=str(partitions),
        )
    return options


def read_jdbc(spark: SparkSession, url: str, table: str, **options) -> DataFrame:
    """A table; filters and column choices made later reach the database."""
    return spark.read.format("jdbc").options(**jdbc_options(url, table, **options)).load()


def kafka_options(
    servers: str,
    topics: Sequence[str],
    *,
    group: str | None = None,
    starting: str = "earliest",
    max_offsets: int | None = None,
    properties: Mapping[str, str] | None = None,
) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "startingOffsets": starting,
        **{f"kafka.{k}": v for k, v in (properties or {}).items()},
    }
    if group:
        options["kafka.group.id"] = group
    if max_offsets:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def stream_kafka(spark: SparkSession, servers: str, topics: Sequence[str], **options) -> DataFrame:
    """Values of the topics as text; needs the Kafka connector on the class path."""
    stream = spark.readStream.format("kafka").options(**kafka_options(servers, topics, **options))
    return queue_lines(stream.load())


def queue_lines(records: DataFrame) -> DataFrame:
    """The column ``line`` from any frame with a binary or text column ``value``."""
    return records.select(F.col("value").cast("string").alias("line"))
