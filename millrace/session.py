"""Session settings, and the one place that decides where pinned data goes."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: MB that each state of a task gathers in memory before it goes to disk, which RocksDB would do at 64.
WRITE_BUFFER, WRITE_BUFFER_MB = "spark.sql.streaming.stateStore.rocksdb.writeBufferSizeMB", "8"


def local_session(cores: int | str = 8, **conf: str) -> SparkSession:
    """A local session for tests and the bench; clusters bring their own."""
    settings = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.driver.memory": os.environ.get("MILLRACE_DRIVER_MEMORY", "8g"),
        STATE_STORE: ROCKSDB,
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName("millrace")
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@contextmanager
def keyed_state(spark: SparkSession) -> Iterator[None]:
    """Streams that start within keep their state in RocksDB, unless the session names a store.

    Spark's default store can't hold the states of ``transformWithState``. Write buffers, which an executor
    holds outside its heap for every state of every task, are small unless the session says how
    large. A stream keeps the settings it started with, so those of the session are as before afterwards.
    """
    given = {STATE_STORE: ROCKSDB, WRITE_BUFFER: WRITE_BUFFER_MB}
    missing = {name: value for name, value in given.items() if not spark.conf.get(name, None)}
    for name, value in missing.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name in missing:
            spark.conf.unset(name)


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    A local session without that setting uses the warehouse. On a cluster a
    machine-local folder would be lost with its executor, so the setting is required.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    folder = f"{spark.conf.get('spark.sql.warehouse.dir')}/millrace-pins"
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def pin(df: DataFrame) -> DataFrame:
    """Write ``df`` once as a table in the shared folder and continue from there.

    For results that several later jobs read. The table survives lost executors, which a
    cache would not; its row count is free, and each job reads only the columns it needs.
    It is deleted when the driver's JVM ends.
    """
    path = scratch(df.sparkSession)
    df.write.mode("append").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch(spark: SparkSession) -> str:
    """A new folder in the shared one, deleted when the driver's JVM ends."""
    path = f"{shared_folder(spark)}/millrace-{uuid.uuid4().hex}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    # Only what exists can be marked.
    files.mkdirs(folder)
    files.deleteOnExit(folder)
    return path
