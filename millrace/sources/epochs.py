"""A folder of committed epochs, as a source and as a sink of Spark's own kind.

A write puts its rows into Parquet files under names of their own, and its commit lists
these in the manifest of the epoch. Only what a manifest lists is ever read, so files of
failed or repeated attempts don't count, and an epoch that is written again leaves the
first copy in force. Batch writes take the next free number, streams that of the micro-batch.

As a source the folder is a log whose offsets are epochs: a stream reads whole epochs, and
after a restart those behind its checkpoint; a batch reads all. Each file is a partition.

Register both with ``register(spark)``; then ``df.write.format("epochs").save(folder)`` and
``spark.readStream.format("epochs").load(folder)``. The folder is a path or a URI that
``pyarrow.fs`` knows, on storage that driver and executors share.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    DataSourceStreamArrowWriter,
    DataSourceStreamReader,
    InputPartition,
    WriterCommitMessage,
)
from pyspark.sql.pandas.types import from_arrow_schema
from pyspark.sql.types import StructType

_MANIFESTS, _DATA, _SUFFIX = "epochs", "data", ".json"


def _place(folder: str) -> tuple[fs.FileSystem, str]:
    if "://" in folder or folder.startswith("file:"):
        return fs.FileSystem.from_uri(folder)
    return fs.LocalFileSystem(), folder


class Folder:
    """Manifests and files of one folder."""

    def __init__(self, folder: str) -> None:
        self.files, self.path = _place(folder)

    def epochs(self) -> list[int]:
        chosen = fs.FileSelector(f"{self.path}/{_MANIFESTS}", allow_not_found=True)
        names = [f.base_name for f in self.files.get_file_info(chosen)]
        return sorted(int(n.removesuffix(_SUFFIX)) for n in names if n.endswith(_SUFFIX))

    def listed(self, epoch: int) -> list[str]:
        with self.files.open_input_stream(f"{self.path}/{_MANIFESTS}/{epoch:020d}{_SUFFIX}") as f:
            return json.loads(f.read())

    def write(self, batches: Iterator[pa.RecordBatch]) -> str | None:
        """The name of a new file with the rows; none without rows."""
        name, writer = f"{uuid.uuid4().hex}.parquet", None
        self.files.create_dir(f"{self.path}/{_DATA}")
        for batch in batches:
            if writer is None:
                writer = pq.ParquetWriter(f"{self.path}/{_DATA}/{name}", batch.schema, filesystem=self.files)
            writer.write_batch(batch)
        if writer is None:
            return None
        writer.close()
        return name

    def read(self, name: str) -> Iterator[pa.RecordBatch]:
        with self.files.open_input_file(f"{self.path}/{_DATA}/{name}") as f:
            yield from pq.ParquetFile(f).iter_batches()

    def schema(self) -> pa.Schema | None:
        for epoch in self.epochs():
            for name in self.listed(epoch):
                with self.files.open_input_file(f"{self.path}/{_DATA}/{name}") as f:
                    return pq.read_schema(f)
        return None

    def commit(self, epoch: int, names: list[str]) -> None:
        """List the files of an epoch, unless an earlier attempt has."""
        if epoch in self.epochs():
            self.drop(names)
            return
        self.files.create_dir(f"{self.path}/{_MANIFESTS}")
        path = f"{self.path}/{_MANIFESTS}/{epoch:020d}{_SUFFIX}"
        draft = f"{path}.{uuid.uuid4().hex}"
        with self.files.open_output_stream(draft) as f:
            f.write(json.dumps(names).encode())
        self.files.move(draft, path)

    def drop(self, names: list[str]) -> None:
        for name in names:
            self.files.delete_file(f"{self.path}/{_DATA}/{name}")


@dataclass
class Written(WriterCommitMessage):
    name: str | None


def _names(messages: list) -> list[str]:
    # A task that failed has no message.
    return [m.name for m in messages if m is not None and m.name is not None]


class _BatchWriter(DataSourceArrowWriter):
    def __init__(self, folder: str) -> None:
        self.folder = folder

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        return Written(Folder(self.folder).write(iterator))

    def commit(self, messages: list) -> None:
        folder = Folder(self.folder)
        folder.commit(max(folder.epochs(), default=-1) + 1, _names(messages))

    def abort(self, messages: list) -> None:
        Folder(self.folder).drop(_names(messages))


class _StreamWriter(DataSourceStreamArrowWriter):
    def __init__(self, folder: str) -> None:
        self.folder = folder

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        return Written(Folder(self.folder).write(iterator))

    def commit(self, messages: list, batchId: int) -> None:
        Folder(self.folder).commit(batchId, _names(messages))

    def abort(self, messages: list, batchId: int) -> None:
        Folder(self.folder).drop(_names(messages))


@dataclass
class File(InputPartition):
    name: str


class _Reader(DataSourceReader):
    def __init__(self, folder: str) -> None:
        self.folder = folder

    def partitions(self) -> list[File]:
        folder = Folder(self.folder)
        # Spark asks for a partition at least.
        return [File(name) for epoch in folder.epochs() for name in folder.listed(epoch)] or [File("")]

    def read(self, partition: File) -> Iterator[pa.RecordBatch]:
        if partition.name:
            yield from Folder(self.folder).read(partition.name)


class _StreamReader(DataSourceStreamReader):
    """Offsets count epochs: rows of epoch n lie between n and n + 1."""

    def __init__(self, folder: str) -> None:
        self.folder = folder

    def initialOffset(self) -> dict:
        return {"epoch": 0}

    def latestOffset(self) -> dict:
        return {"epoch": max(Folder(self.folder).epochs(), default=-1) + 1}

    def partitions(self, start: dict, end: dict) -> list[File]:
        folder = Folder(self.folder)
        epochs = [e for e in folder.epochs() if start["epoch"] <= e < end["epoch"]]
        return [File(name) for epoch in epochs for name in folder.listed(epoch)] or [File("")]

    def read(self, partition: File) -> Iterator[pa.RecordBatch]:
        if partition.name:
            yield from Folder(self.folder).read(partition.name)


class Epochs(DataSource):
    """The data source ``epochs``; its schema is that of the first file, if none is given."""

    @classmethod
    def name(cls) -> str:
        return "epochs"

    def schema(self) -> StructType:
        found = Folder(self.options["path"]).schema()
        if found is None:
            raise ValueError("an empty folder needs a schema")
        return from_arrow_schema(found, prefer_timestamp_ntz=True)

    def reader(self, schema: StructType) -> _Reader:
        return _Reader(self.options["path"])

    def streamReader(self, schema: StructType) -> _StreamReader:
        return _StreamReader(self.options["path"])

    def writer(self, schema: StructType, overwrite: bool) -> _BatchWriter:
        if overwrite:
            raise ValueError("epochs are only appended")
        return _BatchWriter(self.options["path"])

    def streamWriter(self, schema: StructType, overwrite: bool) -> _StreamWriter:
        return _StreamWriter(self.options["path"])


def register(spark: SparkSession) -> None:
    """Make ``epochs`` known to a session."""
    spark.dataSource.register(Epochs)
