"""Archive objects as a data source: a partition for each object, in the order of their keys, from a cursor on.

An object is a file of lines below a folder, its key the path from there. The
cursor is the last key that is done, or a prefix of keys that come after all
before it: a batch reads the keys beyond it, a stream takes it as its offset and
goes on where its checkpoint stands. Keys with ``..`` are refused. Objects are
plain, gzip (``.gz``) or LZ4 frames (``.lz4``), of which no more than
OBJECT_CAP bytes are unpacked.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from tickloom.functions.codecs import unpacked_object

NAME = "tickloom_archive"
SCHEMA = "key string, line long, value string"
#: Lines of a record batch.
BATCH = 10_000


class Object(InputPartition):
    """One object to read."""


def _opened(path: str):
    from pyarrow import fs

    system, root = fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")
    return system, root.rstrip("/")


def keys(path: str, prefix: str = "") -> list[str]:
    """The keys below a folder in their order; hidden and marker files aren't objects."""
    from pyarrow import fs

    if ".." in prefix.split("/"):
        raise ValueError(f"key outside the archive: {prefix}")
    system, root = _opened(path)
    found = system.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True))
    names = [f.path[len(root) + 1 :] for f in found if f.type == fs.FileType.File]
    return sorted(n for n in names if n.startswith(prefix) and not n.rsplit("/", 1)[-1].startswith(("_", ".")))


def content(path: str, key: str) -> bytes:
    """An object's unpacked bytes."""
    if ".." in key.split("/"):
        raise ValueError(f"key outside the archive: {key}")
    system, root = _opened(path)
    with system.open_input_stream(f"{root}/{key}", compression=None) as stream:
        data = stream.read()
    return unpacked_object(key, data)


def lines(path: str, key: str) -> Iterator[pa.RecordBatch]:
    found = content(path, key).decode("utf-8", "replace").split("\n")
    if found and not found[-1]:
        found.pop()
    for start in range(0, len(found), BATCH):
        some = [x.removesuffix("\r") for x in found[start : start + BATCH]]
        yield pa.RecordBatch.from_arrays([pa.array([key] * len(some)), pa.array(range(start, start + len(some)), pa.int64()), pa.array(some)], ["key", "line", "value"])


class Archive(DataSource):
    """Options: path, cursor, prefix."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return ArchiveReader(self.options)

    def streamReader(self, schema) -> DataSourceStreamReader:
        return ArchiveStream(self.options)


class ArchiveReader(DataSourceReader):
    def __init__(self, options):
        self.path, self.cursor, self.prefix = options["path"], options.get("cursor", ""), options.get("prefix", "")

    def partitions(self) -> list[InputPartition]:
        return [Object(k) for k in keys(self.path, self.prefix) if k > self.cursor] or [Object(None)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        if partition.value is not None:
            yield from lines(self.path, partition.value)


class ArchiveStream(DataSourceStreamReader):
    """Offsets are keys. Objects must come in the order of their keys, as archives by time do."""

    def __init__(self, options):
        self.path, self.cursor, self.prefix = options["path"], options.get("cursor", ""), options.get("prefix", "")

    def initialOffset(self) -> dict:
        return {"key": self.cursor}

    def latestOffset(self) -> dict:
        return {"key": max([self.cursor, *keys(self.path, self.prefix)])}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return [Object(k) for k in keys(self.path, self.prefix) if start["key"] < k <= end["key"]] or [Object(None)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        if partition.value is not None:
            yield from lines(self.path, partition.value)

    def commit(self, end: dict) -> None:
        """Nothing to release: objects stay."""


def register(spark: SparkSession) -> None:
    spark.dataSource.register(Archive)
