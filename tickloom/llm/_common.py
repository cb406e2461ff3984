"""What the operators of this subpackage share: text batches, row keys and written intermediates."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that a Python task works on at once.
SLICE_BYTES = 4 << 20
#: Leading bits of a hash that address a bit table (8 MB).
TABLE_BITS = 26


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the data folder, by any path that Spark's readers open."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slices(batches: Iterable[pa.RecordBatch], text: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that none holds much more text than ``most`` (one long row stays whole)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = batch.column(text)
        ends = np.cumsum(np.nan_to_num(pa.compute.binary_length(sizes).to_numpy(zero_copy_only=False)))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def byte_texts(batch: pa.RecordBatch, text: str = "text") -> list[bytes]:
    """The texts as UTF-8 bytes; null is empty."""
    column = batch.column(text)
    if pa.types.is_string(column.type) or pa.types.is_large_string(column.type):
        column = column.cast(pa.large_binary())
    return [x or b"" for x in column.to_pylist()]


def keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, text, h1, h2): rows of equal doc_id and text share one key; null text counts as empty."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        text.alias("text"),
        F.xxhash64(text).alias("h1"),
        F.xxhash64(F.lit("second"), text).alias("h2"),
    )


KEY = ("doc_id", "h1", "h2")


def fresh(frame: DataFrame, name: str) -> str:
    """A column name that ``frame`` doesn't have."""
    taken = {c.lower() for c in frame.columns}
    while name.lower() in taken:
        name += "_"
    return name


class Store:
    """Parquet intermediates in the folder that the cluster shares (spark.checkpoint.dir).

    Each written table cuts the lineage and outlives lost executors. Where the
    setting is unset, a local master gets a temporary folder; a cluster must set it.
    What an operator wrote goes at the end of the ``cleaned`` block that it was
    called in.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        root = spark.conf.get("spark.checkpoint.dir", None)
        if not root:
            there = spark.sparkContext._jsc.sc().getCheckpointDir()
            root = there.get() if there.isDefined() else None
        if not root:
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError("spark.checkpoint.dir must name a folder that the cluster shares")
            root = f"file://{tempfile.mkdtemp(prefix='tickloom-')}"
        self.root = f"{root.rstrip('/')}/tickloom-{uuid.uuid4().hex}"
        self.count = 0
        if blocks := _open.get():
            blocks[-1].append(self)

    def keep(self, frame: DataFrame) -> DataFrame:
        """Write a frame, read it back."""
        self.count += 1
        path = f"{self.root}/{self.count}"
        frame.write.option("compression", "zstd").parquet(path)
        kept = self.spark.read.schema(frame.schema).parquet(path)
        kept._stored_at = path
        return kept

    def drop(self, *frames: DataFrame) -> None:
        """Remove written frames that nothing reads any more."""
        for frame in frames:
            self._delete(frame._stored_at)

    def close(self) -> None:
        """Remove all that was written here. Frames that read it are of no use afterwards."""
        self._delete(self.root)

    def _delete(self, place: str) -> None:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(place)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


#: The stores of the ``cleaned`` blocks that are open in this thread, innermost last.
_open: ContextVar[tuple[list[Store], ...]] = ContextVar("_open", default=())


@contextmanager
def cleaned() -> Iterator[None]:
    """Removes the intermediates of all operators called inside once the block ends; write or collect their results before that.

    Operators return frames that read their intermediates, so these stay until
    then, or until the folder is emptied. Blocks of other threads are their own.
    """
    own: list[Store] = []
    outer = _open.set((*_open.get(), own))
    try:
        yield
    finally:
        _open.reset(outer)
        for store in own:
            store.close()


def runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.RecordBatch]:
    """Cut sorted batches so that no run of equal keys is parted; a run longer than a batch is gathered."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(key).to_numpy()
        cut = int(np.searchsorted(values, values[-1], side="left"))
        if held and held[-1].column(key)[-1].as_py() != values[0]:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held = []
        if cut:
            yield pa.Table.from_batches([*held, batch.slice(0, cut)]).combine_chunks().to_batches()[0]
            held = []
        held.append(batch.slice(cut))
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def bit_table(keys: DataFrame, column: str, bits: int = TABLE_BITS) -> bytes:
    """A bit for each value of the leading bits of a 64-bit hash column: of fixed size, whatever the number of keys."""
    place = F.shiftrightunsigned(column, 64 - bits) + 1
    parts = keys.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
    table = bytearray(1 << (bits - 3))
    for row in parts.toLocalIterator():
        table[(row["bucket"] - 1) * 4096 : row["bucket"] * 4096] = row["bits"]
    return bytes(table)


def in_table(table: np.ndarray, keys: np.ndarray, bits: int = TABLE_BITS) -> np.ndarray:
    """Whether each key's bit is set: for all keys of the table, and for a few others."""
    at = keys.view(np.uint64) >> np.uint64(64 - bits)
    return (table[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def parallelism(spark: SparkSession) -> int:
    """The number of shuffle partitions that the session asks for."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
