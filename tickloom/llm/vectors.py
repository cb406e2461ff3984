"""Vectors as whole numbers in blocks: what the vector operators read.

A component x counts as floor(256 * x), x as a double. Rows whose vector is null
or holds a null or non-finite component are dropped. Beyond 524288 in size
components saturate, so that squared distances of 64 components fit 64 bits.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import RDD
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm._common import Store

SCALE = 256
#: The greatest size of a whole component.
MOST = 1 << 27
#: Vectors whose distances are worked out at once.
AT_ONCE = 2048


def whole(values: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(values.astype(np.float64) * SCALE), -MOST, MOST).astype(np.int32)


def usable(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(rows, first, size, values): the rows that stay, where each begins in ``values`` and how long it is."""
    size = np.asarray(pc.fill_null(pc.list_value_length(column), 0), np.int64)
    flat = column.flatten()
    values = np.asarray(pc.fill_null(flat.cast(pa.float64()), np.nan), np.float64)
    first = np.cumsum(size) - size
    bad = np.append(0, np.cumsum(~np.isfinite(values)))
    stays = ~np.asarray(column.is_null()) & (bad[first + size] == bad[first])
    rows = np.flatnonzero(stays)
    return rows, first[rows], size[rows], values


def blocks(frame: DataFrame, store: Store, vector: str, row_id: str = "vec_id", label: str = "label", dims: int | None = None) -> DataFrame:
    """A written table of (block, dims, ids, labels, data): data are int32 numbers, all of the first component, then of the second.

    A block holds vectors of one length, ``dims`` if given, and at most an
    Arrow batch of them.
    """
    kind = frame.schema[label].dataType
    fields = [T.StructField("block", T.LongType()), T.StructField("dims", T.IntegerType()), T.StructField("ids", T.ArrayType(T.LongType())), T.StructField("labels", T.ArrayType(kind)), T.StructField("data", T.BinaryType())]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        numbers = itertools.count(TaskContext.get().partitionId() << 32)
        for batch in batches:
            rows, first, size, values = usable(batch.column("vector"))
            for length in np.unique(size):
                if dims is not None and length != dims:
                    continue
                own = size == length
                data = whole(values[first[own][:, None] + np.arange(length)]).T
                ids, labels = (batch.column(c).take(pa.array(rows[own])) for c in ("vec_id", "label"))
                lists = [pa.ListArray.from_arrays(pa.array([0, len(c)], pa.int32()), c) for c in (ids, labels)]
                yield pa.RecordBatch.from_arrays([pa.array([next(numbers)]), pa.array([length], pa.int32()), *lists, pa.array([np.ascontiguousarray(data).tobytes()])], ["block", "dims", "ids", "labels", "data"])

    rows = frame.select(F.col(row_id).cast("long").alias("vec_id"), F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("vector"))
    return store.keep(rows.mapInArrow(cut, T.StructType(fields)))


def columns_of(data: bytes, dims: int, n: int) -> np.ndarray:
    """A block's numbers as (component, vector)."""
    return np.frombuffer(data, np.int32).reshape(dims, n)


def squares(columns: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """(vector, entry) squared distances, one component after the other."""
    found = np.zeros((columns.shape[1], len(entries)), np.int64)
    for own, other in zip(columns, entries.T, strict=True):
        step = own[:, None].astype(np.int64) - other
        step *= step
        found += step
    return found


def totals(rows: RDD, measure: Callable, depth: int = 3):
    """The sum of ``measure(row)``, a tuple of integer arrays, over all rows, merged in a tree of tasks; None without rows."""

    def add(total, row):
        return both(total, measure(row))

    def both(a, b):
        return b if a is None else a if b is None else tuple(x + y for x, y in zip(a, b, strict=True))

    return rows.treeAggregate(None, add, both, depth)


def moved(entries: np.ndarray, sums: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Entries replaced by the floored means of what they won; those that won nothing stay."""
    means = sums // np.maximum(counts, 1)[..., None]
    return np.where(counts[..., None] > 0, means, entries)
