"""Vector code compression: product codes whose codebooks come from a reduction tree.

Vectors lie in columnar blocks. A task works out the distances of a block's
parts to their codebook component by component, and adds what each entry won to
a tensor of sums and counts; the tensors merge in a tree of tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm._common import Store
from tickloom.llm.vectors import AT_ONCE, blocks, columns_of, moved, squares, totals

PARTS, ENTRIES, ROUNDS = 16, 64, 2


def first_vectors(made: DataFrame, n: int) -> np.ndarray:
    """The ``n`` vectors of smallest vec_id (then smallest components; null ids last), as rows."""

    def least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dims, ids, data in zip(batch.column("dims").to_pylist(), batch.column("ids"), batch.column("data").to_pylist(), strict=True):
                column = ids.values
                vectors = columns_of(data, dims, len(column)).T
                known = np.asarray(column.fill_null(0), np.int64)
                nulls = np.asarray(column.is_null())
                order = np.lexsort((*vectors.T[::-1], known, nulls))[:n]
                yield pa.RecordBatch.from_arrays([column.take(pa.array(order)), pa.array(list(vectors[order]), pa.list_(pa.int32()))], ["vec_id", "vector"])

    rows = made.select("dims", "ids", "data").mapInArrow(least, "vec_id long, vector array<int>")
    return np.array([r["vector"] for r in rows.orderBy(F.asc_nulls_last("vec_id"), "vector").limit(n).collect()], np.int64)


def nearest(columns: np.ndarray, codebooks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per part and vector: the nearest entry (ties: the lower) and its squared distance. ``codebooks`` is (part, entry, component)."""
    parts, _, width = codebooks.shape
    n = columns.shape[1]
    entry, error = np.empty((parts, n), np.int64), np.empty((parts, n), np.int64)
    for start in range(0, n, AT_ONCE):
        some = slice(start, min(n, start + AT_ONCE))
        for p in range(parts):
            far = squares(columns[p * width : (p + 1) * width, some], codebooks[p])
            entry[p, some] = best = far.argmin(axis=1)
            error[p, some] = far[np.arange(len(best)), best]
    return entry, error


def won(columns: np.ndarray, codebooks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sums, counts) of what each entry of each codebook wins in a block."""
    parts, size, width = codebooks.shape
    entry, _ = nearest(columns, codebooks)
    sums, counts = np.zeros((parts, size, width), np.int64), np.zeros((parts, size), np.int64)
    for p in range(parts):
        np.add.at(sums[p], entry[p], columns[p * width : (p + 1) * width].T)
        np.add.at(counts[p], entry[p], 1)
    return sums, counts


def fit(made: DataFrame, dims: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks (part, entry, component) after the rounds over all vectors."""
    seeds = first_vectors(made, entries)
    codebooks = np.ascontiguousarray(seeds.reshape(len(seeds), parts, dims // parts).transpose(1, 0, 2))
    rows = made.select("data").rdd
    for _ in range(rounds):
        shared = made.sparkSession.sparkContext.broadcast(codebooks)  # fixed size: entries * dims numbers

        def measure(row):
            return won(columns_of(bytes(row[0]), dims, len(row[0]) // (4 * dims)), shared.value)  # noqa: B023

        codebooks = moved(codebooks, *totals(rows, measure))
        shared.unpersist()
    return codebooks


def common_length(made: DataFrame, parts: int) -> int | None:
    """The length that most vectors have, among the positive multiples of ``parts`` (ties: the greater)."""
    found = made.where((F.col("dims") > 0) & (F.col("dims") % parts == 0)).groupBy("dims").agg(F.sum(F.size("ids")).alias("n"))
    best = found.orderBy(F.desc("n"), F.desc("dims")).limit(1).collect()
    return best[0]["dims"] if best else None


def compress(vectors: DataFrame, vector: str = "embedding", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) for each row with a usable vector.

    ``code`` has two hex digits a part. Dropped: rows whose vector is null or
    holds null or non-finite components; also those of another length than most
    have, or of a length that ``parts`` doesn't divide. Components beyond
    524288 saturate. Null ids stay and are no seeds while others are left;
    repeated rows repeat; of equal ids the smaller vector comes first. Null
    labels are one label. A sum of errors beyond 64 bits is null. An empty
    table gives an empty result.
    """
    store = Store(vectors.sparkSession)
    made = blocks(vectors, store, vector)
    dims = common_length(made, parts)
    kind = vectors.schema["label"].dataType
    if dims is None:
        empty = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("code", T.StringType()), T.StructField("error", T.LongType()), T.StructField("label_error", T.LongType()), T.StructField("codebooks_sha256", T.StringType())])
        return vectors.sparkSession.createDataFrame([], empty)
    made = made.where(F.col("dims") == dims)
    codebooks = fit(made, dims, parts, entries, rounds)
    digest = hashlib.sha256(",".join(map(str, codebooks.ravel())).encode()).hexdigest()
    shared = vectors.sparkSession.sparkContext.broadcast(codebooks)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, labels, data in zip(batch.column("ids"), batch.column("labels"), batch.column("data").to_pylist(), strict=True):
                entry, error = nearest(columns_of(data, dims, len(ids)), shared.value)
                code = [row.tobytes().hex() for row in np.ascontiguousarray(entry.T.astype(np.uint8))]
                yield pa.RecordBatch.from_arrays([ids.values, labels.values, pa.array(code, pa.string()), pa.array(error.sum(axis=0))], ["vec_id", "label", "code", "error"])

    fields = [T.StructField("vec_id", T.LongType()), T.StructField("label", kind), T.StructField("code", T.StringType()), T.StructField("error", T.LongType())]
    coded = store.keep(made.select("ids", "labels", "data").mapInArrow(encode, T.StructType(fields)))
    sums = coded.groupBy(F.col("label").alias("_label")).agg(F.sum(F.col("error").cast("decimal(20,0)")).try_cast("long").alias("label_error"))
    met = coded.join(sums, F.col("label").eqNullSafe(F.col("_label")))
    return met.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def _sql(rounds: int = ROUNDS) -> str:
    """The same in DuckDB for vectors of 64 components in 16 parts of 4."""
    d = ("x1", "x2", "x3", "x4")
    far = " + ".join(f"(v.{x} - c.{x}) * (v.{x} - c.{x})" for x in d)
    mean = ", ".join(f"CAST((sum({x}) - ((sum({x}) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS {x}" for x in d)
    steps = []
    for r in range(rounds + 1):
        steps.append(f"a{r} AS MATERIALIZED (SELECT v.vec_id, v.p, min(({far}) * {ENTRIES} + c.e) AS k FROM parts v JOIN c{r} c ON v.p = c.p GROUP BY v.vec_id, v.p)")
        if r < rounds:
            steps.append(f"m{r} AS (SELECT p, a.k % {ENTRIES} AS e, {mean} FROM a{r} a JOIN parts v USING (vec_id, p) GROUP BY p, a.k % {ENTRIES})")
            steps.append(f"c{r + 1} AS MATERIALIZED (SELECT c.p, c.e, " + ", ".join(f"coalesce(m.{x}, c.{x}) AS {x}" for x in d) + f" FROM c{r} c LEFT JOIN m{r} m ON c.p = m.p AND c.e = m.e)")
    return f"""
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS MATERIALIZED (
  SELECT vec_id, CAST(t.p AS BIGINT) AS p, v[4 * t.p + 1] AS x1, v[4 * t.p + 2] AS x2, v[4 * t.p + 3] AS x3, v[4 * t.p + 4] AS x4 FROM kept, range({PARTS}) t(p)
), seeds AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept ORDER BY vec_id LIMIT {ENTRIES}
), c0 AS MATERIALIZED (SELECT p, e, x1, x2, x3, x4 FROM parts JOIN seeds USING (vec_id)
), {", ".join(steps)},
coded AS (SELECT vec_id, string_agg(format('{{:02x}}', k % {ENTRIES}), '' ORDER BY p) AS code, CAST(sum(k // {ENTRIES}) AS BIGINT) AS error FROM a{rounds} GROUP BY vec_id),
sums AS (SELECT label, CAST(sum(error) AS BIGINT) AS label_error FROM coded JOIN kept USING (vec_id) GROUP BY label),
digest AS (SELECT sha256(string_agg(concat_ws(',', x1, x2, x3, x4), ',' ORDER BY p, e)) AS codebooks_sha256 FROM c{rounds})
SELECT vec_id, code, error, label_error, codebooks_sha256
FROM coded JOIN kept USING (vec_id) JOIN sums ON kept.label IS NOT DISTINCT FROM sums.label CROSS JOIN digest
"""


ORACLE_SQL = _sql()
