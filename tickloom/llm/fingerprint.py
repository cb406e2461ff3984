"""Document fingerprints: a quartile bucket digest.

Six byte triplets of every sliding five-byte window are hashed into buckets.
The digest holds, for each bucket, in which quartile of all buckets its count
lies (two bits), after a header of the length's logarithm and the quartiles'
ratios. Two digests differ by a bounded score: quartile distances (a jump over
all quartiles counts double) plus header distances, cut at ``BOUND``.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm._common import SLICE_BYTES, parallelism

BUCKETS = 128
#: Score at which two digests have nothing in common.
BOUND = 400
#: Bytes of the header: length, ratios of the quartiles.
HEADER = 2
#: Bytes counted at once; longer texts are counted in parts.
SEGMENT = 1 << 20
#: The byte pairs that, with the newest byte, make the six triplets of a window.
TRIPLETS = ((1, 2), (1, 3), (2, 3), (2, 4), (1, 4), (3, 4))


def _permutation() -> np.ndarray:
    """A fixed shuffle of the byte values, drawn by a multiplicative generator."""
    table, state = list(range(256)), 12345
    for i in range(255, 0, -1):
        state = state * 6364136223846793005 + 1442695040888963407 & (1 << 64) - 1
        j = (state >> 33) % (i + 1)
        table[i], table[j] = table[j], table[i]
    return np.array(table, np.uint8)


MIX = _permutation()
JUMP = np.array([0, 1, 2, 6], np.uint8)
BASE = math.log(1.1)


def _pair_tables() -> list[np.ndarray]:
    """For each triplet the hash of (newest, second) byte under the triplet's own start value."""
    high, low = np.arange(256, dtype=np.uint8)[:, None], np.arange(256, dtype=np.uint8)[None, :]
    return [MIX[MIX[MIX[salt] ^ high] ^ low].ravel() for salt in (2, 3, 5, 7, 11, 13)]


def _parts(texts: list[bytes]) -> Iterator[tuple[list[int], list[memoryview]]]:
    """(text numbers, parts) of SEGMENT bytes at most; parts of a long text overlap by four bytes, so that each window is in one."""
    owners, parts, held = [], [], 0
    for k, text in enumerate(texts):
        view = memoryview(text)
        for at in range(0, max(1, len(view) - 4), SEGMENT - 4):
            part = view[at : at + SEGMENT]
            if parts and held + len(part) > SEGMENT:
                yield owners, parts
                owners, parts, held = [], [], 0
            owners.append(k)
            parts.append(part)
            held += len(part)
    if parts:
        yield owners, parts


class Digester:
    """Digests of many texts at once."""

    def __init__(self):
        self.pairs = _pair_tables()

    def counts(self, texts: list[bytes]) -> np.ndarray:
        """Bucket counts, a row for each text; a text below five bytes has none."""
        out = np.zeros((len(texts), BUCKETS), np.int64)
        for owners, parts in _parts(texts):
            np.add.at(out, owners, self._counts(parts))
        return out

    def _counts(self, parts: list[memoryview]) -> np.ndarray:
        """Bucket counts of SEGMENT bytes or so."""
        sizes = np.array([len(x) for x in parts], np.int64)
        out = np.zeros(len(parts) * BUCKETS, np.int64)
        data = np.frombuffer(b"".join(parts), np.uint8)
        if len(data) >= 5:
            ends = np.cumsum(sizes)
            owner = np.repeat(np.arange(len(parts), dtype=np.int64), sizes)[4:]
            whole = np.arange(4, len(data)) - (ends - sizes)[owner] >= 4
            base = owner[whole] * BUCKETS
            bytes_at = [data[4 - k : len(data) - k][whole] for k in range(5)]
            newest = bytes_at[0].astype(np.uint16) << 8
            for table, (second, third) in zip(self.pairs, TRIPLETS, strict=True):
                h = MIX[table[newest | bytes_at[second]] ^ bytes_at[third]] % BUCKETS
                out += np.bincount(base + h, minlength=len(out))
        return out.reshape(len(parts), BUCKETS)

    def digests(self, texts: list[bytes]) -> np.ndarray:
        """One row of bytes for each text: header, then four buckets to a byte. The empty text is all zero."""
        counts = self.counts(texts)
        ranked = np.sort(counts, axis=1)
        q1, q2, q3 = (ranked[:, BUCKETS * k // 4 - 1] for k in (1, 2, 3))
        codes = sum((counts > q[:, None]).astype(np.uint8) for q in (q1, q2, q3))
        out = np.zeros((len(texts), HEADER + BUCKETS // 4), np.uint8)
        out[:, 0] = [0 if not x else 1 + round(math.log(len(x)) / BASE) % 255 for x in texts]
        top = np.maximum(q3, 1)
        out[:, 1] = (q1 * 100 // top % 16) << 4 | q2 * 100 // top % 16
        for k in range(4):
            out[:, HEADER:] |= codes[:, k::4] << (2 * k)
        return out


def difference(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The bounded difference score of digests, row by row."""

    def turn(x: np.ndarray, y: np.ndarray, size: int) -> np.ndarray:
        gap = np.abs(x.astype(np.int64) - y)
        return np.minimum(gap, size - gap)

    def steep(gap: np.ndarray) -> np.ndarray:
        return np.where(gap <= 1, gap, (gap - 1) * 12)

    score = steep(turn(a[:, 0], b[:, 0], 256))
    score = score + steep(turn(a[:, 1] >> 4, b[:, 1] >> 4, 16)) + steep(turn(a[:, 1] & 15, b[:, 1] & 15, 16))
    for k in range(4):
        x, y = a[:, HEADER:] >> (2 * k) & 3, b[:, HEADER:] >> (2 * k) & 3
        score = score + JUMP[np.where(x > y, x - y, y - x)].sum(axis=1, dtype=np.int64)
    return np.minimum(score, BOUND)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """1 for equal digests, 0 at the bound."""
    return 1.0 - difference(a, b) / BOUND


def _deal_by_order(rows: DataFrame, parts: int) -> DataFrame:
    """Deal (doc_id, text) to ``parts`` ranges of doc_id; the row after a range's last comes along, marked by ``tail``.

    Only bounds (one number for each part) reach the driver.
    """
    shares = [k / parts for k in range(1, parts)] or [0.5]
    bounds = rows.agg(F.percentile_approx("doc_id", shares, 100 * parts)).first()[0] or []
    bounds = sorted(set(bounds))
    width = math.isqrt(len(bounds)) + 1
    fine = [bounds[k : k + width] for k in range(0, len(bounds), width)] or [[]]

    def longs(values: list[int]):
        return F.array(*(F.lit(v).cast("long") for v in values)) if values else F.array().cast("array<long>")

    def below(values):
        return F.size(F.filter(values, lambda b: b < F.col("doc_id")))

    coarse = below(longs([x[-1] for x in fine[:-1]]))
    place = F.when(F.col("doc_id").isNull(), 0).otherwise(coarse * width + below(F.element_at(F.array(*map(longs, fine)), coarse + 1)))
    dealt = rows.withColumn("part", place.cast("int"))
    heads = dealt.groupBy("part").agg(F.min(F.coalesce(F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id"))).alias("head")).orderBy("part").collect()
    if not heads:
        return dealt.withColumn("tail", F.lit(False))
    known = [r["part"] for r in heads]
    before = dict(zip(known, [known[-1], *known[:-1]], strict=True))
    head, back = [None] * (max(known) + 1), [0] * (max(known) + 1)
    for r in heads:
        head[r["part"]], back[r["part"]] = r["head"]["doc_id"], before[r["part"]]
    first = F.col("doc_id").eqNullSafe(F.element_at(F.array(*(F.lit(v).cast("long") for v in head)), F.col("part") + 1))
    prior = F.element_at(F.array(*(F.lit(v) for v in back)), F.col("part") + 1)
    own = F.struct(F.col("part").alias("part"), F.lit(False).alias("tail"))
    both = F.when(first, F.array(own, F.struct(prior.alias("part"), F.lit(True).alias("tail")))).otherwise(F.array(own))
    return dealt.select("doc_id", "text", F.explode(both).alias("to")).select("doc_id", "text", "to.*")


SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def compare_edited(docs: DataFrame) -> DataFrame:
    """Fingerprint every text and its edited text, and compare with the next document's.

    The edited text has its last floor(n_chars / 4) code points replaced by the
    first as many (or all) of the next document's in ascending doc_id, after
    the last the first's. Nulls: a null text is empty; null doc_ids come before
    all others. Rows of one doc_id (repeated ones too) follow each other in the
    order of their texts. A single row is its own next. An empty table gives an
    empty result. Only doc_id and text are read.
    """
    spark = docs.sparkSession
    parts = parallelism(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digester = Digester()

        def tell(ids: list, texts: list[str]) -> pa.RecordBatch:
            """All but the last text, each against its next."""
            n = len(texts) - 1
            plain = [x.encode() for x in texts]
            edited = []
            for x, y in zip(texts, texts[1:], strict=False):
                cut = len(x) // 4
                edited.append((x[: len(x) - cut] + y[:cut]).encode())
            a, b = digester.digests(plain), digester.digests(edited)
            columns = [
                pa.array(ids[:n], pa.int64()),
                pa.array([len(x) for x in texts[:n]], pa.int64()),
                pa.array([hashlib.sha256(x).hexdigest() for x in edited]),
                pa.array([x.tobytes().hex() for x in a[:n]]),
                pa.array([x.tobytes().hex() for x in b]),
                pa.array(likeness(a[:n], b)),
                pa.array(likeness(a[:n], a[1:])),
            ]
            return pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in SCHEMA.split(", ")])

        ids, texts, held, ended = [], [], 0, False
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                for doc_id, text, tail in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), part.column("tail").to_pylist(), strict=True):
                    if ended:
                        continue
                    ended = tail
                    ids.append(doc_id)
                    texts.append(text)
                    held += len(text)
                    if held > SLICE_BYTES and len(texts) > 1:
                        yield tell(ids, texts)
                        ids, texts = ids[-1:], texts[-1:]
                        held = len(texts[0])
        if len(texts) > 1:
            yield tell(ids, texts)

    dealt = _deal_by_order(rows, parts).repartitionById(parts, "part")
    ordered = dealt.sortWithinPartitions(F.col("tail"), F.col("doc_id").asc_nulls_first(), F.col("text"))
    return ordered.select("doc_id", "text", "tail").mapInArrow(scan, SCHEMA)
