"""SimHash near-duplicates with a Gray-ordered hierarchical index.

Fingerprints are 64 bits, from the XXH64 values of word shingles. Two
fingerprints link when at most ``DISTANCE`` bits differ. Four 16-bit blocks give
six pairs of blocks; fingerprints within two bits agree on one pair at least,
so the six 32-bit keys deal out the search without losing a link. A group of
one key is sorted by Gray rank; its upper nodes hold the bits on which all
codes below agree, and pairs of nodes whose agreed bits already differ too
much are pruned whole. A group above ``GROUP`` codes is dealt out again by
thirds of its free bits, which loses no link either; after two such rounds 15
bits are free at most, so no group can exceed 32768 codes.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm import banding
from tickloom.llm._common import KEY, Store, bit_table, byte_texts, fresh, in_table, keyed, parallelism, slices
from tickloom.llm.banding import PACKED, Forest, band_keys, packed
from tickloom.llm.components import components

DISTANCE = 2
GROUP = 4096
FANOUT = 16
#: Words of a shingle and Jaccard similarity of the documents that the filter takes for copies, and the bits in which their fingerprints differ at most: ten of 64 are expected, with a deviation of three.
WORDS, SIMILAR, WIDE = 5, 0.8, 20


def shingle_hashes(data: bytes, words: int = 3, seed: int = 42) -> np.ndarray:
    """XXH64 of every run of ``words`` words, A-Z lowered, joined by one space; a shorter text is one run."""
    parts = data.lower().split()
    if not parts:
        return np.empty(0, np.uint64)
    joined = b" ".join(parts)
    if len(parts) <= words:
        return np.array([xxhash.xxh64_intdigest(joined, seed)], np.uint64)
    gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    starts = np.concatenate(([0], gaps + 1))[: len(parts) - words + 1].tolist()
    ends = np.concatenate((gaps, [len(joined)]))[words - 1 :].tolist()
    runs = map(joined.__getitem__, map(slice, starts, ends))
    return np.fromiter(map(xxhash.xxh64_intdigest, runs, repeat(seed)), np.uint64, len(starts))


def fingerprint(hashes: np.ndarray) -> int:
    """A bit is 1 if set in over half the hashes; no hashes: zero."""
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * counts > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """(doc_id, fp) for each row of ``docs``; null text is empty, its fingerprint zero."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            fps = np.array([fingerprint(shingle_hashes(x, words)) for x in byte_texts(batch)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(scan, "doc_id long, fp long")


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Place of each code in the binary-reflected Gray sequence."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def _agreed(codes: np.ndarray, masks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One level up: the bits on which every FANOUT neighbours agree, and their values."""
    at = np.arange(0, len(codes), FANOUT)
    ones = np.bitwise_and.reduceat(codes, at)
    some = np.bitwise_or.reduceat(codes, at)
    return ones, ~(ones ^ some) & np.bitwise_and.reduceat(masks, at)


def near_pairs(codes: np.ndarray, distance: int = DISTANCE, step: int = 1 << 14) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i < j) of Gray-sorted distinct codes that differ in at most ``distance`` bits, in blocks."""
    levels = [(codes, np.full(len(codes), ~np.uint64(0)))]
    while len(levels[-1][0]) > 1:
        levels.append(_agreed(*levels[-1]))
    work = [(len(levels) - 1, np.zeros(1, np.int64), np.zeros(1, np.int64))]
    spread = np.arange(FANOUT)
    while work:
        level, left, right = work.pop()
        values, masks = levels[level]
        differ = np.bitwise_count((values[left] ^ values[right]) & masks[left] & masks[right])
        kept = differ <= distance
        left, right = left[kept], right[kept]
        if level == 0:
            real = left < right
            yield left[real], right[real]
            continue
        below = len(levels[level - 1][0])
        for at in range(0, len(left), step // FANOUT):
            a, b = left[at : at + step // FANOUT], right[at : at + step // FANOUT]
            a = (a[:, None, None] * FANOUT + spread[None, :, None]).repeat(FANOUT, 2).ravel()
            b = (b[:, None, None] * FANOUT + spread[None, None, :]).repeat(FANOUT, 1).ravel()
            there = (a < below) & (b < below) & (a <= b)
            if there.any():
                work.append((level - 1, a[there], b[there]))


def local_links(codes: np.ndarray, distance: int = DISTANCE) -> list[tuple[int, int]]:
    """A spanning set of links: each code of a local component with that component's first code."""
    forest = Forest(len(codes))
    for left, right in near_pairs(codes, distance):
        for a, b in zip(left.tolist(), right.tolist(), strict=True):
            forest.join(a, b)
    return forest.links()


def _spread_bits(mask: int, parts: int) -> list[int]:
    """Cut the bits of a mask into runs, each as a mask of its own."""
    bits = [b for b in range(64) if mask >> b & 1]
    cuts = [len(bits) * k // parts for k in range(parts + 1)]
    return [sum(1 << b for b in bits[cuts[k] : cuts[k + 1]]) for k in range(parts)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _keys(codes: DataFrame) -> DataFrame:
    """(key, mask, fp): a row for each pair of 16-bit blocks; equal keys mean equal bits under the mask (or a hash collision, which costs time only)."""
    full = (1 << 64) - 1
    blocks = _spread_bits(full, 4)
    masks = [_signed(a | b) for a, b in combinations(blocks, 2)]
    each = F.explode(F.array(*(F.lit(m) for m in masks)))
    return codes.select("fp", each.alias("mask")).select(F.xxhash64("mask", F.col("fp").bitwiseAND(F.col("mask"))).alias("key"), "mask", "fp")


def _finer(hot: DataFrame) -> DataFrame:
    """Deal out the groups of hot keys by each third of their free bits."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        thirds: dict[int, list[int]] = {}
        for batch in batches:
            masks, fps = batch.column("mask").to_numpy(), batch.column("fp").to_numpy()
            for mask in np.unique(masks).tolist():
                if mask not in thirds:
                    fixed = mask & ((1 << 64) - 1)
                    thirds[mask] = [_signed(fixed | t) for t in _spread_bits(fixed ^ ((1 << 64) - 1), DISTANCE + 1)]
                own = fps[masks == mask]
                for finer in thirds[mask]:
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), finer)), pa.array(own)], ["mask", "fp"])

    cut = hot.select("mask", "fp").mapInArrow(split, "mask long, fp long")
    return cut.select(F.xxhash64("mask", F.col("fp").bitwiseAND(F.col("mask"))).alias("key"), "mask", "fp").distinct()


def _grouped_links(dealt: DataFrame, parts: int) -> DataFrame:
    """(a, b): links found inside the groups of one key."""

    def flush(keys: list[np.ndarray], fps: list[np.ndarray], last: bool):
        key, fp = np.concatenate(keys), np.concatenate(fps)
        cut = len(key) if last else int(np.searchsorted(key, key[-1], side="left"))
        starts = np.concatenate(([0], np.flatnonzero(np.diff(key[:cut])) + 1)) if cut else np.empty(0, np.int64)
        ends = np.append(starts[1:], cut)
        found = []
        for s, e in zip(starts[(many := ends - starts > 1)].tolist(), ends[many].tolist(), strict=True):
            codes = np.unique(fp[s:e])
            codes = codes[np.argsort(gray_rank(codes.view(np.uint64)))]
            found += [(codes[i], codes[j]) for i, j in local_links(codes.view(np.uint64))]
        return found, [key[cut:]], [fp[cut:]]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, fps, held = [], [], 0
        for batch in batches:
            keys.append(batch.column("key").to_numpy())
            fps.append(batch.column("fp").to_numpy())
            held += batch.num_rows
            if held >= 4 * GROUP:
                found, keys, fps = flush(keys, fps, False)
                held = len(keys[0])
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())], ["a", "b"])
        if held:
            found, _, _ = flush(keys, fps, True)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())], ["a", "b"])

    return dealt.select("key", "fp").repartition(parts, "key").sortWithinPartitions("key").mapInArrow(search, "a long, b long")


def links(codes: DataFrame, store: Store) -> DataFrame:
    """(a, b): enough links to connect all of ``codes`` (fp, distinct) that lie within DISTANCE bits of each other."""
    spark = codes.sparkSession
    dealt, found = _keys(codes), None
    for _ in range(2):
        hot = dealt.groupBy("key").count().where(F.col("count") > GROUP).select("key")
        hot = store.keep(hot)
        if hot.isEmpty():
            break
        cold = _grouped_links(dealt.join(hot, "key", "left_anti"), parallelism(spark))
        found = cold if found is None else found.unionByName(cold)
        dealt = store.keep(_finer(dealt.join(hot, "key", "left_semi")))
    rest = _grouped_links(dealt, parallelism(spark))
    return rest if found is None else found.unionByName(rest)


def near_duplicates(docs: DataFrame, words: int = 3) -> DataFrame:
    """Each row of ``docs`` with its fingerprint (16 hex digits) and the smallest doc_id of its component.

    Nulls: a null text is empty (fingerprint zero, linked like any other); a
    null doc_id keeps its row and never names a component unless all its
    members lack one, when component_id is null. Repeated rows repeat. Only
    ``doc_id`` and ``text`` are read, so further columns cannot clash. Exact
    copies share a fingerprint and are never paired: the index holds distinct
    fingerprints only.
    """
    store = Store(docs.sparkSession)
    rows = store.keep(fingerprints(docs, words))
    return rows.join(_named(rows, store), "fp").select(
        "doc_id",
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
    )


def _named(rows: DataFrame, store: Store) -> DataFrame:
    """(fp, root, component_id) of each fingerprint."""
    codes = store.keep(rows.groupBy("fp").agg(F.min("doc_id").alias("first")))
    roots = components(links(codes.select("fp"), store), store)
    placed = store.keep(codes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root")))
    named = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    return store.keep(placed.join(named, "root").select("fp", "root", "component_id"))


class Documents:
    """Exact comparison of the texts of candidate groups: the Gray-ordered index proposes what differs in WIDE bits at most, the shingle sets decide."""

    def __init__(self, texts: list[str]):
        self.sets = [np.unique(shingle_hashes(x.encode(), WORDS)) for x in texts]
        self.codes = np.array([fingerprint(x) for x in self.sets], np.uint64)

    def similar(self, a: int, b: int) -> bool:
        x, y = self.sets[a], self.sets[b]
        if min(len(x), len(y)) < SIMILAR * max(len(x), len(y)) - 1e-6:
            return False
        common = len(np.intersect1d(x, y, assume_unique=True))
        return common >= SIMILAR * (len(x) + len(y) - common) - 1e-6

    def links(self, teams: list[np.ndarray]) -> list[tuple[int, int]]:
        forest = Forest(len(self.sets))
        for team in teams:
            order = team[np.argsort(gray_rank(self.codes[team]))]
            for left, right in near_pairs(self.codes[order], WIDE):
                for a, b in zip(order[left].tolist(), order[right].tolist(), strict=True):
                    if forest.root(a) != forest.root(b) and self.similar(a, b):
                        forest.join(a, b)
        return forest.links()


def _band_rows(rows: DataFrame, shares: int) -> DataFrame:
    """(share, packed): the band keys of the word shingles of each distinct text of a slice."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, most=2 << 20):
            ids, first = np.unique(batch.column("h1").to_numpy(), return_index=True)
            texts = byte_texts(batch)
            sets = [np.unique(shingle_hashes(texts[k], WORDS)) for k in first.tolist()]
            there = np.flatnonzero([len(x) > 0 for x in sets])
            if len(there):
                own = [sets[k] for k in there.tolist()]
                owner = np.repeat(np.arange(len(own)), [len(x) for x in own])
                yield packed(band_keys(np.concatenate(own), owner, len(own)), ids[there], shares)

    return rows.select("h1", "text").mapInArrow(scan, PACKED)


def _wanted_texts(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """(line, line2, content): the texts whose first hash is wanted; of texts that share it, one."""
    shared = rows.sparkSession.sparkContext.broadcast(bit_table(wanted, "line"))

    def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(shared.value, np.uint8)
        for batch in batches:
            yield batch.filter(pa.array(in_table(bits, batch.column("line").to_numpy())))

    named = rows.select(F.col("h1").alias("line"), F.col("h2").alias("line2"), F.col("text").alias("content"))
    found = named.mapInArrow(likely, "line long, line2 long, content string").join(wanted, "line", "left_semi")
    return found.groupBy("line").agg(F.min("line2").alias("line2"), F.min_by("content", "line2").alias("content"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that come first in their group (by doc_id, null last, then hashes of the text), with their own columns.

    Texts are linked if their sets of WORDS-word shingles (A-Z lowered; a
    shorter text is one) have a Jaccard similarity of SIMILAR or more; groups
    are the components of the links. Bands of MinHash sketches deal out the
    search, which at this distance no choice of a fingerprint's bits could: a
    pair meets in one of them 998 times in a thousand at the least similarity,
    and is 20 bits apart or nearer practically always. Inside a band the
    fingerprints' Gray-ordered index proposes pairs and the shingle sets
    decide. Nulls: a null text is empty, a null doc_id comes last. Equal texts
    are one group; texts without words are linked to equal texts only. Of
    repeated rows one stays. An empty table gives an empty one.
    """
    spark = docs.sparkSession
    store, parts = Store(spark), parallelism(spark)
    rows = keyed(docs)
    placed = store.keep(rows.select(*KEY))
    enough = max(parts, -(-placed.count() * banding.BANDS // banding.TASK_ROWS))
    groups = store.keep(banding.groups(_band_rows(rows, banding.SHARES * enough), enough).distinct())
    wanted = store.keep(groups.select("line").distinct())
    texts = store.keep(_wanted_texts(rows, wanted))
    roots = components(banding.links(groups, texts, store, parts, Documents), store)
    roots = store.keep(roots.withColumnRenamed("node", "h1").join(texts.select(F.col("line").alias("h1"), F.col("line2").alias("h2")), "h1"))
    store.drop(groups, wanted, texts)

    part2 = F.when(F.col("root").isNull(), F.col("h2")).otherwise(0).alias("part2")
    named = placed.join(roots, ["h1", "h2"], "left").select(*KEY, F.coalesce("root", "h1").alias("part"), part2)
    firsts = named.groupBy("part", "part2").agg(F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), *KEY)).alias("first")).select("first.*")
    same = [F.col(f"p.{c}").eqNullSafe(F.col(f"f.{c}")) for c in KEY]
    gone = store.keep(placed.distinct().alias("p").join(firsts.alias("f"), same, "left_anti"))
    one, two = fresh(docs, "hash"), fresh(docs, "hash2")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    base = docs.withColumn(one, F.xxhash64(text)).withColumn(two, F.xxhash64(F.lit("second"), text))
    right = gone.select(F.col("doc_id").alias("_d"), F.col("h1").alias("_1"), F.col("h2").alias("_2"))
    kept = base.join(right, (base[one] == right["_1"]) & (base[two] == right["_2"]) & base["doc_id"].cast("long").eqNullSafe(right["_d"]), "left_anti")
    if not placed.groupBy(*KEY).count().where("count > 1").isEmpty():
        kept = kept.dropDuplicates([one, two, "doc_id"])
    return kept.select(*docs.columns)
