"""High-recall banding of MinHash sketches, and the exact comparison of what shares a band.

A sketch of 48 bins is cut into 12 bands of four; sets that share a band are
candidates: 99.8 % of pairs at a Jaccard similarity of 0.8, and nearly all
above. Band rows are 16 bytes, carry no text and travel packed, a row for each
slice of texts and share of the keys. Equal candidate groups of several bands
are compared once. A group above ``TEAM`` members is dealt in blocks, each with
the group's pivots; only the members that no pivot's component takes in are
held against the other blocks, block by block, so that no task sees a whole
group and no link between components is lost.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm._common import Store, runs

BANDS, ROWS = 12, 4
BINS = BANDS * ROWS
#: Members of a group up to which it is dealt by its first member.
SMALL = 16
#: Members of a candidate group, or of a block of a larger group, that one task compares; and pivots of a larger group.
TEAM, PIVOTS = 512, 8
#: Band rows that one task sorts, about; and packed shares of the keys for each task.
TASK_ROWS, SHARES = 2_000_000, 16
ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)


def mixed(codes: np.ndarray, turn: int) -> np.ndarray:
    h = codes ^ np.uint64((turn + 1) * ODD[3] & (1 << 64) - 1)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(ODD[1])
    h = (h ^ (h >> np.uint64(29))) * np.uint64(ODD[2])
    return h ^ (h >> np.uint64(32))


def sketches(codes: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """A sketch of BINS values for each of ``n`` sets; ``owner`` tells whose each shingle code is.

    In each round every shingle falls into one bin; a bin keeps the least
    value of the first round that reached it. Rounds end when all bins are
    filled; from round BINS on, all shingles fall into one bin after another.
    """
    none = ~np.uint64(0)
    out = np.full(n * BINS, none)
    for turn in range(2 * BINS):
        if not len(codes):
            break
        h = mixed(codes, turn)
        bins = (h >> np.uint64(32)) * np.uint64(BINS) >> np.uint64(32) if turn < BINS else np.uint64(turn - BINS)
        value = np.uint64(turn << 56) | (h * np.uint64(ODD[0])) >> np.uint64(8)
        np.minimum.at(out, owner * BINS + bins.astype(np.int64), value)
        open_ = (out.reshape(-1, BINS) == none).any(axis=1)
        left = open_[owner]
        codes, owner = codes[left], owner[left]
    return out.reshape(-1, BINS)


def band_keys(codes: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """One 64-bit key for each set and band."""
    sketch = sketches(codes, owner, n).reshape(n, BANDS, ROWS)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (n, BANDS)).copy()
    for k in range(ROWS):
        key = (key ^ sketch[:, :, k]) * np.uint64(ODD[1])
        key ^= key >> np.uint64(31)
    return key.view(np.int64)


def packed(keys: np.ndarray, ids: np.ndarray, shares: int) -> pa.RecordBatch:
    """(share, packed): the (band key, id) pairs as 16 bytes each, a row for each share of the keys."""
    pairs = np.empty((keys.size, 2), np.int64)
    pairs[:, 0] = keys.ravel()
    pairs[:, 1] = np.repeat(ids, BANDS)
    share = ((pairs[:, 0].view(np.uint64) >> np.uint64(32)) * np.uint64(shares) >> np.uint64(32)).astype(np.int64)
    order = np.argsort(share, kind="stable")
    count = np.bincount(share, minlength=shares)
    there = np.flatnonzero(count)
    ends = np.append(0, np.cumsum(count[there]) * 16).astype(np.int32)
    blobs = pa.Array.from_buffers(pa.binary(), len(there), [None, pa.py_buffer(ends), pa.py_buffer(pairs[order])])
    return pa.RecordBatch.from_arrays([pa.array(there), blobs], ["share", "packed"])


PACKED = "share long, packed binary"


def groups(rows: DataFrame, parts: int) -> DataFrame:
    """(deal, team, n, line): ids that share a band, of packed rows; a team is known by its members, so that equal teams of several bands are one.

    Small teams are dealt by their first id: the teams of one id's bands
    meet in one task, which compares each of their pairs once. ``n`` is the
    size of the team.

    A task sorts one partition's keys, 16 bytes a row; ``parts`` keeps
    partitions at TASK_ROWS rows, so it holds about 100 MB.
    """

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.frombuffer(b"".join(b.column("packed").to_pylist()), np.int64).reshape(-1, 2) for b in batches if b.num_rows]
        if not held:
            return
        band, line = (np.concatenate([x[:, k] for x in held]) for k in (0, 1))
        held.clear()
        order = np.argsort(band)
        band, line = band[order], line[order]
        # Most keys occur once; only the others are looked at further.
        twice = np.append(False, band[1:] == band[:-1])
        twice[:-1] |= twice[1:]
        band, line = band[twice], line[twice]
        order = np.lexsort((line, band))
        band, line = band[order], line[order]
        new = np.append(True, (band[1:] != band[:-1]) | (line[1:] != line[:-1]))[: len(band)]
        band, line = band[new], line[new]
        start = np.flatnonzero(np.append(True, band[1:] != band[:-1])[: len(band)])
        size = np.diff(np.append(start, len(band)))
        many = np.repeat(size > 1, size)
        if many.any():
            team = np.add.reduceat(mixed(line.view(np.uint64), 1), start).view(np.int64)
            deal = np.where(size <= SMALL, line[start], team)
            columns = [np.repeat(deal, size)[many], np.repeat(team, size)[many], np.repeat(size, size)[many], line[many]]
            for at in range(0, len(columns[0]), 1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array(c[at : at + (1 << 16)]) for c in columns], ["deal", "team", "n", "line"])

    return rows.repartition(parts, "share").mapInArrow(gather, "deal long, team long, n long, line long")


class Forest:
    """Union-find over the numbers 0..n-1; the least number of a component is its root."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def root(self, x: int) -> int:
        parent = self.parent
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    def join(self, a: int, b: int) -> None:
        a, b = self.root(a), self.root(b)
        self.parent[max(a, b)] = min(a, b)

    def links(self) -> list[tuple[int, int]]:
        """Each number with its root, where they differ."""
        return [(x, r) for x in range(len(self.parent)) if (r := self.root(x)) != x]


#: Makes a comparison of contents; its ``links(teams)`` gives number pairs that span the components of each team's similar contents.
Kind = Callable[[list], object]


def verified(groups: DataFrame, texts: DataFrame, parts: int, kind: Kind) -> DataFrame:
    """(a, b): links of members that are similar indeed, from groups of TEAM lines at most."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in runs(batches, "deal"):
            team, line = batch.column("team").to_numpy(), batch.column("line").to_numpy()
            ids, first, place = np.unique(line, return_index=True, return_inverse=True)
            content = batch.column("content").take(pa.array(first)).to_pylist()
            order = np.lexsort((place, team))
            cuts = np.flatnonzero(np.diff(team[order])) + 1
            found = kind(content).links(np.split(place[order], cuts))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(ids[[x for x, _ in found]]), pa.array(ids[[y for _, y in found]])], ["a", "b"])

    full = groups.join(texts, "line").select("deal", "team", "line", "content")
    return full.repartition(parts, "deal").sortWithinPartitions("deal").mapInArrow(check, "a long, b long")


def _compared(units: DataFrame, texts: DataFrame, parts: int, kind: Kind) -> DataFrame:
    """(a, b, team): the links inside each unit (unit, team, line, pivot), and with b null the lines that the component of the unit's least pivot doesn't hold."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in runs(batches, "unit"):
            unit, line, team, pivot = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("unit", "line", "team", "pivot"))
            order = np.lexsort((line, unit))
            for own in np.split(order, np.flatnonzero(np.diff(unit[order])) + 1):
                ids = line[own]
                found = kind(batch.column("content").take(pa.array(own)).to_pylist()).links([np.arange(len(own))])
                root = np.arange(len(own))
                for x, r in found:
                    root[x] = r
                least = np.flatnonzero(pivot[own])
                apart = np.flatnonzero(root != root[least[0]]) if len(least) else np.empty(0, np.int64)
                a = np.concatenate([ids[[x for x, _ in found]] if found else ids[:0], ids[apart]])
                b = pa.array([int(ids[r]) for _, r in found] + [None] * len(apart), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(a), b, pa.array(np.full(len(a), team[own[0]]))], ["a", "b", "team"])

    full = units.join(texts, "line").select("unit", "team", "line", "pivot", "content")
    return full.repartition(parts, "unit").sortWithinPartitions("unit").mapInArrow(check, "a long, b long, team long")


def large_links(groups: DataFrame, texts: DataFrame, parts: int, store: Store, kind: Kind) -> DataFrame:
    """(a, b): links that span the components of groups above TEAM lines (team, n, line).

    Every block is compared with itself and the group's pivots. Lines that end
    up beside the least pivot are one component; any other line may still be
    similar to a line of another block, so these are dealt in blocks too and
    each is held against each block of the group. Work and copies grow with
    the lines that no pivot settles times the blocks of their group.
    """
    member = groups.select("team", "line", F.ceil(F.col("n") / TEAM).cast("long").alias("blocks")).distinct()
    member = store.keep(member.withColumn("block", F.pmod(F.xxhash64("line"), F.col("blocks"))))
    chosen = F.array_compact(F.array(*(F.min(F.when(F.pmod("line", F.lit(PIVOTS)) == k, F.col("line"))) for k in range(PIVOTS))))
    teams = member.groupBy("team").agg(F.max("blocks").alias("blocks"), chosen.alias("pivots"))
    own = F.xxhash64("team", "block")
    pivots = teams.select("team", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"), "pivots").select("team", "block", F.explode("pivots").alias("line"))
    units = member.select(own.alias("unit"), "team", "line", F.lit(False).alias("pivot")).unionByName(pivots.select(own.alias("unit"), "team", "line", F.lit(True).alias("pivot")))
    units = units.groupBy("unit", "team", "line").agg(F.max("pivot").alias("pivot"))
    first = store.keep(_compared(units, texts, parts, kind))
    found = first.where("b is not null").select("a", "b")
    # A pivot stands in every block; it is apart only if it is so in each, but a line too many costs time only.
    rest = store.keep(first.where("b is null").select("team", F.col("a").alias("line")).distinct())
    if rest.isEmpty():
        return found
    sizes = rest.groupBy("team").agg(F.ceil(F.count("*") / TEAM).cast("long").alias("others"))
    spread = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block")
    left = rest.join(teams.select("team", "blocks"), "team").join(sizes, "team").select("team", "line", F.pmod(F.xxhash64(F.lit("rest"), "line"), F.col("others")).alias("other"), spread)
    right = member.join(sizes, "team").select("team", "line", F.explode(F.sequence(F.lit(0).cast("long"), F.col("others") - 1)).alias("other"), "block")
    crossed = left.unionByName(right, allowMissingColumns=True).select(F.xxhash64("team", "other", "block").alias("unit"), "team", "line", F.lit(False).alias("pivot")).distinct()
    return found.unionByName(_compared(crossed, texts, parts, kind).where("b is not null").select("a", "b"))


def links(groups: DataFrame, texts: DataFrame, store: Store, parts: int, kind: Kind) -> DataFrame:
    """(a, b): links that span the components of similar members of written groups; ``texts`` (line, content) tells what ``kind`` compares."""
    found = verified(groups.where(F.col("n") <= TEAM), texts, parts, kind)
    large = groups.where(F.col("n") > TEAM)
    return found if large.isEmpty() else found.unionByName(large_links(large, texts, parts, store, kind))
