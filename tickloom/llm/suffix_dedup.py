"""Exact removal of repeated 200-byte strings, settled by suffix arrays of grouped pieces.

Every 200-byte window has an anchor, the 50-byte gram of least hash inside it.
Equal windows have equal anchors at equal offsets, so a repeat can only be
found among the occurrences of one anchor. Neighbouring windows of one anchor
form a chunk. Three steps narrow the work, none of them loses a repeat:

1. Anchors that occur once are dropped. An anchor whose chunks are all equal is
   settled: all its windows repeat.
2. In the other anchors, chunks that occur twice are settled too. Each distinct
   chunk is cut into pieces: windows whose offsets lie in one class of
   ``CLASS`` share a core of ``LENGTH - CLASS + 1`` bytes. A core that occurs
   in one piece only has no repeat.
3. Pieces of one core differ in the few bytes around it. With the core as one
   symbol they are joined to a text, whose suffix array shows which windows
   (runs of ``CLASS`` symbols) occur twice.

The suffix array is built by linear grouping: suffixes are grouped by their
Lyndon prefixes, groups are processed in descending order, find their
previous-smaller pointers through the pointers of the groups done before, and
refine the groups that they point to; a second pass emits each group's order
along the pointers. Nothing is renamed or recursed.

Suffix arrays of whole corpora are out of reach for Python; the narrowing keeps
the text that they sort to the surroundings of the places where repeats end,
and settles most windows by equal hashes (the README gives the shares).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm._common import KEY, Store, bit_table, byte_texts, in_table, keyed, parallelism, runs, slices

LENGTH = 200
GRAM = 50
CLASS = 32
CORE = LENGTH - CLASS + 1
SPREAD = LENGTH - GRAM + 1
#: Bytes hashed at once; places inside fit PLACE bits.
SEGMENT, PLACE = 1 << 18, 19
#: Pieces of one core that one suffix array takes; larger groups are dealt to several, compared by window hashes.
BLOCK = 2000
#: Symbols of one suffix array, about.
SYMBOLS = 1 << 16

BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
POWERS = {}


def _powers(base: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a base and of its inverse modulo 2**64."""
    if base not in POWERS:
        both = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(SEGMENT + LENGTH + 1, b, np.uint64)
            p[0] = 1
            both.append(np.multiply.accumulate(p))
        POWERS[base] = tuple(both)
    return POWERS[base]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xC2B2AE3D27D4EB4F)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x165667B19E3779F9)
    return h ^ (h >> np.uint64(32))


class Hashes:
    """Hashes of any substrings of up to SEGMENT bytes, from prefix sums."""

    def __init__(self, data: np.ndarray, base: int):
        self.up, down = _powers(base)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * down[: len(data)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mix((self.sums[end] - self.sums[start]) * self.up[start])


class Chunks:
    """The chunks of a few documents: arrays by chunk."""

    def __init__(self, texts: list[bytes]):
        self.data = b"".join(texts)
        flat = np.frombuffer(self.data, np.uint8)
        n = len(flat) - LENGTH + 1
        none = np.empty(0, np.int64)
        self.doc = self.low = self.count = self.offset = self.begin = none
        self.anchor = self.chunk = np.empty(0, np.uint64)
        if n <= 0:
            return
        ends = np.cumsum([len(x) for x in texts])
        owner = np.repeat(np.arange(len(texts)), [len(x) for x in texts])
        self.hashes = Hashes(flat, BASES[0])
        at = np.arange(len(flat) - GRAM + 1)
        gram = self.hashes.of(at, at + GRAM)
        low = (gram >> np.uint64(PLACE) << np.uint64(PLACE)) | at.astype(np.uint64)
        width = 1
        while width * 2 <= SPREAD:
            low = np.minimum(low[:-width], low[width:])
            width *= 2
        low = np.minimum(low[: len(low) - (SPREAD - width)], low[SPREAD - width :])
        least = (low & np.uint64((1 << PLACE) - 1)).astype(np.int64)
        start = np.flatnonzero(np.arange(n) + LENGTH <= ends[owner[:n]])
        if not len(start):
            return
        least = least[start]
        new = np.append(True, (least[1:] != least[:-1]) | (start[1:] != start[:-1] + 1))
        first = np.flatnonzero(new)
        self.begin = start[first]
        self.count = np.diff(np.append(first, len(start)))
        place = least[first]
        self.doc = owner[self.begin]
        self.low = self.begin - (ends - [len(x) for x in texts])[self.doc]
        self.offset = place - self.begin
        # Anchors are least hashes; mixed again, their leading bits fill the bit tables evenly.
        self.anchor = _mix(gram[place] ^ np.uint64(BASES[1]))
        self.chunk = _mix(self.hashes.of(self.begin, self.begin + self.count + LENGTH - 1) + (self.offset * 512 + self.count).astype(np.uint64))

    def pieces(self, which: np.ndarray) -> dict[str, list]:
        """The pieces of some chunks: chunk number, class, hashes of the core, bytes left and right of it."""
        out = {k: [] for k in ("k", "q", "core", "core2", "left", "right")}
        if not len(which):
            return out
        second = Hashes(np.frombuffer(self.data, np.uint8), BASES[1])
        high = self.offset[which]
        least = high - self.count[which] + 1
        for q in range((SPREAD - 1) // CLASS + 1):
            here = (least < (q + 1) * CLASS) & (high >= q * CLASS)
            own = which[here]
            o1, o2 = np.maximum(least[here], q * CLASS), np.minimum(high[here], q * CLASS + CLASS - 1)
            core = self.begin[own] + self.offset[own] - q * CLASS
            out["core"] += (self.hashes.of(core, core + CORE) + np.uint64(q)).view(np.int64).tolist()
            out["core2"] += second.of(core, core + CORE).view(np.int64).tolist()
            out["k"] += own.tolist()
            out["q"] += [q] * len(own)
            for c, a, b in zip(core.tolist(), (o1 - q * CLASS).tolist(), (o2 - q * CLASS).tolist(), strict=True):
                out["left"].append(self.data[c - b : c])
                out["right"].append(self.data[c + CORE : c + CORE + CLASS - 1 - a])
        return out


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[int], list[int], list[bytes]]]:
    """(batch, row numbers, first bytes, texts) of SEGMENT bytes at most; long texts are cut so that each window is in one part."""
    for batch in slices(batches, most=SEGMENT // 2):
        rows, first, texts, held = [], [], [], 0
        for k, data in enumerate(byte_texts(batch)):
            for at in range(0, max(1, len(data) - LENGTH + 1), SEGMENT // 2):
                part = data[at : at + SEGMENT // 2 + LENGTH - 1]
                if held + len(part) > SEGMENT:
                    yield batch, rows, first, texts
                    rows, first, texts, held = [], [], [], 0
                rows.append(k)
                first.append(at)
                texts.append(part)
                held += len(part)
        yield batch, rows, first, texts


def _anchor_counts(rows: DataFrame) -> DataFrame:
    """(anchor, pure): the anchors that occur twice at least; pure if all their chunks are equal."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, _, texts in _segments(batches):
            c = Chunks(texts)
            if len(c.anchor):
                yield pa.RecordBatch.from_arrays([pa.array(c.anchor.view(np.int64)), pa.array(c.chunk.view(np.int64))], ["anchor", "chunk"])

    found = rows.select("text").mapInArrow(scan, "anchor long, chunk long")
    return found.groupBy("anchor").agg(F.count("*").alias("n"), F.min("chunk").alias("a"), F.max("chunk").alias("b")).where("n > 1").select("anchor", (F.col("a") == F.col("b")).alias("pure"))


OCCURRENCE = "doc_id long, h1 long, h2 long, anchor long, chunk long, low long, count int, offset int, pieces array<struct<q:int,core:long,core2:long,left:binary,right:binary>>"
PIECES = pa.list_(pa.struct([("q", pa.int32()), ("core", pa.int64()), ("core2", pa.int64()), ("left", pa.binary()), ("right", pa.binary())]))


def _occurrences(rows: DataFrame, anchors: DataFrame) -> DataFrame:
    """The chunks whose anchors may repeat; of each distinct chunk of a mixed anchor, one in a segment carries its pieces."""
    context = rows.sparkSession.sparkContext
    repeated, mixed = context.broadcast(bit_table(anchors, "anchor")), context.broadcast(bit_table(anchors.where("not pure"), "anchor"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        two, many = np.frombuffer(repeated.value, np.uint8), np.frombuffer(mixed.value, np.uint8)
        for batch, numbers, first, texts in _segments(batches):
            c = Chunks(texts)
            hit = np.flatnonzero(in_table(two, c.anchor)) if len(c.anchor) else np.empty(0, np.int64)
            if not len(hit):
                continue
            _, once = np.unique(c.chunk[hit], return_index=True)
            once = hit[np.sort(once)]
            cut = c.pieces(once[in_table(many, c.anchor[once])])
            own: dict[int, list] = {}
            for k, *piece in zip(*cut.values(), strict=True):
                own.setdefault(k, []).append(dict(zip(("q", "core", "core2", "left", "right"), piece, strict=True)))
            at = np.array(numbers)[c.doc[hit]]
            keys = [batch.column(k).take(pa.array(at)) for k in KEY]
            low = c.low[hit] + np.array(first)[c.doc[hit]]
            numbers_ = [pa.array(c.anchor[hit].view(np.int64)), pa.array(c.chunk[hit].view(np.int64)), pa.array(low), pa.array(c.count[hit].astype(np.int32)), pa.array(c.offset[hit].astype(np.int32))]
            yield pa.RecordBatch.from_arrays([*keys, *numbers_, pa.array([own.get(k) for k in hit.tolist()], PIECES)], [x.split()[0] for x in OCCURRENCE.split(", ", 8)])

    return rows.select(*KEY, "text").mapInArrow(scan, OCCURRENCE)


def suffix_array(text: str) -> list[int]:
    """The suffix array of a text whose last character is its only least one, in linear time but for sorting each group's places."""
    n = len(text)
    # Groups as intervals of one array, at first by character.
    order = sorted(range(n), key=text.__getitem__)
    place, start, size = [0] * n, [0] * n, [0] * n
    k = 0
    while k < n:
        e = k
        while e < n and text[order[e]] == text[order[k]]:
            place[order[e]] = e
            start[order[e]] = k
            e += 1
        size[k] = e - k
        k = e
    # Groups in descending order lengthen the prefixes of the suffixes that they hang on: the last before them in a smaller group.
    before = [-1] * n
    end = n
    while end > 0:
        begin = start[order[end - 1]]
        times: dict[int, int] = {}
        for i in sorted(order[begin:end]):
            p = i - 1
            # Greater groups are done, so their pointers lead on.
            while p >= 0 and start[p] > begin:
                p = before[p]
            if p >= 0 and start[p] == begin:
                p = before[p]
            before[i] = p
            if p >= 0:
                times[p] = times.get(p, 0) + 1
        by_count: dict[int, list[int]] = {}
        for p, t in times.items():
            by_count.setdefault(t, []).append(p)
        for t in sorted(by_count, reverse=True):
            moved: dict[int, int] = {}
            for p in by_count[t]:
                g = start[p]
                m = moved.get(g, 0) + 1
                moved[g] = m
                last = g + size[g] - m
                other, at = order[last], place[p]
                order[at], order[last] = other, p
                place[other], place[p] = at, last
            for g, m in moved.items():
                if m == size[g]:
                    continue
                size[g] -= m
                new = g + size[g]
                size[new] = m
                for at in range(new, new + m):
                    start[order[at]] = new
        end = begin
    # A suffix follows its group's prefix; the suffixes that end in front of a placed one are its chain of pointers.
    out, head, placed = [-1] * n, list(range(n)), [False] * n
    out[0] = n - 1
    for k in range(n):
        p = out[k] - 1
        while p >= 0 and not placed[p]:
            g = start[p]
            out[head[g]] = p
            head[g] += 1
            placed[p] = True
            p = before[p]
    return out


def repeated_windows(pieces: list[tuple[int, bytes, bytes]]) -> list[int]:
    """A mask for each piece (core number, left, right): bit l is set if the window with l bytes left of the core occurs in another piece too."""
    masks = [0] * len(pieces)
    parts, at, origin = [], 0, []
    for k, (core, left, right) in enumerate(pieces):
        # 0 ends the text, 1 parts pieces, bytes follow, cores come last.
        part = "".join(map(chr, [x + 2 for x in left] + [258 + core] + [x + 2 for x in right])) + "\x01"
        parts.append(part)
        windows = len(left) + 1 - (CLASS - 1 - len(right))
        origin += [(k, len(left) - x) if x < windows else None for x in range(len(part))]
        at += len(part)
    text = "".join(parts) + "\x00"
    order = suffix_array(text)
    previous, held = None, None
    for i in order:
        if i >= len(origin) or origin[i] is None:
            continue
        window = text[i : i + CLASS]
        if window == previous:
            for k, left in (held, origin[i]):
                masks[k] |= 1 << left
        previous, held = window, origin[i]
    return masks


def _masks(pieces: DataFrame, parts: int) -> DataFrame:
    """(anchor, chunk, q, mask, core, core2) of the pieces, which come with their core's deal."""
    schema = "anchor long, chunk long, q int, mask long, core long, core2 long, hot boolean, left binary, right binary"

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in runs(batches, "unit"):
            rows = batch.to_pylist()
            rows.sort(key=lambda r: (r["core"], r["core2"], r["deal"]))
            block, used, seen = [], 0, {}
            for k, r in enumerate(rows):
                team = (r["core"], r["core2"], r["deal"])
                if used > SYMBOLS and team not in seen:
                    yield tell(block, seen)
                    block, used, seen = [], 0, {}
                seen.setdefault(team, len(seen))
                block.append(r)
                used += len(r["left"]) + len(r["right"]) + 2
            if block:
                yield tell(block, seen)

    def tell(block: list[dict], seen: dict) -> pa.RecordBatch:
        # Equal pieces of several chunks repeat each other whole; one of them stands for all.
        numbers: dict[tuple[int, bytes, bytes], int] = {}
        own = [numbers.setdefault((seen[r["core"], r["core2"], r["deal"]], r["left"], r["right"]), len(numbers)) for r in block]
        found = repeated_windows(list(numbers))
        times = np.bincount(own)
        whole = (1 << CLASS) - 1
        masks = [whole >> (CLASS - 1 - len(r["left"])) & ~((1 << (CLASS - 1 - len(r["right"]))) - 1) if times[k] > 1 else found[k] for k, r in zip(own, block, strict=True)]
        columns = [pa.array([r[c] for r in block], t) for c, t in (("anchor", pa.int64()), ("chunk", pa.int64()), ("q", pa.int32()))]
        columns += [pa.array(masks, pa.int64())]
        columns += [pa.array([r[c] for r in block], pa.int64()) for c in ("core", "core2")]
        columns += [pa.array([r["hot"] for r in block])]
        columns += [pa.array([r[c] if r["hot"] else None for r in block], pa.binary()) for c in ("left", "right")]
        return pa.RecordBatch.from_arrays(columns, ["anchor", "chunk", "q", "mask", "core", "core2", "hot", "left", "right"])

    # Runs are gathered by deal, so that the deals of a large core which meet in a task stay apart.
    dealt = pieces.withColumn("unit", F.xxhash64("core", "core2", "deal")).repartition(parts, "unit").sortWithinPartitions("unit")
    return dealt.mapInArrow(settle, schema)


def _across_blocks(masks: DataFrame, store: Store) -> DataFrame:
    """(anchor, chunk, q, mask): windows of hot cores that occur in several blocks, found by counting window hashes."""
    schema = "anchor long, chunk long, q int, core long, core2 long, l int, window long"

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            out = []
            for r in batch.select(["anchor", "chunk", "q", "core", "core2", "left", "right"]).to_pylist():
                least = CLASS - 1 - len(r["right"])
                for left in range(least, len(r["left"]) + 1):
                    window = r["left"][len(r["left"]) - left :] + b"|" + r["right"][: CLASS - 1 - left]
                    out.append((r["anchor"], r["chunk"], r["q"], r["core"], r["core2"], left, xxhash.xxh64_intdigest(window) - (1 << 63)))
            columns = list(zip(*out, strict=True)) or [[]] * 7
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], [x.split()[0] for x in schema.split(", ")])

    each = masks.where("hot").mapInArrow(windows, schema)
    # Written, so that the join can split a window that thousands of pieces share.
    twice = store.keep(each.groupBy("core", "core2", "l", "window").agg(F.count("*").alias("n")).where("n > 1").drop("n"))
    met = each.join(twice, ["core", "core2", "l", "window"])
    return met.groupBy("anchor", "chunk", "q").agg(F.bit_or(F.expr("shiftleft(1L, l)")).alias("mask"))


def _marks(mixed: DataFrame, store: Store, parts: int) -> DataFrame:
    """(anchor, chunk, whole, masks): what repeats in the chunks of mixed anchors."""
    chunks = store.keep(mixed.groupBy("anchor", "chunk").agg(F.count("*").alias("n")))
    pieces = mixed.where("pieces is not null").select("anchor", "chunk", F.explode("pieces").alias("p")).select("anchor", "chunk", "p.*")
    # Written tables have no partitioning of their own, so that the joins which follow can split a frequent core or chunk.
    pieces = store.keep(pieces.groupBy("anchor", "chunk", "q", "core", "core2").agg(F.min("left").alias("left"), F.min("right").alias("right")))
    cores = store.keep(pieces.groupBy("core", "core2").agg(F.count("*").alias("n")).where("n > 1"))
    deal = F.pmod("chunk", F.ceil(F.col("n") / BLOCK).cast("long")).cast("int")
    dealt = pieces.join(cores, ["core", "core2"]).select(*pieces.columns, deal.alias("deal"), (F.col("n") > BLOCK).alias("hot"))
    masks = store.keep(_masks(dealt, parts))
    told = masks.where("mask <> 0").select("anchor", "chunk", "q", "mask")
    if not masks.where("hot").isEmpty():
        told = told.unionByName(_across_blocks(masks, store))
    told = told.groupBy("anchor", "chunk", "q").agg(F.bit_or("mask").alias("mask"))
    single = told.groupBy("anchor", "chunk").agg(F.collect_list(F.struct("q", "mask")).alias("masks"))
    met = chunks.join(single, ["anchor", "chunk"], "left").where("n > 1 or masks is not null")
    marks = store.keep(met.select("anchor", "chunk", (F.col("n") > 1).alias("whole"), "masks"))
    store.drop(chunks, pieces, cores, masks)
    return marks


def merged(doc: np.ndarray, first: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc, start, end) of the maximal byte ranges that ranges of repeated window starts cover."""
    order = np.lexsort((first, doc))
    doc, first, end = doc[order], first[order], end[order] + LENGTH - 1
    # Documents are set apart so far that one running maximum serves all.
    apart = doc * (int(end.max(initial=0)) + 2)
    reach = np.maximum.accumulate(end + apart)
    new = np.append(True, first[1:] + apart[1:] > reach[:-1])
    start = np.flatnonzero(new)
    last = np.append(start[1:], len(doc)) - 1
    return doc[start], first[start], reach[last] - apart[last]


def repeated_ranges(docs: DataFrame, store: Store) -> DataFrame:
    """(doc_id, h1, h2, ranges): for each distinct (doc_id, text) with repeats, the ranges of its repeated windows' starts."""
    parts = parallelism(docs.sparkSession)
    rows = keyed(docs)
    anchors = store.keep(_anchor_counts(rows))
    real = store.keep(_occurrences(rows, anchors).join(anchors, "anchor"))
    marks = _marks(real.where("not pure"), store, parts)
    whole = F.struct(F.col("low").alias("first"), (F.col("low") + F.col("count")).alias("end")).alias("range")
    pure = real.where("pure").select(*KEY, whole)
    other = real.where("not pure").select(*KEY, "anchor", "chunk", "low", "count", "offset").join(marks, ["anchor", "chunk"])
    full = other.where("whole").select(*KEY, whole)
    # Bit l of a class's mask: the window that starts l bytes before the core. Runs of bits become ranges of starts.
    bit = f"array_compact(transform(sequence(0, {CLASS - 1}), b -> if((shiftright(m.mask, b) & 1L) = 1L and (b = {{0}} or (shiftright(m.mask, b + {{1}}) & 1L) = 0L), b, null)))"
    bits = F.arrays_zip(F.expr(bit.format(0, -1)).alias("low"), F.expr(bit.format(CLASS - 1, 1)).alias("high"))
    single = other.where("not whole").select(*KEY, "low", "offset", F.explode("masks").alias("m")).select(*KEY, "low", "offset", F.col("m.q").alias("q"), F.explode(bits).alias("l"))
    core = F.col("low") + F.col("offset") - F.col("q") * CLASS
    single = single.select(*KEY, F.struct((core - F.col("l.high")).cast("long").alias("first"), (core - F.col("l.low") + 1).cast("long").alias("end")).alias("range"))
    by_doc = pure.unionByName(full).unionByName(single).groupBy(*KEY).agg(F.collect_set("range").alias("ranges"))
    # Rows of one doc_id and text send the same ranges; a set holds them once.
    kept = store.keep(by_doc)
    store.drop(real, marks, anchors)
    return kept


def remove_repeats(docs: DataFrame, texts: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) for each row of ``docs``; with ``texts`` also kept, the bytes that stay.

    Removes every byte covered by a 200-byte string of the UTF-8 text that also
    starts anywhere else, in the same document or another one. Nulls: a null
    text is empty, a null doc_id keeps its row. Repeated rows repeat, and each
    is a place where its strings occur, so long ones lose everything. Texts
    below 200 bytes lose nothing. Only doc_id and text are read.
    """
    spark = docs.sparkSession
    store = Store(spark)
    rows = keyed(docs)
    found = repeated_ranges(docs, store)
    names = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    table = spark.sparkContext.broadcast(bit_table(found, "h2"))

    def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(table.value, np.uint8)
        for batch in batches:
            yield batch.filter(pa.array(in_table(bits, batch.column("h2").to_numpy())))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            lists = batch.column("ranges")
            ranges = lists.flatten()
            doc = np.repeat(np.arange(batch.num_rows), pc.list_value_length(lists).to_numpy())
            own, start, end = merged(doc, ranges.field("first").to_numpy(), ranges.field("end").to_numpy())
            cuts = np.searchsorted(own, np.arange(batch.num_rows + 1)).tolist()
            start, end, out = start.tolist(), end.tolist(), []
            for k, (doc_id, data) in enumerate(zip(batch.column("doc_id").to_pylist(), byte_texts(batch), strict=True)):
                kept, at = [], 0
                for s, e in zip(start[cuts[k] : cuts[k + 1]], end[cuts[k] : cuts[k + 1]], strict=True):
                    kept.append(data[at:s])
                    at = e
                kept = b"".join([*kept, data[at:]])
                out.append((doc_id, len(data), len(data) - len(kept), cuts[k + 1] - cuts[k], hashlib.sha256(kept).hexdigest(), kept if texts else None))
            kinds = [pa.int64()] * 4 + [pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], [x.split()[0] for x in names.split(", ")])

    # Only the texts with repeats move; a null id meets through the null-safe comparison.
    hits = rows.mapInArrow(likely, "doc_id long, text string, h1 long, h2 long")
    same = [F.col(f"t.{k}").eqNullSafe(F.col(f"f.{k}")) for k in KEY]
    edited = hits.alias("t").join(found.alias("f"), same).select("t.doc_id", "t.text", "f.ranges").mapInArrow(cut, names)
    plain = rows.select(*KEY, F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("sha"), *([F.encode("text", "UTF-8").alias("bytes")] if texts else []))
    rest = plain.alias("t").join(found.select(*KEY).alias("f"), same, "left_anti")
    zero = F.lit(0).cast("long")
    whole = rest.select("doc_id", "n_bytes", zero.alias("n_removed"), zero.alias("n_spans"), F.col("sha").alias("kept_sha256"), (F.col("bytes") if texts else F.lit(None).cast("binary")).alias("kept"))
    out = edited.unionByName(whole)
    return out if texts else out.drop("kept")
