"""Mixing sources to target weights by cube-method balanced sampling.

A source's documents are all taken floor(target / size) times; the rest is a
fractional inclusion probability. The flight phase moves the probabilities
through the null space of two constraints (words and documents of the source),
three documents at a time, until each is 0 or 1. Blocks of a source fly on
their own and leave two documents undecided at most; those fly again, block by
block, until one block of a source is left. Its undecided documents and a few
more are the landing problem, decided by trying every choice, whatever the
other sources still need.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm._common import KEY, Store, byte_texts, fresh, parallelism, runs, slices

#: Times its size that a source (and a document) may give at most.
MOST = 3
#: Documents of one block of the flight phase, about.
BLOCK = 4096
#: Documents of a source's last block that are kept for the landing, besides the undecided ones.
POOL = 12
TINY = 1e-9
#: Bytes of a table with a row for each source up to which joins broadcast it; above, they shuffle.
BROADCAST_BYTES = 16 << 20


def sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, h1, h2, source, size): words of each row, runs of anything but the six ASCII blanks."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            counts = pa.array([len(x.split()) for x in byte_texts(batch)], pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in (*KEY, "source")), counts], [*KEY, "source", "size"])

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("h1"), F.xxhash64(F.lit("second"), text).alias("h2"), F.col("source").cast("string").alias("source"), text.alias("text"))
    return rows.mapInArrow(scan, "doc_id long, h1 long, h2 long, source string, size long")


def _ranked(totals: DataFrame, store: Store) -> DataFrame:
    """``totals`` with each source's place in the order of code points, null last: ranges are sorted on their own, only their sizes are summed up."""
    parts = parallelism(store.spark)
    order = F.col("source").asc_nulls_last()
    dealt = store.keep(totals.repartitionByRange(parts, order).withColumn("part", F.spark_partition_id()))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # A row for each range, as many as shuffle partitions.
    offset = dealt.groupBy("part").agg(F.count("*").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = F.row_number().over(Window.partitionBy("part").orderBy(order)) - 1
    return dealt.withColumn("place", inside).join(F.broadcast(offset), "part").select("source", "total", (F.col("place") + F.col("offset")).alias("place"))


def targets(totals: DataFrame, store: Store, weights: tuple[float, ...] = (1.0, 2.0, 3.0), most: float = MOST) -> DataFrame:
    """(source, total, target): the words that each source of ``totals`` (source, total) shall give.

    Sources in the order of their code points, null last, weigh ``weights`` in
    turn and share the sum of all sizes; no target exceeds ``most`` times its
    source's size, and what that cuts off is shared by weight among the rest.
    Each round sees the sums of all sources only; what one weight gets rises
    from round to round, until no more sources are cut off.
    """
    turn = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("place") % len(weights)).cast("int") + 1)
    own = store.keep(_ranked(totals, store).select("source", "total", turn.alias("weight"), (F.col("total") * float(most)).alias("cap")))
    left, weight = own.agg(F.sum("total"), F.sum("weight")).first()
    whole, cut = float(left or 0), 0
    left = whole
    while weight:
        over = F.col("weight") * left / weight > F.col("cap")
        now, capped, free = own.agg(F.count(F.when(over, 1)), F.sum(F.when(over, F.col("cap"))), F.sum(F.when(~over, F.col("weight")))).first()
        if now <= cut:
            return own.select("source", "total", F.when(over, F.col("cap")).otherwise(F.col("weight") * left / weight).alias("target"))
        cut, left, weight = now, whole - capped, free or 0.0
    return own.select("source", "total", "cap").withColumnRenamed("cap", "target")


def flight(size: list[int], chance: list[float], seed: int) -> tuple[list[float], list[int]]:
    """Move the chances of one block until two at most are neither 0 nor 1; their places come second.

    Keeps sum(chance) and sum(size * chance), and every chance in expectation.
    """
    draw = random.Random(seed)
    p, open_ = list(chance), []
    for k in range(len(p)):
        if TINY < p[k] < 1 - TINY:
            open_.append(k)
        else:
            p[k] = float(round(p[k]))
        while len(open_) == 3:
            i, j, h = open_
            u = (float(size[j] - size[h]), float(size[h] - size[i]), float(size[i] - size[j]))
            if not any(u):
                u = (1.0, -1.0, 0.0)
            up = min((1 - p[x]) / v if v > 0 else -p[x] / v for x, v in zip(open_, u, strict=True) if v)
            down = min(p[x] / v if v > 0 else (p[x] - 1) / v for x, v in zip(open_, u, strict=True) if v)
            step = up if draw.random() * (up + down) < down else -down
            for x, v in zip(open_, u, strict=True):
                p[x] += step * v
                if p[x] < TINY or p[x] > 1 - TINY:
                    p[x] = float(round(p[x]))
            open_ = [x for x in open_ if 0 < p[x] < 1]
    return p, open_


def land(size: list[int], chance: list[float]) -> list[int]:
    """Decide the last few documents together: the choice whose words, then number, come nearest to what was expected."""
    choices = np.arange(1 << len(size))[:, None] >> np.arange(len(size)) & 1
    words = np.abs(choices @ np.array(size, float) - np.dot(size, chance))
    number = np.abs(choices.sum(axis=1) - sum(chance))
    scale = max(1.0, sum(size) / len(size))
    return choices[int(np.argmin(words / scale + 0.01 * number))].tolist()


ROW = "doc_id long, h1 long, h2 long, nth int, source string, size long, chance double"
NAMES = [x.split()[0] for x in ROW.split(", ")]


def _fly(dealt: DataFrame, parts: int) -> DataFrame:
    """Each row with its chance moved; where ``last`` is set the undecided ones are landed. A task holds one block."""

    def move(size: list[int], chance: list[float], seed: int, last: bool) -> list[float]:
        n = max(0, len(size) - POOL) if last else len(size)
        moved, undecided = flight(size[:n], chance[:n], seed)
        moved += chance[n:]
        if last:
            undecided += range(n, len(size))
            for k, got in zip(undecided, land([size[k] for k in undecided], [moved[k] for k in undecided]), strict=True):
                moved[k] = float(got)
        return moved

    def fly(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in runs(batches, "unit"):
            size, chance, mark, last = (batch.column(c).to_pylist() for c in ("size", "chance", "mark", "last"))
            unit, block, source = batch.column("unit").to_numpy(), batch.column("block").to_numpy(), batch.column("source").to_pylist()
            cuts = [k for k in range(1, len(size)) if unit[k] != unit[k - 1] or block[k] != block[k - 1] or source[k] != source[k - 1]]
            moved = []
            for a, b in zip([0, *cuts], [*cuts, len(size)], strict=True):
                moved += move(size[a:b], chance[a:b], mark[a], last[a])
            columns = [pa.array(moved) if c == "chance" else batch.column(c) for c in NAMES]
            yield pa.RecordBatch.from_arrays(columns, NAMES)

    placed = dealt.withColumn("unit", F.xxhash64("source", "block")).repartition(parts, "unit")
    return placed.sortWithinPartitions("unit", "source", "block", "mark", *KEY, "nth").mapInArrow(fly, ROW)


def _met(rows: DataFrame, per_source: DataFrame) -> DataFrame:
    """``rows`` with the columns of ``per_source`` (source, ...), a written table: broadcast if its bytes allow that, else shuffled."""
    n, named = per_source.agg(F.count("*"), F.sum(F.octet_length("source"))).first()
    right = per_source.withColumnRenamed("source", "of")
    right = F.broadcast(right) if 64 * n + (named or 0) <= BROADCAST_BYTES else right
    return rows.join(right, F.col("source").eqNullSafe(F.col("of"))).drop("of")


def _dealt(rows: DataFrame, store: Store, level: int) -> tuple[DataFrame, bool]:
    """Rows with a mark that orders them, a block and whether their source is one block (last); whether every source is."""
    blocks = store.keep(rows.groupBy("source").agg(F.ceil(F.count("*") / BLOCK).cast("long").alias("blocks")))
    dealt = _met(rows, blocks).withColumn("mark", F.xxhash64(F.lit(level), *KEY, "nth"))
    dealt = dealt.withColumn("block", F.pmod("mark", "blocks")).withColumn("last", F.col("blocks") == 1).drop("blocks")
    return dealt, blocks.where("blocks > 1").isEmpty()


def mix(docs: DataFrame, weights: tuple[float, ...] = (1.0, 2.0, 3.0), most: float = MOST) -> DataFrame:
    """(doc_id, h1, h2, source, size, source_size, target, copies, taken) for each row of ``docs``.

    ``copies`` is how often the mix takes the document, ``taken`` its words
    with repeats. Nulls: a null text has size 0, a null source is a source of
    its own and comes last, a null doc_id keeps its row. Documents without
    words are never taken. Repeated rows are drawn one by one. Draws depend on
    doc_id and text alone, so reruns agree. An empty table, or one without
    words, gives targets of 0. (h1, h2) is the hash of the text.
    """
    store = Store(docs.sparkSession)
    # Rows of one key differ in nothing; a key's rows are numbered by being counted and repeated.
    counted = store.keep(sizes(docs).groupBy(*KEY, "source", "size").agg(F.count("*").cast("int").alias("rows")))
    totals = counted.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("total"))
    rate = F.when(F.col("total") > 0, F.col("target") / F.col("total")).otherwise(0.0)
    rates = store.keep(targets(totals, store, weights, most).select("source", F.col("total").alias("source_size"), "target", rate.alias("rate")))
    placed = _met(counted, rates)
    each = placed.select("*", F.explode(F.sequence(F.lit(1), F.col("rows"))).alias("nth")).drop("rows")

    open_ = store.keep(each.where("size > 0 and rate - floor(rate) > 0").select(*KEY, "nth", "source", "size", (F.col("rate") - F.floor("rate")).alias("chance")))
    decided, level = None, 0
    while True:
        dealt, last = _dealt(open_, store, level)
        flown = store.keep(_fly(dealt, parallelism(docs.sparkSession)))
        settled = flown.where("chance = 0 or chance = 1").select(*KEY, "nth", "source", "chance")
        decided = settled if decided is None else decided.unionByName(settled)
        if last:
            break
        open_ = flown.where("chance > 0 and chance < 1")
        level += 1
    extra = decided.where("chance = 1").groupBy(*KEY, "source").agg(F.collect_set("nth").alias("drawn"))
    # Rows of one key are alike, so it doesn't matter which of them the draw took.
    keys = [F.col(f"p.{c}").eqNullSafe(F.col(f"x.{c}")) for c in (*KEY, "source")]
    joined = placed.alias("p").join(extra.alias("x"), keys[0] & keys[1] & keys[2] & keys[3], "left").select("p.*", "x.drawn")
    each = joined.select("*", F.explode(F.sequence(F.lit(1), F.col("rows"))).alias("nth"))
    drawn = F.coalesce(F.array_contains("drawn", F.col("nth")), F.lit(False)).cast("long")
    copies = F.when(F.col("size") > 0, F.floor("rate") + drawn).otherwise(0).cast("long")
    return each.select(*KEY, "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def mixed_documents(docs: DataFrame, weights: tuple[float, ...] = (1.0, 2.0, 3.0), most: float = MOST) -> DataFrame:
    """The documents that the mix takes, with their own columns and (mix_copies, mix_taken); identical rows come as one, their copies added.

    Nulls: null, empty and wordless texts are never taken; a null doc_id is a
    document like any other, a null source a source of its own. Where ``docs``
    has mix_copies or mix_taken already, the new columns' names get underscores.
    An empty table gives an empty one.
    """
    store = Store(docs.sparkSession)
    drawn = mix(docs, weights, most).groupBy(*KEY, "source").agg(F.sum("copies").alias("copies"), F.sum("taken").alias("taken"), F.count("*").alias("rows"))
    drawn = store.keep(drawn.where("copies > 0"))
    one, two = fresh(docs, "hash"), fresh(docs, "hash2")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    base = docs.withColumn(one, F.xxhash64(text)).withColumn(two, F.xxhash64(F.lit("second"), text))
    if not drawn.where("rows > 1").isEmpty():
        base = base.dropDuplicates([one, two, "doc_id", "source"])
    copies, taken = fresh(docs, "mix_copies"), fresh(docs, "mix_taken")
    right = drawn.select(F.col("doc_id").alias("_d"), F.col("h1").alias("_1"), F.col("h2").alias("_2"), F.col("source").alias("_s"), F.col("copies").alias(copies), F.col("taken").alias(taken))
    same = base["doc_id"].eqNullSafe(right["_d"]) & (base[one] == right["_1"]) & (base[two] == right["_2"]) & base["source"].eqNullSafe(right["_s"])
    return base.join(right, same).select(*(base[c] for c in docs.columns), right[copies], right[taken])
