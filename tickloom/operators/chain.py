"""Blocks of a chain put together from transactions and block metas in arrival order.

``SlotBook`` is the fold that batch and stream share. The batch version,
``assembled``, gives it few rows only: metas, coverage rows, undecodable
updates, and of the transactions the first of each bank (what raises the
highest slot is the first of its slot, hence among them; and a bank that
refuses one takes none after it). Each bank's transactions are then counted in
one aggregation up to the row at which the fold closed the bank, so the many
transactions are never ordered in one task. A close of the coverage ends a
cycle; a chain's cycles are folded in parallel.

Rules. A meta seals its bank (slot and bank_id). A sealed bank leaves, lowest
height first, when its height follows the last one that left, when its parent's
slot lies before the coverage, or when ``hold`` newer slots were seen. A bank
falls when its slot is more than ``abandon`` behind the highest. Coverage opens
at a slot, or COVERAGE_MARGIN after the highest one seen (after the next one
seen, if none was); a close lets what is held leave, abandons the rest and
forgets what was seen, until it opens again. Of a bank's transactions one with
each tx_index counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tickloom.operators import blocked
from tickloom.operators.onchain import COVERAGE_MARGIN

Bank = tuple[int, int]


@dataclass
class SlotBook:
    """The state of one chain; banks are told by (slot, bank_id)."""

    hold: int = 4
    abandon: int = 32
    #: Whether slots count only inside coverage rows.
    coverage: bool = False
    covered: bool | None = None
    boundary: int | None = None
    top: int = -1
    #: Slot and height of the bank that left last.
    released: int | None = None
    height: int | None = None
    #: Open banks: whether an update of theirs was undecodable.
    open: dict[Bank, bool] = field(default_factory=dict)
    #: Sealed banks by height: slot, bank_id.
    sealed: dict[int, Bank] = field(default_factory=dict)
    #: Banks told already: sealed or abandoned.
    closed: dict[Bank, str] = field(default_factory=dict)
    #: Parent slots of sealed banks.
    parents: dict[Bank, int] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if self.covered is None:
            self.covered, self.boundary = not self.coverage, None if self.coverage else 0

    def covers(self, slot: int) -> bool:
        return bool(self.covered) and self.boundary is not None and slot >= self.boundary

    def begin(self, slot: int | None) -> None:
        """Open the coverage."""
        self.covered = True
        self.boundary = slot if slot is not None else self.top + COVERAGE_MARGIN if self.top > 0 else None

    def end(self) -> list[tuple]:
        """Close the coverage: (slot, bank_id, height, lost, verdict) of what goes."""
        gone = [(*bank, None, 0, "abandoned") for bank in sorted(self.open)]
        gone += [self.release() for _ in range(len(self.sealed))]
        self.open, self.closed = {}, {}
        self.covered, self.boundary, self.top = False, None, -1
        return gone

    def advance(self, slot: int) -> list[tuple]:
        """Raise the highest slot; the banks that fall behind it."""
        if self.covered and self.boundary is None:
            self.boundary = slot + COVERAGE_MARGIN
        if slot <= self.top:
            return []
        self.top = slot
        floor = slot - self.abandon
        gone = sorted(bank for bank in self.open if bank[0] < floor)
        for bank in gone:
            del self.open[bank]
            self.closed[bank] = "abandoned"
        self.closed = {bank: v for bank, v in self.closed.items() if bank[0] >= floor - self.abandon}
        return [(*bank, None, 0, "abandoned") for bank in gone]

    def update(self, slot: int, bank_id: int, undecodable: bool = False) -> tuple[bool, list[tuple]]:
        """A transaction or undecodable update: whether its bank takes it, and what fell."""
        gone, bank = self.advance(slot), (slot, bank_id)
        taken = self.covers(slot) and bank not in self.closed and (self.released is None or slot > self.released) and slot >= self.top - self.abandon
        if taken:
            self.open[bank] = self.open.get(bank, False) or undecodable
        return taken, gone

    def meta(self, slot: int, bank_id: int, parent: int | None, height, time, blockhash) -> tuple[str | None, list[tuple], list[tuple]]:
        """A block meta: its verdict (None while its bank is held or left now), what fell, what left."""
        gone = self.advance(slot)
        told = self.seal((slot, bank_id), height, time, blockhash)
        return told, gone, self.ready({(slot, bank_id): parent} if told is None else {})

    def seal(self, bank: Bank, height, time, blockhash) -> str | None:
        poisoned = self.open.pop(bank, False)
        if not self.covers(bank[0]):
            return "uncovered"
        if self.closed.get(bank) == "sealed":
            return "late" if self.released is not None and bank[0] <= self.released else "duplicate"
        if bank in self.closed or bank[0] < self.top - self.abandon:
            self.closed[bank] = "abandoned"
            return "abandoned"
        self.closed[bank] = "sealed"
        if not (height is not None and height > 0 and time is not None and time > 0 and blockhash):
            return "partial"
        if (self.released is not None and bank[0] <= self.released) or (self.height is not None and height <= self.height):
            return "late"
        if height in self.sealed:
            return "duplicate"
        if poisoned:
            return "partial"
        self.sealed[height] = bank
        return None

    def ready(self, parents: dict[Bank, int | None]) -> list[tuple]:
        self.parents |= {bank: p for bank, p in parents.items() if p is not None}
        left = []
        while self.sealed:
            height = min(self.sealed)
            bank = self.sealed[height]
            parent = self.parents.get(bank)
            follows = self.height is not None and height == self.height + 1
            uncovered = parent is not None and self.boundary is not None and parent < self.boundary
            if not (follows or uncovered or self.top >= bank[0] + self.hold):
                break
            left.append(self.release())
        return left

    def release(self) -> tuple:
        height = min(self.sealed)
        bank = self.sealed.pop(height)
        self.parents.pop(bank, None)
        lost = max(height - self.height - 1, 0) if self.height is not None else 0
        self.height, self.released = height, bank[0]
        return (*bank, height, lost, "sealed")

    def take(self, kind: str, slot, bank_id, parent=None, height=None, time=None, blockhash=None) -> tuple[bool, list[tuple]]:
        """One row of the stream: whether an update was taken, and the banks told by it, in order: (slot, bank_id, height, lost, verdict)."""
        if kind == "open":
            self.begin(slot)
            return False, []
        if kind == "close":
            return False, self.end()
        if kind != "meta":
            return self.update(slot, bank_id, kind == "undecodable")
        told, gone, left = self.meta(slot, bank_id, parent, height, time, blockhash)
        return False, gone + ([(slot, bank_id, height, 0, told)] if told else []) + left


CHECKED = {"block_time_secs": 1, "blockhash": "-"}
TOLD = "order long, place long, slot long, bank_id long, block_height long, blocks_lost long, verdict string, closed_order long, parts array<long>, cycle long, first boolean, least_slot long, least_height long"
#: The verdict of a row that tells how a cycle ended.
END = "end"


def assembled(events: DataFrame, key: str = "chain", order: str = "seq", hold: int = 4, abandon: int = 32, coverage: bool = False) -> DataFrame:
    """(key, order, place, slot, bank_id, block_height, n_transactions, blocks_lost, verdict): every bank and meta as it is told, by the row (``order``, unique in a key) that told it.

    ``events``: key, order, kind (tx, undecodable, meta, open, close), slot;
    bank_id (else 0), tx_index (else each counts), parent_slot, block_height,
    block_time_secs and blockhash (else not checked) where there are. Rows of
    null kind or order, or of a null slot but for open and close, count for
    nothing.
    """
    there = set(events.columns)

    def column(name: str, kind: str, other=None) -> Column:
        return (F.col(name) if name in there else F.lit(other)).cast(kind).alias(name)

    bounds = F.col("kind").isin("open", "close")
    rows = events.where(F.col("kind").isNotNull() & F.col(order).isNotNull() & (F.col("slot").isNotNull() | bounds)).select(
        F.col(key).alias("key"),
        F.col(order).cast("long").alias("order"),
        "kind",
        F.col("slot").cast("long").alias("slot"),
        F.coalesce(column("bank_id", "long", 0), F.lit(0)).cast("long").alias("bank_id"),
        F.coalesce(column("tx_index", "long"), F.col(order).cast("long")).alias("tx_index"),
        column("parent_slot", "long"),
        column("block_height", "long"),
        *(column(c, "string" if c == "blockhash" else "long", v) for c, v in CHECKED.items()),
    )
    # Between two coverage rows the first transaction of a bank tells whether it takes any.
    closes = (F.col("kind") == "close").cast("long")
    rows = blocked.scanned(rows, ["key"], ["order"], {"cycle": ("sum", closes)}, {"part": ("sum", bounds.cast("long"))}, width=blocked.NUMBERS).withColumn("cycle", F.coalesce("cycle", F.lit(0)))
    plain = F.col("kind") == "tx"
    bank = ["key", "slot", "bank_id"]
    firsts = rows.where(plain).groupBy(*bank, "part", "cycle").agg(F.min("order").alias("order")).withColumn("kind", F.lit("tx"))
    marks = rows.where(~plain).drop("tx_index").unionByName(firsts, allowMissingColumns=True)
    out = T.StructType([T.StructField("key", events.schema[key].dataType), *T._parse_datatype_string(TOLD).fields])

    def run(batches: Iterator[pa.RecordBatch], whole: bool) -> Iterator[pa.RecordBatch]:
        # What sealed banks took ended with these rows, and the parts in which open ones take transactions.
        now, book, ends, takes, stops = None, None, {}, {}, {}
        # What rows were held against before a bank of the cycle left: their least slot and height.
        least = [None, None]

        def end() -> list[tuple]:
            return [] if whole or book is None else [(now[0], 0, -1, book.released, 0, book.height, 0, END, None, None, now[1], False, *least)]

        def record(told: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([t[k] for t in told], f.type) for k, f in enumerate(to_arrow_schema(out))], [f.name for f in out])

        for batch in batches:
            told = []
            for r in batch.to_pylist():
                place_of = (r["key"], None if whole else r["cycle"])
                if book is None or place_of != now:
                    told += end()
                    now, book, ends, takes, stops = place_of, SlotBook(hold, abandon, coverage or bool(place_of[1])), {}, {}, {}
                    least = [None, None]
                own = (r["slot"], r["bank_id"])
                was, fresh = own in book.open, book.released is None
                mine, found = book.take(r["kind"], *own, r["parent_slot"], r["block_height"], r["block_time_secs"], r["blockhash"])
                if fresh and r["kind"] not in ("open", "close") and book.covers(r["slot"]):
                    seen = (r["slot"], r["block_height"] if r["kind"] == "meta" else None)
                    least = [a if b is None else b if a is None else min(a, b) for a, b in zip(least, seen, strict=True)]
                if mine and r["kind"] == "tx":
                    takes.setdefault(own, []).append(r["part"])
                if r["kind"] == "meta" and was:
                    ends[own] = (stops.pop(own, r["order"]), takes.pop(own, []))
                for place, x in enumerate(found):
                    verdict_of_own = r["kind"] == "meta" and x[:2] == own and x[4] != "sealed"
                    if x[4] == "abandoned" and not verdict_of_own:
                        # A bank that falls was open until now.
                        ended_by = (stops.pop(x[:2], r["order"]), takes.pop(x[:2], []))
                    else:
                        # A meta whose bank wasn't open ends none: one of its name may still be held.
                        ended_by = ends.pop(x[:2], None) if was or not verdict_of_own else None
                    first = fresh and x[4] == "sealed"
                    fresh = fresh and not first
                    told.append((now[0], r["order"], place, *x, *(ended_by or (None, None)), now[1], first, None, None))
                if any(x[4] == "sealed" for x in found):
                    # Open banks that what left has passed take nothing any more.
                    for passed in book.open:
                        if passed[0] <= book.released:
                            stops.setdefault(passed, r["order"])
            yield record(told)
        yield record(end())

    def folded(some: DataFrame, by: list[str], whole: bool) -> DataFrame:
        return some.repartition(*by).sortWithinPartitions(*by, "order").mapInArrow(lambda batches: run(batches, whole), out)

    # A close leaves nothing but the slot and height that left last. So cycles are folded apart, and where these
    # lie below all that a cycle held against them, they only tell what its first bank lost.
    each = folded(marks, ["key", "cycle"], False).localCheckpoint()
    last = F.last(F.when(F.col("slot").isNotNull(), F.struct("slot", "block_height")), ignorenulls=True)
    before = last.over(Window.partitionBy("key").orderBy("cycle").rowsBetween(Window.unboundedPreceding, -1))
    entries = each.where(F.col("verdict") == END).select("key", "cycle", "least_slot", "least_height", before.alias("e"))
    held = (F.col("e.slot") >= F.col("least_slot")) | (F.col("e.block_height") + 1 >= F.col("least_height"))
    entered = entries.select(F.col("key").alias("k"), F.col("cycle").alias("c"), F.col("e.block_height").alias("was"))
    lost = F.when(F.col("first") & F.col("was").isNotNull(), F.greatest(F.col("block_height") - F.col("was") - 1, F.lit(0))).otherwise(F.col("blocks_lost"))
    here = F.col("key").eqNullSafe(F.col("k")) & (F.col("cycle") == F.col("c"))
    told = each.where(F.col("verdict") != END).join(F.broadcast(entered), here, "left").withColumn("blocks_lost", lost).drop("k", "c", "was")
    # Chains in which they mattered are folded as a whole.
    knotted = entries.where(held).select(F.col("key").alias("k")).distinct().localCheckpoint()
    if not knotted.isEmpty():
        same_key = F.col("key").eqNullSafe(F.col("k"))
        told = told.join(F.broadcast(knotted), same_key, "left_anti").unionByName(folded(marks.join(F.broadcast(knotted), same_key, "left_semi"), ["key"], True))
    told = told.select("key", *(f.name for f in out.fields[1:10]))
    ended = told.where("closed_order is not null").select(F.col("key").alias("k"), F.col("slot").alias("s"), F.col("bank_id").alias("b"), "closed_order", "parts")
    same = F.col("key").eqNullSafe(F.col("k")) & (F.col("slot") == F.col("s")) & (F.col("bank_id") == F.col("b"))
    taken = rows.where(plain).join(ended, same & F.array_contains("parts", F.col("part")) & (F.col("order") < F.col("closed_order")))
    counts = taken.groupBy("k", "s", "b", "closed_order").agg(F.countDistinct("tx_index").alias("n"))
    met = told.join(counts.withColumnRenamed("closed_order", "c"), same & (F.col("closed_order") == F.col("c")), "left")
    return met.select(F.col("key").alias(key), F.col("order").alias(order), "place", "slot", "bank_id", "block_height", F.coalesce("n", F.lit(0)).cast("long").alias("n_transactions"), "blocks_lost", "verdict")
