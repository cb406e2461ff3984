"""Streaming operators: the grid clock, event sampling, book reconstruction, continuity and slot assembly.

Exact versions keep state by instrument (``transformWithStateInPandas``), with
the driver stream as their clock. Where Spark's own watermark semantics will
do, ``windowed_flow`` and ``deduplicated`` are the shorter way; their clock is
the greatest event time of all input and moves between micro-batches only.

State is bounded: a grid keeps the rows not yet emitted and one book, a book
its levels, a slot assembler the slots of its reorder window. Outputs of the
exact operators equal those of the batch operators over the same input in the
same order.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from decimal import Decimal

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tickloom.operators.books import MOST_SEEDS, MOST_WAITING, Fold, OrderFold, Seeded, checked
from tickloom.operators.chain import SlotBook

# ---- idiomatic versions


def deduplicated(stream: DataFrame, key: tuple[str, ...] = ("exchange", "symbol", "id"), ts: str = "ts", within: str = "10 minutes") -> DataFrame:
    """Replayed prints once, as long as they come within the watermark."""
    return stream.withWatermark(ts, within).dropDuplicatesWithinWatermark(list(key))


def windowed_flow(stream: DataFrame, width: str, slide: str | None = None, ts: str = "ts", late: str = "10 minutes", key: tuple[str, ...] = ("exchange", "symbol")) -> DataFrame:
    """Volumes by tumbling or sliding window; late prints are dropped by the watermark."""
    window = F.window(ts, width, slide) if slide else F.window(ts, width)
    side = F.col("side") == "buy"
    return (
        stream.withWatermark(ts, late)
        .groupBy(window, *key)
        .agg(F.count("*").alias("n_trades"), F.sum(F.when(side, F.col("amount")).otherwise(0)).alias("buy_volume"), F.sum(F.when(~side, F.col("amount")).otherwise(0)).alias("sell_volume"))
        .select(*key, F.col("window.start").alias("start"), F.col("window.end").alias("end"), "n_trades", "buy_volume", "sell_volume")
    )


def sessions(stream: DataFrame, gap: str = "5 seconds", ts: str = "ts", late: str = "10 minutes", key: tuple[str, ...] = ("exchange", "symbol")) -> DataFrame:
    """Stretches of activity parted by silences."""
    return stream.withWatermark(ts, late).groupBy(F.session_window(ts, gap), *key).agg(F.count("*").alias("n")).select(*key, F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "n")


# ---- exact versions


def _given(value) -> bool:
    return value is not None and not pd.isna(value)


def _names(schema: str) -> list[str]:
    return [x.split()[0] for x in schema.split(", ")]


class Keyed(StatefulProcessor):
    """A processor with typed state: one row of values, and maps whose entries are written one by one.

    ``load`` gives a dict of the values and of each map (tuples to tuples);
    ``save`` writes the values if they changed, puts the entries that are new or
    changed and removes those that are gone.
    """

    VALUES = ""
    MAPS: dict[str, tuple[str, str]] = {}

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.values = handle.getValueState("values", self.VALUES)
        self.maps = {name: handle.getMapState(name, *schemas) for name, schemas in self.MAPS.items()}

    def load(self) -> dict | None:
        """None for a key without state."""
        self.before, self.entries = None, {name: {} for name in self.maps}
        if not self.values.exists():
            return None
        self.before = tuple(self.values.get())
        self.entries = {name: {tuple(k): tuple(v) for k, v in state.iterator()} for name, state in self.maps.items()}
        return dict(zip(_names(self.VALUES), self.before, strict=True)) | {name: dict(own) for name, own in self.entries.items()}

    def save(self, doc: dict) -> None:
        now = tuple(doc[c] for c in _names(self.VALUES))
        if now != self.before:
            self.values.update(now)
        for name, state in self.maps.items():
            old, new = self.entries[name], doc[name]
            for key in old.keys() - new.keys():
                state.removeKey(key)
            for key, value in new.items():
                if old.get(key) != value:
                    state.updateValue(key, value)

    def close(self) -> None:
        pass


GRID_SCHEMA = "exchange string, symbol string, row long, n_trades long, volume double, n_liquidations long, book_ts_us long, bid double, ask double, late long"


class GridClock(Keyed):
    """Rows of a grid driven by one kind of event, as they close. Events in arrival order: ts_us, kind (book, trade, liq), amount, bid, ask."""

    def __init__(self, period_us: int, driver: str, hold_us: int = 0, cap: int = 10_000):
        self.period_us, self.driver, self.hold_us, self.cap = period_us, driver, hold_us, cap

    VALUES = "clock long, late long"
    MAPS = {"rows": ("row long", "n long, volume double, liquidations long"), "books": ("row long", "ts_us long, bid double, ask double")}

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        doc = self.load() or {"clock": None, "late": 0, "rows": {}, "books": {}}
        out = []
        batch = pd.concat(list(rows)).sort_values(["seq"], kind="stable")
        for e in batch.itertuples():
            row = (int(e.ts_us) // self.period_us + 1,)
            if e.kind == "book":
                # A row shows its last book only.
                book = (int(e.ts_us), float(e.bid), float(e.ask))
                doc["books"][row] = max(book, doc["books"].get(row, book))
            else:
                n, volume, liqs = doc["rows"].get(row, (0, 0.0, 0))
                doc["rows"][row] = (n + 1, volume + float(e.amount), liqs) if e.kind == "trade" else (n, volume, liqs + 1)
            if e.kind == self.driver:
                out += self.advance(doc, key, max(int(e.ts_us) - self.hold_us, 0) // self.period_us)
        self.save(doc)
        if out:
            yield pd.DataFrame(out, columns=_names(GRID_SCHEMA))

    def advance(self, doc: dict, key, period: int) -> list[tuple]:
        if doc["clock"] is None:
            doc["clock"] = period
            return []
        if period <= doc["clock"]:
            return []
        last = doc["clock"] + min(period - doc["clock"], self.cap)
        for r in [r for r in doc["rows"] if r[0] <= doc["clock"]]:
            n, _, liqs = doc["rows"].pop(r)
            doc["late"] += n + liqs
        ahead = sorted(doc["books"])
        made, seen, book = [], 0, (None, None, None)
        for row in range(doc["clock"] + 1, last + 1):
            while seen < len(ahead) and ahead[seen][0] <= row:
                book, seen = doc["books"][ahead[seen]], seen + 1
            n, volume, liqs = doc["rows"].pop((row,), (0, 0.0, 0))
            made.append((*key, row, n, volume, liqs, *book, doc["late"]))
        for r in ahead[: max(seen - 1, 0)]:
            del doc["books"][r]
        doc["clock"] = period
        return made


def grid(stream: DataFrame, period_us: int, driver: str = "book", hold_us: int = 0) -> DataFrame:
    """Closed rows of each instrument; the open tail stays in state until the driver moves on."""
    processor = GridClock(period_us, driver, hold_us)
    return stream.groupBy("exchange", "symbol").transformWithStateInPandas(statefulProcessor=processor, outputStructType=GRID_SCHEMA, outputMode="Append", timeMode="None")


SAMPLE_SCHEMA = "exchange string, symbol string, ts_us long, bid double, ask double, n_trades long, volume double, n_liquidations long"


class EventSampler(Keyed):
    """A row at each trigger event: the last book and what came since the trigger before."""

    def __init__(self, triggers: tuple[str, ...]):
        self.triggers = triggers

    VALUES = "bid double, ask double, n long, volume double, liqs long"

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        doc = self.load() or {"bid": None, "ask": None, "n": 0, "volume": 0.0, "liqs": 0}
        out = []
        for e in pd.concat(list(rows)).sort_values(["seq"], kind="stable").itertuples():
            if e.kind == "book":
                doc |= {"bid": float(e.bid), "ask": float(e.ask)}
            elif e.kind == "trade":
                doc["n"] += 1
                doc["volume"] += float(e.amount)
            else:
                doc["liqs"] += 1
            if e.kind in self.triggers and doc["bid"] is not None:
                out.append((*key, int(e.ts_us), doc["bid"], doc["ask"], doc["n"], doc["volume"], doc["liqs"]))
                doc |= {"n": 0, "volume": 0.0, "liqs": 0}
        self.save(doc)
        if out:
            yield pd.DataFrame(out, columns=_names(SAMPLE_SCHEMA))


def event_samples(stream: DataFrame, triggers: tuple[str, ...]) -> DataFrame:
    return stream.groupBy("exchange", "symbol").transformWithStateInPandas(statefulProcessor=EventSampler(triggers), outputStructType=SAMPLE_SCHEMA, outputMode="Append", timeMode="None")


BOOK_SCHEMA = "exchange string, symbol string, update_id long, applied boolean, state string, bid double, ask double, n_bids long, n_asks long, gaps long"


class BookKeeper(Keyed):
    """One book from its updates: full refresh, deltas checked by sequence or checksum, single orders, depth bound; tells the top after every update."""

    def __init__(self, predicate: str | None = None, depth: int | None = None, recipe: str | None = None, orders: bool = False):
        self.predicate, self.depth, self.recipe, self.orders = predicate, depth, recipe, orders

    VALUES = "state string, last long, gaps long, rejected long"
    MAPS = {"levels": ("side string, price string", "size string"), "orders": ("order_id string", "side string, price string, size string")}

    def restored(self, doc: dict | None) -> Fold:
        book = OrderFold(self.depth) if self.orders else Fold(self.depth, self.predicate)
        if doc:
            for name in ("state", "last", "gaps", "rejected"):
                setattr(book, name, doc[name])
            for (side, price), (size,) in doc["levels"].items():
                book.apply_level(side, price, size)
            for (order_id,), (side, price, size) in doc["orders"].items():
                book.place(order_id, side, Decimal(price), Decimal(size))
        return book

    def kept(self, book: Fold) -> dict:
        doc = {name: getattr(book, name) for name in ("state", "last", "gaps", "rejected")}
        doc["levels"] = {(side, str(p)): (str(z),) for side, _, p, z in book.levels()}
        doc["orders"] = {(k,): (side, str(p), str(z)) for k, (side, p, z) in book.orders.items()} if self.orders else {}
        return doc

    def told(self, key, book: Fold, number: int | None, done: bool) -> tuple:
        bids, asks = book.sides["bid"], book.sides["ask"]
        return (*key, number, done, book.state, float(bids.best()) if bids else None, float(asks.best()) if asks else None, len(bids), len(asks), book.gaps)

    @staticmethod
    def changes(u) -> list[tuple]:
        return [("bid", x["price"], x["size"]) for x in u.bids] + [("ask", x["price"], x["size"]) for x in u.asks]

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        book, out = self.restored(self.load()), []
        for u in pd.concat(list(rows)).sort_values(["seq"], kind="stable").itertuples():
            number, snapshot = int(u.update_id), bool(u.is_snapshot)
            if self.orders:
                done = book.apply_orders([(x["order_id"], "ask" if x["is_ask"] else "bid", x["price"], x["size"], bool(x["removed"])) for x in u.orders], number, snapshot)
            else:
                check = checked(self.recipe, int(u.checksum) if _given(u.checksum) else None, snapshot) if self.recipe else None
                done = book.apply(self.changes(u), number, int(u.sequence), snapshot, check)
            out.append(self.told(key, book, number, done))
        self.save(self.kept(book))
        yield pd.DataFrame(out, columns=_names(BOOK_SCHEMA))


def book_states(stream: DataFrame, predicate: str | None = None, depth: int | None = None, recipe: str | None = None, orders: bool = False) -> DataFrame:
    """``stream``: exchange, symbol, seq (arrival), bids and asks (arrays of price, size text), update_id, sequence, is_snapshot.

    With ``recipe`` ("kraken" at a depth of 10, or "okx") it has ``checksum`` too: a delta that doesn't lead to it, or comes
    without one, gaps the book. With ``orders``, an array of order_id, is_ask, price, size, removed (as ``venues.l3_updates`` tells them) stands for bids, asks and sequence.
    """
    return stream.groupBy("exchange", "symbol").transformWithStateInPandas(statefulProcessor=BookKeeper(predicate, depth, recipe, orders), outputStructType=BOOK_SCHEMA, outputMode="Append", timeMode="None")


SEEDED_SCHEMA = BOOK_SCHEMA + ", outcome string, waiting long, asked long, lost long"


class SeedKeeper(BookKeeper):
    """A book whose seeds come in its own stream, with a deadline.

    Updates wait until a seed is there; what the seed covers is discarded, the
    rest replayed. A book that waits longer than ``wait_us`` (event time, by the
    watermark) is told as ``reseed``, when the next seed is asked for, and as
    ``exhausted`` after ``seeds`` in a row: then its connection must begin anew,
    and what comes up to then waits as before. Seeds may come late, twice or not
    at all: one for a synced book that covers no more than the book is stale.
    """

    VALUES = BookKeeper.VALUES + ", seeding boolean, exhausted boolean, asked long, lost long, next long, due_ms long"
    MAPS = {"levels": BookKeeper.MAPS["levels"], "orders": BookKeeper.MAPS["orders"], "waiting": ("n long", "update_id long, sequence long, changes string")}

    def __init__(self, predicate: str | None = None, depth: int | None = None, wait_us: int = 10_000_000, most: int = MOST_WAITING, seeds: int = MOST_SEEDS):
        super().__init__(predicate, depth)
        self.wait_us, self.most, self.seeds = wait_us, most, seeds

    def resumed(self) -> tuple[Seeded, int | None]:
        doc = self.load()
        seeded = Seeded(self.restored(doc), self.most, self.seeds)
        self.first, due = 0, None
        if doc:
            for name in ("seeding", "exhausted", "asked", "lost"):
                setattr(seeded, name, doc[name])
            # Numbers of waiting updates go on, so that one that stays is not written again.
            numbers = sorted(doc["waiting"])
            seeded.waiting.extend(([tuple(x) for x in json.loads(c)], i, q) for i, q, c in (doc["waiting"][n] for n in numbers))
            self.first, due = numbers[0][0] if numbers else doc["next"], doc["due_ms"]
        return seeded, due

    def stored(self, seeded: Seeded, due: int | None, now_ms: int) -> None:
        """Write what changed, and set or drop the deadline."""
        waits = seeded.seeding and not seeded.exhausted
        if not waits and due is not None:
            self.handle.deleteTimer(due)
            due = None
        elif waits and due is None:
            due = now_ms + self.wait_us // 1000
            self.handle.registerTimer(due)
        doc = self.kept(seeded.book) | {"seeding": seeded.seeding, "exhausted": seeded.exhausted, "asked": seeded.asked, "lost": seeded.lost, "due_ms": due}
        begin = self.first + seeded.left
        doc["next"] = begin + len(seeded.waiting)
        doc["waiting"] = {(begin + k,): (i, q, json.dumps(c)) for k, (c, i, q) in enumerate(seeded.waiting)}
        self.save(doc)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        seeded, due = self.resumed()
        out, now_ms = [], 0
        for u in pd.concat(list(rows)).sort_values(["seq"], kind="stable").itertuples():
            number, now_ms = int(u.update_id), max(now_ms, int(u.ts.timestamp() * 1000))
            if bool(u.is_seed):
                stale = not seeded.seeding and seeded.book.last is not None and number <= seeded.book.last
                if not stale:
                    seeded.seed(self.changes(u), number)
                outcome = "stale" if stale else "gapped" if seeded.seeding else "seeded"
            else:
                outcome = seeded.update(self.changes(u), number, int(u.sequence) if _given(u.sequence) else None)
            out.append((*self.told(key, seeded.book, number, outcome in ("applied", "seeded")), outcome, len(seeded.waiting), seeded.asked, seeded.lost))
        self.stored(seeded, due, now_ms)
        yield pd.DataFrame(out, columns=_names(SEEDED_SCHEMA))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        seeded, due = self.resumed()
        if due is None or not seeded.seeding or expiredTimerInfo.get_expiry_time_in_ms() != due:
            return
        delay = seeded.failed()
        self.stored(seeded, None, due + (delay or 0) // 1000)
        outcome = "exhausted" if seeded.exhausted else "reseed"
        yield pd.DataFrame([(*self.told(key, seeded.book, None, False), outcome, len(seeded.waiting), seeded.asked, seeded.lost)], columns=_names(SEEDED_SCHEMA)).astype({"update_id": "Int64"})


def seeded_books(stream: DataFrame, predicate: str | None = None, depth: int | None = None, wait_us: int = 10_000_000, late: str = "0 seconds", **bounds: int) -> DataFrame:
    """As ``book_states`` for venues whose books begin with a seed: rows with ``is_seed`` carry one, others are updates; ``ts`` is the event time that deadlines run by."""
    keyed = stream.withWatermark("ts", late).groupBy("exchange", "symbol")
    return keyed.transformWithStateInPandas(statefulProcessor=SeedKeeper(predicate, depth, wait_us, **bounds), outputStructType=SEEDED_SCHEMA, outputMode="Append", timeMode="EventTime")


LOSS_SCHEMA = "exchange string, symbol string, number long, missed long, duplicate boolean"


class Continuity(Keyed):
    """Missed and repeated sequence numbers; the highest number outlives reconnects."""

    VALUES = "highest long"

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        doc = self.load() or {"highest": None}
        out = []
        for t in pd.concat(list(rows)).sort_values(["seq"], kind="stable").itertuples():
            n, high = int(t.number), doc["highest"]
            out.append((*key, n, max(n - high - 1, 0) if high is not None else 0, high is not None and n <= high))
            doc["highest"] = n if high is None else max(high, n)
        self.save(doc)
        yield pd.DataFrame(out, columns=_names(LOSS_SCHEMA))


def continuity(stream: DataFrame) -> DataFrame:
    return stream.groupBy("exchange", "symbol").transformWithStateInPandas(statefulProcessor=Continuity(), outputStructType=LOSS_SCHEMA, outputMode="Append", timeMode="None")


SLOT_SCHEMA = "chain string, slot long, bank_id long, block_height long, n_transactions long, blocks_lost long, verdict string"


class SlotAssembler(Keyed):
    """Blocks of a chain from transactions and block metas, as ``operators.chain`` tells them; a bank's transactions are an entry each."""

    VALUES = "covered boolean, boundary long, top long, released long, height long"
    MAPS = {
        "open": ("slot long, bank_id long", "poisoned boolean"),
        "sealed": ("height long", "slot long, bank_id long, parent long"),
        "closed": ("slot long, bank_id long", "verdict string"),
        "taken": ("slot long, bank_id long, tx_index long", "there boolean"),
    }

    def __init__(self, hold: int = 4, abandon: int = 32, coverage: bool = False):
        self.hold, self.abandon, self.coverage = hold, abandon, coverage

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        doc, book = self.load(), SlotBook(self.hold, self.abandon, self.coverage)
        taken: dict[tuple, set] = {}
        if doc:
            for name in _names(self.VALUES):
                setattr(book, name, doc[name])
            book.open = {k: v[0] for k, v in doc["open"].items()}
            book.closed = {k: v[0] for k, v in doc["closed"].items()}
            book.sealed = {k[0]: v[:2] for k, v in doc["sealed"].items()}
            book.parents = {v[:2]: v[2] for v in doc["sealed"].values() if v[2] is not None}
            for slot, bank_id, tx in doc["taken"]:
                taken.setdefault((slot, bank_id), set()).add(tx)
        out = []
        for e in pd.concat(list(rows)).sort_values(["seq"], kind="stable").itertuples():
            slot, bank_id, tx, parent, height = (int(v) if _given(v := getattr(e, c, None)) else None for c in ("slot", "bank_id", "tx_index", "parent_slot", "block_height"))
            bank = (slot, bank_id or 0)
            time, blockhash = getattr(e, "block_time_secs", 1), getattr(e, "blockhash", "-")
            was = bank in book.open
            mine, found = book.take(e.kind, *bank, parent, height, time if _given(time) else None, blockhash if _given(blockhash) else None)
            if mine and e.kind == "tx":
                taken.setdefault(bank, set()).add(int(e.seq) if tx is None else tx)
            for s, b, h, lost, verdict in found:
                # A meta whose bank wasn't open ends none: one of its name may still be held.
                none = e.kind == "meta" and (s, b) == bank and verdict != "sealed" and not was
                out.append((*key, s, b, h, 0 if none else len(taken.pop((s, b), ())), lost, verdict))
        now = {name: getattr(book, name) for name in _names(self.VALUES)}
        now["open"] = {k: (v,) for k, v in book.open.items()}
        now["closed"] = {k: (v,) for k, v in book.closed.items()}
        now["sealed"] = {(h,): (*bank, book.parents.get(bank)) for h, bank in book.sealed.items()}
        now["taken"] = {(*bank, tx): (True,) for bank, own in taken.items() for tx in own}
        self.save(now)
        if out:
            yield pd.DataFrame(out, columns=_names(SLOT_SCHEMA)).astype({"block_height": "Int64"})


def slots(stream: DataFrame, hold: int = 4, abandon: int = 32, coverage: bool = False) -> DataFrame:
    """``stream``: chain, seq (arrival), kind (tx, undecodable, meta, open, close), slot, block_height; bank_id (else 0), tx_index (else each counts), parent_slot, block_time_secs and blockhash (else not checked) where there are."""
    return stream.groupBy("chain").transformWithStateInPandas(statefulProcessor=SlotAssembler(hold, abandon, coverage), outputStructType=SLOT_SCHEMA, outputMode="Append", timeMode="None")


# ---- sinks


def to_tables(stream: DataFrame, tables: dict[str, str], root: str, checkpoint: str):
    """Each micro-batch to one Parquet table for each datatype, written once by batch number.

    ``tables``: datatype to filter. A batch that is run again after a failure
    overwrites its own folder, so no row is written twice.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.persist()
        for name, rule in tables.items():
            batch.where(rule).write.mode("overwrite").option("compression", "snappy").parquet(f"{root}/{name}/batch={number}")
        batch.unpersist()

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
