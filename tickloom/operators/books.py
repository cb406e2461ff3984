"""Order books in long form: a row for each (book, side, price) level."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import deque
from collections.abc import Callable, Sequence
from decimal import Decimal, InvalidOperation

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.codecs import RECIPES
from tickloom.operators import blocked

BOOK = ("book",)


def best_first(side: str = "side", price: str = "price") -> Column:
    """Sorts bids from the highest, asks from the lowest price."""
    return F.when(F.col(side) == "bid", -F.col(price)).otherwise(F.col(price))


def ranked(levels: DataFrame, key: Sequence[str] = BOOK) -> DataFrame:
    """Levels with their rank; 0 is best."""
    return levels.withColumn("level", F.row_number().over(Window.partitionBy(*key, "side").orderBy(best_first())) - 1)


def top(levels: DataFrame, n: int, key: Sequence[str] = BOOK) -> DataFrame:
    return ranked(levels, key).where(F.col("level") < n)


def bbo(levels: DataFrame, key: Sequence[str] = BOOK) -> DataFrame:
    """Best prices and their sizes; null for an empty side."""
    bid, ask = F.col("side") == "bid", F.col("side") == "ask"
    price, size = F.col("price"), F.col("size")
    return levels.groupBy(*key).agg(
        F.max(F.when(bid, price)).alias("bid"),
        F.max_by(F.when(bid, size), F.when(bid, price)).alias("bid_size"),
        F.min(F.when(ask, price)).alias("ask"),
        F.min_by(F.when(ask, size), F.when(ask, price)).alias("ask_size"),
    )


def metrics(levels: DataFrame, key: Sequence[str] = BOOK) -> DataFrame:
    """Per book: bests, mid, spread, basis points, totals, imbalance, level counts. Nulls where a side is empty."""
    bid, ask = F.col("side") == "bid", F.col("side") == "ask"
    price, size = F.col("price"), F.col("size")
    sums = levels.groupBy(*key).agg(
        F.max(F.when(bid, price)).cast("double").alias("bid"),
        F.min(F.when(ask, price)).cast("double").alias("ask"),
        F.coalesce(F.sum(F.when(bid, size)), F.lit(0)).cast("double").alias("bid_volume"),
        F.coalesce(F.sum(F.when(ask, size)), F.lit(0)).cast("double").alias("ask_volume"),
        F.count(F.when(bid, 1)).alias("n_bids"),
        F.count(F.when(ask, 1)).alias("n_asks"),
    )
    mid = (F.col("bid") + F.col("ask")) / 2
    total = F.col("bid_volume") + F.col("ask_volume")
    return (
        sums.withColumn("mid_price", mid)
        .withColumn("spread", F.col("ask") - F.col("bid"))
        .withColumn("spread_bps", F.when(mid > 0, (F.col("ask") - F.col("bid")) / mid * 10000))
        .withColumn("imbalance", F.when(total != 0, (F.col("bid_volume") - F.col("ask_volume")) / total))
        .withColumn("crossed", F.coalesce(F.col("bid") >= F.col("ask"), F.lit(False)))
    )


def two_sided(levels: DataFrame, key: Sequence[str] = BOOK) -> DataFrame:
    """``metrics`` for whoever can't do with half a book: one with an empty side is an error, told with its key."""
    m = metrics(levels, key)
    named = F.concat_ws(", ", *(F.col(c).cast("string") for c in key))
    bad = F.when((F.col("n_bids") == 0) | (F.col("n_asks") == 0), F.raise_error(F.concat(F.lit("one-sided book: "), named)).cast("double"))
    return m.withColumn("mid_price", F.coalesce(bad, F.col("mid_price")))


def snapshot(levels: DataFrame, key: Sequence[str] = BOOK) -> DataFrame:
    """Metrics rounded half-even for display: prices and volumes to 8 places, basis points 4, imbalance 6."""
    m = metrics(levels, key)
    places = dict.fromkeys(("bid", "ask", "bid_volume", "ask_volume", "mid_price", "spread"), 8) | {"spread_bps": 4, "imbalance": 6}
    return m.select(*key, *(F.bround(F.col(c), n).alias(c) for c, n in places.items()), "n_bids", "n_asks")


def volume_within(levels: DataFrame, depth: float, key: Sequence[str] = BOOK) -> DataFrame:
    """Volume of each side within a price distance of that side's best: one window, one aggregation."""
    side = Window.partitionBy(*key, "side")
    best = F.when(F.col("side") == "bid", F.max("price").over(side)).otherwise(F.min("price").over(side))
    near = F.abs(F.col("price") - best) <= depth
    rows = levels.withColumn("near", near)
    return rows.groupBy(*key).agg(*(F.coalesce(F.sum(F.when((F.col("side") == s) & F.col("near"), F.col("size"))), F.lit(0)).cast("double").alias(f"{s}_volume") for s in ("bid", "ask")))


def order_faults(levels: DataFrame, key: Sequence[str] = BOOK) -> DataFrame:
    """(key, faults): levels whose price doesn't lie beyond that of the level before, by stored rank."""
    before = F.lag("price").over(Window.partitionBy(*key, "side").orderBy("level"))
    wrong = F.when(F.col("side") == "bid", F.col("price") >= before).otherwise(F.col("price") <= before)
    return levels.select(*key, F.coalesce(wrong, F.lit(False)).alias("wrong")).groupBy(*key).agg(F.count(F.when(F.col("wrong"), 1)).alias("faults"))


def final_state(deltas: DataFrame, order: Sequence[str], key: Sequence[str] = BOOK) -> DataFrame:
    """The levels after all updates, without depth pruning: the last size of each price, deletions gone.

    A fold in arrival order, but each level only depends on its own last
    update, so it is one aggregation with map-side combining.
    """
    return deltas.groupBy(*key, "side", "price").agg(F.max_by("size", F.struct(*order)).alias("size")).where("size > 0")


def state_after_snapshots(deltas: DataFrame, order: Sequence[str], key: Sequence[str] = BOOK, snapshot: str = "is_snapshot") -> DataFrame:
    """As ``final_state``, for streams in which a snapshot update resets the book: only updates since the last one count."""
    return final_state(since_snapshot(deltas, order, key, snapshot), order, key)


def since_snapshot(deltas: DataFrame, order: Sequence[str], key: Sequence[str] = BOOK, snapshot: str = "is_snapshot") -> DataFrame:
    """Each book's updates from its last snapshot on; all of a book without one."""
    at = F.struct(*order)
    resets = deltas.where(F.col(snapshot)).groupBy(*key).agg(F.max(at).alias("_reset"))
    same = [F.col(f"d.{c}").eqNullSafe(F.col(f"r.{c}")) for c in key]
    met = deltas.withColumn("_at", at).alias("d").join(resets.alias("r"), same, "left")
    return met.where(F.col("_reset").isNull() | (F.col("_at") >= F.col("_reset"))).select("d.*").drop("_at")


def update_stats(deltas: DataFrame, order: Sequence[str], key: Sequence[str] = BOOK) -> DataFrame:
    """(key, inserted, modified, deleted) as updates arrive: a level is new if its last update deleted it or there is none."""
    last = F.lag("size").over(Window.partitionBy(*key, "side", "price").orderBy(*order))
    there = F.coalesce(last > 0, F.lit(False))
    rows = deltas.select(*key, there.alias("there"), (F.col("size") > 0).alias("sets"))
    return rows.groupBy(*key).agg(
        F.count(F.when(~F.col("there") & F.col("sets"), 1)).alias("inserted"),
        F.count(F.when(F.col("there") & F.col("sets"), 1)).alias("modified"),
        F.count(F.when(F.col("there") & ~F.col("sets"), 1)).alias("deleted"),
    )


def l3_to_l2(orders: DataFrame, order: Sequence[str], key: Sequence[str] = BOOK) -> DataFrame:
    """Levels from single orders: the last state of each order id, summed by price."""
    last = orders.groupBy(*key, "order_id").agg(F.max_by(F.struct("side", "price", "size", "removed"), F.struct(*order)).alias("o")).select(*key, "o.*")
    return last.where("not removed and size > 0").groupBy(*key, "side", "price").agg(F.sum("size").alias("size"), F.count("*").alias("n_orders"))


#: Continuity of book updates: does (sequence, id) follow the last applied id?
PREDICATES: dict[str, Callable[[Column, Column, Column], Column]] = {
    "range_inclusive": lambda seq, uid, last: (seq <= last + 1) & (uid > last),
    "exact_prev": lambda seq, uid, last: seq == last,
    "monotonic": lambda seq, uid, last: uid > last,
}


def sequence_breaks(deltas: DataFrame, predicate: str, order: Sequence[str], key: Sequence[str] = BOOK, update_id: str = "update_id", sequence: str = "sequence") -> DataFrame:
    """Updates with ``follows`` and the number of breaks before and at them (their segment).

    Each update is held against the one before it; from a break on, a segment
    is only good once the book is seeded again.
    """
    rows = blocked.scanned(deltas, key, order, {"_last": ("lag", F.col(update_id))})
    follows = F.coalesce(PREDICATES[predicate](F.col(sequence), F.col(update_id), F.col("_last")), F.lit(True))
    return blocked.scanned(rows.withColumn("follows", follows).drop("_last"), key, order, upto={"segment": ("sum", (~F.col("follows")).cast("long"))})


def break_counts(deltas: DataFrame, predicates: Sequence[str], order: Sequence[str], key: Sequence[str] = BOOK, update_id: str = "update_id", sequence: str = "sequence") -> DataFrame:
    """(key, n, breaks, predicate): updates and breaks of each book under several predicates, from one scan."""
    rows = blocked.scanned(deltas, key, order, {"_last": ("lag", F.col(update_id))})
    broken = {p: ~F.coalesce(PREDICATES[p](F.col(sequence), F.col(update_id), F.col("_last")), F.lit(True)) for p in predicates}
    sums = rows.groupBy(*key).agg(F.count("*").alias("n"), *(F.count(F.when(test, 1)).alias(p) for p, test in broken.items()))
    return sums.unpivot([*key, "n"], list(predicates), "predicate", "breaks").select(*key, "n", "breaks", "predicate")


def dense_breaks(frame: DataFrame, order: Sequence[str], key: Sequence[str] = BOOK, sequence: str = "sequence") -> DataFrame:
    """Numbers skipped before each update of a dense sequence."""
    rows = blocked.scanned(frame, key, order, {"_last": ("lag", F.col(sequence))})
    return rows.withColumn("skipped", F.greatest(F.col(sequence) - F.col("_last") - 1, F.lit(0).cast("long"))).drop("_last")


def attributed_gaps(frame: DataFrame, order: Sequence[str], key: Sequence[str], sequence: str, heartbeat: str) -> DataFrame:
    """Connection sequence gaps minus those that lost heartbeats explain."""
    rows = blocked.scanned(frame, key, order, {"_last": ("lag", F.struct(F.col(sequence).alias("s"), F.col(heartbeat).alias("h")))})
    gap, beats = F.col(sequence) - F.col("_last.s") - 1, F.col(heartbeat) - F.col("_last.h") - 1
    unexplained = F.greatest(F.coalesce(gap, F.lit(0)) - F.greatest(F.coalesce(beats, F.lit(0)), F.lit(0)), F.lit(0)).cast("long")
    return rows.withColumn("unexplained", unexplained).drop("_last")


def seed_reconcile(seeds: DataFrame, deltas: DataFrame, key: Sequence[str] = BOOK) -> DataFrame:
    """Buffered updates against a book's seed: those that it covers are discarded, later ones are replayed on top."""
    return deltas.join(seeds, list(key)).withColumn("replayed", F.col("update_id") > F.col("seed_id"))


def conformance(levels: DataFrame, key: Sequence[str] = BOOK) -> DataFrame:
    """Per book: levels not strictly positive, crossed (strictly), one-sided."""
    m = metrics(levels, key)
    bad = levels.groupBy(*key).agg(F.count(F.when((F.col("price") <= 0) | (F.col("size") <= 0), 1)).alias("not_positive"))
    return m.select(*key, F.coalesce(F.col("bid") > F.col("ask"), F.lit(False)).alias("crossed"), ((F.col("n_bids") == 0) | (F.col("n_asks") == 0)).alias("one_sided")).join(bad, list(key))


class Ladder(dict):
    """One side of a book: price to (price, size) as sent, with the prices in rising order beside it."""

    def __init__(self, bids: bool):
        super().__init__()
        self.bids, self.prices = bids, []

    def put(self, price, size) -> None:
        """Set or (size 0) delete a level."""
        at = _exact(price)
        if _exact(size) == 0:
            if self.pop(at, None) is not None:
                del self.prices[bisect_left(self.prices, at)]
        else:
            if at not in self:
                insort(self.prices, at)
            self[at] = (price, size)

    def cut(self, depth: int) -> None:
        """Drop what lies beyond the best ``depth`` levels."""
        over = len(self.prices) - depth
        if over > 0:
            gone = slice(0, over) if self.bids else slice(depth, None)
            for at in self.prices[gone]:
                del self[at]
            del self.prices[gone]

    def best(self):
        return None if not self.prices else self.prices[-1 if self.bids else 0]

    def ranked(self) -> list[tuple]:
        """(price, size), best first."""
        return [self[p] for p in (reversed(self.prices) if self.bids else self.prices)]


def _exact(number):
    """Numbers compare as they are; text as decimals."""
    return Decimal(number) if isinstance(number, str) else number


class Fold:
    """One book as updates arrive: levels, depth bound, state machine.

    States: empty, synced, gapped, closed. A snapshot (or the first update of a
    self-seeding venue) syncs; a break of the sequence clears and gaps the book
    until the next snapshot. With a depth, levels beyond it are cut after every
    update and don't come back by themselves.
    """

    def __init__(self, depth: int | None = None, predicate: str | None = None):
        self.clear()
        self.depth, self.predicate = depth, predicate
        self.state, self.last = "empty", None
        self.gaps = self.rejected = 0
        #: Whether a crossed book is a gap.
        self.gated = predicate is not None

    def clear(self) -> None:
        self.sides = {"bid": Ladder(True), "ask": Ladder(False)}

    def follows(self, sequence, update_id) -> bool:
        if self.predicate is None or self.last is None:
            return True
        return {"range_inclusive": sequence <= self.last + 1 and update_id > self.last, "exact_prev": sequence == self.last, "monotonic": update_id > self.last}[self.predicate]

    def gap(self) -> None:
        """Also from outside, when the connection itself proves a loss: the levels go at once, and what follows needs a snapshot."""
        if self.state != "closed":
            self.clear()
            self.state, self.last = "gapped", None
            self.gaps += 1

    def close(self) -> None:
        """No update is applied any more; the levels stay."""
        self.state = "closed"

    def apply_level(self, side: str, price, size) -> None:
        """Set or (size 0) delete a level."""
        self.sides[side].put(price, size)

    def apply(self, changes: list[tuple], update_id=None, sequence=None, is_snapshot: bool = False, checksum: Callable[[dict], bool] | None = None) -> bool:
        """Apply one update: (side, price, size) changes. False if it was not applied. With ``checksum``, a book that it refuses or that is crossed is gapped."""
        if self.state == "closed":
            return False
        if is_snapshot:
            self.clear()
        elif self.state == "gapped":
            self.rejected += 1
            return False
        elif not self.follows(sequence, update_id):
            self.gap()
            return False
        for side, price, size in changes:
            self.apply_level(side, price, size)
        if self.depth:
            for own in self.sides.values():
                own.cut(self.depth)
        bids, asks = self.sides["bid"], self.sides["ask"]
        if (bids and asks and bids.best() >= asks.best() and (self.gated or checksum)) or (checksum and not checksum(self.sides)):
            self.gap()
            return False
        self.last = update_id if update_id is not None else self.last
        self.state = "synced"
        return True

    def levels(self) -> list[tuple]:
        """(side, rank, price, size), best first."""
        return [(side, n, *level) for side, own in self.sides.items() for n, level in enumerate(own.ranked())]


def checked(recipe: str, expected: int | None, is_snapshot: bool) -> Callable[[dict], bool]:
    """A checksum function for ``Fold.apply``: the book must reproduce ``expected``; only a snapshot may come without one."""

    def holds(sides: dict) -> bool:
        if expected is None:
            return is_snapshot
        bids, asks = ([tuple(map(str, level)) for level in own.ranked()] for own in sides.values())
        return RECIPES[recipe](bids, asks) == expected

    return holds


#: A book of more single orders than this is gapped.
MOST_ORDERS = 200_000


class OrderFold(Fold):
    """One book from single orders (L3): an order id is set, moved or removed, and only the levels that it touches are summed anew."""

    def __init__(self, depth: int | None = None, most: int = MOST_ORDERS):
        super().__init__(depth)
        self.gated, self.most = True, most
        self.orders: dict[str, tuple[str, Decimal, Decimal]] = {}
        self.totals: dict[tuple[str, Decimal], Decimal] = {}

    def gap(self) -> None:
        super().gap()
        if self.state != "closed":
            self.orders, self.totals = {}, {}

    def place(self, order_id: str, side: str, price: Decimal, size: Decimal) -> None:
        self.orders[order_id] = (side, price, size)
        self.totals[side, price] = self.totals.get((side, price), Decimal(0)) + size

    def apply_orders(self, orders: list[tuple], update_id=None, is_snapshot: bool = False) -> bool:
        """Apply one update: (order_id, side, price, size, removed) rows. Orders whose numbers can't be read, or of no size, are gone."""
        if self.state == "closed" or (self.state == "gapped" and not is_snapshot):
            return self.apply([], update_id)
        if is_snapshot:
            self.orders, self.totals = {}, {}
        touched = {}
        for order_id, side, price, size, removed in orders:
            if order_id in self.orders:
                *level, old = self.orders.pop(order_id)
                left = self.totals[tuple(level)] = self.totals[tuple(level)] - old
                if left <= 0:
                    del self.totals[tuple(level)]
                touched[tuple(level)] = True
            at, much = _number(price), _number(size)
            if removed or at is None or much is None or much <= 0:
                continue
            self.place(order_id, side, at, much)
            touched[side, at] = True
        if len(self.orders) > self.most:
            self.gap()
            return False
        return self.apply([(side, price, self.totals.get((side, price), Decimal(0))) for side, price in touched], update_id, None, is_snapshot)


#: Updates that wait for a seed at most, seeds asked for in a row, and the wait before another seed (step and longest, in microseconds).
MOST_WAITING, MOST_SEEDS, SEED_STEP_US, SEED_WAIT_US = 100_000, 8, 250_000, 2_000_000


def seed_delay_us(attempt: int) -> int:
    """The wait before a seed is asked for again after ``attempt`` failures."""
    return min(attempt * SEED_STEP_US, SEED_WAIT_US)


class Seeded:
    """A book whose first state comes from outside its stream.

    Updates wait until a seed is there; those that the seed covers are
    discarded, the others replayed on it. A break makes the rest wait for
    another seed; when ``seeds`` were asked for in a row without a book, it is
    ``exhausted`` and its connection must begin anew. Beyond ``most`` waiting
    updates the oldest go (``lost``); the replay then shows a break unless the
    seed covers them.
    """

    def __init__(self, book: Fold, most: int = MOST_WAITING, seeds: int = MOST_SEEDS):
        self.book, self.most, self.seeds = book, most, seeds
        self.waiting: deque[tuple] = deque()
        self.asked = self.lost = 0
        #: Updates that left the queue.
        self.left = 0
        self.seeding, self.exhausted = True, False

    def wait(self, update: tuple) -> None:
        self.waiting.append(update)
        if len(self.waiting) > self.most:
            self.waiting.popleft()
            self.lost += 1
            self.left += 1

    def ask(self) -> None:
        """Another seed is wanted."""
        self.seeding = True
        self.exhausted = self.asked >= self.seeds
        self.asked += not self.exhausted

    def update(self, changes: list[tuple], update_id: int, sequence: int | None = None) -> str:
        """What became of an update: waiting, applied, stale (not beyond the book) or gapped."""
        if self.seeding:
            self.wait((changes, update_id, sequence))
            return "waiting"
        if self.book.last is not None and update_id <= self.book.last:
            return "stale"
        if self.book.apply(changes, update_id, sequence):
            self.asked = 0
            return "applied"
        self.wait((changes, update_id, sequence))
        self.ask()
        return "gapped"

    def seed(self, levels: list[tuple], update_id: int) -> int:
        """Take a seed; how many waiting updates were replayed on it."""
        if not self.book.apply(levels, update_id, is_snapshot=True):
            self.ask()
            return 0
        self.seeding, replayed = False, 0
        while self.waiting:
            changes, own_id, sequence = self.waiting[0]
            if own_id > update_id:
                if not self.book.apply(changes, own_id, sequence):
                    self.ask()
                    break
                replayed += 1
            self.waiting.popleft()
            self.left += 1
        else:
            self.asked = 0
        return replayed

    def failed(self) -> int | None:
        """A seed could not be fetched: the wait before the next in microseconds, or None when no further one is asked for."""
        self.ask()
        return None if self.exhausted else seed_delay_us(self.asked)


def _number(text) -> Decimal | None:
    try:
        found = Decimal(str(text))
    except InvalidOperation:
        return None
    return found if found.is_finite() else None
