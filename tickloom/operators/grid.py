"""Alignment of streams on clocks: tumbling grids, as-of joins, event-driven sampling.

Grid rules. An event at ``ts`` belongs to row ``ts div P + 1``, labelled with
the closing time ``row * P``. The driver stream's first event anchors the clock
and emits nothing; each later one closes the rows up to its own period, at most
``cap`` of them at a jump. When the input ends, a terminal row takes what is
left. Events of rows that were closed before they came, or never opened, are
late: they are dropped and counted. A row's book is the last one that began
before the row's closing time, and is carried over quiet rows; funding, open
interest and prints are not carried.

Events come in time order unless an ``arrival`` column says otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.scalars import div, row_of
from tickloom.operators import blocked

GAP_FILL = 10_000
#: From this period on a key has half a million rows a year at most, which one window orders; shorter ones go in blocks.
ONE_WINDOW_US = 60_000_000
KEY = ("exchange", "symbol")


def clock(driver: DataFrame, period_us: int, key: Sequence[str] = KEY, ts: str = "ts_us", arrival: Sequence[str] | None = None, hold_us: int = 0) -> DataFrame:
    """(key, period, previous): the driver's record periods in order; previous is null at the anchor.

    With time order the distinct periods are the records, and each key sends one
    row per period to the window. With an arrival order a period is a record
    if no earlier arrival reached it.
    """
    period = div(F.greatest(F.col(ts) - hold_us, F.lit(0).cast("long")), period_us)
    if arrival:
        seen = blocked.with_highest(driver.select(*key, *arrival, period.alias("period")), F.col("period"), "most", key, arrival)
        records = seen.where("most is null or period > most").select(*key, "period")
    else:
        records = driver.select(*key, period.alias("period")).distinct()
    return blocked.scanned(records, key, ["period"], {"previous": ("max", F.col("period"))}, blocks=period_us < ONE_WINDOW_US)


def spine(periods: DataFrame, key: Sequence[str] = KEY, cap: int = GAP_FILL, final: bool = True) -> DataFrame:
    """(key, row, terminal): the rows that the clock closes, gaps filled, and a terminal one."""
    inner = periods.where("previous is not null").select(*key, F.explode(F.sequence(F.col("previous") + 1, F.least(F.col("period"), F.col("previous") + cap))).alias("row"), F.lit(False).alias("terminal"))
    if not final:
        return inner
    last = periods.groupBy(*key).agg((F.max("period") + 1).alias("row")).withColumn("terminal", F.lit(True))
    return inner.unionByName(last)


def ends(periods: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """(key, anchor, terminal_row): one row for each key."""
    return periods.groupBy(*key).agg(F.min("period").alias("anchor"), (F.max("period") + 1).alias("terminal_row"))


def placed(events: DataFrame, periods: DataFrame, period_us: int, key: Sequence[str] = KEY, ts: str = "ts_us") -> DataFrame:
    """Events with their row; events after the clock's end join the terminal row, events at or before the anchor row are late."""
    met = events.join(ends(periods, key), list(key))
    row = F.least(row_of(F.col(ts), period_us), F.col("terminal_row"))
    return met.withColumn("row", row).withColumn("late", F.col("row") <= F.col("anchor")).drop("anchor", "terminal_row")


def late_by_arrival(events: DataFrame, period_us: int, arrival: Sequence[str], key: Sequence[str] = KEY, ts: str = "ts_us", hold_us: int = 0, drives: Column | None = None) -> DataFrame:
    """Events with their row and whether the clock had closed it before they came; all of them drive the clock in arrival order, or those for which ``drives`` holds."""
    period = div(F.greatest(F.col(ts) - hold_us, F.lit(0).cast("long")), period_us)
    rows = blocked.with_highest(events, period if drives is None else F.when(drives, period), "_clock", key, arrival)
    return rows.withColumn("row", row_of(F.col(ts), period_us)).withColumn("late", F.coalesce(F.col("row") <= F.col("_clock"), F.lit(False))).drop("_clock")


def in_time(driver: DataFrame, events: DataFrame, period_us: int, arrival: Sequence[str], key: Sequence[str] = KEY, ts: str = "ts_us", hold_us: int = 0) -> DataFrame:
    """The events that came before the clock of ``driver`` had closed their row, by the arrival order of both."""
    ticks = driver.select(*key, *arrival, ts).withColumn("_ticks", F.lit(True))
    both = events.withColumn("_ticks", F.lit(False)).unionByName(ticks, allowMissingColumns=True)
    told = late_by_arrival(both, period_us, [*arrival, "_ticks"], key, ts, hold_us, F.col("_ticks"))
    return told.where("not _ticks and not late").drop("_ticks", "row", "late")


def as_of(rows: DataFrame, states: DataFrame, value: str, key: Sequence[str] = KEY, row: str = "row", blocks: bool = True) -> DataFrame:
    """Each row with the last ``value`` of a state whose row is not later: one union and one scan, no range join."""
    kind = states.schema[value].dataType
    both = rows.withColumn("_own", F.lit(True)).withColumn("_state", F.lit(None).cast(kind)).unionByName(states.select(*key, row, F.col(value).alias("_state")).withColumn("_own", F.lit(False)), allowMissingColumns=True)
    told = blocked.scanned(both, key, [row, "_own"], upto={value: ("last", F.col("_state"))}, blocks=blocks)
    return told.where("_own").drop("_own", "_state")


def book_states(books: DataFrame, period_us: int, key: Sequence[str] = KEY, ts: str = "ts_us", order: Sequence[str] = ("ts_us", "seq")) -> DataFrame:
    """(key, row, book): the last book of each period; ``books`` has best and total columns."""
    book = F.struct("bid", "ask", "bid_volume", "ask_volume", F.col(ts).alias("book_ts_us"))
    return books.groupBy(*key, row_of(F.col(ts), period_us).alias("row")).agg(F.max_by(book, F.struct(*order)).alias("book"))


def _zero(value: Column, kind: str = "double") -> Column:
    return F.coalesce(value.cast(kind), F.lit(0).cast(kind))


def _share(a: Column, b: Column) -> Column:
    """(a - b) / (a + b), 0 where nothing is there."""
    total = a + b
    return F.when(total != 0, (a - b) / total).otherwise(F.lit(0.0))


def market_aggregate(
    driver: DataFrame,
    books: DataFrame,
    trades: DataFrame,
    liquidations: DataFrame,
    funding: DataFrame,
    open_interest: DataFrame,
    period_us: int,
    key: Sequence[str] = KEY,
    cap: int = GAP_FILL,
    hold_us: int = 0,
    arrival: Sequence[str] | None = None,
) -> DataFrame:
    """The feature row of every grid row: 26 columns after the key, 0 where nothing is known.

    With ``arrival`` (columns that order all streams as they came) the driver
    closes rows in that order, and prints, liquidations, funding and open
    interest that come after their row was closed are dropped; books are never
    late, as the last one is carried.

    Inputs carry the key, ``ts_us`` and ``seq`` (arrival): books bid, ask,
    bid_volume, ask_volume; trades and liquidations side, price, amount
    (decimals); funding rate, interval_hours, next_funding_ts_us; open interest
    oi, oi_value, mark_px. All events meet in one aggregation by (key, row).
    """
    periods = clock(driver, period_us, key, arrival=arrival, hold_us=hold_us)

    def part(frame: DataFrame, kind: str, **columns: Column) -> DataFrame:
        return frame.select(*key, "ts_us", "seq", *(c for c in arrival or () if c not in ("ts_us", "seq")), F.lit(kind).alias("kind"), *(c.alias(n) for n, c in columns.items()))

    col = F.col
    events = (
        part(trades, "trade", side=col("side"), price=col("price"), amount=col("amount"))
        .unionByName(part(liquidations, "liq", side=col("side"), price=col("price"), amount=col("amount")))
        .unionByName(part(funding, "funding", rate=col("rate"), interval_hours=col("interval_hours"), next_ts=col("next_funding_ts_us")), allowMissingColumns=True)
        .unionByName(part(open_interest, "oi", oi=col("oi"), oi_value=col("oi_value"), mark_px=col("mark_px")), allowMissingColumns=True)
    )
    if arrival:
        events = in_time(driver, events, period_us, arrival, key, hold_us=hold_us)
    at = F.struct("ts_us", "seq")

    def when(kind: str, value: Column, side: str | None = None) -> Column:
        test = col("kind") == kind
        return F.when(test & (col("side") == side) if side else test, value)

    notional = col("price") * col("amount")
    one = F.lit(1).cast("long")
    facts = (
        placed(events, periods, period_us, key)
        .where(~col("late"))
        .groupBy(*key, "row")
        .agg(
            *(F.sum(when("trade", col("amount"), s)).alias(f"{s}_volume") for s in ("buy", "sell")),
            *(F.sum(when("trade", notional, s)).alias(f"{s}_notional") for s in ("buy", "sell")),
            *(F.sum(when("trade", one, s)).alias(f"{s}_count") for s in ("buy", "sell")),
            F.count(when("trade", one)).alias("trade_count"),
            F.min_by("price", when("trade", at)).alias("px_first"),
            F.max_by("price", when("trade", at)).alias("px_last"),
            *(F.sum(when("liq", notional, s)).alias(f"liq_{s}") for s in ("buy", "sell")),
            F.count(when("liq", one)).alias("liq_count"),
            F.max_by(F.struct("rate", "interval_hours", "next_ts", "ts_us"), when("funding", at)).alias("fr"),
            F.max_by(F.struct("oi", "oi_value", "mark_px"), when("oi", at)).alias("oi"),
        )
    )
    rows = spine(periods, key, cap)
    last = ends(periods, key).select(*key, "terminal_row")
    states = book_states(books, period_us, key).join(last, list(key)).withColumn("row", F.least("row", "terminal_row")).drop("terminal_row")
    states = states.groupBy(*key, "row").agg(F.max_by("book", "book.book_ts_us").alias("book"))
    blocks = period_us < ONE_WINDOW_US
    full = as_of(rows, states, "book", key, blocks=blocks).join(facts, [*key, "row"], "left")

    bid, ask = col("book.bid"), col("book.ask")
    both = (bid > 0) & (ask > 0)
    volume = {s: _zero(col(f"{s}_volume")) for s in ("buy", "sell")}
    money = {s: _zero(col(f"{s}_notional")) for s in ("buy", "sell")}
    contracts = _zero(col("oi.oi"))
    liq = {s: _zero(col(f"liq_{s}")) for s in ("buy", "sell")}
    total, paid = volume["buy"] + volume["sell"], money["buy"] + money["sell"]
    shown = full.select(
        *key,
        (col("row") * period_us).alias("ts_us"),
        F.when(both, (bid + ask) / 2).otherwise(0.0).alias("ob_mid_price"),
        F.when(both, ask - bid).otherwise(0.0).alias("ob_spread"),
        F.coalesce(_share(col("book.bid_volume").cast("double"), col("book.ask_volume").cast("double")), F.lit(0.0)).alias("ob_imbalance"),
        total.alias("trade_volume"),
        F.when(total != 0, paid / total).otherwise(0.0).alias("trade_vwap"),
        _zero(col("trade_count"), "long").alias("trade_count"),
        (liq["buy"] + liq["sell"]).alias("liq_notional"),
        _zero(col("liq_count"), "long").alias("liq_count"),
        _share(liq["buy"], liq["sell"]).alias("liq_imbalance"),
        _zero(col("fr.rate")).alias("fr_rate"),
        _zero(col("fr.rate") * 8760 / col("fr.interval_hours")).alias("fr_annualized"),
        F.when(col("fr.next_ts") > 0, col("fr.next_ts") - col("fr.ts_us")).otherwise(F.lit(0).cast("long")).alias("fr_next_settlement_delta"),
        contracts.alias("oi_contracts"),
        _zero(F.coalesce(col("oi.oi_value"), col("oi.oi") * col("oi.mark_px"))).alias("oi_value"),
        paid.alias("trade_notional"),
        volume["buy"].alias("trade_buy_volume"),
        money["buy"].alias("trade_buy_notional"),
        _zero(col("buy_count"), "long").alias("trade_buy_count"),
        volume["sell"].alias("trade_sell_volume"),
        money["sell"].alias("trade_sell_notional"),
        _zero(col("sell_count"), "long").alias("trade_sell_count"),
        _share(volume["buy"], volume["sell"]).alias("trade_imbalance"),
        _zero(col("px_first")).alias("trade_px_first"),
        _zero(col("px_last")).alias("trade_px_last"),
    )
    told = blocked.scanned(shown, key, ["ts_us"], {"_oi": ("lag", col("oi_contracts"))}, blocks=blocks)
    return told.withColumn("oi_change", col("oi_contracts") - F.coalesce("_oi", F.lit(0.0))).drop("_oi")


def sampled_books(books: DataFrame, period_us: int, key: Sequence[str] = KEY, cap: int = GAP_FILL) -> DataFrame:
    """(key, ts_us, book): at every boundary the book stored before it was crossed, carried over empty periods; a terminal one at the end."""
    periods = clock(books, period_us, key)
    # A boundary row shows what was stored when the crossing update came: the last book of the period before.
    states = book_states(books, period_us, key)
    sampled = as_of(spine(periods, key, cap), states, "book", key, blocks=period_us < ONE_WINDOW_US)
    return sampled.select(*key, (F.col("row") * period_us).alias("ts_us"), "book.*")


def event_samples(events: DataFrame, triggers: Sequence[str], key: Sequence[str] = KEY, order: Sequence[str] = ("ts_us", "seq")) -> DataFrame:
    """A row for each trigger event: the latest book, funding and open interest, and the prints since the trigger before.

    ``events`` is one stream of kinds (book, trade, liq, funding, oi) with book
    {bid, ask}, rate, oi, amount. Triggers count once the first book came; what
    came before it waits for the first trigger after. Left-over prints make a
    closing row with the last book's time.
    """
    kind = F.col("kind")
    # A book that triggers shows itself, so its own row counts as begun.
    state = blocked.scanned(
        events,
        key,
        order,
        upto={
            "_begun": ("max", kind == "book"),
            "book_now": ("last", F.when(kind == "book", F.struct("bid", "ask", "ts_us"))),
            "rate_now": ("last", F.when(kind == "funding", F.col("rate"))),
            "oi_now": ("last", F.when(kind == "oi", F.col("oi"))),
        },
    ).withColumn("fires", kind.isin(*triggers) & F.col("_begun"))
    state = blocked.scanned(state, key, order, {"span": ("sum", F.col("fires").cast("long"))}).withColumn("span", F.coalesce("span", F.lit(0).cast("long")))
    at = F.struct(*order)
    spans = state.groupBy(*key, "span").agg(
        F.max("fires").alias("fired"),
        F.max(F.when(F.col("fires"), F.col("ts_us"))).alias("trigger_ts"),
        F.count(F.when(kind == "trade", 1)).alias("n_trades"),
        F.coalesce(F.sum(F.when(kind == "trade", F.col("amount"))), F.lit(0)).cast("double").alias("volume"),
        F.count(F.when(kind == "liq", 1)).alias("n_liquidations"),
        *(F.max_by(c, at).alias(c) for c in ("book_now", "rate_now", "oi_now")),
    )
    kept = spans.where("fired or (book_now is not null and n_trades + n_liquidations > 0)")
    return kept.select(
        *key,
        F.col("span"),
        F.when(F.col("fired"), F.col("trigger_ts")).otherwise(F.col("book_now.ts_us")).alias("ts_us"),
        F.col("book_now.bid").alias("bid"),
        F.col("book_now.ask").alias("ask"),
        F.col("rate_now").alias("rate"),
        F.col("oi_now").alias("oi"),
        "n_trades",
        "volume",
        "n_liquidations",
    )


def homed_settlements(settlements: DataFrame, periods: DataFrame, period_us: int, key: Sequence[str] = KEY, ts: str = "local_ts_us") -> DataFrame:
    """Settlements by the row of their receipt, never late: at the earliest the first row after the anchor."""
    met = settlements.join(ends(periods, key), list(key))
    row = F.least(F.greatest(row_of(F.col(ts), period_us), F.col("anchor") + 1), F.col("terminal_row"))
    return met.withColumn("row", row).drop("anchor", "terminal_row")
