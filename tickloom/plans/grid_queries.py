"""Queries of the clock and grid operators over the event tables, with their oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.operators import grid
from tickloom.plans import oracle as o
from tickloom.sources import mapping as m

HOUR = o.HOUR
SPINE = o.spine("quotes_ev")


def rounded(frame: DataFrame, places: int = 6) -> DataFrame:
    """Derived doubles to a few places, as the oracles do."""
    return frame.select(*(F.round(F.col(c), places).alias(c) if t == "double" else F.col(c) for c, t in frame.dtypes))


def market_aggregate_1h(spark: SparkSession, d: str) -> DataFrame:
    quotes = m.quotes(spark, d)
    return rounded(grid.market_aggregate(quotes, quotes, m.trades(spark, d), m.liquidations(spark, d), m.funding(spark, d), m.open_interest(spark, d), HOUR))


PLACED = f"""
trades_at as (
  select t.*, least(ts_us // {HOUR} + 1, terminal_row) as row, anchor from trades_ev t join ends using (exchange, symbol)),
liqs_at as (
  select l.*, least(ts_us // {HOUR} + 1, terminal_row) as row, anchor from liqs_ev l join ends using (exchange, symbol)),
funding_at as (
  select f.*, least(ts_us // {HOUR} + 1, terminal_row) as row, anchor from funding_ev f join ends using (exchange, symbol)),
interest_at as (
  select i.*, least(ts_us // {HOUR} + 1, terminal_row) as row, anchor from interest_ev i join ends using (exchange, symbol)),
books as (
  select exchange, symbol, least(ts_us // {HOUR} + 1, terminal_row) as row, arg_max({{'bid': bid, 'ask': ask, 'bv': bid_volume, 'av': ask_volume}}, seq) as book
  from quotes_ev join ends using (exchange, symbol) group by all),
t as (
  select exchange, symbol, row,
    cast(sum(amount) filter (side = 'buy') as double) as bv, cast(sum(amount) filter (side = 'sell') as double) as sv,
    cast(sum(price * amount) filter (side = 'buy') as double) as bn, cast(sum(price * amount) filter (side = 'sell') as double) as sn,
    count(*) filter (side = 'buy') as bc, count(*) filter (side = 'sell') as sc, count(*) as n,
    cast(arg_min(price, seq) as double) as px_first, cast(arg_max(price, seq) as double) as px_last
  from trades_at where row > anchor group by all),
l as (
  select exchange, symbol, row, cast(sum(price * amount) filter (side = 'buy') as double) as bn, cast(sum(price * amount) filter (side = 'sell') as double) as sn, count(*) as n
  from liqs_at where row > anchor group by all),
f as (select exchange, symbol, row, arg_max({{'rate': rate, 'h': interval_hours, 'next': next_funding_ts_us, 'ts': ts_us}}, seq) as fr from funding_at where row > anchor group by all),
i as (select exchange, symbol, row, arg_max({{'oi': oi, 'v': oi_value, 'mark': mark_px}}, seq) as oi from interest_at where row > anchor group by all),
full_rows as (
  select s.exchange, s.symbol, s.row, last_value(b.book ignore nulls) over (partition by s.exchange, s.symbol order by s.row) as book,
    coalesce(t.bv, 0) as bv, coalesce(t.sv, 0) as sv, coalesce(t.bn, 0) as bn, coalesce(t.sn, 0) as sn, coalesce(t.bc, 0) as bc, coalesce(t.sc, 0) as sc, coalesce(t.n, 0) as n,
    coalesce(t.px_first, 0) as px_first, coalesce(t.px_last, 0) as px_last, coalesce(l.bn, 0) as lb, coalesce(l.sn, 0) as ls, coalesce(l.n, 0) as ln, f.fr, coalesce(i.oi.oi, 0) as oi,
    coalesce(i.oi.v, i.oi.oi * i.oi.mark, 0) as oi_value
  from spine s left join books b using (exchange, symbol, row) left join t using (exchange, symbol, row) left join l using (exchange, symbol, row)
    left join f using (exchange, symbol, row) left join i using (exchange, symbol, row))"""

MARKET_AGGREGATE_SQL = o.sql(
    o.EVENTS, o.TRADES, o.LIQS, o.QUOTES, o.FUNDING, o.INTEREST, SPINE, PLACED,
    last=f"""
select exchange, symbol, row * {HOUR} as ts_us,
  round(case when book.bid > 0 and book.ask > 0 then (book.bid + book.ask) / 2 else 0 end, 6) as ob_mid_price,
  round(case when book.bid > 0 and book.ask > 0 then book.ask - book.bid else 0 end, 6) as ob_spread,
  round(coalesce((book.bv - book.av) / nullif(cast(book.bv + book.av as double), 0), 0), 6) as ob_imbalance,
  round(bv + sv, 6) as trade_volume, round(coalesce((bn + sn) / nullif(bv + sv, 0), 0), 6) as trade_vwap, n as trade_count,
  round(lb + ls, 6) as liq_notional, ln as liq_count, round(coalesce((lb - ls) / nullif(lb + ls, 0), 0), 6) as liq_imbalance,
  round(coalesce(fr.rate, 0), 6) as fr_rate, round(coalesce(fr.rate * 8760 / fr.h, 0), 6) as fr_annualized,
  case when fr.next > 0 then fr.next - fr.ts else 0 end as fr_next_settlement_delta,
  round(oi, 6) as oi_contracts, round(oi_value, 6) as oi_value, round(bn + sn, 6) as trade_notional,
  round(bv, 6) as trade_buy_volume, round(bn, 6) as trade_buy_notional, bc as trade_buy_count,
  round(sv, 6) as trade_sell_volume, round(sn, 6) as trade_sell_notional, sc as trade_sell_count,
  round(coalesce((bv - sv) / nullif(bv + sv, 0), 0), 6) as trade_imbalance, round(px_first, 6) as trade_px_first, round(px_last, 6) as trade_px_last,
  round(oi - lag(oi, 1, 0) over (partition by exchange, symbol order by row), 6) as oi_change
from full_rows""",
)


def market_aggregate_arrival(spark: SparkSession, d: str) -> DataFrame:
    """The same rows when events come out of time order: rows close as the quotes come, and what comes after is dropped."""
    quotes = _shuffled(m.quotes(spark, d))
    others = (_shuffled(f(spark, d)) for f in (m.trades, m.liquidations, m.funding, m.open_interest))
    return rounded(grid.market_aggregate(quotes, quotes, *others, HOUR, arrival=["arrival", "seq"]))


ARRIVAL = f"""
raw_told as (
  select *, max(case when event_type = 'view' then ts_us // {HOUR} end) over (partition by exchange, symbol order by seq + (seq * 7919) % 64, seq rows between unbounded preceding and 1 preceding) as clock from raw_ev),
ev as (select exchange, symbol, ts_us, seq, event_type, value, k, user_id from raw_told where event_type = 'view' or clock is null or ts_us // {HOUR} + 1 > clock),
records as (select exchange, symbol, ts_us, seq from raw_told where event_type = 'view' and (clock is null or ts_us // {HOUR} > clock))"""
AGGREGATE_ARRIVAL_SQL = o.sql(
    o.EVENTS.replace("ev as (", "raw_ev as (", 1), ARRIVAL, o.TRADES, o.LIQS, o.QUOTES, o.FUNDING, o.INTEREST, o.spine("records"), PLACED,
    last=MARKET_AGGREGATE_SQL[MARKET_AGGREGATE_SQL.rindex("\nselect exchange, symbol, row * ") :],
)


def grid_spine_gapfill(spark: SparkSession, d: str) -> DataFrame:
    return grid.spine(grid.clock(m.trades(spark, d), HOUR))


def grid_asof_book(spark: SparkSession, d: str) -> DataFrame:
    quotes = m.quotes(spark, d)
    rows = grid.spine(grid.clock(m.trades(spark, d), HOUR))
    met = grid.as_of(rows, grid.book_states(quotes, HOUR), "book")
    return met.select("exchange", "symbol", "row", F.col("book.bid").alias("bid"), F.col("book.ask").alias("ask"), F.col("book.book_ts_us").alias("book_ts_us"))


ASOF_SQL = o.sql(
    o.EVENTS, o.TRADES, o.QUOTES, o.spine("trades_ev"),
    last=f"""
select s.exchange, s.symbol, s.row, q.bid, q.ask, q.ts_us as book_ts_us
from spine s asof left join quotes_ev q on s.exchange = q.exchange and s.symbol = q.symbol and q.ts_us < s.row * {HOUR}""",
)


def grid_trade_bucket(spark: SparkSession, d: str) -> DataFrame:
    trades = m.trades(spark, d)
    rows = grid.placed(trades, grid.clock(trades, HOUR), HOUR).where("not late")
    return rows.groupBy("exchange", "symbol", "row").agg(F.count("*").alias("trade_count"), F.sum("amount").cast("double").alias("trade_volume"))


def _shuffled(frame: DataFrame) -> DataFrame:
    """A fixed arrival order that differs from time order."""
    return frame.withColumn("arrival", F.col("seq") + (F.col("seq") * 7919) % 64)


def late_events_count(spark: SparkSession, d: str) -> DataFrame:
    rows = grid.late_by_arrival(_shuffled(m.events(spark, d)), HOUR, ["arrival", "seq"])
    return rows.groupBy("exchange", "symbol").agg(F.count("*").alias("n"), F.count(F.when(F.col("late"), 1)).alias("late"))


def holdback_membership(spark: SparkSession, d: str) -> DataFrame:
    """Late events without and with an hour of hold-back."""
    events = _shuffled(m.events(spark, d))
    plain = grid.late_by_arrival(events, HOUR, ["arrival", "seq"]).groupBy("exchange", "symbol").agg(F.count(F.when(F.col("late"), 1)).alias("late"))
    held = grid.late_by_arrival(events, HOUR, ["arrival", "seq"], hold_us=HOUR).groupBy("exchange", "symbol").agg(F.count(F.when(F.col("late"), 1)).alias("late_with_hold"))
    return plain.join(held, ["exchange", "symbol"])


def _late_sql(hold: int) -> str:
    return f"""(select exchange, symbol, ts_us // {HOUR} + 1 <= max(greatest(ts_us - {hold}, 0) // {HOUR}) over (partition by exchange, symbol order by seq + (seq * 7919) % 64, seq rows between unbounded preceding and 1 preceding) as late from ev)"""


LATE_SQL = o.sql(o.EVENTS, last=f"select exchange, symbol, count(*) as n, count(*) filter (late) as late from {_late_sql(0)} group by all")
HOLD_SQL = o.sql(
    o.EVENTS,
    last=f"""select * from (select exchange, symbol, count(*) filter (late) as late from {_late_sql(0)} group by all)
join (select exchange, symbol, count(*) filter (late) as late_with_hold from {_late_sql(HOUR)} group by all) using (exchange, symbol)""",
)


def clock_mode_compare(spark: SparkSession, d: str) -> DataFrame:
    """Rows that each clock emits."""
    drivers = {"orderbook": m.quotes(spark, d), "trade": m.trades(spark, d), "liquidation": m.liquidations(spark, d), "external": m.events(spark, d)}
    parts = [grid.spine(grid.clock(f, HOUR)).groupBy("exchange", "symbol").agg(F.count("*").alias("rows")).withColumn("mode", F.lit(k)) for k, f in drivers.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _mode_sql(mode: str, test: str) -> str:
    return f"""select exchange, symbol, '{mode}' as mode, cast(max(p) - min(p) + 1 as bigint) as rows from (select exchange, symbol, ts_us // {HOUR} as p from ev where {test}) group by exchange, symbol"""


MODES_SQL = o.sql(
    o.EVENTS,
    last=" union all ".join(
        _mode_sql(*x) for x in (("orderbook", "event_type = 'view'"), ("trade", "event_type in ('click', 'purchase')"), ("liquidation", "event_type = 'error'"), ("external", "true"))
    ),
)


def _one_stream(spark: SparkSession, d: str) -> DataFrame:
    e = m.events(spark, d)
    kind = F.col("event_type")
    cents = F.col("value").cast("decimal(18,2)")
    return e.select(
        "exchange",
        "symbol",
        "ts_us",
        "seq",
        F.when(kind == "view", "book").when(kind.isin("click", "purchase"), "trade").when(kind == "error", "liq").otherwise("context").alias("kind"),
        cents.cast("double").alias("bid"),
        (cents + ((F.col("k") + 1) * F.lit(0.01).cast("decimal(3,2)")).cast("decimal(18,2)")).cast("double").alias("ask"),
        (F.col("value") / 1e6).alias("rate"),
        (F.col("k") * 10).cast("double").alias("oi"),
        F.col("k").cast("decimal(18,0)").alias("amount"),
    )


def event_sync_snapshots(spark: SparkSession, d: str) -> DataFrame:
    """A snapshot at each liquidation; a context event sets funding and open interest at once."""
    stream = _one_stream(spark, d)
    context = stream.where("kind = 'context'")
    parted = stream.where("kind <> 'context'").unionByName(context.withColumn("kind", F.lit("funding"))).unionByName(context.withColumn("kind", F.lit("oi")))
    return rounded(grid.event_samples(parted, ["liq"]))


EVENT_SYNC_SQL = o.sql(
    o.EVENTS,
    """
x as (
  select *, max(case when event_type = 'view' then 1 else 0 end) over w as begun from ev
  window w as (partition by exchange, symbol order by seq)),
y as (select *, event_type = 'error' and begun = 1 as fires from x),
z as (
  select *, coalesce(sum(cast(fires as bigint)) over (partition by exchange, symbol order by seq rows between unbounded preceding and 1 preceding), 0) as span,
    last_value(case when event_type = 'view' then {'bid': cast(value as decimal(18,2)), 'ask': cast(value as decimal(18,2)) + cast((k + 1) * 0.01 as decimal(18,2)), 'ts': ts_us} end ignore nulls) over w as book,
    last_value(case when event_type = 'signup' then value / 1e6 end ignore nulls) over w as rate,
    last_value(case when event_type = 'signup' then cast(k * 10 as double) end ignore nulls) over w as oi
  from y window w as (partition by exchange, symbol order by seq)),
g as (
  select exchange, symbol, span, bool_or(fires) as fired, max(ts_us) filter (fires) as trigger_ts, count(*) filter (event_type in ('click', 'purchase')) as n_trades,
    cast(coalesce(sum(k) filter (event_type in ('click', 'purchase')), 0) as double) as volume, count(*) filter (event_type = 'error') as n_liquidations,
    arg_max({'b': book}, seq).b as book, arg_max({'r': rate}, seq).r as rate, arg_max({'o': oi}, seq).o as oi
  from z group by all)""",
    last="""
select exchange, symbol, cast(span as bigint) as span, case when fired then trigger_ts else book.ts end as ts_us, cast(book.bid as double) as bid, cast(book.ask as double) as ask,
  round(rate, 6) as rate, oi, n_trades, volume, n_liquidations
from g where fired or (book is not null and n_trades + n_liquidations > 0)""",
)


def ob_sync_sampling(spark: SparkSession, d: str) -> DataFrame:
    return grid.sampled_books(m.quotes(spark, d), HOUR)


OB_SYNC_SQL = o.sql(
    o.EVENTS, o.QUOTES, SPINE,
    last=f"""
select s.exchange, s.symbol, s.row * {HOUR} as ts_us, q.bid, q.ask, q.bid_volume, q.ask_volume, q.ts_us as book_ts_us
from spine s asof left join quotes_ev q on s.exchange = q.exchange and s.symbol = q.symbol and q.ts_us < s.row * {HOUR}""",
)


def settlement_homing(spark: SparkSession, d: str) -> DataFrame:
    """Settlements go to the row of their receipt, and none is late."""
    settled = m.funding(spark, d).select("exchange", "symbol", "seq", F.col("ts_us").alias("local_ts_us"))
    homed = grid.homed_settlements(settled, grid.clock(m.quotes(spark, d), HOUR), HOUR)
    return homed.groupBy("exchange", "symbol", "row").agg(F.count("*").alias("n"), F.min("seq").alias("first_seq"))


HOMING_SQL = o.sql(
    o.EVENTS, o.QUOTES, o.FUNDING, SPINE,
    last=f"""
select exchange, symbol, least(greatest(ts_us // {HOUR} + 1, anchor + 1), terminal_row) as row, count(*) as n, min(seq) as first_seq
from funding_ev join ends using (exchange, symbol) group by all""",
)


def funding_annualized(spark: SparkSession, d: str) -> DataFrame:
    f = m.funding(spark, d)
    return rounded(f.select("exchange", "symbol", "seq", "rate", (F.col("rate") * 8760 / F.col("interval_hours")).alias("annualized")))


def oi_change(spark: SparkSession, d: str) -> DataFrame:
    """Open interest and its change by row; a quiet row reads 0."""
    return market_aggregate_1h(spark, d).select("exchange", "symbol", "ts_us", "oi_contracts", "oi_change")


QUERIES = {
    "market_aggregate_1h": market_aggregate_1h,
    "market_aggregate_arrival": market_aggregate_arrival,
    "grid_spine_gapfill": grid_spine_gapfill,
    "grid_asof_book": grid_asof_book,
    "grid_trade_bucket": grid_trade_bucket,
    "late_events_count": late_events_count,
    "holdback_membership": holdback_membership,
    "clock_mode_compare": clock_mode_compare,
    "event_sync_snapshots": event_sync_snapshots,
    "ob_sync_sampling": ob_sync_sampling,
    "settlement_homing": settlement_homing,
    "funding_annualized": funding_annualized,
    "oi_change": oi_change,
}
ORACLE_SQL = {
    "market_aggregate_1h": MARKET_AGGREGATE_SQL,
    "market_aggregate_arrival": AGGREGATE_ARRIVAL_SQL,
    "grid_spine_gapfill": o.sql(o.EVENTS, o.TRADES, o.spine("trades_ev"), last="select * from spine"),
    "grid_asof_book": ASOF_SQL,
    "grid_trade_bucket": o.sql(
        o.EVENTS, o.TRADES, o.spine("trades_ev"),
        last=f"""
select exchange, symbol, least(ts_us // {HOUR} + 1, terminal_row) as row, count(*) as trade_count, cast(sum(amount) as double) as trade_volume
from trades_ev join ends using (exchange, symbol) where least(ts_us // {HOUR} + 1, terminal_row) > anchor group by all""",
    ),
    "late_events_count": LATE_SQL,
    "holdback_membership": HOLD_SQL,
    "clock_mode_compare": MODES_SQL,
    "event_sync_snapshots": EVENT_SYNC_SQL,
    "ob_sync_sampling": OB_SYNC_SQL,
    "settlement_homing": HOMING_SQL,
    "funding_annualized": o.sql(o.EVENTS, o.FUNDING, last="select exchange, symbol, seq, round(rate, 6) as rate, round(rate * 8760 / interval_hours, 6) as annualized from funding_ev"),
    "oi_change": f"select exchange, symbol, ts_us, oi_contracts, oi_change from ({MARKET_AGGREGATE_SQL})",
}
