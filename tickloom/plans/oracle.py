"""Shared pieces of the DuckDB oracles: the market streams as common table expressions."""

from __future__ import annotations

HOUR = 3_600_000_000

EVENTS = """
ev as (
  select ['binance', 'bybit', 'coinbase', 'kraken'][cast(user_id % 4 as int) + 1] as exchange,
    'U' || cast(user_id % 5 as varchar) || '/USD' as symbol, epoch_us(ts) as ts_us, event_id as seq, event_type, value,
    cast(json_extract_string(props, '$.k') as bigint) as k, user_id
  from events)"""
TRADES = """
trades_ev as (
  select exchange, symbol, ts_us, seq, case event_type when 'click' then 'buy' else 'sell' end as side,
    cast(value as decimal(18,2)) as price, cast(k as decimal(18,0)) as amount
  from ev where event_type in ('click', 'purchase'))"""
LIQS = """
liqs_ev as (
  select exchange, symbol, ts_us, seq, case when k % 2 = 0 then 'buy' else 'sell' end as side,
    cast(value as decimal(18,2)) as price, cast(k as decimal(18,0)) as amount
  from ev where event_type = 'error')"""
QUOTES = """
quotes_ev as (
  select exchange, symbol, ts_us, seq, cast(cast(value as decimal(18,2)) as double) as bid,
    cast(cast(value as decimal(18,2)) + cast((k + 1) * 0.01 as decimal(18,2)) as double) as ask, k + 1 as bid_volume, user_id + 1 as ask_volume
  from ev where event_type = 'view')"""
FUNDING = f"""
funding_ev as (
  select exchange, symbol, ts_us, seq, value / 1e6 as rate, case when user_id % 2 = 0 then 1 else 8 end as interval_hours,
    case when k % 3 = 0 then 0 else (ts_us // {HOUR} + 1) * {HOUR} end as next_funding_ts_us
  from ev where event_type = 'signup')"""
INTEREST = """
interest_ev as (
  select exchange, symbol, ts_us, seq, cast(k * 10 as double) as oi, case when k % 4 = 0 then cast(k * 1000 as double) end as oi_value, value as mark_px
  from ev where event_type = 'signup')"""
FILLS = """
fills as (
  select 'binance' as exchange, 'S' || cast(l_suppkey as varchar) || '/USD' as symbol, cast(l_orderkey as varchar) || '-' || cast(l_linenumber as varchar) as id,
    l_orderkey, l_linenumber, epoch_us(l_shipdate) as ts_us, case l_returnflag when 'R' then 'sell' else 'buy' end as side,
    cast(l_quantity as decimal(18,0)) as amount, l_partkey, l_suppkey, l_extendedprice, l_discount, l_tax, l_linestatus, l_returnflag
  from lineitem)"""
LEVELS = """
levels as (
  select l_orderkey as book, case l_linestatus when 'O' then 'bid' else 'ask' end as side, l_partkey as price, cast(sum(l_quantity) as double) as size
  from lineitem group by all)"""
DELTAS = """
deltas as (
  select l_suppkey as book, case l_linestatus when 'O' then 'bid' else 'ask' end as side, l_partkey as price,
    case when l_returnflag = 'R' then 0.0 else l_quantity end as size, l_orderkey as update_id, l_linenumber, epoch_us(l_shipdate) as ts_us,
    l_extendedprice, l_discount, l_tax
  from lineitem)"""


def spine(driver: str, period_us: int = HOUR) -> str:
    """Clock and rows of a driver stream, in time order."""
    return f"""
periods as (select distinct exchange, symbol, ts_us // {period_us} as period from {driver}),
jumps as (select *, lag(period) over (partition by exchange, symbol order by period) as previous from periods),
ends as (select exchange, symbol, min(period) as anchor, max(period) + 1 as terminal_row from periods group by all),
spine as (
  select exchange, symbol, unnest(range(previous + 1, least(period, previous + 10000) + 1)) as row, false as terminal from jumps where previous is not null
  union all select exchange, symbol, terminal_row, true from ends)"""


def sql(*parts: str, last: str) -> str:
    """A query of common table expressions and its last select."""
    return "with " + ",".join(parts) + "\n" + last
