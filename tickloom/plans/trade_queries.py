"""Queries of the trade-log operators, with their oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions import codecs
from tickloom.operators import repair, trades
from tickloom.plans import oracle as o
from tickloom.plans.grid_queries import rounded
from tickloom.sources import mapping as m

HOUR = o.HOUR
CONTENT = ("ts_us", "side", "amount", "l_partkey", "l_extendedprice")
IDENTITY = ("l_orderkey", "l_linenumber")
ORDER_SQL = ", ".join(m.FILL_ORDER)


def _raw(spark: SparkSession, d: str) -> DataFrame:
    """Events as raw prints: the side is a free word, the amount a text that may be none."""
    e = m.events(spark, d)
    side = F.when(F.col("event_type") == "click", "Buy").when(F.col("event_type") == "purchase", "SELL").otherwise(F.col("event_type"))
    amount = F.when(F.col("seq") % 17 == 0, "n/a").otherwise(F.col("k").cast("string"))
    return e.select("exchange", "symbol", "ts_us", "seq", side.alias("side"), F.col("value").cast("decimal(18,2)").cast("string").alias("price"), amount.alias("amount"))


RAW = """
raw as (
  select exchange, symbol, ts_us, seq, case event_type when 'click' then 'Buy' when 'purchase' then 'SELL' else event_type end as side,
    cast(value as decimal(18,2)) as price, case when seq % 17 = 0 then null else k end as amount
  from ev),
judged as (
  select *, case when lower(side) not in ('buy', 'sell') then 'side' when amount is null then 'decimal' when price <= 0 or amount <= 0 then 'not_positive' end as reason from raw)"""


def trade_side_filter(spark: SparkSession, d: str) -> DataFrame:
    kept = trades.accepted(_raw(spark, d))
    return kept.select("exchange", "symbol", "seq", F.col("side_ok").alias("side"), F.col("price_ok").cast("double").alias("price"), F.col("amount_ok").cast("double").alias("amount"))


def trade_drop_counts(spark: SparkSession, d: str) -> DataFrame:
    return trades.drop_counts(_raw(spark, d))


def trade_dedup(spark: SparkSession, d: str) -> DataFrame:
    kept = trades.dedup(m.fills(spark, d), IDENTITY, m.FILL_ORDER, CONTENT)
    return kept.select("id", "ts_us", "side", F.col("amount").cast("double").alias("amount"), "l_partkey", "l_suppkey", "l_extendedprice")


def trade_dedup_report(spark: SparkSession, d: str) -> DataFrame:
    return trades.dedup_report(m.fills(spark, d), IDENTITY, m.FILL_ORDER, CONTENT, by=["side"])


DEDUP = f"""
ranked as (
  select *, row_number() over w as nth, first_value({{'a': ts_us, 'b': side, 'c': amount, 'd': l_partkey, 'e': l_extendedprice}}) over w as kept
  from fills window w as (partition by l_orderkey, l_linenumber order by {ORDER_SQL} rows between unbounded preceding and current row))"""


def _numbered(spark: SparkSession, d: str) -> DataFrame:
    """Prints with a sequence that lost every eleventh number's neighbour and repeats some."""
    t = m.trades(spark, d)
    return t.withColumn("number", F.when(F.col("seq") % 11 == 0, F.col("seq") - 40).otherwise(F.col("seq")))


def trade_continuity(spark: SparkSession, d: str) -> DataFrame:
    return trades.loss(_numbered(spark, d), seq="number", arrival=("seq",))


CONTINUITY_SQL = o.sql(
    o.EVENTS, o.TRADES,
    """
numbered as (select exchange, symbol, seq, case when seq % 11 = 0 then seq - 40 else seq end as number from trades_ev),
held as (select *, max(number) over (partition by exchange, symbol order by seq rows between unbounded preceding and 1 preceding) as highest from numbered)""",
    last="""
select exchange, symbol, count(*) filter (highest is null or number > highest) as trades, count(*) filter (number > highest + 1) as gap_events,
  cast(coalesce(sum(number - highest - 1) filter (number > highest + 1), 0) as bigint) as trades_lost, count(*) filter (number <= highest) as duplicates
from held group by all""",
)
GAP_US = 6 * HOUR


def silence_gaps(spark: SparkSession, d: str) -> DataFrame:
    return trades.silences(m.trades(spark, d), GAP_US)


def silence_stats(spark: SparkSession, d: str) -> DataFrame:
    return trades.silence_stats(m.trades(spark, d), GAP_US)


SILENCE = f"""
gaps as (
  select exchange, symbol, lag(ts_us) over (partition by exchange, symbol order by ts_us, seq) as opened_us, ts_us as closed_us from trades_ev),
silent as (select *, closed_us - opened_us as window_us from gaps where closed_us - opened_us > {GAP_US})"""


def possible_dropped_estimate(spark: SparkSession, d: str) -> DataFrame:
    """Silences of trade logs with the prints that they may hide, by the rate of the day before them."""
    return trades.incidents(m.trades(spark, d), GAP_US, 24 * HOUR)


DROPPED_SQL = o.sql(
    o.EVENTS, o.TRADES,
    f"""
rated as (
  select *, least(count(*) over (partition by exchange, symbol order by ts_us range between {24 * HOUR} preceding and current row), 4096) as recent from trades_ev),
gaps as (
  select exchange, symbol, lag(ts_us) over w as opened_us, ts_us as closed_us, lag(recent) over w as before, ts_us - lag(ts_us) over w as window_us
  from rated window w as (partition by exchange, symbol order by ts_us, seq))""",
    last=f"""
select *, cast(ceil(before * (60000000 / {24 * HOUR}::double) / 60.0 * (window_us / 1e6)) as bigint) as possible_dropped from gaps where window_us > {GAP_US}""",
)


def taker_aggregate(spark: SparkSession, d: str) -> DataFrame:
    made = trades.takers(m.trades(spark, d), HOUR)
    doubles = ("qty", "notional", "px_first", "px_last", "px_min", "px_max", "sweep_depth")
    return rounded(made.select(*(F.col(c).cast("double").alias(c) if c in doubles else F.col(c) for c in made.columns)))


TAKER_SQL = o.sql(
    o.EVENTS, o.TRADES,
    f"""
b as (select *, ts_us // {HOUR} * {HOUR} as bucket_us from trades_ev),
turned as (
  select *, coalesce(case when side = 'buy' then price < lag(price) over w else price > lag(price) over w end, false) as turned
  from b window w as (partition by exchange, symbol, side, bucket_us order by ts_us, seq)),
numbered as (select *, sum(cast(turned as bigint)) over (partition by exchange, symbol, side, bucket_us order by ts_us, seq rows unbounded preceding) as taker from turned),
made as (
  select exchange, symbol, side, bucket_us, taker, min(ts_us) as t0, arg_min(seq, (ts_us, seq)) as s0, count(*) as n_fills, sum(amount) as qty, sum(price * amount) as notional,
    arg_min(price, seq) as px_first, arg_max(price, seq) as px_last, min(price) as px_min, max(price) as px_max, cast(min(seq) as varchar) as id_first, cast(max(seq) as varchar) as id_last
  from numbered group by all having sum(amount) > 0),
placed as (
  select *, row_number() over (partition by exchange, symbol, bucket_us order by t0, s0, side) as k, count(*) over (partition by exchange, symbol, bucket_us) as m,
    count(*) over (partition by exchange, symbol, side, bucket_us) as split
  from made)""",
    last=f"""
select bucket_us + {HOUR}::bigint * (k - 1) // m as ts_us, bucket_us, {HOUR}::bigint as w_us, exchange, symbol, side, n_fills, cast(qty as double) as qty, cast(notional as double) as notional,
  round(cast(notional as double) / cast(qty as double), 6) as vwap, cast(px_first as double) as px_first, cast(px_last as double) as px_last, cast(px_min as double) as px_min, cast(px_max as double) as px_max,
  cast(abs(px_last - px_first) as double) as sweep_depth, id_first, id_last, 'numeric_id' as order_evidence,
  case when split > 1 then 'direction_split' when n_fills = 1 then 'single' when px_min = px_max then 'same_price' else 'swept' end as split_reason, 'taker.v1' as rule_version
from placed""",
)


def order_flow_imbalance(spark: SparkSession, d: str) -> DataFrame:
    hour = F.expr(f"ts_us div {HOUR} * {HOUR}").alias("hour_us")
    return rounded(trades.flow(m.trades(spark, d), ["exchange", "symbol", hour]).select("exchange", "symbol", "hour_us", "n_trades", "buy_volume", "sell_volume", "imbalance"))


def vwap_by_symbol(spark: SparkSession, d: str) -> DataFrame:
    return rounded(trades.flow(m.trades(spark, d), ["exchange", "symbol"]).select("exchange", "symbol", "n_trades", "notional", "vwap"))


FLOW = """
select {by}, count(*) as n_trades, cast(coalesce(sum(amount) filter (side = 'buy'), 0) as double) as buy_volume, cast(coalesce(sum(amount) filter (side = 'sell'), 0) as double) as sell_volume,
  cast(sum(price * amount) as double) as notional from trades_ev group by all"""


def wire_regressions(spark: SparkSession, d: str) -> DataFrame:
    events = m.events(spark, d).withColumn("arrival", F.col("seq") + (F.col("seq") * 7919) % 64)
    return trades.regressions(events, arrival=("arrival", "seq"))


REGRESSED_SQL = o.sql(
    o.EVENTS,
    last="""
select exchange, symbol, count(*) filter (back) as regressed from (
  select exchange, symbol, ts_us < max(ts_us) over (partition by exchange, symbol order by seq + (seq * 7919) % 64, seq rows between unbounded preceding and 1 preceding) as back from ev) group by all""",
)


def ewma_latency(spark: SparkSession, d: str) -> DataFrame:
    return rounded(trades.ewma(m.events(spark, d), "value"))


EWMA_SQL = o.sql(
    o.EVENTS,
    """
numbered as (select exchange, symbol, ts_us, seq, value, row_number() over (partition by exchange, symbol order by ts_us, seq) as n from ev),
smooth as (
  select exchange, symbol, ts_us, seq, n, value as s from numbered where n = 1
  union all select x.exchange, x.symbol, x.ts_us, x.seq, x.n, 0.2::double * x.value + 0.8::double * smooth.s from smooth join numbered x on x.exchange = smooth.exchange and x.symbol = smooth.symbol and x.n = smooth.n + 1)""",
    last="select exchange, symbol, ts_us, seq, round(s, 6) as smoothed from smooth",
).replace("with", "with recursive", 1)


def rtt_average(spark: SparkSession, d: str) -> DataFrame:
    """The round-trip average of each connection, with pings that got no answer."""
    e = m.read(spark, d, "events")
    pings = e.select((F.col("user_id") % 40).alias("conn"), F.col("event_id").alias("ping"), F.when(F.col("event_id") % 29 != 3, F.round(F.col("value") * 1000).cast("long")).alias("rtt_us"))
    return trades.round_trips(pings, order=["ping"])


RTT_SQL = """
with recursive pings as (select user_id % 40 as conn, event_id as ping, case when event_id % 29 <> 3 then cast(round(value * 1000) as bigint) end as rtt_us from events),
numbered as (select *, row_number() over (partition by conn order by ping) as n from pings),
told as (
  select conn, ping, rtt_us, n, rtt_us as srtt_us from numbered where n = 1
  union all select x.conn, x.ping, x.rtt_us, x.n, case when x.rtt_us is null then told.srtt_us when told.srtt_us is null then x.rtt_us else (x.rtt_us + 4 * told.srtt_us) // 5 end
  from told join numbered x on x.conn = told.conn and x.n = told.n + 1)
select conn, ping, rtt_us, srtt_us from told"""


def fnv1a_fingerprint(spark: SparkSession, d: str) -> DataFrame:
    t = m.trades(spark, d)
    return t.select("seq", codecs.fingerprint("ts_us", "side", "price", "amount").alias("fingerprint"))


FNV_SQL = o.sql(
    o.EVENTS, o.TRADES,
    """
texts as (
  select seq, ts_us, side || regexp_replace(regexp_replace(cast(price as varchar), '0+$', ''), '[.]$', '') || cast(amount as varchar) as t from trades_ev),
bytes as (
  select seq, list_concat([14695981039346656037::uhugeint], list_transform(range(8), lambda k: cast((ts_us >> (8 * k)) & 255 as uhugeint)), list_transform(range(1, length(t) + 1), lambda k: cast(ascii(t[k]) as uhugeint))) as b from texts)""",
    last="select seq, lpad(lower(to_hex(cast(list_reduce(b, lambda h, x: (xor(h, x) * 1099511628211::uhugeint) % 18446744073709551616::uhugeint) as ubigint))), 16, '0') as fingerprint from bytes",
)


def push_dedup(spark: SparkSession, d: str) -> DataFrame:
    """Funding pushes seen twice: the ones with a receipt number once, the others as they are."""
    f = m.funding(spark, d).select("exchange", "symbol", F.lit(1).alias("conn_epoch_us"), (F.col("seq") % 5 * F.col("seq")).alias("recv_seq"), "seq")
    kept = trades.drop_pushes(f.unionByName(f))
    return kept.groupBy("exchange", "symbol").agg(F.count("*").alias("n"), F.count(F.when(F.col("recv_seq") == 0, 1)).alias("unnumbered"))


PUSH_SQL = o.sql(
    o.EVENTS, o.FUNDING,
    last="select exchange, symbol, count(distinct seq % 5 * seq) filter (seq % 5 * seq > 0) + 2 * count(*) filter (seq % 5 * seq = 0) as n, 2 * count(*) filter (seq % 5 * seq = 0) as unnumbered from funding_ev group by all",
)


def rehydrate_merge(spark: SparkSession, d: str) -> DataFrame:
    """A log that lost its sells, repaired from a second source within the log's range; the source of each row is told."""
    full = m.trades(spark, d).select("exchange", "symbol", F.col("seq").cast("string").alias("id"), "ts_us", "side", "price", "amount")
    own = full.where("side = 'buy'").withColumn("origin", F.lit("ws"))
    merged = repair.rehydrate(own, full.withColumn("origin", F.lit("rest")))
    return merged.select("exchange", "symbol", "id", "ts_us", "side", F.col("price").cast("double").alias("price"), "origin")


REHYDRATE_SQL = o.sql(
    o.EVENTS, o.TRADES,
    "own as (select * from trades_ev where side = 'buy'), span as (select exchange, symbol, min(seq) as a, max(seq) as b from own group by all)",
    last="""
select t.exchange, t.symbol, cast(t.seq as varchar) as id, t.ts_us, t.side, cast(t.price as double) as price, case t.side when 'buy' then 'ws' else 'rest' end as origin
from trades_ev t join span s on t.exchange = s.exchange and t.symbol = s.symbol and t.seq between a and b""",
)


def rehydrate_report(spark: SparkSession, d: str) -> DataFrame:
    full = m.trades(spark, d).select("exchange", "symbol", F.col("seq").cast("string").alias("id"), "ts_us", "side", "price", "amount")
    own = full.where("side = 'buy'").withColumn("origin", F.lit("ws"))
    return repair.report(own, full.withColumn("origin", F.lit("rest")))


REPORT_SQL = o.sql(
    o.EVENTS, o.TRADES,
    "own as (select * from trades_ev where side = 'buy'), span as (select exchange, symbol, min(seq) as a, max(seq) as b, count(*) as n from own group by all)",
    last="""
select s.exchange, s.symbol, any_value(s.n) as present, count(*) filter (t.side = 'sell') as recovered, count(*) as merged
from trades_ev t join span s on t.exchange = s.exchange and t.symbol = s.symbol and t.seq between a and b group by all""",
)

QUERIES = {
    "trade_side_filter": trade_side_filter,
    "trade_drop_counts": trade_drop_counts,
    "trade_dedup": trade_dedup,
    "trade_dedup_report": trade_dedup_report,
    "trade_continuity": trade_continuity,
    "silence_gaps": silence_gaps,
    "silence_stats": silence_stats,
    "possible_dropped_estimate": possible_dropped_estimate,
    "taker_aggregate": taker_aggregate,
    "order_flow_imbalance": order_flow_imbalance,
    "vwap_by_symbol": vwap_by_symbol,
    "wire_regressions": wire_regressions,
    "ewma_latency": ewma_latency,
    "rtt_average": rtt_average,
    "fnv1a_fingerprint": fnv1a_fingerprint,
    "push_dedup": push_dedup,
    "rehydrate_merge": rehydrate_merge,
    "rehydrate_report": rehydrate_report,
}
ORACLE_SQL = {
    "trade_side_filter": o.sql(
        o.EVENTS, RAW, last="select exchange, symbol, seq, lower(side) as side, cast(price as double) as price, cast(amount as double) as amount from judged where reason is null"
    ),
    "trade_drop_counts": o.sql(
        o.EVENTS, RAW,
        last="""
select exchange, symbol, count(*) as n, count(*) filter (reason = 'side') as dropped_side, count(*) filter (reason = 'decimal') as dropped_decimal,
  count(*) filter (reason = 'not_positive') as dropped_not_positive, cast(0 as bigint) as dropped_time from judged group by all""",
    ),
    "trade_dedup": o.sql(o.FILLS, DEDUP, last="select id, ts_us, side, cast(amount as double) as amount, l_partkey, l_suppkey, l_extendedprice from ranked where nth = 1"),
    "trade_dedup_report": o.sql(
        o.FILLS, DEDUP,
        last="""
select side, count(*) as n, count(*) filter (nth > 1) as removed,
  count(*) filter (kept <> {'a': ts_us, 'b': side, 'c': amount, 'd': l_partkey, 'e': l_extendedprice}) as conflicts from ranked group by all""",
    ),
    "trade_continuity": CONTINUITY_SQL,
    "silence_gaps": o.sql(o.EVENTS, o.TRADES, SILENCE, last="select * from silent"),
    "silence_stats": o.sql(
        o.EVENTS, o.TRADES, SILENCE,
        last="select exchange, symbol, count(*) as n_gaps, cast(sum(window_us) // 1000 as bigint) as total_ms, max(window_us) as longest_us from silent group by all",
    ),
    "possible_dropped_estimate": DROPPED_SQL,
    "taker_aggregate": TAKER_SQL,
    "order_flow_imbalance": o.sql(
        o.EVENTS, o.TRADES,
        last=f"""
select exchange, symbol, hour_us, n_trades, buy_volume, sell_volume, round(coalesce((buy_volume - sell_volume) / nullif(buy_volume + sell_volume, 0), 0), 6) as imbalance
from ({FLOW.format(by=f"exchange, symbol, ts_us // {HOUR} * {HOUR} as hour_us")})""",
    ),
    "vwap_by_symbol": o.sql(
        o.EVENTS, o.TRADES,
        last=f"""
select exchange, symbol, n_trades, notional, round(coalesce(notional / nullif(buy_volume + sell_volume, 0), 0), 6) as vwap from ({FLOW.format(by="exchange, symbol")})""",
    ),
    "wire_regressions": REGRESSED_SQL,
    "ewma_latency": EWMA_SQL,
    "rtt_average": RTT_SQL,
    "fnv1a_fingerprint": FNV_SQL,
    "push_dedup": PUSH_SQL,
    "rehydrate_merge": REHYDRATE_SQL,
    "rehydrate_report": REPORT_SQL,
}
