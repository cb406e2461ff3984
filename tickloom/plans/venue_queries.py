"""One query for each venue: events written as its trade and book frames, and decoded back."""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.plans import oracle as o
from tickloom.sources import mapping as m
from tickloom.sources import venues

MS = "ts_us // 1000 * 1000"


@dataclass(frozen=True)
class Wire:
    """A venue's frames, with @names@ for an event's values, and what its oracle expects of them."""

    trade: str
    raw: tuple[str, str]
    book: str = ""
    #: How buys, sells and anything else are written.
    sides: tuple[str, str, str] = ("buy", "sell", "none")
    #: The words for a full book and for a change; none: ``full`` tells what every frame is.
    kinds: tuple[str, str] | None = None
    full: str = "false"
    ts: str = MS
    book_ts: str = MS
    counted: bool = True
    update_id: str = "seq"
    sequence: str = "seq - 3"
    pairs: tuple[str, str] = ("BTC/USDT", "ETH/USDT")


# The venues' frames.
WIRES = {
    "binance": Wire(
        '{"e":"trade","E":@ms@,"s":"@raw@","t":@seq@,"p":"@px@","q":"@qty@","T":@ms@,"m":@side@}',
        ("BTCUSDT", "ETHUSDT"),
        '{"e":"depthUpdate","E":@ms@,"s":"@raw@","U":@first@,"u":@seq@,"b":[["@px@","@qty@"]],"a":[["@ask@","@qty@"]]}',
        sides=("false", "true", "true"),
    ),
    "bitget": Wire(
        '{"action":"update","arg":{"instType":"SPOT","channel":"trade","instId":"@raw@"},"data":[{"ts":"@ms@","price":"@px@","size":"@qty@","side":"@side@","tradeId":"@seq@"}]}',
        ("BTCUSDT", "ETHUSDT"),
        '{"action":"@kind@","arg":{"channel":"books","instId":"@raw@"},"data":[{"asks":[["@ask@","@qty@"]],"bids":[["@px@","@qty@"]],"ts":"@ms@","seq":@seq@,"pseq":@first@}]}',
        kinds=("snapshot", "update"),
        counted=False,
    ),
    "bitso": Wire(
        '{"type":"trades","book":"@raw@","payload":[{"i":@seq@,"a":"@qty@","r":"@px@","t":@side@,"x":@ms@}]}',
        ("btc_usdt", "eth_usdt"),
        sides=("0", "1", "5"),
        counted=False,
    ),
    "bybit": Wire(
        '{"topic":"publicTrade.@raw@","type":"snapshot","ts":@ms@,"data":[{"T":@ms@,"s":"@raw@","S":"@side@","v":"@qty@","p":"@px@","i":"@seq@"}]}',
        ("BTCUSDT", "ETHUSDT"),
        '{"topic":"orderbook.50.@raw@","type":"@kind@","ts":@ms@,"data":{"s":"@raw@","b":[["@px@","@qty@"]],"a":[["@ask@","@qty@"]],"u":@seq@,"seq":1},"cts":@ms@}',
        sides=("Buy", "Sell", "none"),
        kinds=("snapshot", "delta"),
        sequence="seq",
    ),
    "coinbase": Wire(
        '{"channel":"market_trades","events":[{"type":"update","trades":[{"trade_id":"@seq@","product_id":"@raw@","price":"@px@","size":"@qty@","side":"@side@","time":"@iso@"}]}]}',
        ("BTC-USDT", "ETH-USDT"),
        '{"channel":"l2_data","timestamp":"@iso@","sequence_num":@seq@,"events":[{"type":"@kind@","product_id":"@raw@","updates":[{"side":"bid","event_time":"@iso@","price_level":"@px@","new_quantity":"@qty@"},{"side":"offer","event_time":"@iso@","price_level":"@ask@","new_quantity":"@qty@"}]}]}',
        sides=("BUY", "SELL", "none"),
        kinds=("snapshot", "update"),
        ts="ts_us",
        book_ts="ts_us",
        sequence="seq",
    ),
    "gateio": Wire(
        '{"channel":"spot.trades","event":"update","result":{"id":@seq@,"create_time":1,"create_time_ms":"@ms@.123","side":"@side@","currency_pair":"@raw@","amount":"@qty@","price":"@px@"}}',
        ("BTC_USDT", "ETH_USDT"),
        '{"channel":"spot.order_book","event":"update","result":{"t":@ms@,"lastUpdateId":@seq@,"s":"@raw@","bids":[["@px@","@qty@"]],"asks":[["@ask@","@qty@"]]}}',
        full="true",
        sequence="seq",
    ),
    "htx": Wire(
        '{"ch":"market.@raw@.trade.detail","tick":{"data":[{"ts":@ms@,"tradeId":@seq@,"amount":@qty@,"price":@px@,"direction":"@side@"}]}}',
        ("btcusdt", "ethusdt"),
        '{"ch":"market.@raw@.mbp.150","ts":@ms@,"tick":{"seqNum":@seq@,"prevSeqNum":@first@,"bids":[[@px@,@qty@]],"asks":[[@ask@,@qty@]]}}',
    ),
    "hyperliquid": Wire(
        '{"channel":"trades","data":[{"coin":"@raw@","side":"@side@","px":"@px@","sz":"@qty@","time":@ms@,"tid":@seq@}]}',
        ("BTC", "ETH"),
        '{"channel":"l2Book","data":{"coin":"@raw@","time":@ms@,"levels":[[{"px":"@px@","sz":"@qty@","n":1}],[{"px":"@ask@","sz":"@qty@","n":1}]]}}',
        sides=("B", "A", "none"),
        full="true",
        counted=False,
        update_id="ts_us // 1000",
        sequence="0",
        pairs=("BTC/USDC", "ETH/USDC"),
    ),
    "kraken": Wire(
        '{"channel":"trade","type":"update","data":[{"symbol":"@raw@","side":"@side@","price":@px@,"qty":@qty@,"trade_id":@seq@,"timestamp":"@iso@"}]}',
        ("BTC/USDT", "ETH/USDT"),
        '{"channel":"book","type":"@kind@","data":[{"symbol":"@raw@","bids":[{"price":@px@,"qty":@qty@}],"asks":[{"price":@ask@,"qty":@qty@}],"checksum":@seq@,"timestamp":"@iso@"}]}',
        kinds=("snapshot", "update"),
        ts="ts_us",
        book_ts="ts_us",
        sequence="seq",
    ),
    "kucoin": Wire(
        '{"topic":"/market/match:@raw@","data":{"symbol":"@raw@","side":"@side@","price":"@px@","size":"@qty@","time":"@ns@","tradeId":"@seq@"}}',
        ("BTC-USDT", "ETH-USDT"),
        '{"topic":"/market/level2:@raw@","data":{"sequenceStart":@first@,"sequenceEnd":@seq@,"symbol":"@raw@","changes":{"asks":[["@ask@","@qty@","1"]],"bids":[["@px@","@qty@","1"]]},"time":@ms@}}',
        ts="ts_us",
        counted=False,
    ),
    "okx": Wire(
        '{"arg":{"channel":"trades","instId":"@raw@"},"data":[{"instId":"@raw@","tradeId":"@seq@","px":"@px@","sz":"@qty@","side":"@side@","ts":"@ms@"}]}',
        ("BTC-USDT", "ETH-USDT"),
        '{"arg":{"channel":"books","instId":"@raw@"},"action":"@kind@","data":[{"asks":[["@ask@","@qty@","0","1"]],"bids":[["@px@","@qty@","0","1"]],"ts":"@ms@","seqId":@seq@,"prevSeqId":@first@,"checksum":7}]}',
        kinds=("snapshot", "update"),
        sequence="greatest(seq - 3, 0)",
    ),
    "poloniex": Wire(
        '{"channel":"trades","data":[{"symbol":"@raw@","quantity":"@qty@","takerSide":"@side@","createTime":@ms@,"price":"@px@","id":"@seq@","ts":1}]}',
        ("BTC_USDT", "ETH_USDT"),
        '{"channel":"book_lv2","action":"@kind@","data":[{"symbol":"@raw@","asks":[["@ask@","@qty@"]],"bids":[["@px@","@qty@"]],"id":@seq@,"lastId":@first@,"ts":@ms@,"createTime":1}]}',
        kinds=("snapshot", "update"),
    ),
    "upbit": Wire(
        '{"type":"trade","code":"@raw@","trade_price":@px@,"trade_volume":@qty@,"ask_bid":"@side@","trade_timestamp":@ms@,"sequential_id":@seq@}',
        ("USDT-BTC", "USDT-ETH"),
        '{"type":"orderbook","code":"@raw@","timestamp":@ms@,"orderbook_units":[{"ask_price":@ask@,"bid_price":@px@,"ask_size":@qty@,"bid_size":@qty@}]}',
        sides=("BID", "ASK", "none"),
        full="true",
        update_id="ts_us // 1000",
        sequence="0",
    ),
}


def _frame(template: str, values: dict[str, Column]) -> Column:
    parts = re.split("@([a-z]+)@", template)
    return F.concat(*(values[p].cast("string") if k % 2 else F.lit(p) for k, p in enumerate(parts)))


def _values(wire: Wire) -> dict[str, Column]:
    seq, ts = F.col("seq"), F.col("ts_us")
    price = F.col("value").cast("decimal(18,2)")
    buy, sell, other = (F.lit(s) for s in wire.sides)
    full, change = wire.kinds or ("", "")
    return {
        "seq": seq,
        "first": seq - 3,
        "ms": F.expr("ts_us div 1000"),
        "ns": ts * 1000,
        "iso": F.date_format(F.timestamp_micros(ts), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"),
        "raw": F.when(seq % 2 == 0, wire.raw[0]).otherwise(wire.raw[1]),
        "px": price,
        "ask": price + F.lit(1).cast("decimal(1,0)"),
        "qty": F.concat(F.col("k").cast("string"), F.lit(".500")),
        "side": F.when(seq % 10 == 0, other).when(F.col("event_type") == "click", buy).otherwise(sell),
        "kind": F.when(seq % 7 == 0, full).otherwise(change),
    }


def frames(spark: SparkSession, d: str, venue: str) -> DataFrame:
    """Prints and best levels of the books of all events, by way of the venue's frames."""
    wire, events = WIRES[venue], m.events(spark, d)
    values = _values(wire)
    none = F.lit(None)
    prints = venues.prints(events.select(_frame(wire.trade, values).alias("value")), venue).select(
        F.lit("trade").alias("kind"), "exchange", "symbol", "side", F.col("price").cast("double").alias("price"), F.col("amount").cast("double").alias("amount"), none.cast("double").alias("ask"),
        F.col("source_trade_ts_us").alias("ts_us"), "id", F.coalesce("sequence", F.lit(-1)).alias("sequence"), F.lit(-1).cast("long").alias("update_id"), none.cast("boolean").alias("is_snapshot"), "reason",
    )
    if not wire.book:
        return prints
    books = venues.updates(events.select(_frame(wire.book, values).alias("value")), venue).select(
        F.lit("book").alias("kind"), "exchange", "symbol", none.cast("string").alias("side"), F.expr("cast(bids[0].price as double)").alias("price"), F.expr("cast(bids[0].size as double)").alias("amount"),
        F.expr("cast(asks[0].price as double)").alias("ask"), F.col("source_orderbook_ts_us").alias("ts_us"), none.cast("string").alias("id"), "sequence", "update_id", "is_snapshot", none.cast("string").alias("reason"),
    )
    return prints.unionByName(books)


def _oracle(venue: str) -> str:
    w = WIRES[venue]
    # The one venue that tells sides by a flag knows no other side.
    side = "case when event_type = 'click' and seq % 10 <> 0 then 'buy' else 'sell' end" if w.sides[2] == w.sides[1] else "case when seq % 10 = 0 then null when event_type = 'click' then 'buy' else 'sell' end"
    symbol = f"case when seq % 2 = 0 then '{w.pairs[0]}' else '{w.pairs[1]}' end"
    price, amount = "cast(cast(value as decimal(18,2)) as double)", "k + 0.5::double"
    book = f"""
union all select 'book', '{venue}', {symbol}, null, {price}, {amount}, cast(cast(value as decimal(18,2)) + 1 as double), {w.book_ts}, null, cast({w.sequence} as bigint), cast({w.update_id} as bigint),
  {"seq % 7 = 0" if w.kinds else w.full}, null from ev"""
    return o.sql(
        o.EVENTS,
        last=f"""
select * from (select 'trade' as kind, '{venue}' as exchange, {symbol} as symbol, {side} as side, {price} as price, {amount} as amount, cast(null as double) as ask, {w.ts} as ts_us, cast(seq as varchar) as id,
  {"seq" if w.counted else "cast(-1 as bigint)"} as sequence, cast(-1 as bigint) as update_id, cast(null as boolean) as is_snapshot, case when {side} is null then 'side' end as reason from ev{book if w.book else ""})""",
    )


def bitso_orders(spark: SparkSession, d: str) -> DataFrame:
    """Events as changes of single orders, decoded back."""
    seq = F.col("seq")
    values = _values(WIRES["bitso"]) | {"state": F.when(seq % 5 == 0, "cancelled").when(seq % 7 == 0, "completed").otherwise("open"), "flag": (F.col("event_type") != "click").cast("int")}
    frame = _frame('{"type":"diff-orders","book":"@raw@","sequence":@seq@,"payload":[{"d":@seq@,"r":"@px@","a":"@qty@","t":@flag@,"o":"o@seq@","s":"@state@"}]}', values)
    rows = venues.l3_updates(m.events(spark, d).select(frame.alias("value")))
    return rows.select("symbol", "sequence", "update_id", "order_id", "is_ask", F.col("price").cast("double").alias("price"), F.col("size").cast("double").alias("size"), "removed")


ORDERS_SQL = o.sql(
    o.EVENTS,
    last="""
select case when seq % 2 = 0 then 'BTC/USDT' else 'ETH/USDT' end as symbol, seq as sequence, seq as update_id, 'o' || cast(seq as varchar) as order_id, event_type <> 'click' as is_ask,
  cast(cast(value as decimal(18,2)) as double) as price, k + 0.5::double as size, seq % 5 = 0 or seq % 7 = 0 as removed from ev""",
)


def _coin() -> Column:
    return F.when(F.col("seq") % 2 == 0, "BTC").otherwise("ETH")


def wire_contexts(spark: SparkSession, d: str) -> DataFrame:
    """Events as asset contexts, decoded back; every ninth has no readable premium."""
    values = _values(WIRES["hyperliquid"]) | {"bad": F.when(F.col("seq") % 9 == 0, "x").otherwise("0.25")}
    frame = _frame('{"channel":"activeAssetCtx","data":{"coin":"@raw@","ctx":{"funding":"@px@","openInterest":"@qty@","markPx":"@ask@","premium":"@bad@"}}}', values)
    rows = venues.contexts(m.events(spark, d).select(frame.alias("value")))
    return rows.select("symbol", *(F.col(c).cast("double").alias(c) for c in ("funding_rate", "premium", "open_interest", "mark_px")), "interval_hours")


CONTEXTS_SQL = o.sql(
    o.EVENTS,
    last="""
select case when seq % 2 = 0 then 'BTC/USDC' else 'ETH/USDC' end as symbol, cast(cast(value as decimal(18,2)) as double) as funding_rate, case when seq % 9 <> 0 then 0.25::double end as premium,
  k + 0.5::double as open_interest, cast(cast(value as decimal(18,2)) + 1 as double) as mark_px, 1 as interval_hours from ev""",
)


def wire_settlements(spark: SparkSession, d: str) -> DataFrame:
    """Events as answers of a funding history, decoded back."""
    frame = _frame('[{"coin":"@raw@","fundingRate":"@px@","premium":"0.5","time":@ms@}]', _values(WIRES["hyperliquid"]))
    rows = venues.settlements(m.events(spark, d).select(frame.alias("value")))
    return rows.select("symbol", F.col("funding_rate").cast("double").alias("funding_rate"), F.col("premium").cast("double").alias("premium"), "funding_time_us")


SETTLEMENTS_SQL = o.sql(
    o.EVENTS,
    last=f"select case when seq % 2 = 0 then 'BTC/USDC' else 'ETH/USDC' end as symbol, cast(cast(value as decimal(18,2)) as double) as funding_rate, 0.5::double as premium, {MS} as funding_time_us from ev",
)


def wire_liquidations(spark: SparkSession, d: str) -> DataFrame:
    """Events as liquidation frames, decoded back; unknown sides read sell."""
    frame = _frame('{"topic":"allLiquidation.@raw@","data":[{"T":@ms@,"s":"@raw@","S":"@side@","v":"@qty@","p":"@px@"}]}', _values(WIRES["bybit"]))
    rows = venues.liquidations(m.events(spark, d).select(frame.alias("value")))
    return rows.select("symbol", "side", F.col("price").cast("double").alias("price"), F.col("amount").cast("double").alias("amount"), "liquidation_ts_us")


LIQUIDATIONS_SQL = o.sql(
    o.EVENTS,
    last=f"""
select case when seq % 2 = 0 then 'BTC/USDT' else 'ETH/USDT' end as symbol, case when event_type = 'click' and seq % 10 <> 0 then 'buy' else 'sell' end as side,
  cast(cast(value as decimal(18,2)) as double) as price, k + 0.5::double as amount, {MS} as liquidation_ts_us from ev""",
)


def wire_tickers(spark: SparkSession, d: str) -> DataFrame:
    """Events as tickers, decoded back; every fourth has no funding interval."""
    values = _values(WIRES["bybit"]) | {"hours": F.when(F.col("seq") % 4 == 0, "").otherwise(',"fundingIntervalHour":"4"')}
    frame = _frame('{"topic":"tickers.@raw@","ts":@ms@,"data":{"symbol":"@raw@","fundingRate":"@px@","nextFundingTime":"@ms@"@hours@,"openInterest":"@qty@"}}', values)
    rows = venues.tickers(m.events(spark, d).select(frame.alias("value")))
    return rows.select("symbol", "ts_us", F.col("funding_rate").cast("double").alias("funding_rate"), "next_funding_ts_us", "interval_hours", F.col("open_interest").cast("double").alias("open_interest"), F.col("mark_px").cast("double").alias("mark_px"))


TICKERS_SQL = o.sql(
    o.EVENTS,
    last=f"""
select case when seq % 2 = 0 then 'BTC/USDT' else 'ETH/USDT' end as symbol, {MS} as ts_us, cast(cast(value as decimal(18,2)) as double) as funding_rate, {MS} as next_funding_ts_us,
  case when seq % 4 = 0 then 8 else 4 end as interval_hours, k + 0.5::double as open_interest, cast(null as double) as mark_px from ev""",
)

QUERIES = {f"frames_{v}": partial(frames, venue=v) for v in WIRES} | {f.__name__: f for f in (bitso_orders, wire_contexts, wire_settlements, wire_liquidations, wire_tickers)}
ORACLE_SQL = {f"frames_{v}": _oracle(v) for v in WIRES} | {
    "bitso_orders": ORDERS_SQL,
    "wire_contexts": CONTEXTS_SQL,
    "wire_settlements": SETTLEMENTS_SQL,
    "wire_liquidations": LIQUIDATIONS_SQL,
    "wire_tickers": TICKERS_SQL,
}
