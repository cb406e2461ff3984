"""Queries of the remaining operators: filters, status, layout, attribution, generators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom.functions import scalars
from tickloom.operators import books, chain, feeds, onchain, repair, trades, validation
from tickloom.plans import oracle as o
from tickloom.plans.book_queries import LINE_ORDER
from tickloom.plans.data_queries import expected_kinds
from tickloom.sources import files, generators
from tickloom.sources import mapping as m

HOUR = o.HOUR


def tracked_instruments(spark: SparkSession, d: str) -> DataFrame:
    """Prints of the instruments on a list."""
    wanted = spark.createDataFrame([("binance", "U0/USD"), ("kraken", "U3/USD"), ("bybit", "none")], "exchange string, symbol string")
    return trades.tracked(m.trades(spark, d), wanted).select("exchange", "symbol", "seq", "side")


def feed_staleness(spark: SparkSession, d: str) -> DataFrame:
    now = 1_706_572_800_000_000
    return validation.stale(m.trades(spark, d), "ts_us", ["exchange", "symbol"], now, 2 * HOUR)


STALE_SQL = o.sql(
    o.EVENTS, o.TRADES,
    last=f"select exchange, symbol, max(ts_us) as last_us, 1706572800000000 - max(ts_us) > {4 * HOUR} as stale from trades_ev group by all",
)


def expected_files(spark: SparkSession, d: str) -> DataFrame:
    """Venues and kinds without any file."""
    return expected_kinds(spark, d)


EXPECTED_SQL = """
select e.exchange, k.kind from (select unnest(['binance', 'bybit', 'coinbase', 'kraken', 'okx']) as exchange) e, (select unnest(['orderbooks', 'trades']) as kind) k
where not (kind = 'trades' and exchange <> 'okx')"""


def leaf_paths(spark: SparkSession, d: str) -> DataFrame:
    """Paths in both layouts, read back."""
    p = F.col("p_partkey")
    kind = F.element_at(F.array(F.lit("trades"), F.lit("orderbooks"), F.lit("transactions")), (p % 3 + 1).cast("int"))
    flat = F.concat_ws("/", F.lit("data"), F.concat(F.lit("x"), p % 4), kind, F.concat(p, F.lit(".parquet")))
    deep = F.concat_ws("/", F.lit("data"), F.concat(F.lit("x"), p % 4), F.lit("spot"), kind, F.concat(F.lit("b"), p % 5), F.lit("2026-01-02"), F.concat(p, F.lit(".parquet")))
    rows = m.read(spark, d, "part").select("p_partkey", F.when(p % 2 == 0, flat).otherwise(deep).alias("path"))
    parsed = rows.withColumn("l", files.leaf(F.col("path")))
    return parsed.select("p_partkey", "l.datatype", "l.binding", "l.day")


LEAF_SQL = """
select p_partkey, ['trades', 'orderbooks', 'transactions'][p_partkey % 3 + 1] as datatype, case when p_partkey % 2 = 1 then 'b' || cast(p_partkey % 5 as varchar) end as binding,
  case when p_partkey % 2 = 1 then '2026-01-02' end as day from part"""


def pending_files(spark: SparkSession, d: str) -> DataFrame:
    """Listed files that the index lacks."""
    listing = m.read(spark, d, "orders").select(F.concat(F.lit("f"), "o_orderkey", F.lit(".parquet")).alias("filename"))
    index = m.read(spark, d, "orders").where("o_orderstatus <> 'P'").select(F.concat(F.lit("f"), "o_orderkey", F.lit(".parquet")).alias("filename"))
    return files.pending(listing, index)


def connection_gaps(spark: SparkSession, d: str) -> DataFrame:
    """Gaps of a connection's sequence that lost heartbeats don't explain."""
    k = F.col("o_orderkey")
    rows = m.read(spark, d, "orders").select((F.col("o_custkey") % 50).alias("conn"), k.alias("sequence"), (k / 3).cast("long").alias("heartbeat"))
    return books.attributed_gaps(rows, ["sequence"], ["conn"], "sequence", "heartbeat").groupBy("conn").agg(F.sum("unexplained").alias("unexplained"))


CONNECTION_SQL = """
select conn, cast(sum(greatest(coalesce(s - ls - 1, 0) - greatest(coalesce(h - lh - 1, 0), 0), 0)) as bigint) as unexplained from (
  select o_custkey % 50 as conn, o_orderkey as s, o_orderkey // 3 as h, lag(o_orderkey) over w as ls, lag(o_orderkey // 3) over w as lh from orders window w as (partition by o_custkey % 50 order by o_orderkey))
group by conn"""


def book_snapshot(spark: SparkSession, d: str) -> DataFrame:
    return books.snapshot(m.levels(spark, d)).select("book", "bid", "ask", "bid_volume", "ask_volume", "n_bids", "n_asks")


SNAPSHOT_SQL = o.sql(
    o.LEVELS,
    last="""
select book, cast(max(price) filter (side = 'bid') as double) as bid, cast(min(price) filter (side = 'ask') as double) as ask, coalesce(sum(size) filter (side = 'bid'), 0) as bid_volume,
  coalesce(sum(size) filter (side = 'ask'), 0) as ask_volume, count(*) filter (side = 'bid') as n_bids, count(*) filter (side = 'ask') as n_asks from levels group by book""",
)


def book_since_snapshot(spark: SparkSession, d: str) -> DataFrame:
    """Levels after each book's last reset."""
    rows = m.deltas(spark, d).withColumn("is_snapshot", F.col("update_id") % 997 == 0)
    return books.state_after_snapshots(rows, m.DELTA_ORDER).select("book", "side", F.col("price").cast("double").alias("price"), "size")


AT = "(update_id, l_linenumber, ts_us, l_extendedprice, l_discount, l_tax, price, size)"
SINCE_SQL = o.sql(
    o.DELTAS,
    f"resets as (select book, max({AT}) as reset from deltas where update_id % 997 = 0 group by book)",
    f"last as (select book, side, price, arg_max(size, {AT}) as size from deltas left join resets using (book) where reset is null or {AT} >= reset group by all)",
    last="select book, side, cast(price as double) as price, size from last where size > 0",
)


def recovered_prints(spark: SparkSession, d: str) -> DataFrame:
    """Recovered prints that the live feed didn't bring."""
    t = m.trades(spark, d).select("exchange", "symbol", F.col("seq").alias("id"), "side")
    return repair.without_recent(t.where("side = 'buy'"), t)


def slot_verdicts(spark: SparkSession, d: str) -> DataFrame:
    """Orders as block metas in arrival order: some seen twice or by a second bank, some far behind, some incomplete or with an undecodable update."""
    k = F.col("o_orderkey")
    slot = k - F.when(k % 19 == 0, 50).when(k % 17 == 0, 10).otherwise(0)
    rows = m.read(spark, d, "orders").select(k.alias("k"), slot.alias("slot"), (k % 2).alias("bank_id"), F.explode(F.expr("filter(array(0, 1, 2, 3), x -> x = 1 or (x = 0 and o_orderkey % 37 = 0) or (x = 2 and o_orderkey % 11 = 0) or (x = 3 and o_orderkey % 13 = 0))")).alias("x"))
    rows = rows.withColumn("arrival", F.col("k") * 40 + F.col("x")).withColumn("bank_id", F.col("bank_id") + F.when(F.col("x") == 3, 2).otherwise(0))
    k = F.col("k")
    metas = rows.where("x > 0").select("slot", "bank_id", F.when(k % 31 != 0, k).alias("block_height"), F.when(k % 23 == 0, 0).otherwise(k).alias("block_time_secs"), F.when(k % 29 == 0, "").otherwise("h").alias("blockhash"), "arrival")
    updates = rows.where("x = 0").select("slot", "bank_id", "arrival", F.lit(True).alias("undecodable"))
    return onchain.verdicts(metas, updates=updates, covered_from=100).groupBy("slot", "verdict").agg(F.count("*").alias("n"))


VERDICTS_SQL = """
with xs as (
  select o_orderkey as k, o_orderkey - case when o_orderkey % 19 = 0 then 50 when o_orderkey % 17 = 0 then 10 else 0 end as slot, unnest([0, 1, 2, 3]) as x from orders),
ev as (
  select k, slot, k % 2 + case when x = 3 then 2 else 0 end as bank, x, k * 40 + x as arrival, k % 31 <> 0 and k % 23 <> 0 and k % 29 <> 0 as whole from xs
  where x = 1 or (x = 0 and k % 37 = 0) or (x = 2 and k % 11 = 0) or (x = 3 and k % 13 = 0)),
tops as (select *, coalesce(max(slot) over (order by arrival rows between unbounded preceding and 1 preceding) - slot, 0) as behind from ev),
banks as (
  select *, min(arrival) filter (x > 0 and slot >= 100 and behind <= 32) over w as taken, coalesce(min(arrival) filter (x = 0) over w < arrival, false) as bad from tops window w as (partition by slot, bank)),
told as (
  select *, case when slot < 100 then 'uncovered' when taken < arrival and behind <= 64 then 'duplicate' when behind > 32 then 'abandoned' when not whole then 'partial' when behind > 4 then 'late' end as early
  from banks where x > 0),
heights as (select *, min(arrival) filter (early is null and not bad) over (partition by k) as first from told)
select slot, coalesce(early, case when first < arrival then 'duplicate' when bad then 'partial' else 'sealed' end) as verdict, count(*) as n from heights group by all"""


def chain_blocks(spark: SparkSession, d: str) -> DataFrame:
    """Orders as blocks of three chains and their lines as transactions: metas out of order, rivals, repeats, undecodable updates, a coverage that closes and opens."""
    order = F.col("o_orderkey")
    line = m.read(spark, d, "lineitem").withColumn("n", F.row_number().over(Window.partitionBy("l_orderkey").orderBy(*LINE_ORDER)))
    k = F.col("l_orderkey")
    # A row's place in time: its block's, a few blocks later for some.
    txs = line.select(
        F.concat(F.lit("c"), k % 3).alias("chain"),
        (k * 100 + F.col("n") + F.when((k + F.col("n")) % 31 == 0, 900).otherwise(0)).alias("seq"),
        F.when((k % 47 == 0) & (F.col("n") == 1), "undecodable").otherwise("tx").alias("kind"),
        k.alias("slot"),
        F.when((k % 19 == 0) & (F.col("n") > 2), 1).otherwise(0).alias("bank_id"),
        F.col("l_linenumber").cast("long").alias("tx_index"),
    )
    blocks = m.read(spark, d, "orders").withColumn("x", F.explode(F.expr("filter(array(0, 1, 2), x -> x = 0 or (x = 1 and o_orderkey % 19 = 0) or (x = 2 and o_orderkey % 13 = 0))")))
    x = F.col("x")
    metas = blocks.select(
        F.concat(F.lit("c"), order % 3).alias("chain"),
        (order * 100 + 80 + x + F.when(order % 11 == 0, 700).when(order % 101 == 0, 15_000).otherwise(0)).alias("seq"),
        F.lit("meta").alias("kind"),
        order.alias("slot"),
        (x == 1).cast("long").alias("bank_id"),
        (order - 3).alias("parent_slot"),
        F.when(order % 43 != 0, F.expr("o_orderkey div 3 + 1")).alias("block_height"),
        F.lit(1).alias("block_time_secs"),
        F.lit("h").alias("blockhash"),
    )
    bounds = blocks.where("x = 0 and o_orderkey % 3000 < 3").select(
        F.concat(F.lit("c"), order % 3).alias("chain"), (order * 100 + 99).alias("seq"), F.when(F.expr("o_orderkey div 3000") % 3 == 2, "close").otherwise("open").alias("kind"), F.lit(None).cast("long").alias("slot")
    )
    events = txs.unionByName(metas, allowMissingColumns=True).unionByName(bounds, allowMissingColumns=True)
    return chain.assembled(events, coverage=True).drop("place")


def chain_updates(spark: SparkSession, d: str) -> DataFrame:
    """Orders as stream updates of all kinds, some transactions lacking a part: what each is and what it lacks, and how many kept no logs."""
    k = F.col("o_orderkey")
    byte = lambda n: F.unhex(F.repeat(F.lit("ab"), n))
    keys = F.array(byte(F.lit(32)), byte(F.when(k % 31 == 0, 31).otherwise(32)))
    message = F.when(k % 13 != 0, F.struct(F.when(k % 17 != 0, F.struct(F.lit(1).alias("num_required_signatures"))).alias("header"), keys.alias("account_keys")))
    body = F.when(k % 11 != 0, F.struct(message.alias("message")))
    meta = F.when(k % 19 != 0, F.struct(F.array(byte(F.lit(32))).alias("loaded_writable_addresses"), F.array(byte(F.when(k % 37 == 0, 1).otherwise(32))).alias("loaded_readonly_addresses"), F.array(F.lit("log")).alias("log_messages"), (k % 5 == 0).alias("log_messages_none")))
    info = F.when(k % 7 != 0, F.struct(byte(F.when(k % 23 == 0, 63).otherwise(64)).alias("signature"), body.alias("transaction"), meta.alias("meta")))
    kind = k % 10
    rows = m.read(spark, d, "orders").select(
        F.when(kind < 6, F.struct(k.alias("slot"), F.lit(0).alias("bank_id"), info.alias("transaction"))).alias("transaction"),
        F.when(kind == 6, F.struct(k.alias("slot"))).alias("block_meta"),
        F.when(kind == 7, True).alias("ping"),
        F.when(kind == 8, F.struct(k.alias("id"))).alias("pong"),
        F.when((kind == 9) & (k % 3 == 0), k).alias("account"),
        F.when((kind == 9) & (k % 3 == 1), k).alias("entry"),
    )
    told = onchain.told_updates(rows).withColumn("silent", (F.col("kind") == "transaction") & F.col("fault").isNull() & onchain.logs(F.col("transaction.transaction.meta")).isNull())
    return told.groupBy("kind", "what", "fault").agg(F.count("*").alias("n"), F.count(F.when(F.col("silent"), 1)).alias("silent"))


UPDATES_SQL = """
with told as (
  select o_orderkey as k, case when k % 10 < 6 then 'transaction' when k % 10 = 6 then 'block_meta' when k % 10 = 7 then 'ping' when k % 10 = 8 then 'pong' else 'unrequested' end as kind,
    case when k % 10 = 9 then ['account', 'entry', 'empty'][k % 3 + 1] end as what,
    case when k % 10 >= 6 then null when k % 7 = 0 then 'missing transaction' when k % 23 = 0 then 'signature of 63 bytes' when k % 11 = 0 then 'missing transaction.transaction'
      when k % 13 = 0 then 'missing transaction.transaction.message' when k % 17 = 0 then 'missing transaction.transaction.message.header' when k % 19 = 0 then 'missing transaction.meta'
      when k % 31 = 0 then 'account_keys[1]' when k % 37 = 0 then 'loaded_readonly_addresses[0]' end as fault
  from orders)
select kind, what, fault, count(*) as n, count(*) filter (kind = 'transaction' and fault is null and k % 5 = 0) as silent from told group by kind, what, fault"""


def random_books(spark: SparkSession, d: str) -> DataFrame:
    """A random book for each order, conforming."""
    made = generators.books(spark, m.read(spark, d, "orders").select(F.col("o_orderkey").alias("id")), seed=7)
    return books.conformance(made)


def random_trades(spark: SparkSession, d: str) -> DataFrame:
    """A random print for each event: all are accepted."""
    t = generators.trades(spark, m.read(spark, d, "events").select(F.col("event_id").alias("id")), seed=7)
    return trades.accepted(t, ts="source_trade_ts_us").agg(F.count("*").alias("n"), F.count_distinct("id").alias("ids"), F.count_distinct("side").alias("sides"))


RANDOM_BOOKS_SQL = "select distinct o_orderkey as book, false as crossed, false as one_sided, 0::bigint as not_positive from orders"
RANDOM_TRADES_SQL = "select count(*) as n, count(distinct event_id) as ids, 2::bigint as sides from events"


def chain_ticks(spark: SparkSession, d: str) -> DataFrame:
    """Orders as block metas, four to a slot, some without a time: the chain's own clock."""
    k = F.col("o_orderkey")
    metas = m.read(spark, d, "orders").select(F.expr("o_orderkey div 4").alias("slot"), F.when(k % 7 != 0, k).alias("block_time_secs"))
    return onchain.slot_ticks(metas)


def snapshot_presence(spark: SparkSession, d: str) -> DataFrame:
    """Orders as snapshots; those that hold nothing at all are left out."""
    k = F.col("o_orderkey")
    lists = ("trades", "liquidations", "funding", "open_interest", "settlements", "transactions")
    rows = m.read(spark, d, "orders").select(
        "o_orderkey", F.when(k % 5 == 0, "book").alias("book"), *(F.when(k % (n + 2) == 0, F.array(F.lit(1))).when(k % 3 == 1, F.array().cast("array<int>")).alias(c) for n, c in enumerate(lists))
    )
    return repair.has_data(rows).select("o_orderkey")


def _feed_changes(spark: SparkSession, d: str) -> DataFrame:
    """Orders as state changes of their customer's feed; most of them run through the states in turn."""
    k = F.col("o_orderkey")
    return m.read(spark, d, "orders").select((F.col("o_custkey") % 500).alias("feed"), k.alias("step"), F.element_at(F.array(*(F.lit(s) for s in feeds.EDGES)), (k % 41 % 10 + 1).cast("int")).alias("state"))


def feed_changes(spark: SparkSession, d: str) -> DataFrame:
    """State changes of feeds with their verdicts."""
    return feeds.judged(_feed_changes(spark, d), ["feed"], ["step"])


def feed_status(spark: SparkSession, d: str) -> DataFrame:
    """Where each feed stands."""
    return feeds.status(_feed_changes(spark, d), ["feed"], ["step"])


CHANGES = [
    f"edges as (select unnest({sorted(f'{a}>{b}' for a, following in feeds.EDGES.items() for b in following)}) as edge)",
    f"changes as (select o_custkey % 500 as feed, o_orderkey as step, {list(feeds.EDGES)}[o_orderkey % 41 % 10 + 1] as state from orders)",
    """told as (
  select *, coalesce(lag(state) over w, 'requested') as before, coalesce(max(case when state in ('closed', 'rejected', 'failed') then 1 else 0 end) over (w rows between unbounded preceding and 1 preceding), 0) as ended
  from changes window w as (partition by feed order by step))""",
    """judged as (
  select feed, step, state, before, case when ended = 1 then 'absorbed' when before = state then 'repeat' when before || '>' || state in (select edge from edges) then 'legal' else 'illegal' end as verdict from told)""",
]


def ledger_paths(spark: SparkSession, d: str) -> DataFrame:
    """Places of gap ledgers in both layouts."""
    p = F.col("p_partkey")
    folder = F.when(p % 2 == 0, F.concat(F.lit("/data/recorded/x/spot/{data_type}/b"), p)).otherwise(F.concat(F.lit("/out/"), p))
    return m.read(spark, d, "part").select("p_partkey", files.ledger_path(folder, F.lit("bitso"), F.concat(F.lit("x:T"), p, F.lit("/USD"))).alias("path"))


def wire_symbols(spark: SparkSession, d: str) -> DataFrame:
    """Pairs as live feeds spell them, read back; every third coin is one of a named dex."""
    rows = m.read(spark, d, "part").select("p_partkey", F.concat(F.when(F.col("p_partkey") % 3 == 0, "xyz:").otherwise(""), F.lit("T"), "p_partkey", F.lit("/USDC")).alias("pair"))
    each = rows.select("*", F.explode(F.array(*(F.lit(v) for v in ("binance", "htx", "gateio", "hyperliquid")))).alias("exchange"))
    each = each.withColumn("raw", scalars.wire_symbol(F.col("pair"), F.col("exchange")))
    return each.withColumn("decoded", scalars.wire_pair(F.col("raw"), F.col("exchange"))).where("exchange = 'hyperliquid' or p_partkey % 3 <> 0")


WIRE_SQL = """
select p_partkey, pair, exchange, decoded, case exchange when 'binance' then replace(pair, '/', '') when 'htx' then lower(replace(pair, '/', '')) when 'gateio' then replace(pair, '/', '_') else split_part(pair, '/', 1) end as raw
from (select p_partkey, case when p_partkey % 3 = 0 then 'xyz:' else '' end || 'T' || cast(p_partkey as varchar) || '/USDC' as pair, unnest(['binance', 'htx', 'gateio', 'hyperliquid']) as exchange, pair as decoded from part)
where exchange = 'hyperliquid' or p_partkey % 3 <> 0"""


SNAPSHOT_LISTS = {
    "trades": "transform(sequence(0, k % 3), i -> named_struct('id', k * 10 + i))",
    "liquidations": "if(k % 5 = 0, array(named_struct('id', k)), cast(array() as array<struct<id:long>>))",
    "funding": "array(named_struct('exchange', 'x', 'symbol', 'A/B', 'conn_epoch_us', k % 11, 'recv_seq', k % 13))",
    "open_interest": "array(named_struct('exchange', 'x', 'symbol', 'A/B', 'conn_epoch_us', k % 7, 'recv_seq', k % 5))",
    "settlements": "array(named_struct('exchange', 'x', 'symbol', 'A/B', 'funding_time_us', k % 97))",
    "transactions": "array(named_struct('address', k % 10, 'signature', k % 1000))",
}


def decompose_tables(spark: SparkSession, d: str) -> DataFrame:
    """Orders as grid snapshots, taken apart into the seven tables: rows of each and the sum of a number that tells them apart."""
    book = F.expr("if(k % 3 = 0, named_struct('exchange', 'x', 'symbol', 'A/B', 'orderbook_ts_us', k + k % 7 - 3, 'source_orderbook_ts_us', if(k % 2 = 1, 0L, k), 'local_orderbook_ts_us', 0L), null)")
    snapshots = m.read(spark, d, "orders").select(F.col("o_orderkey").cast("long").alias("k")).select(F.col("k").alias("ts_us"), book.alias("book"), *(F.expr(e).alias(c) for c, e in SNAPSHOT_LISTS.items()))
    told = {"orderbooks": "orderbook_ts_us + 2 * source_orderbook_ts_us", "trades": "id", "liquidations": "id", "funding_rates": "conn_epoch_us * 100 + recv_seq", "open_interests": "conn_epoch_us * 100 + recv_seq", "funding_settlements": "funding_time_us", "transactions": "address * 10000 + signature"}
    parts = [rows.agg(F.lit(name).alias("name"), F.count("*").alias("n"), F.sum(F.expr(told[name]).cast("long")).alias("total")) for name, rows in repair.decompose(snapshots).items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _pushes_sql(connections: int, sequences: int) -> str:
    pushes = f"select o_orderkey % {connections} as c, o_orderkey % {sequences} as s from orders"
    return f"(select distinct c, s from ({pushes}) where s > 0) union all (select c, s from ({pushes}) where s = 0)"


DECOMPOSE_SQL = f"""
select 'orderbooks' as name, count(*) as n, cast(sum(greatest(k, b) + 2 * case when k % 2 = 1 or k = 0 then b else k end) as bigint) as total from (select o_orderkey as k, o_orderkey + o_orderkey % 7 - 3 as b from orders where o_orderkey % 3 = 0)
union all select 'trades', count(*), cast(sum(k * 10 + i) as bigint) from (select o_orderkey as k, unnest(range(0, o_orderkey % 3 + 1)) as i from orders)
union all select 'liquidations', count(*), cast(sum(o_orderkey) as bigint) from orders where o_orderkey % 5 = 0
union all select 'funding_rates', count(*), cast(sum(c * 100 + s) as bigint) from ({_pushes_sql(11, 13)})
union all select 'open_interests', count(*), cast(sum(c * 100 + s) as bigint) from ({_pushes_sql(7, 5)})
union all select 'funding_settlements', count(*), cast(sum(t) as bigint) from (select distinct o_orderkey % 97 as t from orders)
union all select 'transactions', count(*), cast(sum(a * 10000 + s) as bigint) from (select distinct o_orderkey % 10 as a, o_orderkey % 1000 as s from orders)"""


def instrument_tags(spark: SparkSession, d: str) -> DataFrame:
    name = F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit("C"), "c_custkey", F.lit("/USD"))).otherwise(F.concat(F.lit("Addr"), "c_custkey"))
    days = F.col("c_custkey").cast("long") * 1000
    return m.read(spark, d, "customer").select("c_custkey", scalars.instrument_kind(name).alias("kind"), scalars.day_named(days).alias("day"), scalars.blocks_lost(F.lit(100), F.col("c_custkey").cast("long")).alias("lost"))


TAGS_SQL = """
select c_custkey, case when c_custkey % 3 = 0 then 'pair' else 'address' end as kind, strftime(make_timestamp(c_custkey * 1000 * 86400000000), '%Y-%m-%d') as day, greatest(c_custkey - 101, 0) as lost from customer"""

QUERIES = {
    f.__name__: f
    for f in (
        tracked_instruments, feed_staleness, expected_files, leaf_paths, pending_files, connection_gaps, book_snapshot, book_since_snapshot, recovered_prints, slot_verdicts, chain_blocks, chain_updates, random_books,
        random_trades, instrument_tags, chain_ticks, snapshot_presence, feed_changes, feed_status, ledger_paths, wire_symbols, decompose_tables,
    )
}
ORACLE_SQL = {
    "chain_updates": UPDATES_SQL,
    "random_books": RANDOM_BOOKS_SQL,
    "random_trades": RANDOM_TRADES_SQL,
    "tracked_instruments": o.sql(
        o.EVENTS, o.TRADES, last="select exchange, symbol, seq, side from trades_ev where (exchange, symbol) in (('binance', 'U0/USD'), ('kraken', 'U3/USD'))"
    ),
    "feed_staleness": STALE_SQL,
    "expected_files": EXPECTED_SQL,
    "leaf_paths": LEAF_SQL,
    "pending_files": "select 'f' || cast(o_orderkey as varchar) || '.parquet' as filename from orders where o_orderstatus = 'P'",
    "connection_gaps": CONNECTION_SQL,
    "book_snapshot": SNAPSHOT_SQL,
    "book_since_snapshot": SINCE_SQL,
    "recovered_prints": o.sql(o.EVENTS, o.TRADES, last="select exchange, symbol, seq as id, side from trades_ev where side = 'sell'"),
    "slot_verdicts": VERDICTS_SQL,
    "instrument_tags": TAGS_SQL,
    "feed_changes": o.sql(*CHANGES, last="select * from judged"),
    "feed_status": o.sql(
        *CHANGES,
        last="""select feed, arg_max(state, step) as state, arg_max(state, step) in ('closed', 'rejected', 'failed') as terminal, count(*) filter (verdict <> 'repeat') as changes, count(*) filter (verdict = 'illegal') as illegal
from judged where verdict <> 'absorbed' group by feed""",
    ),
    "ledger_paths": "select p_partkey, case when p_partkey % 2 = 0 then '/data/gaps/b' || p_partkey || '_gap_ledger.jsonl' else '/out/' || p_partkey || '/gaps/bitso_x-T' || p_partkey || '-USD_gap_ledger.jsonl' end as path from part",
    "wire_symbols": WIRE_SQL,
    "decompose_tables": DECOMPOSE_SQL,
    "chain_ticks": "select o_orderkey // 4 as slot, min(o_orderkey) * 1000000 as ts_us from orders where o_orderkey % 7 <> 0 group by 1",
    "snapshot_presence": "select o_orderkey from orders where o_orderkey % 2 = 0 or o_orderkey % 3 = 0 or o_orderkey % 5 = 0 or o_orderkey % 7 = 0",
}
