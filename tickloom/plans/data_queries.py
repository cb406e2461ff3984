"""Queries of the on-chain, validation, naming, symbol, time and archive operators, with their oracles."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions import codecs, scalars
from tickloom.operators import onchain, trades, validation
from tickloom.plans import oracle as o
from tickloom.plans.grid_queries import rounded
from tickloom.sources import files, venues
from tickloom.sources import mapping as m

HOUR = o.HOUR

# ---- on-chain: line items of an order as a transaction's keys


def _transactions(spark: SparkSession, d: str) -> DataFrame:
    items = m.read(spark, d, "lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_set(F.concat(F.lit("A"), F.col("l_suppkey")))).alias("keys"), F.max("l_quantity").alias("q"))
    n = F.size("keys")
    return items.select(
        F.concat(F.lit("sig"), F.col("l_orderkey")).alias("signature"),
        F.slice("keys", 1, F.greatest(n - 1, F.lit(1))).alias("static_keys"),
        F.when(n > 1, F.slice("keys", n, 1)).otherwise(F.array().cast("array<string>")).alias("loaded_writable"),
        F.array().cast("array<string>").alias("loaded_readonly"),
        (F.col("l_orderkey") % 3).cast("int").alias("num_required_signatures"),
        (F.col("l_orderkey") % 10 == 0).alias("is_vote"),
        (F.col("q") < 45).alias("success"),
    )


def _watch(spark: SparkSession) -> DataFrame:
    rows = spark.range(1, 31).select(
        F.concat(F.lit("A"), F.col("id")).alias("address"),
        F.when(F.col("id") % 3 == 0, "signer").when(F.col("id") % 3 == 1, "fee_payer").otherwise("account_key").alias("required_role"),
        (F.col("id") % 2 == 0).alias("include_failed"),
        F.lit(True).alias("keep_logs"),
    )
    return rows


def tx_match_roles(spark: SparkSession, d: str) -> DataFrame:
    return onchain.matched(_transactions(spark, d), _watch(spark)).select("signature", "address", "match_role", "success")


TX = """
items as (select l_orderkey, list_sort(list(distinct 'A' || cast(l_suppkey as varchar))) as keys, max(l_quantity) as q from lineitem group by all),
tx as (select 'sig' || cast(l_orderkey as varchar) as signature, keys, len(keys) as n, l_orderkey % 3 as signers, l_orderkey % 10 = 0 as is_vote, q < 45 as success from items),
slots as (
  select signature, success, is_vote, unnest(keys) as address, unnest(range(0, n)) as pos, n, least(signers, greatest(n - 1, 1)) as signers from tx),
ranked as (
  select signature, success, is_vote, address, max(case when n > 1 and pos = n - 1 then 0 when pos = 0 and signers > 0 then 2 when pos < signers then 1 else 0 end) as rank from slots group by all),
watch as (
  select 'A' || cast(i as varchar) as address, case i % 3 when 0 then 1 when 1 then 2 else 0 end as required, i % 2 = 0 as include_failed from range(1, 31) t(i))"""
TX_SQL = o.sql(
    TX,
    last="""
select signature, address, case rank when 2 then 'fee_payer' when 1 then 'signer' else 'account_key' end as match_role, success
from ranked join watch using (address) where not is_vote and (success or include_failed) and rank >= required""",
)


def _tx_rows(spark: SparkSession, d: str) -> DataFrame:
    """Orders as transaction rows with a few faults."""
    k = F.col("o_orderkey")
    return m.read(spark, d, "orders").select(
        F.concat(F.lit("A"), F.col("o_custkey") % 50).alias("address"),
        F.when(k % 101 == 0, "").otherwise(F.concat(F.lit("s"), (k / 2).cast("long"))).alias("signature"),
        (k * 10).alias("source_tx_ts_us"),
        F.when(k % 103 == 0, "").otherwise("hash").alias("blockhash"),
        F.when(k % 107 == 0, 0).otherwise(k).alias("block_height"),
        (F.col("o_orderstatus") != "F").alias("success"),
        F.when((F.col("o_orderstatus") == "F") & (k % 109 != 0), "custom").alias("failure_error"),
        F.when(k % 5 == 0, "v1").otherwise("v0").alias("version"),
        F.when(k % 35 == 0, k).alias("compute_unit_price_micro_lamports"),
        F.when(k % 45 == 0, k).alias("priority_fee_lamports"),
        (F.col("o_custkey") % 17).alias("slot"),
        k.alias("tx_index"),
        F.date_format("o_orderdate", "yyyy-MM").alias("day"),
        F.concat(F.lit("f"), k % 4).alias("file"),
        k.alias("arrival"),
    )


TX_ROWS = """
rows as (
  select 'A' || cast(o_custkey % 50 as varchar) as address, case when o_orderkey % 101 = 0 then '' else 's' || cast(o_orderkey // 2 as varchar) end as signature, o_orderkey * 10 as source_tx_ts_us,
    case when o_orderkey % 103 = 0 then '' else 'hash' end as blockhash, case when o_orderkey % 107 = 0 then 0 else o_orderkey end as block_height, o_orderstatus <> 'F' as success,
    case when o_orderstatus = 'F' and o_orderkey % 109 <> 0 then 'custom' end as failure_error, case when o_orderkey % 5 = 0 then 'v1' else 'v0' end as version,
    case when o_orderkey % 35 = 0 then o_orderkey end as cu_price, case when o_orderkey % 45 = 0 then o_orderkey end as priority_fee, o_custkey % 17 as slot, o_orderkey as tx_index,
    strftime(o_orderdate, '%Y-%m') as day, 'f' || cast(o_orderkey % 4 as varchar) as file
  from orders)"""


def tx_invariants(spark: SparkSession, d: str) -> DataFrame:
    return onchain.invariants(_tx_rows(spark, d))


INVARIANTS_SQL = o.sql(
    TX_ROWS,
    last="""
select * from (select case when signature = '' then 'signature' when source_tx_ts_us = 0 then 'source_tx_ts_us' when blockhash = '' then 'blockhash' when block_height = 0 then 'block_height'
  when success = (failure_error is not null) then 'failure' when failure_error = '' then 'failure.error' when version = 'v1' and cu_price is not null then 'compute_unit_price_micro_lamports'
  when version <> 'v1' and priority_fee is not null then 'priority_fee_lamports' end as rule, count(*) as n from rows group by all) where rule is not null""",
)


def tx_order_check(spark: SparkSession, d: str) -> DataFrame:
    return onchain.out_of_order(_tx_rows(spark, d), ["arrival"])


ORDER_SQL = o.sql(
    TX_ROWS,
    last="""
select address, count(*) filter (bad) as out_of_order from (
  select address, coalesce((slot, tx_index) <= lag((slot, tx_index)) over (partition by address order by tx_index), false) as bad from rows) group by all""",
)


def tx_cross_file_dups(spark: SparkSession, d: str) -> DataFrame:
    return onchain.repeated_across(_tx_rows(spark, d).withColumn("address", F.lit("A")).withColumn("day", F.lit("d")))


DUPS_SQL = o.sql(TX_ROWS, last="select 'd' as day, 'A' as address, signature, count(distinct file) as files from rows group by signature having count(distinct file) > 1")


def slot_gaps(spark: SparkSession, d: str) -> DataFrame:
    metas = m.read(spark, d, "lineitem").select((F.col("l_orderkey") * 2).alias("slot"), F.col("l_orderkey").alias("block_height")).distinct()
    return onchain.slot_gaps(metas)


SLOT_SQL = """
select * from (
  select lag(h) over (order by h) * 2 as prev_slot, lag(h) over (order by h) as prev_height, h * 2 as next_slot, h as next_height, h - lag(h) over (order by h) - 1 as blocks_lost
  from (select distinct l_orderkey as h from lineitem)) where blocks_lost > 0"""


def tx_requested_compute(spark: SparkSession, d: str) -> DataFrame:
    """Orders as budget instructions: a limit of the order's key, a price of its customer; some too short."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")

    def little(x, size: int):
        return F.concat(*(F.unhex(F.lpad(F.hex(F.shiftrightunsigned(x, 8 * b).bitwiseAND(F.lit(255).cast("long"))), 2, "0")) for b in range(size)))

    limit = F.struct(F.lit(1).alias("program_id_index"), F.concat(F.unhex(F.lit("02")), F.when(k % 7 == 0, F.unhex(F.lit("01"))).otherwise(little(k, 4))).alias("data"))
    price = F.struct((k % 2).cast("int").alias("program_id_index"), F.concat(F.unhex(F.lit("03")), little(c, 8)).alias("data"))
    rows = m.read(spark, d, "orders").select(
        "o_orderkey", F.array(F.lit("payer"), F.lit(onchain.COMPUTE_BUDGET)).alias("static_keys"), F.array().cast("array<string>").alias("loaded_writable"), F.array().cast("array<string>").alias("loaded_readonly"), F.array(limit, price).alias("instructions")
    )
    return onchain.requested_compute(rows).select("o_orderkey", "compute_unit_limit", F.col("compute_unit_price_micro_lamports").cast("long").alias("compute_unit_price"))


COMPUTE_SQL = """
select o_orderkey, case when o_orderkey % 7 <> 0 then o_orderkey end as compute_unit_limit, case when o_orderkey % 2 = 1 then o_custkey end as compute_unit_price from orders"""

# ---- validation: prints of an event table dealt to files by day


def _named(venue: Column, kind: str, day: Column, mark: Column) -> Column:
    """A file's name by the convention."""
    return F.concat(F.concat_ws("_", venue, F.lit("ALL"), F.lit(kind), F.lit("sync"), day, F.lit("000000.000000")), mark, F.lit(".parquet"))


def _filed(spark: SparkSession, d: str) -> DataFrame:
    """Prints in a file for each venue and day; one venue's names break the convention."""
    t = m.trades(spark, d)
    day = F.date_format(F.timestamp_micros("ts_us"), "yyyyMMdd")
    name = _named(F.col("exchange"), "trades", day, F.when(F.col("exchange") == "kraken", ".x").otherwise(""))
    return t.withColumn("file", name).withColumn("id", (F.col("seq") / 2).cast("long"))


def _listing(spark: SparkSession, d: str) -> DataFrame:
    """What a folder of trade files lists: a file for each venue and day of any event, and for each venue one without rows and one without bytes."""
    days = m.events(spark, d).select("exchange", F.date_format(F.timestamp_micros("ts_us"), "yyyyMMdd").alias("day"), F.lit(100).alias("size")).distinct()
    extra = F.explode(F.expr("array(named_struct('day', '20991230', 'size', 100), named_struct('day', '20991231', 'size', 0))")).alias("x")
    more = m.events(spark, d).select("exchange").distinct().select("exchange", extra).select("exchange", "x.*")
    return days.unionByName(more).select(_named(F.col("exchange"), "trades", F.col("day"), F.when(F.col("exchange") == "kraken", ".x").otherwise("")).alias("file"), "size")


def validate_report(spark: SparkSession, d: str) -> DataFrame:
    rows = _filed(spark, d)
    report = validation.check_trades(rows, threshold=12, period_us=HOUR, order=["seq"], listing=_listing(spark, d))
    levels = m.levels(spark, d).select(F.concat(F.lit("b"), F.col("book") % 40).alias("file"), (F.col("book") * HOUR).alias("orderbook_ts_us"), "side", "price", "size")
    return report.unionByName(validation.check_books(levels, threshold=5000, period_us=HOUR))


TRADE_FILES = """
exchange || '_ALL_trades_sync_' || {day} || '_000000.000000' || case when exchange = 'kraken' then '.x' else '' end || '.parquet'"""
VALIDATE_SQL = o.sql(
    o.EVENTS, o.TRADES, o.LEVELS,
    f"""
filed as (select *, {TRADE_FILES.format(day="strftime(make_timestamp(ts_us), '%Y%m%d')")} as file, seq // 2 as id from trades_ev),
listed as (
  select distinct {TRADE_FILES.format(day="strftime(make_timestamp(ts_us), '%Y%m%d')")} as file, exchange, 100 as size from ev
  union all select {TRADE_FILES.format(day="'20991230'")}, exchange, 100 from (select distinct exchange from ev)
  union all select {TRADE_FILES.format(day="'20991231'")}, exchange, 0 from (select distinct exchange from ev)),
steps as (select *, ts_us < lag(ts_us) over (partition by file order by seq) as back from filed),
ids as (select file, sum(n - 1) as repeated from (select file, id, count(*) as n from filed group by all) group by file),
t as (
  select file, count(*) as n, count(*) filter (back) as backward, min(ts_us) as a, max(ts_us) as b, count(*) filter (price <= 0 or amount <= 0) as bad from steps group by file),
tr as (
  select listed.file, unnest([{{'c': 'T02', 'f': cast(n is null or size = 0 as bigint)}}, {{'c': 'T03', 'f': cast(exchange = 'kraken' as bigint)}}, {{'c': 'T04', 'f': coalesce(backward, 0)}},
    {{'c': 'T05', 'f': coalesce(cast(b - a > {11 * HOUR} * 1.2 as bigint), 0)}}, {{'c': 'T07', 'f': coalesce(cast(repeated as bigint), 0)}}, {{'c': 'T09', 'f': coalesce(bad, 0)}}]) as x
  from listed left join t on listed.file = t.file left join ids on listed.file = ids.file),
lv as (select 'b' || cast(book % 40 as varchar) as file, book * {HOUR} as ts, side, price, size from levels),
bk as (select file, ts, max(price) filter (side = 'bid') >= min(price) filter (side = 'ask') as crossed from lv group by all),
bs as (select file, count(*) as n, count(*) filter (crossed) as crossed, min(ts) as a, max(ts) as b from bk group by file),
bad as (select file, count(*) filter (price <= 0 or size <= 0) as bad from lv group by file),
br as (
  select file, unnest([{{'c': 'T02', 'f': cast(n = 0 as bigint)}}, {{'c': 'T05', 'f': cast(b - a > {4999 * HOUR} * 1.2 or b - a < {4999 * HOUR} * 0.8 as bigint)}}, {{'c': 'T08', 'f': crossed}}, {{'c': 'T09', 'f': bad}}]) as x
  from bs join bad using (file))""",
    last='select file, x.c as "check", x.f as failures from tr union all select file, x.c, x.f from br',
)


def validate_files(spark: SparkSession, d: str) -> DataFrame:
    """The whole battery, T01 to T13, over trade, book and transaction files with planted faults of every kind.

    Books of two symbols share files and times; transactions repeat inside and
    across files, and some are of another address than their file's name says.
    """
    report = validation.check_trades(_filed(spark, d), threshold=12, period_us=HOUR, order=["seq"], listing=_listing(spark, d))
    k = F.col("book")
    price = F.when(k % 41 == 0, 0).otherwise(F.col("price"))
    levels = m.levels(spark, d).select(
        F.concat(F.lit("b"), k % 40).alias("file"), F.concat(F.lit("U"), F.expr("book div 40 % 2")).alias("symbol"), F.expr(f"book div 80 * {HOUR}").alias("orderbook_ts_us"),
        F.when(k % 13 == 0, k * 2 + 2001).otherwise(k * 2).alias("place"), "side", price.alias("price"), "size",
    )
    at = F.col("arrival")
    txs = _tx_rows(spark, d).withColumn("source_tx_ts_us", F.when(at % 97 == 0, 5).otherwise(at * 10)).withColumn("signature", F.when(at % 101 == 0, "").otherwise(F.concat(F.lit("s"), F.expr("arrival div 8"))))
    txs = txs.withColumn("named", F.when(at % 89 == 0, "other").otherwise(F.col("address")))
    report = report.unionByName(validation.check_books(levels, threshold=5000, period_us=HOUR, order=["place"]))
    report = report.unionByName(validation.check_transactions(txs, threshold=12, period_us=10_000, order=["arrival"], expected="named"))
    report = report.unionByName(validation.check_across(txs, ["day"], ["address", "signature"]).select(F.concat("file", F.lit(" across")).alias("file"), "check", "failures"))
    spans = validation.spans(_filed(spark, d).withColumn("file", F.concat(F.lit("h"), F.expr(f"(ts_us + seq % 2 * {6 * HOUR}) div {12 * HOUR}"))), "ts_us", ["exchange", "file"])
    over = validation.overlaps(spans, ["exchange"]).groupBy(F.concat_ws(" ", "exchange", "file").alias("file")).agg(F.lit("T10").alias("check"), F.count("*").alias("failures"))
    none = expected_kinds(spark, d).groupBy(F.col("exchange").alias("file")).agg(F.lit("T01").alias("check"), F.count("*").alias("failures"))
    return report.unionByName(over.select("file", "check", "failures")).unionByName(none.select("file", "check", "failures"))


def expected_kinds(spark: SparkSession, d: str) -> DataFrame:
    """(exchange, kind) that have no file: each venue and one more should have books and trades."""
    venue = F.explode(F.array(*(F.lit(v) for v in (*m.VENUES, "okx")))).alias("exchange")
    expected = spark.range(1).select(venue).select("exchange", F.explode(F.array(*(F.lit(k) for k in validation.EXPECTED))).alias("kind"))
    return validation.absent(expected, m.trades(spark, d).groupBy("exchange").agg(F.count("*").alias("n")).withColumn("kind", F.lit("trades")))


FILES_SQL = o.sql(
    TX_ROWS, o.LEVELS, o.EVENTS, o.TRADES,
    f"""
lv as (
  select 'b' || cast(book % 40 as varchar) as file, book // 40 % 2 as symbol, book // 80 * {HOUR} as ts, case when book % 13 = 0 then book * 2 + 2001 else book * 2 end as place, side,
    case when book % 41 = 0 then 0 else price end as price, size from levels),
bk as (select file, symbol, ts, min(place) as place, max(price) filter (side = 'bid') >= min(price) filter (side = 'ask') as crossed from lv group by file, symbol, ts),
bo as (select *, ts < lag(ts) over (partition by file order by place) as back from bk),
bs as (
  select file, count(*) as n, count(*) filter (crossed) as crossed, min(ts) as a, max(ts) as b, count(*) filter (back) as backward, count(*) - count(distinct ts) as repeated from bo group by file),
bad as (select file, count(*) filter (price <= 0 or size <= 0) as bad from lv group by file),
br as (
  select file, unnest([{{'c': 'T02', 'f': cast(n = 0 as bigint)}}, {{'c': 'T04', 'f': backward}}, {{'c': 'T05', 'f': cast(b - a > {4999 * HOUR} * 1.2 or b - a < {4999 * HOUR} * 0.8 as bigint)}},
    {{'c': 'T06', 'f': repeated}}, {{'c': 'T08', 'f': crossed}}, {{'c': 'T09', 'f': bad}}]) as x from bs join bad using (file)),
tx as (
  select * replace (case when tx_index % 97 = 0 then 5 else source_tx_ts_us end as source_tx_ts_us, case when signature <> '' then 's' || cast(tx_index // 8 as varchar) else '' end as signature) from rows),
tl as (
  select *, source_tx_ts_us < lag(source_tx_ts_us) over (partition by file order by tx_index) as back,
    (slot, tx_index) <= lag((slot, tx_index)) over (partition by file, address order by tx_index) as unordered,
    row_number() over (partition by file, address, signature) > 1 as again, tx_index % 89 = 0 as foreign_row,
    signature = '' or source_tx_ts_us = 0 or blockhash = '' or block_height = 0 or success = (failure_error is not null) or coalesce(failure_error = '', false)
      or (version = 'v1' and cu_price is not null) or (version <> 'v1' and priority_fee is not null) as bad
  from tx),
ts as (
  select file, count(*) as n, count(*) filter (back) as backward, max(source_tx_ts_us) - min(source_tx_ts_us) as span, count(*) filter (again) + count(*) filter (foreign_row) as repeated,
    count(*) filter (unordered) as unordered, count(*) filter (bad) as bad from tl group by file),
tr as (
  select file, unnest([{{'c': 'T02', 'f': cast(n = 0 as bigint)}}, {{'c': 'T04', 'f': backward}}, {{'c': 'T05', 'f': cast(span > 110000 * 1.2 as bigint)}}, {{'c': 'T11', 'f': repeated}},
    {{'c': 'T12', 'f': unordered}}, {{'c': 'T13', 'f': bad}}]) as x from ts),
keys as (select distinct day, address, signature, file from tx),
across_files as (select file, count(*) as n from (select *, count(*) over (partition by day, address, signature) as files from keys) where files > 1 group by file),
halves as (select exchange, 'h' || cast((ts_us + seq % 2 * {6 * HOUR}) // {12 * HOUR} as varchar) as half, min(ts_us) as a, max(ts_us) as b from trades_ev group by all),
over_rows as (select exchange, half, a <= lag(b) over (partition by exchange order by a, b, half) as bad from halves)""",
    last=f"""
select file, x.c as "check", x.f as failures from br union all select file, x.c, x.f from tr
union all select file || ' across', 'T11', n from across_files
union all select exchange || ' ' || half, 'T10', count(*) from over_rows where bad group by exchange, half
union all select exchange, 'T01', count(*) from (select unnest(['binance', 'bybit', 'coinbase', 'kraken', 'okx', 'okx']) as exchange) group by exchange
union all select * from ({VALIDATE_SQL}) where contains(file, '_')""",
)


def validation_rollup(spark: SparkSession, d: str) -> DataFrame:
    return validation.rollup(validate_report(spark, d).withColumn("venue", F.split("file", "_")[0]), ["venue", "check"])


def file_overlap(spark: SparkSession, d: str) -> DataFrame:
    """Files of overlapping days."""
    t = m.trades(spark, d)
    first = t.withColumn("file", F.concat(F.lit("d"), F.expr(f"ts_us div {24 * HOUR}")))
    shifted = t.where("side = 'sell'").withColumn("file", F.concat(F.lit("s"), F.expr(f"(ts_us + {12 * HOUR}) div {48 * HOUR}")))
    spans = validation.spans(first.unionByName(shifted), "ts_us", ["exchange", "file"])
    return validation.overlaps(spans, ["exchange"])


OVERLAP_SQL = o.sql(
    o.EVENTS, o.TRADES,
    f"""
named as (
  select exchange, ts_us, 'd' || cast(ts_us // {24 * HOUR} as varchar) as file from trades_ev
  union all select exchange, ts_us, 's' || cast((ts_us + {12 * HOUR}) // {48 * HOUR} as varchar) from trades_ev where side = 'sell'),
spans as (select exchange, file, min(ts_us) as first_ts, max(ts_us) as last_ts from named group by all),
held as (select exchange, file, first_ts, lag(file) over w as prev_file, lag(last_ts) over w as prev_last from spans window w as (partition by exchange order by first_ts, last_ts, file))""",
    last="select exchange, prev_file, prev_last, file, first_ts from held where first_ts <= prev_last",
)


def dataset_stats(spark: SparkSession, d: str) -> DataFrame:
    t = m.trades(spark, d)
    by = ["symbol"]
    return rounded(validation.numbers(t, "price", by).join(validation.numbers(t, "amount", by), by).join(validation.spacing(t, "ts_us", by), by))


DATASET_SQL = o.sql(
    o.EVENTS, o.TRADES,
    """
s as (select symbol, count(step) as steps, min(step) as step_min, max(step) as step_max from (
  select symbol, ts_us - lag(ts_us) over (partition by symbol order by ts_us) as step from (select distinct symbol, ts_us from trades_ev)) group by symbol)""",
    last="""
select symbol, min(price)::double as price_min, max(price)::double as price_max, round(avg(price::double), 6) as price_mean, min(amount)::double as amount_min, max(amount)::double as amount_max,
  round(avg(amount::double), 6) as amount_mean, any_value(steps) as steps, any_value(step_min) as step_min, any_value(step_max) as step_max from trades_ev join s using (symbol) group by symbol""",
)

# ---- symbols, times, ids, names


def _names(spark: SparkSession, d: str) -> DataFrame:
    """Part brands as raw symbols in many spellings."""
    p = F.col("p_partkey")
    quotes = F.element_at(F.array(*(F.lit(q) for q in scalars.KNOWN_QUOTES)), (p % 13 + 1).cast("int"))
    base = F.concat(F.lit("C"), p % 97)
    return m.read(spark, d, "part").select("p_partkey", base.alias("base"), quotes.alias("quote"))


PART_NAMES = "names as (select p_partkey, 'C' || cast(p_partkey % 97 as varchar) as base, ['USDT','USDC','BUSD','TUSD','FDUSD','USDD','USD','BTC','ETH','EUR','GBP','DAI','BNB'][p_partkey % 13 + 1] as quote from part)"


def symbol_codec(spark: SparkSession, d: str) -> DataFrame:
    """Every pair in every venue's spelling, and read back."""
    rows = _names(spark, d).select("p_partkey", F.concat("base", F.lit("/"), "quote").alias("pair"), F.explode(F.array(*(F.lit(v) for v in scalars.CODECS))).alias("exchange"))
    rows = rows.withColumn("raw", scalars.encode_symbol(F.col("pair"), F.col("exchange")))
    return rows.withColumn("decoded", scalars.decode_symbol(F.col("raw"), F.col("exchange")))


SYMBOL_SQL = o.sql(
    PART_NAMES,
    "venues as (select unnest(['binance','bybit','bitget','htx','coinbase','okx','kucoin','kraken','gateio','poloniex','bitso','upbit','hyperliquid','solana']) as exchange)",
    last="""
select p_partkey, base || '/' || quote as pair, exchange,
  case when exchange in ('binance', 'htx') then lower(base || quote) when exchange in ('bybit', 'bitget') then base || quote when exchange in ('coinbase', 'okx', 'kucoin') then base || '-' || quote
    when exchange in ('gateio', 'poloniex') then base || '_' || quote when exchange = 'bitso' then lower(base || '_' || quote) when exchange = 'upbit' then quote || '-' || base
    when exchange = 'hyperliquid' then base else base || '/' || quote end as raw,
  case when exchange = 'solana' then null when exchange = 'hyperliquid' then base || '/USDC'
    when exchange in ('binance', 'htx', 'bybit', 'bitget') and quote = 'FDUSD' then base || '/FDUSD' else base || '/' || quote end as decoded
from names, venues""",
)


def known_quote_split(spark: SparkSession, d: str) -> DataFrame:
    rows = _names(spark, d).withColumn("raw", F.concat("base", "quote"))
    return rows.select("p_partkey", "raw", scalars.joined(F.col("raw")).alias("pair"), scalars.lenient(F.concat_ws("-", "base", "quote")).alias("hyphen"), scalars.file_symbol(F.concat_ws("/", "base", "quote")).alias("file_symbol"))


def epoch_normalize(spark: SparkSession, d: str) -> DataFrame:
    us = F.unix_micros(F.col("o_orderdate").cast("timestamp"))
    k = F.col("o_orderkey") % 5
    raw = F.when(k == 0, scalars.div(us, 1_000_000)).when(k == 1, scalars.div(us, 1000)).when(k == 2, us).when(k == 3, us * 1000).otherwise(F.lit(0).cast("long"))
    return m.read(spark, d, "orders").select("o_orderkey", raw.alias("raw"), scalars.epoch_to_us(raw).alias("us"))


EPOCH_SQL = """
select o_orderkey, raw, case when raw >= 100000000000000000 then raw // 1000 when raw >= 100000000000000 then raw when raw >= 100000000000 then raw * 1000 else raw * 1000000 end as us
from (select o_orderkey, case o_orderkey % 5 when 0 then epoch_us(o_orderdate) // 1000000 when 1 then epoch_us(o_orderdate) // 1000 when 2 then epoch_us(o_orderdate) when 3 then epoch_us(o_orderdate) * 1000 else 0 end as raw from orders)"""


def effective_ts(spark: SparkSession, d: str) -> DataFrame:
    e = m.events(spark, d)
    source = F.when(F.col("k") % 3 == 0, F.lit(0).cast("long")).otherwise(F.col("ts_us"))
    local = F.when(F.col("k") % 2 == 0, F.lit(0).cast("long")).otherwise(F.col("ts_us") + 7)
    return e.select("seq", scalars.effective(source, local, F.col("ts_us") - 1).alias("effective_us"))


def order_id_codec(spark: SparkSession, d: str) -> DataFrame:
    side = F.when(F.col("o_orderkey") % 2 == 0, "bid").otherwise("ask")
    kind = F.when(F.col("o_orderkey") % 3 == 0, "market").otherwise("limit")
    ts = F.unix_micros(F.col("o_orderdate").cast("timestamp"))
    oid = scalars.order_id(side, kind, ts)
    return m.read(spark, d, "orders").select("o_orderkey", scalars.order_id_side(oid).alias("side"), scalars.order_id_kind(oid).alias("kind"), scalars.order_id_time(oid).alias("ts_us"), oid.bitwiseAND(F.lit((1 << 62) - 1)).alias("low_bits"))


ORDER_ID_SQL = """
select o_orderkey, case when o_orderkey % 2 = 0 then 'bid' else 'ask' end as side, case when o_orderkey % 3 = 0 then 'market' else 'limit' end as kind, epoch_us(o_orderdate) as ts_us,
  epoch_us(o_orderdate) * 4 as low_bits from orders"""


def file_name_parse(spark: SparkSession, d: str) -> DataFrame:
    """File names of orders: most valid, some with a number, some broken."""
    k = F.col("o_orderkey")
    kind = F.element_at(F.array(*(F.lit(t) for t in files.TAGS)), (k % 7 + 1).cast("int"))
    stamp = F.date_format("o_orderdate", "yyyyMMdd")
    clock = F.when(k % 11 == 0, "236061.123").otherwise("101530.123456")
    tail = F.when(k % 4 == 0, F.concat(F.lit("-"), k % 9)).otherwise("")
    name = F.concat(F.concat_ws("_", F.lit("bybit"), F.concat(F.lit("C"), k % 20, F.lit("-USD")), kind, F.lit("sync"), stamp, clock), tail, F.lit(".parquet"))
    parsed = files.parsed_name(name)
    rows = m.read(spark, d, "orders").select("o_orderkey", name.alias("name"), parsed.alias("p"))
    return rows.select("o_orderkey", "name", *(F.col(f"p.{c}").alias(c) for c in ("exchange", "symbol", "kind", "mode", "date", "time", "collision")))


NAME_SQL = """
with named as (
  select o_orderkey, 'bybit_C' || cast(o_orderkey % 20 as varchar) || '-USD_' || ['ob','trades','liquidations','funding_settlement','funding','oi','txs'][o_orderkey % 7 + 1] || '_sync_' || strftime(o_orderdate, '%Y%m%d') || '_' ||
    case when o_orderkey % 11 = 0 then '236061.123' else '101530.123456' end || case when o_orderkey % 4 = 0 then '-' || cast(o_orderkey % 9 as varchar) else '' end || '.parquet' as name,
    o_orderkey % 11 <> 0 and not (o_orderkey % 4 = 0 and o_orderkey % 9 = 0) as valid
  from orders)
select o_orderkey, name, case when valid then 'bybit' end as exchange, case when valid then 'C' || cast(o_orderkey % 20 as varchar) || '-USD' end as symbol,
  case when valid then ['ob','trades','liquidations','funding_settlement','funding','oi','txs'][o_orderkey % 7 + 1] end as kind, case when valid then 'sync' end as mode,
  case when valid then regexp_extract(name, '_(\\d{8})_', 1) end as date, case when valid then '101530.123456' end as time,
  case when valid and o_orderkey % 4 = 0 then cast(o_orderkey % 9 as varchar) end as collision from named"""


def latency_histogram(spark: SparkSession, d: str) -> DataFrame:
    e = m.events(spark, d)
    return e.groupBy("event_type", scalars.latency_bucket(F.col("value") * 10).alias("bucket_ms")).agg(F.count("*").alias("n"))


LATENCY_SQL = o.sql(
    o.EVENTS,
    last="select event_type, case " + " ".join(f"when value * 10 <= {b} then {b}" for b in scalars.LATENCY_BUCKETS_MS) + " end::double as bucket_ms, count(*) as n from ev group by all",
)

# ---- archives, manifests, frames


def _window() -> tuple[datetime.date, datetime.date, list[str]]:
    return datetime.date(2024, 1, 1), datetime.date(2024, 1, 30), ["BTC", "ETH", "SOL"]


def _pairs(spark: SparkSession, d: str) -> DataFrame:
    """The days and coins of all events."""
    coin = F.concat(F.lit("K"), F.col("user_id") % 7)
    return m.events(spark, d).select(F.timestamp_micros("ts_us").cast("date").alias("day"), coin.alias("coin")).distinct()


def archive_plan(spark: SparkSession, d: str) -> DataFrame:
    """The archive's objects for what events there are."""
    return files.archive_keys(_pairs(spark, d), contexts=True).select("key", F.col("day").cast("string").alias("day"), "hour", "coin")


PLAN_SQL = """
select 'market_data/' || strftime(day, '%Y%m%d') || '/' || cast(hour as varchar) || '/l2Book/' || coin || '.lz4' as key, strftime(day, '%Y-%m-%d') as day, cast(hour as int) as hour, coin
from (select unnest(range(timestamp '2024-01-01', timestamp '2024-01-31', interval 1 day)) as day), range(24) h(hour), (select unnest(['BTC', 'ETH', 'SOL']) as coin)
union all select 'asset_ctxs/' || strftime(day, '%Y%m%d') || '.csv.lz4', strftime(day, '%Y-%m-%d'), -1, '' from (select unnest(range(timestamp '2024-01-01', timestamp '2024-01-31', interval 1 day)) as day)"""


PAIRS_SQL = """
with pairs as (select distinct cast(ts as date) as day, 'K' || cast(user_id % 7 as varchar) as coin from events)
select 'market_data/' || strftime(day, '%Y%m%d') || '/' || cast(hour as varchar) || '/l2Book/' || coin || '.lz4' as key, strftime(day, '%Y-%m-%d') as day, cast(hour as int) as hour, coin from pairs, range(24) h(hour)
union all select distinct 'asset_ctxs/' || strftime(day, '%Y%m%d') || '.csv.lz4', strftime(day, '%Y-%m-%d'), -1, '' from pairs"""


def archive_edge(spark: SparkSession, d: str) -> DataFrame:
    """Planned hours against what events are there: present, missing or beyond the archive's edge."""
    start, _, coins = _window()
    plan = files.archive_plan(spark, start, datetime.date(2024, 2, 3), coins)
    coin = F.element_at(F.array(*(F.lit(c) for c in coins)), (F.col("user_id") % 3 + 1).cast("int"))
    at = F.timestamp_micros("ts_us")
    seen = m.events(spark, d).select(
        F.concat_ws("/", F.lit("market_data"), F.date_format(at, "yyyyMMdd"), F.hour(at), F.lit("l2Book"), F.concat(coin, F.lit(".lz4"))).alias("key")
    )
    return files.classified(plan, seen.distinct()).groupBy("coin", "state").agg(F.count("*").alias("n"))


EDGE_SQL = f"""
with plan as ({PLAN_SQL.split("union all")[0].replace("2024-01-31", "2024-02-04")}),
seen as (
  select distinct 'market_data/' || strftime(ts, '%Y%m%d') || '/' || cast(hour(ts) as varchar) || '/l2Book/' || ['BTC', 'ETH', 'SOL'][cast(user_id % 3 as int) + 1] || '.lz4' as key, strftime(ts, '%Y-%m-%d') as day
  from events)
select coin, case when s.key is not null then 'present' when plan.day > (select max(day) from seen) then 'beyond_edge' else 'missing' end as state, count(*) as n
from plan left join seen s on plan.key = s.key group by all"""


def archive_coins(spark: SparkSession, d: str) -> DataFrame:
    return files.coins_of(archive_plan(spark, d))


def json_frames(spark: SparkSession, d: str) -> DataFrame:
    """Events as one venue's trade frames: built as text, decoded back."""
    e = m.events(spark, d)
    side = F.when(F.col("seq") % 10 == 0, "none").when(F.col("event_type") == "click", "Buy").otherwise("Sell")
    item = F.struct(F.col("ts_us").alias("ts"), F.lit("BTC-USDT").alias("instId"), F.col("seq").cast("string").alias("tradeId"), F.col("value").cast("decimal(18,2)").cast("string").alias("px"), F.col("k").cast("string").alias("sz"), side.alias("side"))
    frame = F.to_json(F.struct(F.struct(F.lit("trades").alias("channel"), F.lit("BTC-USDT").alias("instId")).alias("arg"), F.array(item).alias("data")))
    rows = venues.prints(e.select(frame.alias("value")), "okx")
    return rows.select("exchange", "symbol", "side", F.col("price").cast("double").alias("price"), F.col("amount").cast("double").alias("amount"), "source_trade_ts_us", "id", "sequence", "reason")


FRAMES_SQL = o.sql(
    o.EVENTS,
    last="""
select 'okx' as exchange, 'BTC/USDT' as symbol, case when seq % 10 = 0 then null when event_type = 'click' then 'buy' else 'sell' end as side, cast(cast(value as decimal(18,2)) as double) as price, cast(k as double) as amount,
  ts_us as source_trade_ts_us, cast(seq as varchar) as id, seq as sequence, case when seq % 10 = 0 then 'side' end as reason from ev""",
)


def context_rows(spark: SparkSession, d: str) -> DataFrame:
    """Events as context lines; each gives a funding and an open-interest row."""
    e = m.events(spark, d).where("event_type = 'signup'")
    at = F.date_format(F.timestamp_micros("ts_us"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    line = F.concat_ws(",", at, F.concat(F.lit("C"), F.col("seq") % 5), F.col("value").cast("string"), F.when(F.col("k") % 9 == 0, "x").otherwise(F.col("k").cast("string")), *(F.lit("1") for _ in range(8)))
    funding, interest, _ = files.context_rows(e.select(line.alias("value")))
    a = funding.select(F.lit("funding").alias("kind"), F.col("funding_rate_ts_us").alias("ts_us"), "symbol", F.col("funding_rate").alias("value"))
    return a.unionByName(interest.select(F.lit("oi").alias("kind"), F.col("open_interest_ts_us").alias("ts_us"), "symbol", F.col("open_interest").alias("value")))


CONTEXT_SQL = o.sql(
    o.EVENTS,
    last="""
select 'funding' as kind, ts_us, 'C' || cast(seq % 5 as varchar) || '/USDC' as symbol, value from ev where event_type = 'signup'
union all select 'oi', ts_us, 'C' || cast(seq % 5 as varchar) || '/USDC', cast(k as double) from ev where event_type = 'signup' and k % 9 <> 0""",
)


def heartbeat_windows(spark: SparkSession, d: str) -> DataFrame:
    """Six-hour windows of each symbol without a liquidation."""
    width = 6 * HOUR
    rows = m.liquidations(spark, d).select("symbol", "ts_us")
    span = m.events(spark, d).groupBy("symbol").agg(F.min(F.expr(f"ts_us div {width}")).alias("a"), F.max(F.expr(f"ts_us div {width}")).alias("b"))
    windows = span.select("symbol", F.explode(F.sequence("a", "b")).alias("w")).select("symbol", (F.col("w") * width).alias("t_min_us"), ((F.col("w") + 1) * width).alias("t_max_us"))
    return files.heartbeats(windows, rows, "ts_us", "liquidations")


HEARTBEAT_SQL = o.sql(
    o.EVENTS,
    f"span as (select symbol, unnest(range(min(ts_us // {6 * HOUR}), max(ts_us // {6 * HOUR}) + 1)) as w from ev group by symbol)",
    last=f"""
select true as heartbeat, symbol, cast(0 as bigint) as rows, w * {6 * HOUR} as t_min_us, (w + 1) * {6 * HOUR} as t_max_us, 'liquidations.v1' as schema_id from span
where not exists (select 1 from ev where event_type = 'error' and ev.symbol = span.symbol and ev.ts_us // {6 * HOUR} = w)""",
)


def heartbeat_heights(spark: SparkSession, d: str) -> DataFrame:
    """The same windows with the last block before each window's end, events of two kinds taken as blocks."""
    quiet = heartbeat_windows(spark, d)
    metas = m.events(spark, d).where("event_type in ('signup', 'purchase')").select("symbol", "ts_us", F.col("seq").alias("slot"), (F.col("seq") * 2).alias("block_height"))
    return files.with_heights(quiet, metas, "ts_us").select("symbol", "t_min_us", "last_slot", "last_block_height")


HEIGHTS_SQL = o.sql(
    o.EVENTS,
    f"span as (select symbol, unnest(range(min(ts_us // {6 * HOUR}), max(ts_us // {6 * HOUR}) + 1)) as w from ev group by symbol)",
    f"quiet as (select * from span where not exists (select 1 from ev where event_type = 'error' and ev.symbol = span.symbol and ev.ts_us // {6 * HOUR} = w))",
    last=f"""
select q.symbol, any_value(q.w) * {6 * HOUR} as t_min_us, arg_max(seq, (ts_us, seq)) as last_slot, arg_max(seq, (ts_us, seq)) * 2 as last_block_height
from quiet q left join ev on ev.symbol = q.symbol and ev.event_type in ('signup', 'purchase') and ev.ts_us < (q.w + 1) * {6 * HOUR} group by q.symbol, q.w""",
)


def base58_codec(spark: SparkSession, d: str) -> DataFrame:
    """Hashes of names as chain addresses and back."""
    rows = m.read(spark, d, "customer").select("c_custkey", F.unhex(F.sha2("c_name", 256)).alias("raw"))
    text = rows.select("c_custkey", F.hex("raw").alias("hex"), codecs.base58("raw").alias("address"))
    return text.withColumn("back", F.hex(codecs.address_bytes("address")))


def trailing_rate(spark: SparkSession, d: str) -> DataFrame:
    return trades.trailing_count(m.trades(spark, d), HOUR).select("exchange", "symbol", "seq", "trailing")


RATE_SQL = o.sql(
    o.EVENTS, o.TRADES,
    last=f"select exchange, symbol, seq, least(count(*) over (partition by exchange, symbol order by ts_us range between {HOUR} preceding and current row), 4096) as \"trailing\" from trades_ev",
)

QUERIES = {
    f.__name__: f
    for f in (
        tx_match_roles, tx_invariants, tx_order_check, tx_cross_file_dups, slot_gaps, tx_requested_compute, validate_report, validate_files, validation_rollup, file_overlap, dataset_stats, symbol_codec,
        known_quote_split, epoch_normalize, effective_ts, order_id_codec, file_name_parse, latency_histogram, archive_plan, archive_edge, archive_coins, json_frames, context_rows,
        heartbeat_windows, heartbeat_heights, base58_codec, trailing_rate,
    )
}
ORACLE_SQL = {
    "tx_match_roles": TX_SQL,
    "tx_invariants": INVARIANTS_SQL,
    "tx_order_check": ORDER_SQL,
    "tx_cross_file_dups": DUPS_SQL,
    "slot_gaps": SLOT_SQL,
    "tx_requested_compute": COMPUTE_SQL,
    "validate_report": VALIDATE_SQL,
    "validate_files": FILES_SQL,
    "validation_rollup": f"""
select split_part(file, '_', 1) as venue, "check", count(*) as checks, count(*) filter (failures > 0) as failed from ({VALIDATE_SQL}) group by rollup (venue, "check")""",
    "file_overlap": OVERLAP_SQL,
    "dataset_stats": DATASET_SQL,
    "symbol_codec": SYMBOL_SQL,
    "known_quote_split": o.sql(
        PART_NAMES, last="select p_partkey, base || quote as raw, base || '/' || quote as pair, base || '/' || quote as hyphen, base || '-' || quote as file_symbol from names"
    ),
    "epoch_normalize": EPOCH_SQL,
    "effective_ts": o.sql(o.EVENTS, last="select seq, case when k % 3 <> 0 then ts_us when k % 2 <> 0 then ts_us + 7 else ts_us - 1 end as effective_us from ev"),
    "order_id_codec": ORDER_ID_SQL,
    "file_name_parse": NAME_SQL,
    "latency_histogram": LATENCY_SQL,
    "heartbeat_heights": HEIGHTS_SQL,
    "archive_plan": PAIRS_SQL,
    "archive_edge": EDGE_SQL,
    "archive_coins": "select distinct 'K' || cast(user_id % 7 as varchar) as coin from events",
    "json_frames": FRAMES_SQL,
    "context_rows": CONTEXT_SQL,
    "heartbeat_windows": HEARTBEAT_SQL,
    "trailing_rate": RATE_SQL,
}
