"""Queries that write the given tables in canonical form and read them back: scans, sinks, commits, archives, back-fill, state over runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.operators import cumulative, reconcile, validation
from tickloom.plans import oracle as o
from tickloom.plans.data_queries import _tx_rows
from tickloom.sources import archive, commits, files
from tickloom.sources import mapping as m


def _prints(spark: SparkSession, d: str) -> DataFrame:
    """Prints as canonical rows."""
    return m.trades(spark, d).select(F.col("ts_us").alias("source_trade_ts_us"), "symbol", "side", "price", "amount", "exchange", F.col("seq").cast("string").alias("id"), "seq")


def committed_trades(spark: SparkSession, d: str) -> DataFrame:
    """Prints in two commits of a leaf, read by its index; columns that older files lack have their defaults."""
    leaf, rows = commits.Leaf(spark, commits.scratch(spark)), _prints(spark, d)
    leaf.commit(rows.where("seq % 2 = 0").drop("seq"), "trades")
    leaf.commit(rows.where("seq % 2 = 1").drop("seq"), "trades")
    return leaf.read("trades").select("exchange", "symbol", "id", "source_trade_ts_us", "side", "price", "amount", "local_trade_ts_us", "origin")


COMMITTED_SQL = o.sql(
    o.EVENTS, o.TRADES,
    last="""
select exchange, symbol, cast(seq as varchar) as id, ts_us as source_trade_ts_us, side, cast(price as double) as price, cast(amount as double) as amount, 0::bigint as local_trade_ts_us, 'ws' as origin from trades_ev""",
)


def leaf_manifest(spark: SparkSession, d: str) -> DataFrame:
    """What the index of a leaf says: rows and times of its files by exchange, all intact."""
    leaf, rows = commits.Leaf(spark, commits.scratch(spark)), _prints(spark, d).drop("seq")
    for venue in m.VENUES:
        leaf.commit(rows.where(F.col("exchange") == venue), "trades", venue)
    each = leaf.listed().join(leaf.verified().select("filename", "intact"), "filename")
    return each.agg(F.sum("rows").alias("n_rows"), F.min("t_min_us").alias("t_min_us"), F.max("t_max_us").alias("t_max_us"), F.bool_and("intact").alias("intact"))


MANIFEST_SQL = o.sql(o.EVENTS, o.TRADES, last="select count(*) as n_rows, min(ts_us) as t_min_us, max(ts_us) as t_max_us, true as intact from trades_ev")


def _stored_levels(spark: SparkSession, d: str) -> str:
    """Books of line items as canonical levels, by day."""
    rows = m.levels(spark, d).where("book % 3 = 0").select(
        (F.col("book") * 1_000_000_000).alias("orderbook_ts_us"),
        F.concat(F.lit("B"), F.col("book") % 7, F.lit("/USD")).alias("symbol"),
        F.lit("kraken").alias("exchange"),
        "side",
        F.lit(0).alias("level"),
        F.col("price").cast("double").alias("price"),
        F.col("size").cast("double").alias("size"),
    )
    path = commits.scratch(spark)
    files.write(rows, path, "orderbooks", partition=False)
    return path


def stored_books(spark: SparkSession, d: str) -> DataFrame:
    """Books read from level rows: a row each, its sides as arrays."""
    books = files.books(spark, _stored_levels(spark, d))
    price = lambda side: F.array_sort(F.transform(side, lambda x: x["price"]))
    bids, asks = price("bids"), price("asks")
    return books.select("exchange", "symbol", "orderbook_ts_us", F.size("bids").cast("long").alias("n_bids"), F.size("asks").cast("long").alias("n_asks"), F.try_element_at(bids, F.lit(-1)).alias("bid"), F.get(asks, 0).alias("ask"))


STORED_BOOKS_SQL = o.sql(
    o.LEVELS,
    last="""
select 'kraken' as exchange, 'B' || cast(book % 7 as varchar) || '/USD' as symbol, book * 1000000000 as orderbook_ts_us, count(*) filter (side = 'bid') as n_bids, count(*) filter (side = 'ask') as n_asks,
  cast(max(price) filter (side = 'bid') as double) as bid, cast(min(price) filter (side = 'ask') as double) as ask from levels where book % 3 = 0 group by book""",
)


def collapsed_books(spark: SparkSession, d: str) -> DataFrame:
    """All books of a file as one map: each price's last size."""
    return files.collapsed_book(spark, _stored_levels(spark, d))


COLLAPSED_SQL = o.sql(
    o.LEVELS,
    last="""
select 'kraken' as exchange, 'B' || cast(book % 7 as varchar) || '/USD' as symbol, side, cast(price as double) as price, arg_max(size, book) as size from levels where book % 3 = 0 group by all""",
)


def stored_tables(spark: SparkSession, d: str) -> DataFrame:
    """Liquidations, funding, settlements and open interest through their files: rows and a sum of each."""
    liqs = m.liquidations(spark, d).withColumnRenamed("ts_us", "liquidation_ts_us")
    funding = m.funding(spark, d).select(F.col("ts_us").alias("funding_rate_ts_us"), "symbol", F.col("rate").alias("funding_rate"), "next_funding_ts_us", "exchange", "interval_hours")
    settled = m.funding(spark, d).select(F.col("ts_us").alias("funding_time_us"), "symbol", F.col("rate").alias("funding_rate"), F.lit(0.0).alias("premium"), "exchange", F.col("ts_us").alias("local_ts_us"), F.lit(0).alias("rtt_us"))
    interest = m.open_interest(spark, d).select(F.col("ts_us").alias("open_interest_ts_us"), "symbol", F.col("oi").alias("open_interest"), F.col("oi_value").alias("open_interest_value"), "exchange", "mark_px")
    parts = []
    for datatype, rows, value in (("liquidations", liqs, "amount"), ("funding_rates", funding, "interval_hours"), ("funding_settlements", settled, "local_ts_us"), ("open_interests", interest, "open_interest")):
        path = commits.scratch(spark)
        files.write(rows, path, datatype)
        stored = files.scan(spark, path, datatype)
        # Some thousand times in microseconds add up to more than a long.
        number = F.col(value).cast("decimal(20,0)") if value == "local_ts_us" else F.col(value)
        parts.append(stored.agg(F.count("*").alias("n"), F.sum(number).cast("double").alias("total")).withColumn("datatype", F.lit(datatype)))
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


TABLES_SQL = o.sql(
    o.EVENTS, o.LIQS, o.FUNDING, o.INTEREST,
    last="""
select 'liquidations' as datatype, count(*) as n, cast(sum(amount) as double) as total from liqs_ev
union all select 'funding_rates', count(*), cast(sum(interval_hours) as double) from funding_ev
union all select 'funding_settlements', count(*), cast(sum(ts_us) as double) from funding_ev
union all select 'open_interests', count(*), sum(oi) from interest_ev""",
)


def stored_transactions(spark: SparkSession, d: str) -> DataFrame:
    """Transactions through their files; only the two key columns are read back."""
    rows, path = _tx_rows(spark, d), commits.scratch(spark)
    lacking = [f for f in files.schemas.struct(files.schemas.TRANSACTIONS).fields if f.name not in rows.columns]
    files.write(rows.select("*", *(F.lit(None).cast(f.dataType).alias(f.name) for f in lacking)), path, "transactions", partition=False)
    return files.transaction_keys(spark, path).groupBy("address").agg(F.count("*").alias("n"), F.countDistinct("signature").alias("signatures"))


TX_KEYS_SQL = """
select 'A' || cast(o_custkey % 50 as varchar) as address, count(*) as n, count(distinct case when o_orderkey % 101 = 0 then '' else 's' || cast(o_orderkey // 2 as varchar) end) as signatures from orders group by all"""


def archive_resume(spark: SparkSession, d: str) -> DataFrame:
    """Wire lines in archive objects by day and six hours, read from a cursor on; lines of another version are refused."""
    e = m.events(spark, d)
    stamp = F.timestamp_micros("ts_us")
    wrapped = F.to_json(F.struct(F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("time"), F.when(F.col("seq") % 17 == 0, 2).otherwise(1).alias("ver_num"), F.col("seq").cast("string").alias("raw")))
    path = commits.scratch(spark)
    e.select(F.date_format(stamp, "yyyyMMdd").alias("day"), F.format_string("%02d", F.expr("hour(timestamp_micros(ts_us)) div 6 * 6").cast("int")).alias("hour"), wrapped.alias("value")).repartition(4, "day", "hour").write.partitionBy("day", "hour").option("compression", "gzip").text(path)
    archive.register(spark)
    lines = spark.read.format(archive.NAME).option("cursor", "day=20240110/hour=12").load(path)
    frames, _ = files.archive_lines(lines)
    return frames.select(F.col("value").cast("long").alias("seq"), F.col("local_ts_us").alias("ts_us"))


RESUME_SQL = o.sql(o.EVENTS, last="select seq, ts_us from ev where seq % 17 <> 0 and ts_us >= epoch_us(timestamp '2024-01-10 12:00:00')")


def settlement_cycles(spark: SparkSession, d: str) -> DataFrame:
    """Settlements from dumps that overlap, some of them late or sent twice, in cycles of which one is run again: each stands once."""
    all_ = m.funding(spark, d).select(F.col("ts_us").alias("funding_time_us"), "symbol", F.col("rate").alias("funding_rate"), F.lit(0.0).alias("premium"), "exchange", F.col("ts_us").alias("local_ts_us"), F.lit(0).alias("rtt_us"))
    leaf, source = commits.Leaf(spark, commits.scratch(spark)), reconcile.Source("funding_time_us", "local_ts_us")
    day = F.expr("funding_time_us div 86400000000 - 19723")
    first = all_.where((day < 12) & (F.col("funding_time_us") % 97 != 5))
    second = all_.where(day.between(9, 20))
    for dump in (first.unionByName(first), second, second, all_.where(day < 13), all_.where(day > 18)):
        reconcile.cycle(leaf, "funding_settlements", dump, source, 40 * 24 * reconcile.OVERLAP_US)
    return leaf.read("funding_settlements").select("exchange", "symbol", "funding_time_us", "funding_rate")


SETTLED_SQL = o.sql(o.EVENTS, o.FUNDING, last="select distinct exchange, symbol, ts_us as funding_time_us, rate as funding_rate from funding_ev")


def print_cycles(spark: SparkSession, d: str) -> DataFrame:
    """A live log with gaps and an early end, filled from dumps: inside the gaps that its ledger names, and after its mark."""
    rows = _prints(spark, d).withColumn("day", F.expr("source_trade_ts_us div 86400000000 - 19723"))
    live = rows.where((F.col("day") < 20) & ~F.col("day").isin(5, 6, 11)).drop("seq", "day")
    leaf, source = commits.Leaf(spark, commits.scratch(spark)), reconcile.Source("source_trade_ts_us", "id")
    leaf.commit(live, "trades")
    day_us, base = 86_400_000_000, 19723 * 86_400_000_000
    each = F.array(*(F.struct(F.lit(base + a).alias("opened_us"), F.lit(base + b).alias("closed_us")) for a, b in ((5 * day_us, 7 * day_us - 1), (6 * day_us, 6 * day_us + 5))))
    gaps = live.select("exchange", "symbol").distinct().select("exchange", "symbol", F.inline(each))
    dump = files.conform(rows, "trades").withColumn("origin", F.lit("rest"))
    for _ in range(2):
        reconcile.cycle(leaf, "trades", dump, source, gaps=gaps)
    return leaf.read("trades").select("exchange", "symbol", "id", "source_trade_ts_us", "origin")


PRINTS_SQL = o.sql(
    o.EVENTS, o.TRADES,
    "placed as (select *, ts_us // 86400000000 - 19723 as day from trades_ev)",
    "marks as (select exchange, symbol, max((ts_us, cast(seq as varchar))) as mark from placed where day < 20 and day not in (5, 6, 11) group by all)",
    last="""
select p.exchange, p.symbol, cast(seq as varchar) as id, ts_us as source_trade_ts_us, case when day < 20 and day not in (5, 6, 11) then 'ws' else 'rest' end as origin
from placed p left join marks using (exchange, symbol) where (day < 20 and day not in (5, 6, 11)) or (day in (5, 6) and mark is not null) or mark is null or (ts_us, cast(seq as varchar)) > mark""",
)


def validation_cumulative(spark: SparkSession, d: str) -> DataFrame:
    """Counts and extremes of prints in three runs, one of them repeated, as one state; each run's rows are counted while they are written."""
    state = cumulative.State(spark, commits.scratch(spark), ["exchange"], {"n": "sum", "bad": "sum", "first_us": "min", "last_us": "max", "volume": "sum"})
    path, rows = commits.scratch(spark), _prints(spark, d)
    seen = {}
    for run in (0, 1, 1, 2):
        own = rows.where(F.col("seq") % 3 == run)
        counts = own.groupBy("exchange").agg(F.count("*").alias("n"), F.count(F.when(F.col("price") < 5, 1)).alias("bad"), F.min("source_trade_ts_us").alias("first_us"), F.max("source_trade_ts_us").alias("last_us"), F.sum("amount").cast("double").alias("volume"))
        state.add(str(run), counts)
        metrics = cumulative.measured(own, {"rows": F.count("*")}, lambda f, run=run: f.write.mode("overwrite").parquet(f"{path}/run={run}"))
        seen[run] = metrics["rows"]
    return state.total().withColumn("measured", F.lit(sum(seen.values())))


CUMULATIVE_SQL = o.sql(
    o.EVENTS, o.TRADES,
    last="""
select exchange, count(*) as n, count(*) filter (price < 5) as bad, min(ts_us) as first_us, max(ts_us) as last_us, cast(sum(amount) as double) as volume, sum(count(*)) over () as measured from trades_ev group by exchange""",
)

QUERIES = {
    "committed_trades": committed_trades,
    "leaf_manifest": leaf_manifest,
    "stored_books": stored_books,
    "collapsed_books": collapsed_books,
    "stored_tables": stored_tables,
    "stored_transactions": stored_transactions,
    "archive_resume": archive_resume,
    "settlement_cycles": settlement_cycles,
    "print_cycles": print_cycles,
    "validation_cumulative": validation_cumulative,
}
ORACLE_SQL = {
    "committed_trades": COMMITTED_SQL,
    "leaf_manifest": MANIFEST_SQL,
    "stored_books": STORED_BOOKS_SQL,
    "collapsed_books": COLLAPSED_SQL,
    "stored_tables": TABLES_SQL,
    "stored_transactions": TX_KEYS_SQL,
    "archive_resume": RESUME_SQL,
    "settlement_cycles": SETTLED_SQL,
    "print_cycles": PRINTS_SQL,
    "validation_cumulative": CUMULATIVE_SQL,
}
