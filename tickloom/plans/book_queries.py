"""Queries of the order-book operators, with their oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom.functions import codecs
from tickloom.operators import blocked, books, folds, repair
from tickloom.plans import oracle as o
from tickloom.plans.grid_queries import rounded
from tickloom.sources import mapping as m

DEPTH = 1000.0


def _double(frame: DataFrame, *names: str) -> DataFrame:
    return frame.select(*(F.col(c).cast("double").alias(c) if c in names else F.col(c) for c in frame.columns))


def book_bbo(spark: SparkSession, d: str) -> DataFrame:
    return _double(books.bbo(m.levels(spark, d)), "bid", "ask", "bid_size", "ask_size")


def book_topn(spark: SparkSession, d: str) -> DataFrame:
    return _double(books.top(m.levels(spark, d), 2), "price", "size").select("book", "side", "price", "size", F.col("level").cast("long").alias("level"))


def book_rank(spark: SparkSession, d: str) -> DataFrame:
    return _double(books.ranked(m.levels(spark, d)), "price", "size").select("book", "side", "price", "size", F.col("level").cast("long").alias("level"))


RANK = """
ranked as (
  select book, side, cast(price as double) as price, size, row_number() over (partition by book, side order by case side when 'bid' then -price else price end) - 1 as level from levels)"""


def book_metrics(spark: SparkSession, d: str) -> DataFrame:
    return rounded(books.metrics(m.levels(spark, d)))


METRICS = """
sums as (
  select book, cast(max(price) filter (side = 'bid') as double) as bid, cast(min(price) filter (side = 'ask') as double) as ask,
    coalesce(sum(size) filter (side = 'bid'), 0) as bid_volume, coalesce(sum(size) filter (side = 'ask'), 0) as ask_volume,
    count(*) filter (side = 'bid') as n_bids, count(*) filter (side = 'ask') as n_asks
  from levels group by book)"""


def book_volume_within(spark: SparkSession, d: str) -> DataFrame:
    return books.volume_within(m.levels(spark, d), DEPTH)


WITHIN_SQL = o.sql(
    o.LEVELS,
    "best as (select *, case side when 'bid' then max(price) over (partition by book, side) else min(price) over (partition by book, side) end as top from levels)",
    last=f"""
select book, coalesce(sum(size) filter (side = 'bid' and abs(price - top) <= {DEPTH}), 0) as bid_volume, coalesce(sum(size) filter (side = 'ask' and abs(price - top) <= {DEPTH}), 0) as ask_volume
from best group by book""",
)


def book_final_state(spark: SparkSession, d: str) -> DataFrame:
    return books.final_state(m.deltas(spark, d), m.DELTA_ORDER).select("book", "side", F.col("price").cast("double").alias("price"), "size")


LAST = "(update_id, l_linenumber, ts_us, l_extendedprice, l_discount, l_tax, price, size)"
FINAL_SQL = o.sql(
    o.DELTAS,
    f"last as (select book, side, price, arg_max(size, {LAST}) as size from deltas group by all)",
    last="select book, side, cast(price as double) as price, size from last where size > 0",
)


def book_update_stats(spark: SparkSession, d: str) -> DataFrame:
    return books.update_stats(m.deltas(spark, d), m.DELTA_ORDER)


STATS_SQL = o.sql(
    o.DELTAS,
    """
seen as (
  select book, size > 0 as sets, coalesce(lag(size) over (partition by book, side, price order by update_id, l_linenumber, ts_us, l_extendedprice, l_discount, l_tax, price, size) > 0, false) as there
  from deltas)""",
    last="""
select book, count(*) filter (not there and sets) as inserted, count(*) filter (there and sets) as modified, count(*) filter (there and not sets) as deleted
from seen group by book""",
)


def book_state_pruned(spark: SparkSession, d: str) -> DataFrame:
    """Ten levels a side, cut after every update."""
    return folds.pruned_state(m.deltas(spark, d), 10, m.DELTA_ORDER)


PRUNED_SQL = o.sql(
    o.DELTAS,
    "numbered as materialized (select *, row_number() over (partition by book order by update_id, l_linenumber, ts_us, l_extendedprice, l_discount, l_tax, price, size) as n from deltas)",
    # A list is one side's levels, best first: ten prices and their sizes.
    """
folded as (
  select book, 0::bigint as n, []::struct(p bigint, s double)[] as bids, []::struct(p bigint, s double)[] as asks from (select distinct book from deltas)
  union all select u.book, u.n,
    case when u.side = 'bid' then list_reverse_sort(list_concat(list_filter(f.bids, lambda x: x.p <> u.price), case when u.size > 0 then [{'p': u.price, 's': u.size::double}] else [] end))[1:10] else f.bids end,
    case when u.side = 'ask' then list_sort(list_concat(list_filter(f.asks, lambda x: x.p <> u.price), case when u.size > 0 then [{'p': u.price, 's': u.size::double}] else [] end))[1:10] else f.asks end
  from folded f join numbered u on u.book = f.book and u.n = f.n + 1)""",
    "last as (select book, bids, asks from folded join (select book, max(n) as n from numbered group by book) using (book, n))",
    last="""
select book, 'bid' as side, k - 1 as level, bids[k].p::double as price, bids[k].s as size from last, range(1, 11) r(k) where k <= len(bids)
union all select book, 'ask', k - 1, asks[k].p::double, asks[k].s from last, range(1, 11) r(k) where k <= len(asks)""",
).replace("with", "with recursive", 1)


#: A total order of an order's lines, up to lines that are alike.
LINE_ORDER = ("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")


def book_replay_checksum(spark: SparkSession, d: str) -> DataFrame:
    """An order's lines as messages of a book with checksums; the first and each fourth after it are snapshots, some checksums are wrong or missing."""
    numbered = m.read(spark, d, "lineitem").withColumn("n", F.row_number().over(Window.partitionBy("l_orderkey").orderBy(*LINE_ORDER)))
    line = F.col("n")
    rows = numbered.select(
        F.col("l_orderkey").alias("book"),
        line.cast("long").alias("update_id"),
        (line % 4 == 1).alias("is_snapshot"),
        F.expr("(n - 1) div 4").alias("part"),
        F.struct(
            (F.col("l_linestatus") == "O").alias("bid"),
            (F.col("l_partkey") + F.when(F.col("l_linestatus") == "O", 0).otherwise(10_000_000)).alias("at"),
            F.when(F.col("l_returnflag") == "R", 0).otherwise(F.col("l_quantity").cast("long")).alias("size"),
            line.alias("n"),
        ).alias("l"),
    )
    # The state that a message leads to: the last line of each price since the snapshot.
    so_far = F.collect_list("l").over(Window.partitionBy("book", "part").orderBy("update_id"))
    left = F.filter(so_far, lambda x: ~F.exists(so_far, lambda y: (y["at"] == x["at"]) & (y["n"] > x["n"])) & (x["size"] > 0))

    def text(x):
        return F.struct(x["at"].cast("string").alias("price"), x["size"].cast("string").alias("size"))

    def side(levels, bid: bool):
        own = F.filter(levels, lambda x: x["bid"] if bid else ~x["bid"])
        sign = -1 if bid else 1
        ranked = F.sort_array(F.transform(own, lambda x: F.struct((x["at"] * sign).alias("k"), x["at"], x["size"])))
        return F.transform(ranked, text)

    def alone(bid: bool):
        own = F.col("l.bid") if bid else ~F.col("l.bid")
        return F.filter(F.array(F.when(own, text(F.col("l")))), lambda x: x.isNotNull())

    mark = F.col("book") + F.col("update_id")
    right = codecs.okx_checksum(F.col("all_bids"), F.col("all_asks"))
    states = rows.withColumn("left", left).withColumns({"all_bids": side(F.col("left"), True), "all_asks": side(F.col("left"), False)})
    messages = states.select(
        "book",
        "update_id",
        F.lit(None).cast("long").alias("sequence"),
        "is_snapshot",
        alone(True).alias("bids"),
        alone(False).alias("asks"),
        F.when(mark % 29 != 0, right + F.when(mark % 23 == 0, 1).otherwise(0)).alias("checksum"),
    )
    told = folds.replayed(messages, ["update_id"], recipe="okx", blocks=False)
    return told.select("book", "segment", "applied", "rejected", "gaps", "state", F.size("levels").cast("long").alias("n_levels"))


REPLAY_SQL = """
with ranked as (select *, row_number() over (partition by l_orderkey order by """ + ", ".join(LINE_ORDER) + """) as n from lineitem),
lines as (
  select l_orderkey as book, n, (n - 1) // 4 as part, n % 4 = 1 as whole,
    l_partkey + case when l_linestatus = 'O' then 0 else 10000000 end as spot, case when l_returnflag = 'R' then 0 else l_quantity end as size, l_orderkey + n as mark from ranked),
told as (select *, (mark % 29 = 0 and not whole) or (mark % 29 <> 0 and mark % 23 = 0) as bad from lines),
firsts as (select *, min(n) filter (bad) over (partition by book, part) as first, row_number() over (partition by book, part, spot order by n desc) as latest from told)
select book, sum(count(*) filter (whole)) over (partition by book order by part) as segment, count(*) filter (first is null or n < first) as applied, count(*) filter (n > first) as rejected,
  count(*) filter (n = first) as gaps, case when max(first) is null then 'synced' else 'gapped' end as state, case when max(first) is null then count(*) filter (latest = 1 and size > 0) else 0 end as n_levels
from firsts group by book, part"""


def book_replay_orders(spark: SparkSession, d: str) -> DataFrame:
    """Line items as single orders of one book for each supplier, with snapshots; a book of more than 15 orders is gapped."""
    e = m.read(spark, d, "lineitem")
    one = F.struct(
        (F.col("l_partkey") % 40).cast("string").alias("order_id"),
        (F.col("l_linestatus") == "F").alias("is_ask"),
        (F.col("l_partkey") % 50 + F.when(F.col("l_linestatus") == "F", 1000).otherwise(0)).cast("string").alias("price"),
        F.col("l_quantity").cast("long").cast("string").alias("size"),
        (F.col("l_returnflag") == "R").alias("removed"),
    )
    messages = e.select(F.col("l_suppkey").alias("book"), (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("update_id"), (F.col("l_orderkey") % 23 == 0).alias("is_snapshot"), F.array(one).alias("orders"), F.col("l_partkey").alias("part"))
    told = folds.orders_replayed(messages, ["update_id", "part"], most=15)
    volume = F.aggregate("levels", F.lit(0).cast("long"), lambda a, x: a + x["size"].cast("decimal(18,0)").cast("long"))
    return told.select("book", "segment", "applied", "rejected", "gaps", "state", "n_orders", F.size("levels").cast("long").alias("n_levels"), volume.alias("volume"))


ORDERS_SQL = """
with recursive messages as (
  select l_suppkey as book, l_orderkey * 8 + l_linenumber as update_id, l_partkey as part, (l_orderkey % 23 = 0) as whole, l_partkey % 40 as id,
    l_partkey % 50 + case when l_linestatus = 'F' then 1000 else 0 end as price, cast(l_quantity as bigint) as size, l_returnflag = 'R' as removed from lineitem),
parted as (select *, sum(whole::int) over (partition by book order by update_id, part) as segment from messages),
numbered as materialized (select *, row_number() over (partition by book, segment order by update_id, part) as n from parted),
folded as (
  select book, segment, 0::bigint as n, []::struct(id bigint, price bigint, size bigint)[] as own, false as gapped, 0::bigint as applied, 0::bigint as rejected, 0::bigint as gaps from (select distinct book, segment from numbered)
  union all select book, segment, n, case when gapped or len(next) > 15 then [] else next end, gapped or len(next) > 15, applied + (not gapped and len(next) <= 15)::int, rejected + gapped::int, gaps + (not gapped and len(next) > 15)::int
  from (
    select u.book, u.segment, u.n, f.gapped, f.applied, f.rejected, f.gaps,
      list_concat(list_filter(f.own, lambda x: x.id <> u.id), case when u.removed then [] else [{'id': u.id, 'price': u.price, 'size': u.size}] end) as next
    from folded f join numbered u on u.book = f.book and u.segment = f.segment and u.n = f.n + 1)),
last as (select * from folded join (select book, segment, max(n) as n from numbered group by all) using (book, segment, n))
select book, cast(segment as bigint) as segment, applied, rejected, gaps, case when gapped then 'gapped' else 'synced' end as state, len(own) as n_orders, len(list_distinct(list_transform(own, lambda x: x.price))) as n_levels,
  cast(coalesce(list_sum(list_transform(own, lambda x: x.size)), 0) as bigint) as volume from last"""


def l3_to_l2(spark: SparkSession, d: str) -> DataFrame:
    """Line items as single orders: line number and order name an order, later rows change it, returned ones remove it."""
    e = m.deltas(spark, d)
    orders = e.select(
        "book",
        F.concat_ws("-", F.col("update_id") % 500, "l_linenumber").alias("order_id"),
        "side",
        (F.col("price") % 50).alias("price"),
        "size",
        (F.col("size") == 0).alias("removed"),
        *(c for c in m.DELTA_ORDER if c not in ("price", "size")),
        F.col("price").alias("full_price"),
    )
    order = [c if c != "price" else "full_price" for c in m.DELTA_ORDER]
    return books.l3_to_l2(orders, order).select("book", "side", "price", "size", "n_orders")


L3_SQL = o.sql(
    o.DELTAS,
    f"""
last as (
  select book, cast(update_id % 500 as varchar) || '-' || cast(l_linenumber as varchar) as order_id, arg_max({{'side': side, 'price': price % 50, 'size': size}}, {LAST}) as x
  from deltas group by all)""",
    last="select book, x.side as side, x.price as price, sum(x.size) as size, count(*) as n_orders from last where x.size > 0 group by all",
)


def _sequenced(spark: SparkSession, d: str) -> DataFrame:
    """Orders of a customer as updates; each names the one before it, with a few faults."""
    from pyspark.sql import Window

    orders = m.read(spark, d, "orders").select((F.col("o_custkey") % 97).alias("book"), F.col("o_orderkey").alias("update_id"))
    told = blocked.scanned(orders, ["book"], ["update_id"], {"last": ("lag", F.col("update_id"))})
    return told.withColumn("sequence", F.coalesce("last", F.lit(0)) + F.when(F.col("update_id") % 13 == 0, 1).otherwise(0)).drop("last")


SEQUENCED = """
sequenced as (
  select book, update_id, coalesce(lag(update_id) over (partition by book order by update_id), 0) + case when update_id % 13 = 0 then 1 else 0 end as sequence
  from (select o_custkey % 97 as book, o_orderkey as update_id from orders)),
held as (select *, lag(update_id) over (partition by book order by update_id) as last from sequenced)"""


def book_seq_gaps(spark: SparkSession, d: str) -> DataFrame:
    """Breaks of each book under the three predicates."""
    return books.break_counts(_sequenced(spark, d), list(books.PREDICATES), ["update_id"])


SEQ_SQL = o.sql(
    SEQUENCED,
    last=" union all ".join(
        f"select book, count(*) as n, count(*) filter (last is not null and not ({test})) as breaks, '{name}' as predicate from held group by book"
        for name, test in (("range_inclusive", "sequence <= last + 1 and update_id > last"), ("exact_prev", "sequence = last"), ("monotonic", "update_id > last"))
    ),
)


def book_dense_gaps(spark: SparkSession, d: str) -> DataFrame:
    rows = m.read(spark, d, "orders").select((F.col("o_custkey") % 97).alias("book"), F.col("o_orderkey").alias("sequence"))
    return books.dense_breaks(rows, ["sequence"]).groupBy("book").agg(F.coalesce(F.sum("skipped"), F.lit(0)).alias("skipped"))


DENSE_SQL = """
select book, cast(coalesce(sum(greatest(sequence - last - 1, 0)), 0) as bigint) as skipped
from (select book, sequence, lag(sequence) over (partition by book order by sequence) as last from (select o_custkey % 97 as book, o_orderkey as sequence from orders)) group by book"""


def _wire_sides(spark: SparkSession, d: str) -> DataFrame:
    """Sides as arrays of wire text, best level first."""
    level = F.struct("level", F.struct(F.col("price").cast("decimal(18,2)").cast("string").alias("price"), F.col("size").cast("decimal(18,1)").cast("string").alias("size")).alias("l"))
    sides = books.top(m.levels(spark, d), 25).groupBy("book").agg(*(F.array_sort(F.collect_list(F.when(F.col("side") == s, level))).alias(f"{s}s") for s in ("bid", "ask")))
    return sides.select("book", *(F.transform(c, lambda x: x["l"]).alias(c) for c in ("bids", "asks")))


def book_checksum(spark: SparkSession, d: str) -> DataFrame:
    sides = _wire_sides(spark, d)
    return sides.select("book", codecs.okx_checksum(F.col("bids"), F.col("asks")).alias("okx"), codecs.kraken_checksum(F.col("bids"), F.col("asks")).alias("kraken"))


# CRC-32 bit by bit: the reflected polynomial over the text's bytes (all ASCII).
CRC = """(select xor(4294967295, list_reduce(list_prepend(4294967295::bigint, list_transform(string_split({text}, ''), lambda c: ord(c)::bigint)),
  lambda a, c: list_reduce(list_prepend(xor(a, c), [1, 2, 3, 4, 5, 6, 7, 8]), lambda r, i: xor(r >> 1, case when r & 1 = 1 then 3988292384 else 0 end)))))"""
CHECKSUM_SQL = o.sql(
    o.LEVELS,
    "ranked as (select *, row_number() over (partition by book, side order by case side when 'bid' then -price else price end) as k from levels)",
    "texts as (select book, side, k, cast(cast(price as decimal(18,2)) as varchar) as p, cast(cast(size as decimal(18,1)) as varchar) as s from ranked where k <= 25)",
    """
joined as (
  select book, coalesce(string_agg(p || ':' || s, ':' order by k, side desc), '') as okx,
    coalesce(string_agg(ltrim(replace(p, '.', ''), '0') || ltrim(replace(s, '.', ''), '0'), '' order by k) filter (side = 'ask' and k <= 10), '')
    || coalesce(string_agg(ltrim(replace(p, '.', ''), '0') || ltrim(replace(s, '.', ''), '0'), '' order by k) filter (side = 'bid' and k <= 10), '') as kraken
  from texts group by book)""",
    f"sums as (select book, {CRC.format(text='okx')} as okx, {CRC.format(text='kraken')} as kraken from joined)",
    last="select book, case when okx > 2147483647 then okx - 4294967296 else okx end as okx, kraken from sums",
)


def seed_reconcile(spark: SparkSession, d: str) -> DataFrame:
    """A seed per supplier at its median order; updates it covers and updates replayed on it."""
    deltas = m.deltas(spark, d)
    seeds = deltas.groupBy("book").agg(F.expr("(min(update_id) + max(update_id)) div 2").alias("seed_id"))
    met = books.seed_reconcile(seeds, deltas)
    return met.groupBy("book").agg(F.count(F.when(F.col("replayed"), 1)).alias("replayed"), F.count(F.when(~F.col("replayed"), 1)).alias("covered"))


SEED_SQL = o.sql(
    o.DELTAS,
    "seeds as (select book, (min(update_id) + max(update_id)) // 2 as seed_id from deltas group by book)",
    last="select book, count(*) filter (update_id > seed_id) as replayed, count(*) filter (update_id <= seed_id) as covered from deltas join seeds using (book) group by book",
)


def book_conformance(spark: SparkSession, d: str) -> DataFrame:
    return books.conformance(m.levels(spark, d))


def book_order_faults(spark: SparkSession, d: str) -> DataFrame:
    """Levels in stored (price) order: bids stored ascending break the rule."""
    from pyspark.sql import Window

    stored = m.levels(spark, d).withColumn("level", F.row_number().over(Window.partitionBy("book", "side").orderBy("price")))
    return books.order_faults(stored)


def decompose_restamp(spark: SparkSession, d: str) -> DataFrame:
    """Books of hourly rows: stamped with the row or their own time, the true time kept."""
    hour = o.HOUR
    q = m.quotes(spark, d)
    rows = q.select(
        "seq",
        F.expr(f"ts_us div {hour} * {hour}").alias("tick_us"),
        F.col("ts_us").alias("orderbook_ts_us"),
        F.when(F.col("seq") % 2 == 0, F.col("ts_us") - 5).otherwise(F.lit(0).cast("long")).alias("source_orderbook_ts_us"),
        F.when(F.col("seq") % 3 == 0, F.col("ts_us") + 5).otherwise(F.lit(0).cast("long")).alias("local_orderbook_ts_us"),
    )
    return repair.restamped(rows)


RESTAMP_SQL = o.sql(
    o.EVENTS, o.QUOTES,
    last=f"""
select seq, ts_us // {o.HOUR} * {o.HOUR} as tick_us, greatest(ts_us // {o.HOUR} * {o.HOUR}, ts_us) as orderbook_ts_us,
  case when seq % 2 <> 0 and seq % 3 <> 0 then ts_us when seq % 2 = 0 then ts_us - 5 else 0 end as source_orderbook_ts_us,
  case when seq % 3 = 0 then ts_us + 5 else 0 end as local_orderbook_ts_us from quotes_ev""",
)

QUERIES = {
    "book_bbo": book_bbo,
    "book_topn": book_topn,
    "book_rank": book_rank,
    "book_metrics": book_metrics,
    "book_volume_within": book_volume_within,
    "book_final_state": book_final_state,
    "book_update_stats": book_update_stats,
    "book_state_pruned": book_state_pruned,
    "book_replay_checksum": book_replay_checksum,
    "book_replay_orders": book_replay_orders,
    "l3_to_l2": l3_to_l2,
    "book_seq_gaps": book_seq_gaps,
    "book_dense_gaps": book_dense_gaps,
    "book_checksum": book_checksum,
    "seed_reconcile": seed_reconcile,
    "book_conformance": book_conformance,
    "book_order_faults": book_order_faults,
    "decompose_restamp": decompose_restamp,
}
ORACLE_SQL = {
    "book_state_pruned": PRUNED_SQL,
    "book_replay_checksum": REPLAY_SQL,
    "book_replay_orders": ORDERS_SQL,
    "book_checksum": CHECKSUM_SQL,
    "book_bbo": o.sql(
        o.LEVELS,
        last="""
select book, cast(max(price) filter (side = 'bid') as double) as bid, arg_max(size, price) filter (side = 'bid') as bid_size,
  cast(min(price) filter (side = 'ask') as double) as ask, arg_min(size, price) filter (side = 'ask') as ask_size from levels group by book""",
    ),
    "book_topn": o.sql(o.LEVELS, RANK, last="select * from ranked where level < 2"),
    "book_rank": o.sql(o.LEVELS, RANK, last="select * from ranked"),
    "book_metrics": o.sql(
        o.LEVELS, METRICS,
        last="""
select *, round((bid + ask) / 2, 6) as mid_price, round(ask - bid, 6) as spread, round(case when bid + ask > 0 then (ask - bid) / ((bid + ask) / 2) * 10000 end, 6) as spread_bps,
  round((bid_volume - ask_volume) / nullif(bid_volume + ask_volume, 0), 6) as imbalance, coalesce(bid >= ask, false) as crossed from sums""",
    ),
    "book_volume_within": WITHIN_SQL,
    "book_final_state": FINAL_SQL,
    "book_update_stats": STATS_SQL,
    "l3_to_l2": L3_SQL,
    "book_seq_gaps": SEQ_SQL,
    "book_dense_gaps": DENSE_SQL,
    "seed_reconcile": SEED_SQL,
    "book_conformance": o.sql(
        o.LEVELS, METRICS,
        last="""
select book, coalesce(bid > ask, false) as crossed, n_bids = 0 or n_asks = 0 as one_sided, (select count(*) from levels l where l.book = sums.book and (price <= 0 or size <= 0)) as not_positive from sums""",
    ),
    "book_order_faults": o.sql(
        o.LEVELS,
        "held as (select book, side, price, lag(price) over (partition by book, side order by price) as before from levels)",
        last="select book, count(*) filter (case side when 'bid' then price >= before else price <= before end) as faults from held group by book",
    ),
    "decompose_restamp": RESTAMP_SQL,
}
