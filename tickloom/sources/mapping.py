"""The star-schema and event tables seen as market streams.

Pure projections: each takes (spark, folder) and returns a canonical stream.
Prices and amounts are exact decimals.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

VENUES = ("binance", "bybit", "coinbase", "kraken")


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events: exchange, symbol, ts_us, seq, event_type, value, k, user_id."""
    venue = F.element_at(F.array(*(F.lit(v) for v in VENUES)), (F.col("user_id") % 4 + 1).cast("int"))
    return read(spark, sf_dir, "events").select(
        venue.alias("exchange"),
        F.concat(F.lit("U"), F.col("user_id") % 5, F.lit("/USD")).alias("symbol"),
        F.unix_micros(F.col("ts").cast("timestamp")).alias("ts_us"),
        F.col("event_id").alias("seq"),
        "event_type",
        "value",
        F.get_json_object("props", "$.k").cast("long").alias("k"),
        "user_id",
    )


def _prints(frame: DataFrame, side) -> DataFrame:
    return frame.select("exchange", "symbol", "ts_us", "seq", side.alias("side"), F.col("value").cast("decimal(18,2)").alias("price"), F.col("k").cast("decimal(18,0)").alias("amount"))


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    side = F.when(F.col("event_type") == "click", "buy").otherwise("sell")
    return _prints(events(spark, sf_dir).where(F.col("event_type").isin("click", "purchase")), side)


def liquidations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _prints(events(spark, sf_dir).where("event_type = 'error'"), F.when(F.col("k") % 2 == 0, "buy").otherwise("sell"))


def quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top-of-book snapshots."""
    cents = F.col("value").cast("decimal(18,2)")
    return events(spark, sf_dir).where("event_type = 'view'").select(
        "exchange",
        "symbol",
        "ts_us",
        "seq",
        cents.cast("double").alias("bid"),
        (cents + ((F.col("k") + 1) * F.lit(0.01).cast("decimal(3,2)")).cast("decimal(18,2)")).cast("double").alias("ask"),
        (F.col("k") + 1).alias("bid_volume"),
        (F.col("user_id") + 1).alias("ask_volume"),
    )


def funding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Funding samples: an hourly or eight-hourly venue by user, next settlement at the following full hour."""
    hour = 3_600_000_000
    return events(spark, sf_dir).where("event_type = 'signup'").select(
        "exchange",
        "symbol",
        "ts_us",
        "seq",
        (F.col("value") / 1e6).alias("rate"),
        F.when(F.col("user_id") % 2 == 0, 1).otherwise(8).alias("interval_hours"),
        F.when(F.col("k") % 3 == 0, F.lit(0).cast("long")).otherwise(F.expr(f"(ts_us div {hour} + 1) * {hour}")).alias("next_funding_ts_us"),
    )


def open_interest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).where("event_type = 'signup'").select(
        "exchange",
        "symbol",
        "ts_us",
        "seq",
        (F.col("k") * 10).cast("double").alias("oi"),
        F.when(F.col("k") % 4 == 0, F.col("k") * 1000).cast("double").alias("oi_value"),
        F.col("value").alias("mark_px"),
    )


def fills(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as trade prints whose identity repeats: the same order and line number may come with other content."""
    return read(spark, sf_dir, "lineitem").select(
        F.lit("binance").alias("exchange"),
        F.concat(F.lit("S"), F.col("l_suppkey"), F.lit("/USD")).alias("symbol"),
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("id"),
        "l_orderkey",
        "l_linenumber",
        F.unix_micros(F.col("l_shipdate").cast("timestamp")).alias("ts_us"),
        F.when(F.col("l_returnflag") == "R", "sell").otherwise("buy").alias("side"),
        (F.col("l_extendedprice").cast("decimal(18,2)") / F.col("l_quantity").cast("decimal(18,0)")).cast("decimal(18,2)").alias("price"),
        F.col("l_quantity").cast("decimal(18,0)").alias("amount"),
        "l_partkey",
        "l_suppkey",
        "l_extendedprice",
        "l_discount",
        "l_tax",
        "l_linestatus",
        "l_returnflag",
    )


#: A total order of line items.
FILL_ORDER = ("ts_us", "l_partkey", "l_suppkey", "amount", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus")


def levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as book levels: a book for each order, open lines bid, finished ones ask; a price's sizes add up."""
    return (
        read(spark, sf_dir, "lineitem")
        .select(
            F.col("l_orderkey").alias("book"),
            F.when(F.col("l_linestatus") == "O", "bid").otherwise("ask").alias("side"),
            F.col("l_partkey").cast("decimal(18,0)").alias("price"),
            F.col("l_quantity").cast("decimal(18,0)").alias("size"),
        )
        .groupBy("book", "side", "price")
        .agg(F.sum("size").cast("decimal(18,0)").alias("size"))
    )


def deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as level updates of one book for each supplier; returned lines delete their level."""
    return read(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("book"),
        F.when(F.col("l_linestatus") == "O", "bid").otherwise("ask").alias("side"),
        F.col("l_partkey").alias("price"),
        F.when(F.col("l_returnflag") == "R", 0.0).otherwise(F.col("l_quantity")).alias("size"),
        F.col("l_orderkey").alias("update_id"),
        "l_linenumber",
        F.unix_micros(F.col("l_shipdate").cast("timestamp")).alias("ts_us"),
        "l_extendedprice",
        "l_discount",
        "l_tax",
    )


#: A total order of level updates of one book, up to updates that are alike.
DELTA_ORDER = ("update_id", "l_linenumber", "ts_us", "l_extendedprice", "l_discount", "l_tax", "price", "size")
