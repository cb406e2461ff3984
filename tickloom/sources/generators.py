"""Random market data from a seed: prints, liquidations, orders, books. The same seed gives the same rows whatever the partitioning.

``n`` is a number of rows, or a frame whose ``id`` column names them: noise for the rows of a table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

START_US = 1_700_000_000_000_000


def uniform(seed: int, salt: str) -> Column:
    """A number in [0, 1) for each id, by hashing: unlike rand(), it doesn't depend on partitions."""
    return F.pmod(F.xxhash64(F.lit(seed), F.lit(salt), "id"), F.lit(1 << 52)) / float(1 << 52)


def pick(values: tuple[str, ...], seed: int, salt: str) -> Column:
    return F.element_at(F.array(*(F.lit(v) for v in values)), (uniform(seed, salt) * len(values)).cast("int") + 1)


def _ids(spark: SparkSession, n: int | DataFrame) -> DataFrame:
    return spark.range(n) if isinstance(n, int) else n.select(F.col("id").cast("long").alias("id"))


def trades(spark: SparkSession, n: int | DataFrame, seed: int = 0, symbol: str = "BTC/USDT", exchange: str = "binance") -> DataFrame:
    return _ids(spark, n).select(
        (F.lit(START_US) + F.col("id") * 1000 + (uniform(seed, "t") * 1000).cast("long")).alias("source_trade_ts_us"), F.lit(symbol).alias("symbol"), pick(("buy", "sell"), seed, "side").alias("side"),
        F.round(100 + 10 * uniform(seed, "p"), 2).alias("price"), F.round(0.001 + uniform(seed, "a"), 6).alias("amount"), F.lit(exchange).alias("exchange"), F.col("id").cast("string").alias("id"),
        F.lit(0).cast("long").alias("local_trade_ts_us"), F.lit(0).cast("long").alias("source_trade_rtt_us"), F.lit("ws").alias("origin"),
    )


def liquidations(spark: SparkSession, n: int | DataFrame, seed: int = 0, symbol: str = "BTC/USDT", exchange: str = "bybit") -> DataFrame:
    return trades(spark, n, seed, symbol, exchange).select(F.col("source_trade_ts_us").alias("liquidation_ts_us"), "symbol", "side", "price", "amount", "exchange")


def orders(spark: SparkSession, n: int | DataFrame, seed: int = 0) -> DataFrame:
    return _ids(spark, n).select("id", pick(("bid", "ask"), seed, "side").alias("side"), pick(("market", "limit"), seed, "kind").alias("kind"), (F.lit(START_US) + F.col("id")).alias("ts_us"), F.round(100 + uniform(seed, "p"), 2).alias("price"), F.round(0.001 + uniform(seed, "a"), 6).alias("amount"))


def books(spark: SparkSession, n: int | DataFrame, depth: int = 10, seed: int = 0, tick: float = 0.01) -> DataFrame:
    """``n`` books of ``depth`` levels a side around a walking mid; never crossed."""
    mid = F.round(100 + uniform(seed, "m"), 2)
    each = _ids(spark, n).select("id", mid.alias("mid"), F.explode(F.sequence(F.lit(0), F.lit(depth - 1))).alias("level"))
    sides = each.select("*", F.explode(F.array(F.lit("bid"), F.lit("ask"))).alias("side"))
    step = (F.col("level") + 1) * tick
    size = F.pmod(F.xxhash64(F.lit(seed), "id", "level", "side"), F.lit(1000)) / 100.0 + 0.01
    return sides.select(F.col("id").alias("book"), "side", F.round(F.when(F.col("side") == "bid", F.col("mid") - step).otherwise(F.col("mid") + step), 2).alias("price"), F.round(size, 2).alias("size"), F.col("level").cast("long").alias("level"))
