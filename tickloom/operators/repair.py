"""Repair of trade logs from a second source, decomposition of grid snapshots, and duplicate suppression."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.operators.trades import dedup

PAIR = ("exchange", "symbol")


def _numbered(frame: DataFrame) -> DataFrame:
    """Rows with a numeric id; others cannot be placed and are left out of a merged log."""
    return frame.withColumn("_number", F.col("id").try_cast("decimal(20,0)")).where("_number is not null")


def missing(own: DataFrame, other: DataFrame, key: Sequence[str] = PAIR) -> DataFrame:
    """Rows of the other source that the log lacks, within the log's id range."""
    have = _numbered(own)
    span = have.groupBy(*key).agg(F.min("_number").alias("_a"), F.max("_number").alias("_b"))
    near = _numbered(other).join(span, list(key)).where("_number between _a and _b").drop("_a", "_b")
    return near.join(have.select(*key, "_number"), [*key, "_number"], "left_anti").drop("_number")


def rehydrate(own: DataFrame, other: DataFrame, key: Sequence[str] = PAIR, order: Sequence[str] = ("ts_us",)) -> DataFrame:
    """The log with its holes filled; ids occur once, the log's own row first. Columns are the log's."""
    found = missing(own, other, key).select(*own.columns)
    both = _numbered(own).withColumn("_from", F.lit(0)).unionByName(_numbered(found).withColumn("_from", F.lit(1)))
    return dedup(both, [*key, "_number"], ["_from", *order], ["id"]).drop("_from", "_number")


def report(own: DataFrame, other: DataFrame, key: Sequence[str] = PAIR) -> DataFrame:
    """(key, present, recovered, merged)."""
    merged = rehydrate(own, other, key)
    had = _numbered(own).select(*key, "_number").distinct().groupBy(*key).agg(F.count("*").alias("present"))
    total = merged.groupBy(*key).agg(F.count("*").alias("merged"))
    return had.join(total, list(key)).select(*key, "present", (F.col("merged") - F.col("present")).alias("recovered"), "merged")


def without_recent(live: DataFrame, recovered: DataFrame, key: Sequence[str] = (*PAIR, "id")) -> DataFrame:
    """Recovered rows that the live feed didn't bring itself."""
    return recovered.join(live.select(*key).distinct(), list(key), "left_anti")


def restamped(books: DataFrame, tick: str = "tick_us", book: str = "orderbook_ts_us", source: str = "source_orderbook_ts_us", local: str = "local_orderbook_ts_us") -> DataFrame:
    """Books of a grid row stamped with the row's time or their own, whichever is later; the true time goes to the source column where it is unknown."""
    unknown = (F.col(source) == 0) & (F.col(local) == 0)
    true_time = F.when(unknown, F.col(book)).otherwise(F.col(source))
    return books.withColumn(source, true_time).withColumn(book, F.greatest(tick, book))


def decompose(snapshots: DataFrame) -> dict[str, DataFrame]:
    """Seven tables from grid snapshots: (ts_us, book, trades, liquidations, funding, open_interest, settlements, transactions).

    List columns hold canonical rows, ``book`` one book with its levels. Every
    table is a projection of the same plan. Funding and open-interest pushes,
    settlements and transactions occur once.
    """

    def rows(column: str) -> DataFrame:
        return snapshots.select(F.explode(column).alias("x")).select("x.*")

    def pushes(column: str) -> DataFrame:
        frame = rows(column)
        key = ["exchange", "symbol", "conn_epoch_us", "recv_seq"]
        return frame.where("recv_seq > 0").dropDuplicates(key).unionByName(frame.where("recv_seq = 0"))

    books = snapshots.where("book is not null").select(F.col("ts_us").alias("tick_us"), "book.*")
    return {
        "orderbooks": restamped(books).drop("tick_us"),
        "trades": rows("trades"),
        "liquidations": rows("liquidations"),
        "funding_rates": pushes("funding"),
        "open_interests": pushes("open_interest"),
        "funding_settlements": rows("settlements").dropDuplicates(["exchange", "symbol", "funding_time_us"]),
        "transactions": rows("transactions").dropDuplicates(["address", "signature"]),
    }


def has_data(snapshots: DataFrame) -> DataFrame:
    """Snapshots that hold anything at all."""
    lists = ("trades", "liquidations", "funding", "open_interest", "settlements", "transactions")
    return snapshots.where(F.col("book").isNotNull() | (F.greatest(*(F.coalesce(F.size(c), F.lit(0)) for c in lists)) > 0))
