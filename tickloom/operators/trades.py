"""Trade logs: filters that count what they drop, dedup, continuity, silences, taker aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.scalars import decimal, div, possible_dropped, trade_side
from tickloom.operators import blocked

PAIR = ("exchange", "symbol")

# Microseconds of 2020-01-01 and 2100-01-01.
EARLIEST_US, LATEST_US = 1_577_836_800_000_000, 4_102_444_800_000_000


def judged(raw: DataFrame, side: str = "side", price: str = "price", amount: str = "amount", ts: str = "ts_us") -> DataFrame:
    """Raw prints with parsed columns and the first reason to drop them, or null."""
    parsed = raw.withColumns({"side_ok": trade_side(F.col(side)), "price_ok": decimal(F.col(price).cast("string")), "amount_ok": decimal(F.col(amount).cast("string"))})
    reason = (
        F.when(F.col("side_ok").isNull(), "side")
        .when(F.col("price_ok").isNull() | F.col("amount_ok").isNull(), "decimal")
        .when((F.col("price_ok") <= 0) | (F.col("amount_ok") <= 0), "not_positive")
        .when(~F.col(ts).between(EARLIEST_US, LATEST_US - 1), "time")
    )
    return parsed.withColumn("reason", reason)


def accepted(raw: DataFrame, **names: str) -> DataFrame:
    return judged(raw, **names).where("reason is null").drop("reason")


def drop_counts(raw: DataFrame, key: Sequence[str] = PAIR, **names: str) -> DataFrame:
    """How many prints of each key each reason drops."""
    kinds = ("side", "decimal", "not_positive", "time")
    return judged(raw, **names).groupBy(*key).agg(F.count("*").alias("n"), *(F.count(F.when(F.col("reason") == k, 1)).alias(f"dropped_{k}") for k in kinds))


def tracked(frame: DataFrame, wanted: DataFrame, key: Sequence[str] = PAIR) -> DataFrame:
    """Rows of the instruments on a list; Catalyst broadcasts the list while its size allows that."""
    return frame.join(wanted.select(*key), list(key), "left_semi")


def ranked(frame: DataFrame, identity: Sequence[str], order: Sequence[str], content: Sequence[str]) -> DataFrame:
    """Rows numbered inside their identity, and whether their content differs from the first row's.

    The first row of an identity wins. Identities are many and small, so the
    window deals out evenly.
    """
    own = Window.partitionBy(*identity).orderBy(*order)
    first = F.first(F.struct(*content)).over(own.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return frame.withColumn("nth", F.row_number().over(own)).withColumn("differs", F.struct(*content) != first)


def dedup(frame: DataFrame, identity: Sequence[str], order: Sequence[str], content: Sequence[str]) -> DataFrame:
    """The first row of every identity."""
    return ranked(frame, identity, order, content).where("nth = 1").drop("nth", "differs")


def dedup_report(frame: DataFrame, identity: Sequence[str], order: Sequence[str], content: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Rows removed by dedup, and how many of them contradict the row that stays."""
    rows = ranked(frame, identity, order, content)
    return rows.groupBy(*by).agg(F.count("*").alias("n"), F.count(F.when(F.col("nth") > 1, 1)).alias("removed"), F.count(F.when(F.col("differs"), 1)).alias("conflicts"))


def drop_pushes(frame: DataFrame, key: Sequence[str] = (*PAIR, "conn_epoch_us", "recv_seq"), sequence: str = "recv_seq") -> DataFrame:
    """One row of each push; rows without a sequence (0) are all kept."""
    return frame.where(F.col(sequence) > 0).dropDuplicates(list(key)).unionByName(frame.where((F.col(sequence) <= 0) | F.col(sequence).isNull()))


def continuity(frame: DataFrame, seq: str = "seq", arrival: Sequence[str] = ("ts_us",), key: Sequence[str] = PAIR) -> DataFrame:
    """Prints with ``missed`` (sequence numbers skipped before them) and ``duplicate``; the highest number so far carries over reconnects."""
    rows = blocked.with_highest(frame, F.col(seq), "highest", key, arrival)
    ahead = F.col(seq) - F.col("highest") - 1
    return rows.withColumn("missed", F.when(ahead > 0, ahead).otherwise(F.lit(0).cast("long"))).withColumn("duplicate", F.coalesce(F.col(seq) <= F.col("highest"), F.lit(False)))


def loss(frame: DataFrame, key: Sequence[str] = PAIR, **how) -> DataFrame:
    """(key, trades, gap_events, trades_lost, duplicates)."""
    rows = continuity(frame, key=key, **how)
    return rows.groupBy(*key).agg(
        F.count(F.when(~F.col("duplicate"), 1)).alias("trades"),
        F.count(F.when(F.col("missed") > 0, 1)).alias("gap_events"),
        F.sum("missed").alias("trades_lost"),
        F.count(F.when(F.col("duplicate"), 1)).alias("duplicates"),
    )


def silences(frame: DataFrame, threshold_us: int = 5_000_000, key: Sequence[str] = PAIR, ts: str = "ts_us") -> DataFrame:
    """(key, opened_us, closed_us, window_us): stretches without events longer than the threshold."""
    # In time order the time of the row before is the greatest so far.
    rows = blocked.scanned(frame.select(*key, ts), key, [ts], {"opened_us": ("max", F.col(ts))})
    gaps = rows.select(*key, "opened_us", F.col(ts).alias("closed_us"))
    return gaps.withColumn("window_us", F.col("closed_us") - F.col("opened_us")).where(F.col("window_us") > threshold_us)


def silence_stats(frame: DataFrame, threshold_us: int = 5_000_000, key: Sequence[str] = PAIR, **how) -> DataFrame:
    return silences(frame, threshold_us, key, **how).groupBy(*key).agg(F.count("*").alias("n_gaps"), div(F.sum("window_us"), 1000).alias("total_ms"), F.max("window_us").alias("longest_us"))


def trailing_count(frame: DataFrame, span_us: int = 60_000_000, cap: int = 4096, key: Sequence[str] = PAIR, ts: str = "ts_us") -> DataFrame:
    """Prints with how many fell into the span up to them, at most ``cap``."""
    counted = blocked.count_within(frame, span_us, "trailing", key, ts)
    return counted.withColumn("trailing", F.least("trailing", F.lit(cap).cast("long")))


def incidents(frame: DataFrame, threshold_us: int, span_us: int, key: Sequence[str] = PAIR) -> DataFrame:
    """The gap ledger of a trade log: silences with the prints that they may have cost at the rate before them."""
    rated = trailing_count(frame, span_us, key=key)
    # Rows of one time have one trailing count, so time alone orders them.
    each = blocked.scanned(rated.select(*key, "ts_us", "trailing"), key, ["ts_us"], {"opened_us": ("max", F.col("ts_us")), "before": ("lag", F.col("trailing"))})
    gaps = each.select(*key, "opened_us", F.col("ts_us").alias("closed_us"), "before")
    gaps = gaps.withColumn("window_us", F.col("closed_us") - F.col("opened_us")).where(F.col("window_us") > threshold_us)
    return gaps.withColumn("possible_dropped", possible_dropped(F.col("before") * (60_000_000 / span_us), F.col("window_us")))


def ledger_rows(gaps: DataFrame, cause: str = "disconnect") -> DataFrame:
    """Incidents as the rows of a gap ledger; causes are resync, disconnect and slot_gap."""
    if cause not in ("resync", "disconnect", "slot_gap"):
        raise ValueError(f"unknown cause: {cause}")
    return gaps.select(F.col("opened_us").alias("opened_epoch_us"), F.col("closed_us").alias("closed_epoch_us"), "window_us", F.lit(cause).alias("cause"), "exchange", "symbol", F.col("possible_dropped").alias("possible_dropped_trades"))


def regressions(frame: DataFrame, key: Sequence[str] = PAIR, arrival: Sequence[str] = ("seq",), ts: str = "ts_us") -> DataFrame:
    """(key, regressed): events whose wire time lies before an earlier arrival's."""
    rows = blocked.with_highest(frame.select(*dict.fromkeys([*key, *arrival, ts])), F.col(ts), "_highest", key, arrival)
    return rows.select(*key, (F.col(ts) < F.col("_highest")).alias("back")).groupBy(*key).agg(F.count(F.when(F.col("back"), 1)).alias("regressed"))


RULES = "taker.v1"


def takers(frame: DataFrame, bucket_us: int, key: Sequence[str] = PAIR, order: Sequence[str] = ("ts_us", "seq"), evidence: str = "numeric_id") -> DataFrame:
    """Fills grouped to takers and reduced.

    A taker's fills share pair, side and time bucket and walk the book one way:
    a buy's prices don't fall, a sell's don't rise; a fill that turns back
    starts the next taker. The k-th of m takers of a bucket sits at
    bucket + width * (k - 1) / m. Takers without quantity are left out. (The
    reduction is fixed; the grouping is this engine's reading of its rules.)
    """
    if bucket_us <= 0:
        raise ValueError("bucket_us must be positive")
    bucket = div(F.col("ts_us"), bucket_us) * bucket_us
    own = Window.partitionBy(*key, "side", "bucket_us").orderBy(*order)
    rows = frame.withColumn("bucket_us", bucket)
    last = F.lag("price").over(own)
    turned = F.when(F.col("side") == "buy", F.col("price") < last).otherwise(F.col("price") > last)
    rows = rows.withColumn("taker", F.sum(F.coalesce(turned, F.lit(False)).cast("long")).over(own.rowsBetween(Window.unboundedPreceding, 0)))
    at = F.struct(*order)
    made = rows.groupBy(*key, "side", "bucket_us", "taker").agg(
        F.min("ts_us").alias("first_us"),
        F.min(at).alias("begin"),
        F.count("*").alias("n_fills"),
        F.sum("amount").alias("qty"),
        F.sum(F.col("price") * F.col("amount")).alias("notional"),
        F.min_by("price", at).alias("px_first"),
        F.max_by("price", at).alias("px_last"),
        F.min("price").alias("px_min"),
        F.max("price").alias("px_max"),
        F.min_by("seq", at).cast("string").alias("id_first"),
        F.max_by("seq", at).cast("string").alias("id_last"),
    )
    made = made.where("qty > 0")
    peers = Window.partitionBy(*key, "bucket_us")
    k, m = F.row_number().over(peers.orderBy("begin", "side")), F.count("*").over(peers)
    split = F.count("*").over(Window.partitionBy(*key, "side", "bucket_us"))
    reason = F.when(split > 1, "direction_split").when(F.col("n_fills") == 1, "single").when(F.col("px_min") == F.col("px_max"), "same_price").otherwise("swept")
    return made.select(
        (F.col("bucket_us") + div(F.lit(bucket_us).cast("long") * (k - 1), m)).alias("ts_us"),
        "bucket_us",
        F.lit(bucket_us).cast("long").alias("w_us"),
        *key,
        "side",
        "n_fills",
        "qty",
        "notional",
        (F.col("notional").cast("double") / F.col("qty").cast("double")).alias("vwap"),
        "px_first",
        "px_last",
        "px_min",
        "px_max",
        F.abs(F.col("px_last") - F.col("px_first")).alias("sweep_depth"),
        "id_first",
        "id_last",
        F.lit(evidence).alias("order_evidence"),
        reason.alias("split_reason"),
        F.lit(RULES).alias("rule_version"),
    )


def flow(frame: DataFrame, by: Sequence) -> DataFrame:
    """Volumes, counts, imbalance and vwap of prints."""
    buy, sell = F.col("side") == "buy", F.col("side") == "sell"
    zero = F.lit(0).cast("decimal(38,2)")
    rows = frame.groupBy(*by).agg(
        F.count("*").alias("n_trades"),
        F.coalesce(F.sum(F.when(buy, F.col("amount"))), zero).cast("double").alias("buy_volume"),
        F.coalesce(F.sum(F.when(sell, F.col("amount"))), zero).cast("double").alias("sell_volume"),
        F.sum(F.col("price") * F.col("amount")).cast("double").alias("notional"),
    )
    total = F.col("buy_volume") + F.col("sell_volume")
    return rows.withColumn("imbalance", F.when(total != 0, (F.col("buy_volume") - F.col("sell_volume")) / total).otherwise(0.0)).withColumn("vwap", F.when(total != 0, F.col("notional") / total).otherwise(0.0))


def ewma(frame: DataFrame, value: str, alpha: float = 0.2, key: Sequence[str] = PAIR, order: Sequence[str] = ("ts_us", "seq")) -> DataFrame:
    """(key, order, smoothed): exponential average seeded by the first sample, in blocks of a day."""
    if not 0 < alpha <= 1:
        raise ValueError("alpha must lie in (0, 1]")
    return blocked.averaged(frame, value, alpha, key, order)


def round_trips(pings: DataFrame, key: Sequence[str] = ("conn",), order: Sequence[str] = ("ts_us",), sample: str = "rtt_us") -> DataFrame:
    """``pings`` with ``srtt_us``: the whole-number average (sample + 4 * before) div 5, seeded by the first sample.

    Rounding down at each step doesn't compose over blocks, so a connection's
    pings, a few a minute, are folded in order. A null sample (a ping without an
    answer) leaves the average as it is.
    """

    def step(now: int | None, x: int | None) -> int | None:
        return now if x is None else x if now is None else (x + 4 * now) // 5

    return blocked.folded(pings, sample, key, order, "long", step, "srtt_us")
