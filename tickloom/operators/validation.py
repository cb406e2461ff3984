"""The data-quality battery: one aggregate for each check, joined to a report by file.

Input tables carry ``file`` (a path or name), and for time checks an order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.operators import blocked, books, onchain
from tickloom.sources import files

EXPECTED = ("orderbooks", "trades")


def absent(expected: DataFrame, listing: DataFrame) -> DataFrame:
    """T01: expected (exchange, kind) without a file or heartbeat. ``listing``: exchange, kind, n."""
    have = listing.groupBy("exchange", "kind").agg(F.sum("n").alias("n"))
    return expected.join(have, ["exchange", "kind"], "left").where("coalesce(n, 0) = 0").select("exchange", "kind")


def spans(rows: DataFrame, ts: str, by: Sequence[str] = ("file",)) -> DataFrame:
    """(by, rows, distinct_ts, first_ts, last_ts)."""
    return rows.groupBy(*by).agg(F.count("*").alias("rows"), F.countDistinct(ts).alias("distinct_ts"), F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"))


def backward_steps(rows: DataFrame, ts: str, order: Sequence[str], by: Sequence[str] = ("file",)) -> DataFrame:
    """T04: (by, backward) rows whose time lies before the row above them."""
    last = F.lag(ts).over(Window.partitionBy(*by).orderBy(*order))
    return rows.select(*by, F.coalesce(F.col(ts) < last, F.lit(False)).alias("back")).groupBy(*by).agg(F.count(F.when(F.col("back"), 1)).alias("backward"))


def span_fault(first, last, threshold: int, period_us: int, tolerance: float = 0.2, upper_only: bool = False):
    """T05: whether a file's span is out of what its flush threshold allows."""
    expected = float((threshold - 1) * period_us)
    span = F.greatest(last - first, F.lit(0)).cast("double")
    high = span > expected * (1 + tolerance)
    if expected <= 0:
        return F.lit(False)
    return high if upper_only else high | (span < expected * (1 - tolerance))


def repeated(rows: DataFrame, key: Sequence[str], by: Sequence[str] = ("file",)) -> DataFrame:
    """T06, T07, T11: (by, repeated) rows beyond the first of each key; pre-aggregated by key, so a frequent key is one row."""
    counts = rows.groupBy(*by, *key).agg(F.count("*").alias("_n"))
    return counts.groupBy(*by).agg(F.sum(F.col("_n") - 1).alias("repeated"))


def overlaps(files: DataFrame, scope: Sequence[str]) -> DataFrame:
    """T10: files that begin at or before the end of the one before. ``files``: scope, file, first_ts, last_ts."""
    order = Window.partitionBy(*scope).orderBy("first_ts", "last_ts", "file")
    rows = files.withColumn("prev_file", F.lag("file").over(order)).withColumn("prev_last", F.lag("last_ts").over(order))
    return rows.where("first_ts <= prev_last").select(*scope, "prev_file", "prev_last", "file", "first_ts")


def check_books(levels: DataFrame, threshold: int, period_us: int, by: Sequence[str] = ("file",), book: Sequence[str] | None = None, order: Sequence[str] = (), listing: DataFrame | None = None) -> DataFrame:
    """Report rows (by, check, failures) of book files: levels with orderbook_ts_us, side, price, size.

    ``book``: columns that tell the books of a file apart beside their time, by
    default the symbol if there is one; ``order``: the place of a book's rows
    in its file. Time alone cannot tell two books of one time, nor their order,
    so T06 comes with ``book`` and T04 with ``order``. ``listing``: see
    ``_report``.
    """
    book = [c for c in ("symbol",) if c in levels.columns and c not in by] if book is None else book
    ts = "orderbook_ts_us"
    place = F.min(F.struct(*order)) if order else F.lit(0)
    heads = levels.groupBy(*by, *book, ts).agg(place.alias("_place"))
    span = spans(heads, ts, by)
    found = books.metrics(levels, [*by, *book, ts]).groupBy(*by).agg(F.count(F.when(F.col("crossed"), 1)).alias("crossed"))
    bad = levels.groupBy(*by).agg(F.count(F.when((F.col("price") <= 0) | (F.col("size") <= 0), 1)).alias("bad"))
    met = span.join(found, list(by)).join(bad, list(by))
    checks = {
        "T02": F.col("rows") == 0,
        "T05": span_fault(F.col("first_ts"), F.col("last_ts"), threshold, period_us),
        "T08": F.col("crossed"),
        "T09": F.col("bad"),
    }
    if order:
        met = met.join(backward_steps(heads, ts, ["_place"], by), list(by))
        checks["T04"] = F.col("backward")
    if book:
        met = met.join(repeated(heads, [ts], by), list(by))
        checks["T06"] = F.col("repeated")
    return _report(met, by, checks, listing)


def check_trades(rows: DataFrame, threshold: int, period_us: int, order: Sequence[str], by: Sequence[str] = ("file",), ts: str = "ts_us", key: str = "id", listing: DataFrame | None = None) -> DataFrame:
    """Report rows of trade files. ``listing``: see ``_report``."""
    met = (
        spans(rows, ts, by)
        .join(backward_steps(rows, ts, order, by), list(by))
        .join(repeated(rows, [key], by), list(by))
        .join(rows.groupBy(*by).agg(F.count(F.when((F.col("price") <= 0) | (F.col("amount") <= 0), 1)).alias("bad")), list(by))
    )
    return _report(
        met,
        by,
        {
            "T02": F.col("rows") == 0,
            "T04": F.col("backward"),
            "T05": span_fault(F.col("first_ts"), F.col("last_ts"), threshold, period_us, upper_only=True),
            "T07": F.col("repeated"),
            "T09": F.col("bad"),
        },
        listing,
    )


def check_transactions(rows: DataFrame, threshold: int, period_us: int, order: Sequence[str], by: Sequence[str] = ("file",), ts: str = "source_tx_ts_us", expected: str | None = None, listing: DataFrame | None = None) -> DataFrame:
    """Report rows of transaction files: times, span, repeated keys, order, invariants. ``expected``: a column with the address of the file's name; T11 counts the rows of others too. ``listing``: see ``_report``."""
    foreign = F.col("address") != F.col(expected) if expected else F.lit(False)
    met = (
        spans(rows, ts, by)
        .join(backward_steps(rows, ts, order, by), list(by))
        .join(repeated(rows, ["address", "signature"], by), list(by))
        .join(onchain.out_of_order(rows, order, [*by, "address"]).groupBy(*by).agg(F.sum("out_of_order").alias("unordered")), list(by))
        .join(rows.groupBy(*by).agg(F.count(onchain.violation()).alias("bad"), F.count(F.when(foreign, 1)).alias("foreign")), list(by))
    )
    return _report(
        met,
        by,
        {
            "T02": F.col("rows") == 0,
            "T04": F.col("backward"),
            "T05": span_fault(F.col("first_ts"), F.col("last_ts"), threshold, period_us, upper_only=True),
            "T11": F.col("repeated") + F.col("foreign"),
            "T12": F.col("unordered"),
            "T13": F.col("bad"),
        },
        listing,
    )


def check_across(rows: DataFrame, scope: Sequence[str], key: Sequence[str], file: str = "file") -> DataFrame:
    """T11 over files: (file, check, failures), a failure for each key of a file that another file of its scope holds too."""
    seen = rows.select(*scope, *key, file).distinct()
    several = seen.groupBy(*scope, *key).agg(F.count("*").alias("_files")).where("_files > 1")
    return seen.join(several, [*scope, *key], "left_semi").groupBy(file).agg(F.lit("T11").alias("check"), F.count("*").alias("failures")).select(file, "check", "failures")


def _report(met: DataFrame, by: Sequence[str], checks: dict, listing: DataFrame | None = None) -> DataFrame:
    """Wide findings as rows: one stack, no scan for each check.

    ``listing`` (by, size) holds every file that there is, whatever its rows:
    only from there can T02 tell a file without bytes or rows, which passes the
    other checks (without a listing all files have rows). T03, where ``by`` is the file alone, holds its name against
    the convention.
    """
    if listing is not None:
        met = listing.join(met, list(by), "left")
        checks = {k: F.coalesce(found.cast("long"), F.lit(0).cast("long")) for k, found in checks.items()}
        checks["T02"] = F.col("rows").isNull() | (F.col("size") == 0)
        if list(by) == ["file"]:
            checks["T03"] = files.parsed_name(F.col("file")).isNull()
    entries = F.array(*(F.struct(F.lit(name).alias("check"), found.cast("long").alias("failures")) for name, found in checks.items()))
    return met.select(*by, F.explode(entries).alias("e")).select(*by, "e.*")


def rollup(report: DataFrame, by: Sequence[str]) -> DataFrame:
    """Findings by group, check and in total."""
    return report.rollup(*by).agg(F.count("*").alias("checks"), F.count(F.when(F.col("failures") > 0, 1)).alias("failed"))


def numbers(rows: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    """Minimum, maximum and mean; 0 where there is nothing."""
    zero = F.lit(0.0)
    v = F.col(value).cast("double")
    return rows.groupBy(*by).agg(F.coalesce(F.min(v), zero).alias(f"{value}_min"), F.coalesce(F.max(v), zero).alias(f"{value}_max"), F.coalesce(F.avg(v), zero).alias(f"{value}_mean"))


def spacing(rows: DataFrame, ts: str, by: Sequence[str]) -> DataFrame:
    """Distances between consecutive distinct times."""
    times = rows.select(*by, ts).distinct()
    told = blocked.scanned(times, by, [ts], {"_last": ("max", F.col(ts))}, width=blocked.DAY_US)
    return told.select(*by, (F.col(ts) - F.col("_last")).alias("step")).where("step is not null").groupBy(*by).agg(F.count("*").alias("steps"), F.min("step").alias("step_min"), F.max("step").alias("step_max"))


def stale(rows: DataFrame, ts: str, by: Sequence[str], now_us: int, cadence_us: int) -> DataFrame:
    """Feeds silent for more than twice their declared cadence."""
    return rows.groupBy(*by).agg(F.max(ts).alias("last_us")).withColumn("stale", F.lit(now_us) - F.col("last_us") > 2 * cadence_us)
