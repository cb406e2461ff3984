"""Canonical files: scans with strict casts, names and layout, manifests, sinks, archive plans."""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom import schemas
from tickloom.functions.scalars import book_side, day_of, effective, file_symbol, trade_side
from tickloom.operators import blocked

# ---- scans


def conform(frame: DataFrame, datatype: str) -> DataFrame:
    """Cast to the datatype's schema; columns that older files lack get their defaults.

    Unsigned 64-bit columns arrive as decimals and become longs; a value beyond
    a long is an error, never wrapped.
    """
    ddl, defaults = schemas.TABLES[datatype]
    out = []
    for field in schemas.struct(ddl).fields:
        if field.name in frame.columns:
            out.append(F.col(field.name).cast(field.dataType).alias(field.name))
        elif field.name in defaults:
            out.append(F.lit(defaults[field.name]).cast(field.dataType).alias(field.name))
        else:
            raise ValueError(f"{datatype}: column {field.name} is missing")
    return frame.select(*out)


def _strict(value: Column, raw: Column, what: str) -> Column:
    return F.coalesce(value, F.raise_error(F.concat(F.lit(f"unknown {what}: "), F.coalesce(raw.cast("string"), F.lit("null")))).cast("string"))


def scan(spark: SparkSession, path: str | list[str], datatype: str, strict: bool = True) -> DataFrame:
    """A canonical table from Parquet. Strict scans fail on unknown sides and origins; lenient ones drop such rows."""
    frame = conform(spark.read.parquet(*([path] if isinstance(path, str) else path)), datatype)
    checks: dict[str, tuple[Column, str]] = {}
    if datatype in ("trades", "liquidations"):
        checks["side"] = (trade_side(F.col("side")), "side")
    if datatype == "orderbooks":
        checks["side"] = (book_side(F.col("side")), "book side")
    if datatype == "trades":
        checks["origin"] = (F.when(F.col("origin").isin("ws", "rest"), F.col("origin")), "origin")
    for name, (value, what) in checks.items():
        frame = frame.withColumn(name, _strict(value, F.col(name), what)) if strict else frame.withColumn(name, value).where(F.col(name).isNotNull())
    return frame


def transaction_keys(spark: SparkSession, path: str) -> DataFrame:
    """Only the key columns are read."""
    return spark.read.parquet(path).select("address", "signature")


def books(spark: SparkSession, path: str) -> DataFrame:
    """One row for each book: its sides as arrays, best level first."""
    level = F.struct("level", "price", "size")
    return (
        scan(spark, path, "orderbooks")
        .groupBy("exchange", "symbol", "orderbook_ts_us")
        .agg(*(F.array_sort(F.collect_list(F.when(F.col("side") == s, level))).alias(f"{s}s") for s in ("bid", "ask")), *(F.max(c).alias(c) for c in ("source_orderbook_ts_us", "local_orderbook_ts_us", "source_orderbook_rtt_us")))
    )


def collapsed_book(spark: SparkSession, path: str, order: Sequence[str] = ("orderbook_ts_us", "level")) -> DataFrame:
    """All books of a file as one map: each price's last size. Rows of unknown side are skipped."""
    rows = scan(spark, path, "orderbooks", strict=False)
    return rows.groupBy("exchange", "symbol", "side", "price").agg(F.max_by("size", F.struct(*order)).alias("size"))


# ---- names and layout

NAME = r"^([^_]+)_(.+)_({})_([^_]+)_(\d{{8}})_(\d{{6}}\.(?:\d{{3}}|\d{{6}}))(?:-([1-9]\d*))?\.parquet$"
# The tags of file kinds.
TAGS = ("ob", "trades", "liquidations", "funding_settlement", "funding", "oi", "txs")


def parsed_name(name: Column, tags: Sequence[str] = TAGS) -> Column:
    """struct(exchange, symbol, kind, mode, date, time, collision) of a file name; null if it breaks the convention."""
    pattern = NAME.format("|".join(tags))
    parts = ("exchange", "symbol", "kind", "mode", "date", "time", "collision")
    fields = [F.nullif(F.regexp_extract(name, pattern, k + 1), F.lit("")).alias(p) for k, p in enumerate(parts)]
    time = F.regexp_extract(name, pattern, 6)
    real = F.try_to_timestamp(F.concat(F.regexp_extract(name, pattern, 5), F.substring(time, 1, 6)), F.lit("yyyyMMddHHmmss")).isNotNull()
    valid = name.rlike(pattern) & real
    return F.when(valid, F.struct(*fields))


def file_name(exchange: Column, pair: Column, kind: str, mode: Column, stamp_us: Column) -> Column:
    stamp = F.date_format(F.timestamp_micros(stamp_us), "yyyyMMdd_HHmmss.SSSSSS")
    return F.concat_ws("_", exchange, file_symbol(pair), F.lit(kind), mode, F.concat(stamp, F.lit(".parquet")))


LEAF = r"([^/]+)/(?:([^/]+)/)?(orderbooks|trades|transactions|liquidations|funding_rates|funding_settlements|open_interests)/(?:([^/]+)/(\d{4}-\d{2}-\d{2})/)?[^/]+$"


def leaf(path: Column) -> Column:
    """struct(exchange, market_type, datatype, binding, day) of a file's path in either layout."""
    names = ("exchange", "market_type", "datatype", "binding", "day")
    return F.when(path.rlike(LEAF), F.struct(*(F.nullif(F.regexp_extract(path, LEAF, k + 1), F.lit("")).alias(n) for k, n in enumerate(names))))


# ---- manifests


def manifest(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, int]:
    """(entries, heartbeats, torn lines) of a leaf's index; a line that cannot be parsed is torn."""
    lines = spark.read.text(path).where("trim(value) <> ''")
    rows = lines.select("value", F.from_json("value", schemas.LEAF_INDEX).alias("e"))
    good = F.col("e.filename").isNotNull() | F.coalesce(F.col("e.heartbeat"), F.lit(False))
    entries = rows.where(F.col("e.filename").isNotNull()).select("e.filename", "e.sha256", "e.rows", "e.t_min_us", "e.t_max_us", "e.schema_id")
    beats = rows.where(F.coalesce(F.col("e.heartbeat"), F.lit(False))).select("e.symbol", "e.rows", "e.t_min_us", "e.t_max_us", "e.last_slot", "e.last_block_height", "e.schema_id")
    return entries, beats, rows.where(~F.coalesce(good, F.lit(False))).count()


def pending(listing: DataFrame, entries: DataFrame) -> DataFrame:
    """Files on disk that the index doesn't name."""
    return listing.join(entries.select("filename"), "filename", "left_anti")


def digests(spark: SparkSession, path: str) -> DataFrame:
    """(filename, size, sha256, md5) of files: the integrity columns of an index or an object listing."""
    files = spark.read.format("binaryFile").load(path)
    return files.select(F.substring_index("path", "/", -1).alias("filename"), F.col("length").alias("size"), F.sha2("content", 256).alias("sha256"), F.md5("content").alias("md5"))


def intact(objects: DataFrame) -> DataFrame:
    """Objects with ``intact``: length and, where the tag is a plain one, MD5 agree. Columns: size, md5, expected_size, etag."""
    tag = F.lower(F.translate("etag", '"', ""))
    return objects.withColumn("intact", (F.col("size") == F.col("expected_size")) & (~tag.rlike("^[0-9a-f]{32}$") | (tag == F.col("md5"))))


# ---- sinks


def write(frame: DataFrame, path: str, datatype: str, partition: bool = True, mode: str = "append") -> None:
    """A canonical table, Snappy, laid out by exchange and UTC day. The committer makes each job's files visible at once."""
    time, other = schemas.TIMES[datatype]
    rows = conform(frame, datatype)
    writer = rows.write.mode(mode).option("compression", "snappy")
    if partition:
        day = day_of(effective(*(F.col(c) for c in (time, other) if c)))
        writer = rows.withColumn("day", day).write.mode(mode).option("compression", "snappy").partitionBy("day")
    writer.parquet(path)


def write_book(levels: DataFrame, path: str, format: str | None = None, mode: str = "overwrite") -> None:
    """A book dump as Parquet, CSV or JSON, by the path's ending unless told."""
    format = format or path.rsplit(".", 1)[-1].lower()
    if format not in ("parquet", "csv", "json"):
        raise ValueError(f"unknown book format: {format}")
    writer = levels.write.mode(mode)
    (writer.option("header", "true") if format == "csv" else writer).format(format).save(path)


def append_manifest(spark: SparkSession, files: str, path: str, datatype: str, beats: DataFrame | None = None) -> None:
    """A manifest line with the SHA-256 of each written file, and the lines of ``beats`` (see ``heartbeats``), to a JSON-lines folder."""
    time, _ = schemas.TIMES[datatype]
    rows = spark.read.parquet(files).groupBy(F.input_file_name().alias("file")).agg(F.count("*").alias("rows"), F.min(time).alias("t_min_us"), F.max(time).alias("t_max_us"))
    named = rows.select(F.url_decode(F.substring_index("file", "/", -1)).alias("filename"), "rows", "t_min_us", "t_max_us", F.lit(schemas.schema_id(datatype)).alias("schema_id"))
    lines = named.join(digests(spark, files).select("filename", "sha256"), "filename")
    if beats is not None:
        lines = lines.unionByName(beats, allowMissingColumns=True)
    lines.write.mode("append").json(path)


def heartbeats(windows: DataFrame, rows: DataFrame, ts: str, datatype: str, by: Sequence[str] = ("symbol",)) -> DataFrame:
    """Heartbeat lines for windows (by, t_min_us, t_max_us) that hold no row.

    Windows are cells of grids: a width and a phase (where the grid's cells
    begin) give a window its number, so the match is an equality join, not a
    range join.
    """
    numbered = windows.withColumn("_width", F.col("t_max_us") - F.col("t_min_us")).withColumn("_phase", F.pmod("t_min_us", "_width"))
    cell = lambda at: F.expr(f"({at} - _phase - pmod({at} - _phase, _width)) div _width")
    numbered = numbered.withColumn("_w", cell("t_min_us"))
    grids = numbered.select(*by, "_width", "_phase").distinct()
    seen = rows.join(grids, list(by)).select(*by, "_width", "_phase", cell(ts).alias("_w")).distinct()
    quiet = numbered.join(seen, [*by, "_width", "_phase", "_w"], "left_anti")
    return quiet.select(F.lit(True).alias("heartbeat"), *by, F.lit(0).cast("long").alias("rows"), "t_min_us", "t_max_us", F.lit(schemas.schema_id(datatype)).alias("schema_id"))


def with_heights(beats: DataFrame, metas: DataFrame, ts: str, by: Sequence[str] = ("symbol",)) -> DataFrame:
    """Heartbeat lines with ``last_slot`` and ``last_block_height``: those of the last block (by, ts, slot, block_height) before each window's end; null where none was."""
    marks = beats.withColumn("_at", F.col("t_max_us")).withColumn("_block", F.lit(False))
    blocks = metas.where(F.col(ts).isNotNull()).select(*by, F.col(ts).alias("_at"), "slot", "block_height", F.lit(True).alias("_block"))
    both = marks.unionByName(blocks, allowMissingColumns=True).withColumnRenamed("_block", "_is_block")
    # Blocks of one time count by their slot; a window's end comes before what begins there.
    last = F.when(F.col("_is_block"), F.struct("slot", "block_height"))
    told = blocked.scanned(both, by, ["_at", "_is_block", "slot", "block_height"], {"_last": ("last", last)}, width=blocked.DAY_US)
    return told.where("not _is_block").select(*beats.columns, F.col("_last.slot").alias("last_slot"), F.col("_last.block_height").alias("last_block_height"))


LEDGER = "opened_epoch_us long, closed_epoch_us long, window_us long, cause string, exchange string, symbol string, possible_dropped_trades long, prev_slot long, prev_height long, next_slot long, next_height long, blocks_lost long"


def ledger_path(folder: Column, exchange: Column, symbol: Column) -> Column:
    """Where a worker's gap ledger lies: beside the recorded tree, named by its binding, if the folder is of that layout, else below the folder."""
    recorded = folder.contains("/recorded/") & folder.contains("{data_type}")
    root, binding = F.substring_index(folder, "/recorded/", 1), F.element_at(F.split(F.rtrim(folder, F.lit("/")), "/"), -1)
    plain = F.concat_ws("_", exchange, F.translate(symbol, "/:", "--"), F.lit("gap_ledger.jsonl"))
    return F.when(recorded, F.concat(root, F.lit("/gaps/"), binding, F.lit("_gap_ledger.jsonl"))).otherwise(F.concat(F.rtrim(folder, F.lit("/")), F.lit("/gaps/"), plain))


def append_ledger(incidents: DataFrame, path: str) -> None:
    """Incidents as JSON lines, after those that are there; columns of LEDGER that they lack are null."""
    given = set(incidents.columns)
    fields = schemas.struct(LEDGER).fields
    rows = incidents.select(*((F.col(f.name) if f.name in given else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields))
    rows.write.mode("append").json(path)


def ledger(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LEDGER).json(path)


# ---- archives


def archive_plan(spark: SparkSession, start: datetime.date, end: datetime.date, coins: Sequence[str], contexts: bool = False) -> DataFrame:
    """(key, day, hour, coin): the objects of a window in the order of their fetch."""
    days = spark.range(1).select(F.explode(F.sequence(F.lit(start), F.lit(end))).alias("day"))
    return archive_keys(days.select("day", F.explode(F.array(*(F.lit(c) for c in coins))).alias("coin")), contexts)


def archive_keys(wanted: DataFrame, contexts: bool = False) -> DataFrame:
    """The same for wanted (day, coin) pairs: an object for each of their hours, and one of contexts for each day."""
    each = wanted.select("day", "coin").distinct().select("day", F.explode(F.sequence(F.lit(0), F.lit(23))).alias("hour"), "coin")
    stamp = F.date_format("day", "yyyyMMdd")
    keys = each.select(F.concat_ws("/", F.lit("market_data"), stamp, F.col("hour"), F.lit("l2Book"), F.concat("coin", F.lit(".lz4"))).alias("key"), "day", "hour", "coin")
    if contexts:
        keys = keys.unionByName(wanted.select("day").distinct().select(F.concat(F.lit("asset_ctxs/"), stamp, F.lit(".csv.lz4")).alias("key"), "day", F.lit(-1).alias("hour"), F.lit("").alias("coin")))
    return keys


KEY_PATTERN = r"^market_data/(\d{8})/(\d+)/l2Book/([^/]+)\.lz4$"


def coins_of(listing: DataFrame, key: str = "key") -> DataFrame:
    """The distinct coins of listed objects."""
    coin = F.regexp_extract(key, KEY_PATTERN, 3)
    return listing.select(coin.alias("coin")).where("coin <> ''").distinct()


def key_day(key: Column) -> Column:
    day = F.coalesce(F.nullif(F.regexp_extract(key, r"^asset_ctxs/(\d{8})", 1), F.lit("")), F.nullif(F.regexp_extract(key, r"^[^/]+/(\d{8})/", 1), F.lit("")))
    return F.to_date(day, "yyyyMMdd")


def classified(plan: DataFrame, listing: DataFrame) -> DataFrame:
    """Planned keys: present, missing (a hole before the archive's edge) or beyond_edge."""
    edge = listing.agg(F.max(key_day(F.col("key"))).alias("edge"))
    met = plan.join(listing.select("key", F.lit(True).alias("there")).distinct(), "key", "left").crossJoin(F.broadcast(edge))
    state = F.when(F.col("there"), "present").when(F.coalesce(key_day(F.col("key")) > F.col("edge"), F.lit(True)), "beyond_edge").otherwise("missing")
    return met.withColumn("state", state).drop("there", "edge")


def after_cursor(plan: DataFrame, cursor: str | None, order: Sequence[str] = ("day", "hour", "coin")) -> DataFrame:
    """The keys after the last one that was done."""
    if cursor is None:
        return plan
    at = F.struct(*order)
    done = plan.where(F.col("key") == cursor).agg(F.max(at).alias("done"))
    return plan.crossJoin(F.broadcast(done)).where(F.col("done").isNull() | (at > F.col("done"))).drop("done")


CONTEXT_COLUMNS = "time string, coin string, funding string, open_interest string, prev_day_px string, day_ntl_vlm string, premium string, oracle_px string, mark_px string, mid_px string, impact_bid_px string, impact_ask_px string"


def context_rows(lines: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(funding, open interest, rejects) from lines of context files (column ``value``); rows need twelve fields and an RFC 3339 time."""
    names = [x.split()[0] for x in CONTEXT_COLUMNS.split(", ")]
    header = ",".join(names)
    cut = lines.where(F.trim("value") != header).select("value", F.split("value", ",").alias("c"))
    rows = cut.select("value", F.size("c").alias("n"), *(F.get("c", k).alias(x) for k, x in enumerate(names)))
    time = F.unix_micros(F.try_to_timestamp("time"))
    rows = rows.withColumn("ts_us", time).withColumn("symbol", F.when(F.col("coin") != "", F.concat(F.upper("coin"), F.lit("/USDC"))))
    good = (F.col("n") == 12) & F.col("ts_us").isNotNull() & F.col("symbol").isNotNull()
    number = lambda c: F.col(c).try_cast("decimal(38,18)")
    kept = rows.where(good)
    venue = F.lit("hyperliquid").alias("exchange")
    zero = F.lit(0).cast("long")
    funding = kept.where(number("funding").isNotNull()).select(
        F.col("ts_us").alias("funding_rate_ts_us"), "symbol", number("funding").cast("double").alias("funding_rate"), zero.alias("next_funding_ts_us"), venue, number("premium").cast("double").alias("premium"), F.lit(1).alias("interval_hours")
    )
    interest = kept.where(number("open_interest").isNotNull()).select(
        F.col("ts_us").alias("open_interest_ts_us"), "symbol", number("open_interest").cast("double").alias("open_interest"), F.lit(None).cast("double").alias("open_interest_value"), venue, number("mark_px").cast("double").alias("mark_px")
    )
    bad = rows.where(~F.coalesce(good, F.lit(False)) | number("funding").isNull() | number("open_interest").isNull()).select("value")
    return funding, interest, bad


def archive_lines(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(frames, rejects) of archived wire lines {time, ver_num, raw}: only version 1 is known; the receipt time is the wrapper's."""
    rows = lines.select("value", F.from_json("value", "time string, ver_num long, raw string").alias("w"))
    local = F.unix_micros(F.try_to_timestamp("w.time"))
    rows = rows.withColumn("local_ts_us", local)
    good = (F.col("w.ver_num") == 1) & F.col("w.raw").isNotNull() & F.col("local_ts_us").isNotNull()
    return rows.where(good).select("local_ts_us", F.col("w.raw").alias("value")), rows.where(~F.coalesce(good, F.lit(False))).select("value")


def window_size(start: datetime.date, end: datetime.date, coins: int, contexts: bool) -> int:
    """Objects of an archive window."""
    days = (end - start).days + 1
    return days * (24 * coins + contexts)
