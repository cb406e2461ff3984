"""Golden vectors of the market-data operators, and every query against its oracle."""

import datetime
import os
import random
from collections import Counter
from decimal import Decimal
from numbers import Number

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tickloom.functions import codecs, scalars
from tickloom.operators import blocked, books, folds, grid, onchain, repair, trades, validation
from tickloom.plans import catalogue
from tickloom.sources import files, venues

SF = "/root/testdata/sf0.001"
S = 1_000_000


def rows(spark, data, ddl):
    return spark.createDataFrame(data, ddl)


# ---- oracles


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for f in os.listdir(SF):
        connection.sql(f"create view {f.split('.')[0]} as select * from '{SF}/{f}'")
    return connection


def normal(frame):
    """Columns and rows in one order; numbers alike whatever their type."""
    frame = frame[sorted(frame.columns)].copy()

    def shown(x):
        if x is None or x is pd.NaT or x is pd.NA or (isinstance(x, float) and x != x):
            return None
        return f"{float(x):.9g}" if isinstance(x, Number) and not isinstance(x, (bool, np.bool_)) else str(x)

    for c in frame.columns:
        frame[c] = pd.Series([shown(x) for x in frame[c]], dtype=object)
    return frame.sort_values(list(frame.columns)).reset_index(drop=True)


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query_matches_oracle(spark, duck, name):
    got = catalogue.QUERIES[name](spark, SF).toPandas()
    assert len(got)
    if name in catalogue.ORACLE_SQL:
        want = duck.sql(catalogue.ORACLE_SQL[name]).df()
        pd.testing.assert_frame_equal(normal(got), normal(want), check_dtype=False)


def test_every_oracle_has_a_query():
    assert set(catalogue.ORACLE_SQL) <= set(catalogue.QUERIES)


# ---- grid

QUOTE = "exchange string, symbol string, ts_us long, seq long, bid double, ask double, bid_volume long, ask_volume long"
PRINT = "exchange string, symbol string, ts_us long, seq long, side string, price decimal(18,2), amount decimal(18,2)"
FUND = "exchange string, symbol string, ts_us long, seq long, rate double, interval_hours int, next_funding_ts_us long"
OI = "exchange string, symbol string, ts_us long, seq long, oi double, oi_value double, mark_px double"
K = ("x", "A/B")


def aggregate(spark, quotes, prints=(), liqs=(), funds=(), ois=(), driver=None, **how):
    q = rows(spark, [(*K, *r) for r in quotes], QUOTE)
    d = rows(spark, [(*K, t, 0) for t in driver], "exchange string, symbol string, ts_us long, seq long") if driver else q
    parts = [rows(spark, [(*K, *r) for r in data], ddl) for data, ddl in ((prints, PRINT), (liqs, PRINT), (funds, FUND), (ois, OI))]
    return grid.market_aggregate(d, q, *parts, S, **how).orderBy("ts_us").collect()


def test_mid_and_imbalance(spark):
    got = aggregate(spark, [(S, 1, 100.0, 102.0, 10, 5)])
    assert (got[0].ob_mid_price, got[0].ob_spread) == (101.0, 2.0)
    assert got[0].ob_imbalance == pytest.approx(1 / 3)


def test_vwap_and_liquidations(spark):
    got = aggregate(
        spark,
        [(S, 1, 1.0, 2.0, 1, 1)],
        prints=[(S, 2, "buy", Decimal(100), Decimal("0.5")), (S + 1, 3, "sell", Decimal(200), Decimal(1))],
        liqs=[(S, 4, "buy", Decimal(200), Decimal(1)), (S, 5, "sell", Decimal(90), Decimal(1))],
    )[0]
    assert got.trade_vwap == pytest.approx(250 / 1.5) and got.liq_imbalance == pytest.approx(110 / 290)
    assert (got.trade_px_first, got.trade_px_last, got.trade_count) == (100.0, 200.0, 2)


def test_open_interest_saw_tooth(spark):
    got = aggregate(spark, [(S * k, k, 1.0, 2.0, 1, 1) for k in (1, 2, 3)], ois=[(S, 1, 1000.0, None, 2.0), (2 * S, 2, 1500.0, None, None)])
    assert [r.oi_change for r in got] == [1000.0, 500.0, -1500.0]
    assert [r.oi_value for r in got] == [2000.0, 0.0, 0.0]


def test_funding_annualized(spark):
    got = aggregate(spark, [(S, 1, 1.0, 2.0, 1, 1)], funds=[(S + 5, 1, 0.0001, 8, 2 * S)])[0]
    assert got.fr_annualized == pytest.approx(0.0001 * 8760 / 8) and got.fr_next_settlement_delta == S - 5


def test_clock_fills_gaps_and_labels_closing_time(spark):
    got = aggregate(spark, [(S, 1, 1.0, 2.0, 1, 1)], driver=[S, 4 * S])
    assert [r.ts_us for r in got] == [2 * S, 3 * S, 4 * S, 5 * S]
    assert all(r.ob_mid_price == 1.5 for r in got)


def test_crossing_trade_lands_in_next_row_and_early_one_is_late(spark):
    got = aggregate(spark, [(S, 1, 1.0, 2.0, 1, 1)], prints=[(2 * S, 1, "buy", Decimal(1), Decimal(1)), (S - 1, 2, "buy", Decimal(1), Decimal(1))], driver=[S, 2 * S, 3 * S])
    assert [r.trade_count for r in got] == [0, 1, 0]


def test_no_look_ahead(spark):
    got = aggregate(spark, [(S, 1, 1.0, 2.0, 1, 1), (2 * S, 2, 5.0, 6.0, 1, 1)])
    assert [r.ob_mid_price for r in got] == [1.5, 5.5]


def test_gap_cap_skips_rows_and_their_events_are_late(spark):
    got = aggregate(spark, [(S, 1, 1.0, 2.0, 1, 1)], prints=[(8 * S, 1, "buy", Decimal(1), Decimal(1))], driver=[S, 10 * S], cap=3)
    assert [r.ts_us // S for r in got] == [2, 3, 4, 11]
    assert sum(r.trade_count for r in got) == 0


def test_late_and_holdback(spark):
    frame = rows(spark, [(*K, t, n) for n, t in enumerate([S, 2 * S, 3 * S, S + 5])], "exchange string, symbol string, ts_us long, seq long")
    late = lambda hold: [r.late for r in grid.late_by_arrival(frame, S, ["seq"], hold_us=hold).orderBy("seq").collect()]
    assert late(0) == [False, False, False, True]
    assert late(2 * S) == [False, False, False, False]


# ---- trades


def test_taker_reduction(spark):
    data = [(*K, 1, n, "buy", Decimal(p), Decimal(a)) for n, (p, a) in enumerate([(100, 1), (101, 2), (103, 1)])]
    got = trades.takers(rows(spark, data, PRINT), S).collect()[0]
    assert (got.qty, got.notional, got.vwap, got.sweep_depth, got.n_fills, got.split_reason) == (4, 405, 101.25, 3, 3, "swept")
    with pytest.raises(ValueError):
        trades.takers(rows(spark, data, PRINT), 0)


def test_dedup_counts_conflicts(spark):
    data = [("a", 1, "x"), ("a", 2, "x"), ("a", 3, "y"), ("b", 4, "x")]
    frame = rows(spark, data, "id string, n long, body string")
    assert sorted(r.n for r in trades.dedup(frame, ["id"], ["n"], ["body"]).collect()) == [1, 4]
    report = trades.dedup_report(frame, ["id"], ["n"], ["body"]).first()
    assert (report.removed, report.conflicts) == (2, 1)


def test_continuity_carries_over(spark):
    frame = rows(spark, [(*K, n, t) for t, n in enumerate([1, 2, 5, 4, 6])], "exchange string, symbol string, number long, ts_us long")
    got = trades.loss(frame, seq="number").first()
    assert (got.trades, got.gap_events, got.trades_lost, got.duplicates) == (4, 1, 2, 1)


@pytest.mark.parametrize("alpha", [0.001, 0.2, 0.9, 1.0])
def test_ewma_equals_fold(spark, alpha):
    """Over blocks of a day, with null samples, null times and a null key."""
    data = [(*k, None if n % 601 == 5 else n * 100_000_000, n, None if n < 2 or n % 37 == 9 else float((n * 37) % 11)) for k in (K, ("kraken", None)) for n in range(3000)]
    out = trades.ewma(rows(spark, data, "exchange string, symbol string, ts_us long, seq long, v double").repartition(5), "v", alpha).collect()
    assert len(out) == len(data)
    for k in (K, ("kraken", None)):
        got = {r.seq: r.smoothed for r in out if (r.exchange, r.symbol) == k}
        value = None
        for d in sorted((d for d in data if d[:2] == k), key=lambda d: (d[2] is not None, d[2] or 0, d[3])):
            value = value if d[4] is None else d[4] if value is None else alpha * d[4] + (1 - alpha) * value
            assert got[d[3]] is value is None or got[d[3]] == pytest.approx(value, rel=1e-9)


def test_round_trips_equal_fold(spark):
    """Rounded down at every step, from batch to batch."""
    data = [(c, n, None if n % 11 == 4 else (n * 7919 + c) % 250_000) for c in (1, 2, 3) for n in range(30)] + [(None, 1, 7), (None, 2, 1)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        got = trades.round_trips(rows(spark, data, "conn long, ts_us long, rtt_us long").repartition(3)).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    state, want = {}, []
    for c, n, x in sorted(data, key=lambda d: (d[0] or 0, d[1])):
        state[c] = state.get(c) if x is None else x if state.get(c) is None else (x + 4 * state[c]) // 5
        want.append((c, n, x, state[c]))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_scans_in_blocks_equal_one_window(spark):
    """Every kind, over rows with null keys, null orders, negative orders and null values."""
    draw = random.Random(4)
    data = [(draw.choice(["a", "b", None]), None if draw.random() < 0.05 else draw.randint(-300, 900), n, None if draw.random() < 0.4 else draw.randint(0, 50)) for n in range(1500)]
    frame = rows(spark, data, "k string, o long, seq long, v long").repartition(6)
    parts = {f"{kind}_{where}": (kind, F.col("v")) for kind in ("max", "sum", "last", "lag") for where in ("before", "upto")}
    before, upto = ({n: p for n, p in parts.items() if n.endswith(w)} for w in ("before", "upto"))
    told = {r.seq: r for r in blocked.scanned(frame, ["k"], ["o", "seq"], before, upto, width=100).collect()}
    plain = {r.seq: r for r in blocked.scanned(frame, ["k"], ["o", "seq"], before, upto, blocks=False).collect()}
    assert len(told) == len(data) and told == plain
    for k in ("a", "b", None):
        top, total, last, previous = None, None, None, None
        for _, o, seq, v in sorted((d for d in data if d[0] == k), key=lambda d: (d[1] is not None, d[1] or 0, d[2])):
            r = told[seq]
            assert (r.max_before, r.sum_before, r.last_before, r.lag_before) == (top, total, last, previous)
            if v is not None:
                top, total, last = max(v, v if top is None else top), (total or 0) + v, v
            previous = v
            assert (r.max_upto, r.sum_upto, r.last_upto, r.lag_upto) == (top, total, last, previous)


def test_null_keys_and_times_keep_their_rows(spark):
    ddl = "exchange string, symbol string, ts_us long, seq long, amount double"
    data = [(*K, 1, 1, 1.0), (*K, None, 2, 1.0), (None, "X/USD", 3, 3, 1.0), (None, None, None, None, None)]
    frame = rows(spark, data, ddl)
    assert trades.continuity(frame).count() == grid.late_by_arrival(frame, 10, ["seq"]).count() == len(data)
    assert sum(r.regressed for r in trades.regressions(frame).collect()) == 0 and trades.regressions(frame).count() == 3
    assert books.dense_breaks(frame, ["ts_us"], trades.PAIR, "seq").count() == books.attributed_gaps(frame, ["ts_us"], trades.PAIR, "seq", "seq").count() == len(data)
    assert books.sequence_breaks(frame, "monotonic", ["seq"], trades.PAIR, "seq", "seq").count() == len(data)


def test_rehydrate_fills_exactly_the_holes(spark):
    ddl = "exchange string, symbol string, id string, ts_us long, origin string"
    own = rows(spark, [(*K, str(n), n, "ws") for n in range(1, 11) if n not in (4, 7)] + [(*K, "odd", 99, "ws")], ddl)
    other = rows(spark, [(*K, str(n), n, "rest") for n in range(-3, 20)], ddl)
    got = repair.rehydrate(own, other).orderBy("ts_us").collect()
    assert [r.id for r in got] == [str(n) for n in range(1, 11)]
    assert [r.id for r in got if r.origin == "rest"] == ["4", "7"]
    assert repair.report(own, other).first()[2:] == (8, 2, 10)


# ---- books


def test_checksum_column_and_fold_agree(spark):
    level = "array<struct<price:string,size:string>>"
    bids, asks = [("5.0", "0.10"), ("4", "2")], [("6.50", "1.0")]
    got = rows(spark, [(bids, asks)], f"bids {level}, asks {level}").select(codecs.kraken_checksum(F.col("bids"), F.col("asks")).alias("k"), codecs.okx_checksum(F.col("bids"), F.col("asks")).alias("o")).first()
    assert got.k == codecs.kraken_crc(bids, asks)
    import zlib

    signed = zlib.crc32(b"5.0:0.10:6.50:1.0:4:2")
    assert got.o == (signed - (1 << 32) if signed >> 31 else signed)


def test_wire_text_keeps_trailing_zeros_and_capital_keys(spark):
    lines = rows(spark, [('{"channel":"book","type":"snapshot","data":[{"symbol":"BTC/USD","bids":[{"price":1.50,"qty":0.01000000}],"asks":[],"checksum":7,"timestamp":"2026-06-19T05:45:47.859908Z"}]}',)], "value string")
    got = venues.updates(lines, "kraken").first()
    assert (got.bids[0].price, got.bids[0]["size"], got.is_snapshot) == ("1.50", "0.01000000", True)
    assert got.source_orderbook_ts_us == 1781847947859908
    lines = rows(spark, [('{"e":"trade","E":1,"s":"BTCUSDT","t":5,"p":"1.5","q":"2","T":1700000000000,"m":true,"M":true}',), ('{"e":"trade","s":"BTCUSDT","t":6,"p":"x","q":"2","T":1,"m":true}',)], "value string")
    good, bad = venues.prints(lines, "binance").orderBy("id").collect()
    assert (good.side, good.symbol, good.sequence, good.source_trade_ts_us, good.reason) == ("sell", "BTC/USDT", 5, 1700000000000000, None)
    assert bad.reason == "decimal"


def test_fractions_inside_texts_stay(spark):
    line = '{"channel":"book","type":"x,1.5,y","data":[{"symbol":"BTC/USD","bids":[{"price":1.50,"qty":2}],"asks":[],"checksum":7,"timestamp":"a: 1.5, b"}]}'
    got = venues.updates(rows(spark, [(line,)], "value string"), "kraken").first()
    assert got.bids[0].price == "1.50" and got.checksum == 7


def test_newest_first_frames_are_turned(spark):
    item = '{{"ts":1,"tradeId":{},"amount":0.1,"price":2.5,"direction":"sell"}}'
    lines = rows(spark, [('{"ch":"market.btcusdt.trade.detail","tick":{"data":[' + item.format(9) + "," + item.format(8) + "]}}",)], "value string")
    assert [r.sequence for r in venues.prints(lines, "htx").orderBy("item_no").collect()] == [8, 9]


@pytest.mark.parametrize("venue", sorted(venues.PRINTS))
def test_every_decoder_refuses_foreign_frames(spark, venue):
    lines = rows(spark, [("{}",), ("no json",), ('{"channel":"heartbeat"}',)], "value string")
    assert venues.prints(lines, venue).count() == 0
    if venue in venues.UPDATES:
        assert venues.updates(lines, venue).count() == 0


def test_volume_within_and_snapshot(spark):
    levels = rows(spark, [(1, "bid", 100.0, 6.0), (1, "bid", 90.0, 4.0), (1, "ask", 102.0, 3.0), (1, "ask", 120.0, 2.0)], "book long, side string, price double, size double")
    assert tuple(books.volume_within(levels, 5.0).first()[1:]) == (6.0, 3.0)
    got = books.snapshot(levels).first()
    assert got.imbalance == pytest.approx(1 / 3, abs=1e-6) and got.spread_bps == pytest.approx(198.0198)


def test_state_after_snapshots(spark):
    data = [(1, "bid", 10.0, 1.0, 1, True), (1, "bid", 9.0, 1.0, 2, False), (1, "bid", 8.0, 1.0, 3, True), (1, "bid", 7.0, 2.0, 4, False), (1, "bid", 7.0, 0.0, 5, False)]
    got = books.state_after_snapshots(rows(spark, data, "book long, side string, price double, size double, n long, is_snapshot boolean"), ["n"]).collect()
    assert [(r.price, r["size"]) for r in got] == [(8.0, 1.0)]


# ---- functions, files, chain


def test_symbols(spark):
    cases = [("btcusdt", "binance", "BTC/USDT"), ("KRW-BTC", "upbit", "BTC/KRW"), ("btc_mxn", "bitso", "BTC/MXN"), ("ETH", "hyperliquid", "ETH/USDC"), ("@107", "hyperliquid", None), ("xyz:tsla/usdc", "kraken", "xyz:TSLA/USDC"), ("USDT", "binance", None), ("", "okx", None)]
    got = rows(spark, [c[:2] for c in cases], "raw string, ex string").select(scalars.decode_symbol(F.col("raw"), F.col("ex")).alias("s")).collect()
    assert [r.s for r in got] == [c[2] for c in cases]


def test_epochs_and_order_ids(spark):
    got = rows(spark, [(0,), (1_700_000_000,), (1_700_000_000_000,), (1_700_000_000_000_000,), (1_700_000_000_000_000_000,)], "t long").select(scalars.epoch_to_us(F.col("t")).alias("u")).collect()
    assert [r.u for r in got] == [0] + [1_700_000_000_000_000] * 4
    oid = scalars.order_id(F.lit("ask"), F.lit("limit"), F.lit(12345))
    got = spark.range(1).select(oid.alias("o"), scalars.order_id_side(oid), scalars.order_id_kind(oid), scalars.order_id_time(oid)).first()
    assert got.o + (1 << 64) == (1 << 63) | (1 << 62) | (12345 << 2) and got[1:] == ("ask", "limit", 12345)


def test_base58_and_fnv():
    assert codecs.b58encode(b"\0\0abc") == "11ZiCa" and codecs.b58decode("11ZiCa") == b"\0\0abc"
    assert codecs.b58decode("0") is None
    assert codecs.fnv1a(b"") == 0xCBF29CE484222325 and codecs.fnv1a(b"a") == 0xAF63DC4C8601EC8C
    assert codecs.trade_fingerprint(1, "buy", Decimal("1.50"), Decimal("2")) == codecs.trade_fingerprint(1, "buy", Decimal("1.5"), Decimal("2.00"))


def test_lz4_and_gzip():
    body = b"hello hello hello hello"
    frame = b"\x04\x22\x4d\x18\x60\x40\x82" + (len(body) | 1 << 31).to_bytes(4, "little") + body + b"\0\0\0\0"
    assert codecs.decode_lz4_frame(frame) == body
    # A match that overlaps itself: a letter, then eleven copied from one back; a block ends with literals.
    tail = b"bcdefghijklmn"
    packed = bytes([0x17]) + b"a" + b"\x01\x00" + bytes([0xD0]) + tail
    second = b"\x04\x22\x4d\x18\x60\x40\x82" + len(packed).to_bytes(4, "little") + packed + b"\0\0\0\0"
    assert codecs.decode_lz4_frame(second) == b"a" * 12 + tail
    # Frames one after the other, one of them to be skipped.
    skipped = b"\x53\x2a\x4d\x18" + (3).to_bytes(4, "little") + b"xyz"
    assert codecs.decode_lz4_frame(frame + skipped + second) == body + b"a" * 12 + tail
    with pytest.raises(ValueError):
        codecs.decode_lz4_frame(frame, cap=5)
    with pytest.raises(ValueError):
        codecs.decode_lz4_frame(b"12345678")
    assert codecs.inflate(codecs.deflate(body)) == body
    with pytest.raises(ValueError):
        codecs.inflate(codecs.deflate(b"x" * 100), cap=10)


def test_scan_defaults_and_strictness(spark, tmp_path):
    old = rows(spark, [(1, "A/B", "buy", 1.0, 2.0, "x", "7")], "source_trade_ts_us long, symbol string, side string, price double, amount double, exchange string, id string")
    old.write.parquet(str(tmp_path / "old"))
    got = files.scan(spark, str(tmp_path / "old"), "trades").first()
    assert (got.origin, got.local_trade_ts_us) == ("ws", 0)
    old.withColumn("side", F.lit("odd")).write.parquet(str(tmp_path / "bad"))
    assert files.scan(spark, str(tmp_path / "bad"), "trades", strict=False).count() == 0
    with pytest.raises(Exception, match="unknown side"):
        files.scan(spark, str(tmp_path / "bad"), "trades").collect()
    with pytest.raises(ValueError):
        files.conform(old.drop("price"), "trades")


def test_write_round_trip_with_manifest(spark, tmp_path):
    frame = rows(spark, [(1_700_000_000_000_000 + k, "A/B", "buy", 1.0, 2.0, "x", str(k), 0, 0, "ws") for k in range(5)], files.schemas.TRADES)
    files.write(frame, str(tmp_path / "t"), "trades")
    back = files.scan(spark, str(tmp_path / "t"), "trades")
    assert back.orderBy("id").collect() == frame.orderBy("id").collect()
    windows = rows(spark, [("A/B", 50, 150), ("A/B", 150, 250), ("A/B", 250, 350)], "symbol string, t_min_us long, t_max_us long")
    quiet = files.heartbeats(windows, rows(spark, [("A/B", 60), ("A/B", 240)], "symbol string, ts long"), "ts", "trades")
    files.append_manifest(spark, str(tmp_path / "t/*"), str(tmp_path / "m"), "trades", quiet)
    entries, beats, torn = files.manifest(spark, str(tmp_path / "m"))
    assert entries.agg(F.sum("rows")).first()[0] == 5 and torn == 0
    assert [(r.t_min_us, r.t_max_us, r.rows) for r in beats.collect()] == [(250, 350, 0)]
    import hashlib

    for r in entries.collect():
        assert r.sha256 == hashlib.sha256(next(tmp_path.glob(f"t/*/{r.filename}")).read_bytes()).hexdigest()
    listing = rows(spark, [(entries.first().filename,), ("new.parquet",)], "filename string")
    assert [r.filename for r in files.pending(listing, entries).collect()] == ["new.parquet"]
    levels = rows(spark, [(1, "A/B", "x", "bid", 0, 1.0, 2.0)], files.schemas.BOOK_STATE)
    for ending in ("parquet", "csv", "json"):
        files.write_book(levels, str(tmp_path / f"b.{ending}"))
        assert spark.read.format(ending).load(str(tmp_path / f"b.{ending}")).count() >= 1
    with pytest.raises(ValueError):
        files.write_book(levels, str(tmp_path / "b.xml"))


def test_torn_manifest_lines_are_counted(spark, tmp_path):
    (tmp_path / "i.jsonl").write_text('{"filename":"a","rows":1}\n{"heartbeat":true,"symbol":"s","rows":0}\n{"filena\n')
    entries, beats, torn = files.manifest(spark, str(tmp_path / "i.jsonl"))
    assert (entries.count(), beats.count(), torn) == (1, 1, 1)


def test_names_leaves_and_archives(spark):
    names = ["bybit_BTC-USDT_ob_sync_20260101_101530.123456.parquet", "x_A-B_funding_settlement_sync_20260101_101530.123-2.parquet", "bad.parquet", "x_A-B_ob_sync_20261301_101530.123.parquet", "x_A-B_ob_sync_20260101_101560.123.parquet"]
    got = rows(spark, [(n,) for n in names], "n string").select(files.parsed_name(F.col("n")).alias("p")).collect()
    assert (got[0].p.symbol, got[0].p.kind, got[1].p.kind, got[1].p.collision) == ("BTC-USDT", "ob", "funding_settlement", "2")
    assert got[2].p is None and got[3].p is None and got[4].p is None
    path = rows(spark, [("d/bybit/linear/trades/b1/2026-01-01/f.parquet",), ("d/bybit/trades/f.parquet",)], "p string").select(files.leaf(F.col("p")).alias("l")).collect()
    assert (path[0].l.day, path[0].l.exchange, path[1].l.datatype, path[1].l.day) == ("2026-01-01", "bybit", "trades", None)
    plan = files.archive_plan(spark, datetime.date(2026, 1, 1), datetime.date(2026, 1, 2), ["A", "B"])
    assert plan.count() == 96 == files.window_size(datetime.date(2026, 1, 1), datetime.date(2026, 1, 2), 2, False)
    assert files.after_cursor(plan, "market_data/20260102/22/l2Book/B.lz4").count() == 2


def test_archive_and_context_rejects(spark):
    wrapped = ['{"time":"2026-01-01T00:00:00.5Z","ver_num":1,"raw":{"a":1}}', '{"time":"2026-01-01T00:00:00Z","ver_num":2,"raw":{}}', "x"]
    good, bad = files.archive_lines(rows(spark, [(w,) for w in wrapped], "value string"))
    assert good.first().value == '{"a":1}' and good.first().local_ts_us == 1767225600500000 and bad.count() == 2
    lines = ["2026-01-01T00:00:00Z,BTC,0.1,5,1,1,0.2,1,7,1,1,1", "2026-01-01T00:00:00Z,BTC,x,5,1,1,,1,7,1,1,1", "nope,BTC", "2026-01-01T00:00:00Z,BTC,1"]
    funding, interest, bad = files.context_rows(rows(spark, [(x,) for x in lines], "value string"))
    assert (funding.count(), interest.count(), bad.count()) == (1, 2, 3)


def test_integrity(spark):
    data = [(3, "abc", 3, '"ABC"'), (3, "0" * 32, 3, '"' + "1" * 32 + '"'), (3, "0" * 32, 4, "0" * 32)]
    got = files.intact(rows(spark, data, "size long, md5 string, expected_size long, etag string")).collect()
    assert [r.intact for r in got] == [True, False, False]


def test_slot_verdicts_read_a_long_chain(spark):
    assert "slot_verdicts" in catalogue.ORACLE_SQL
    got = {r.verdict: r.n for r in catalogue.QUERIES["slot_verdicts"](spark, SF).groupBy("verdict").agg(F.sum("n").alias("n")).collect()}
    assert set(got) == {"sealed", "duplicate", "late", "partial", "abandoned", "uncovered"} and sum(got.values()) >= 1500


def test_chain_verdicts_partial_uncovered_and_abandoned(spark):
    schema = "slot long, bank_id long, block_height long, block_time_secs long, blockhash string, arrival long"
    data = [
        (99, 0, 49, 1, "h", 1), (100, 0, 50, 1, "h", 2), (101, 0, None, 1, "h", 3), (102, 0, 52, None, "h", 4), (103, 0, 53, 0, "h", 5), (104, 0, 54, 1, "", 6), (104, 0, 54, 1, "h", 7),
        (105, 0, 55, 1, "h", 9), (106, 1, 56, 1, "h", 10), (106, 2, 56, 1, "h", 11), (150, 0, 90, 1, "h", 12), (130, 0, 80, 1, "h", 13), (117, 0, 70, 1, "h", 14), (118, 0, 71, 1, None, 15),
        (100, 0, 50, 1, "h", 16), (400, 0, 91, 1, "h", 17), (150, 0, 90, 1, "h", 18),
    ]
    metas = rows(spark, data, schema)
    updates = rows(spark, [(105, 0, 8, True), (106, 1, 19, True)], "slot long, bank_id long, arrival long, undecodable boolean")
    told = onchain.verdicts(metas, updates=updates, covered_from=100).orderBy("arrival")
    got = [r.verdict for r in told.collect()]
    assert got == ["uncovered", "sealed", "partial", "partial", "partial", "partial", "duplicate", "partial", "sealed", "duplicate", "sealed", "late", "abandoned", "partial", "duplicate", "sealed", "abandoned"]
    first = [r.verdict for r in onchain.verdicts(metas, covered_from="first").orderBy("arrival").limit(3).collect()]
    assert first == ["uncovered", "uncovered", "partial"]
    ahead = rows(spark, [(140, 0, 0, False)], "slot long, bank_id long, arrival long, undecodable boolean")
    assert onchain.verdicts(metas.where("arrival = 2"), updates=ahead).first().verdict == "abandoned"

    txs = metas.select("slot", "bank_id").distinct().withColumn("signature", F.lit("s"))
    released = sorted((r.slot, r.bank_id) for r in onchain.sealed(txs, told).collect())
    assert released == [(100, 0), (106, 1), (150, 0), (400, 0)]
    loose = {(r.slot, r.bank_id) for r in onchain.sealed(txs, metas.where("arrival < 12"), undecodable=updates.where("slot = 105")).collect()}
    assert loose == {(99, 0), (100, 0), (104, 0), (106, 1), (106, 2)}


def test_chain_verdicts_failures_and_order(spark):
    metas = rows(spark, [(10, 1, 100, 1), (11, 1, 101, 2), (11, 1, 101, 3), (30, 1, 102, 4), (12, 1, 103, 5)], "slot long, bank_id long, block_height long, arrival long")
    assert [r.verdict for r in onchain.verdicts(metas).orderBy("arrival").collect()] == ["sealed", "sealed", "duplicate", "sealed", "late"]
    log = "Program JUP6LkbZbjS1jKKwapdHNy74zcZ3tLUZoi5QNyVTaV4 failed: custom program error"
    got = rows(spark, [(["x", log],), (["Program 0O failed: x"],), (None,)], "logs array<string>").select(onchain.failure_log(F.col("logs")).alias("f")).collect()
    assert got[0].f.message == "custom program error" and got[1].f is None and got[2].f is None
    gaps = onchain.slot_gaps(rows(spark, [(1, 1), (2, 2), (9, 70_000)], "slot long, block_height long")).collect()
    assert [(g.prev_height, g.next_height, g.blocks_lost) for g in gaps] == [(2, 70_000, 69_997)]


def test_books_and_transactions_are_held_against_all_checks(spark):
    schema = "file string, symbol string, orderbook_ts_us long, place long, side string, price double, size double"
    level = [("a", "X", 0, 1), ("a", "Y", 0, 2), ("a", "X", S, 3), ("b", "X", S, 1), ("b", "X", 0, 2), ("c", "X", 0, 1), ("c", "X", S, 2)]
    # Two symbols of one time, each sound: as one book they would cross.
    data = [(*x, side, (10.0 if x[1] == "X" else 5.0) + (side == "ask"), 1.0) for x in level for side in ("bid", "ask")]
    report = validation.check_books(rows(spark, data, schema), 2, S, book=["symbol"], order=["place"])
    got = {(r.file, r.check): r.failures for r in report.collect()}
    assert {k for k, n in got.items() if n} == {("a", "T06"), ("b", "T04")} and got["a", "T06"] == 1

    schema = "file string, address string, expected string, signature string, source_tx_ts_us long, slot long, tx_index long, blockhash string, block_height long, success boolean, failure_error string, version string, compute_unit_price_micro_lamports long, priority_fee_lamports long, arrival long"
    ok = ("h", 5, True, None, "v0", None, None)
    data = [
        ("a", "A", "A", "s1", 1 * S, 1, 0, *ok, 1), ("a", "A", "A", "s2", 2 * S, 1, 1, *ok, 2),
        ("b", "A", "A", "s1", 2 * S, 1, 0, *ok, 1), ("b", "A", "A", "s1", 1 * S, 1, 0, *ok, 2), ("b", "B", "A", "s3", 9 * S, 1, 0, "", *ok[1:], 3),
    ]
    got = {(r.file, r.check): r.failures for r in validation.check_transactions(rows(spark, data, schema), 2, S, ["arrival"], expected="expected").collect()}
    assert {k: n for k, n in got.items() if n} == {("b", "T04"): 1, ("b", "T05"): 1, ("b", "T11"): 2, ("b", "T12"): 1, ("b", "T13"): 1}
    assert len(got) == 12


def test_validation_catches_each_fault(spark):
    data = [("f", 1, 1, 1.0, 1.0), ("f", 0, 2, 1.0, 1.0), ("f", 2, 2, -1.0, 1.0)]
    report = validation.check_trades(rows(spark, [(f, t, n, i, p, a) for n, (f, t, i, p, a) in enumerate(data)], "file string, ts_us long, seq long, id long, price double, amount double"), 2, S, ["seq"])
    assert {r.check: r.failures for r in report.collect()} == {"T02": 0, "T04": 1, "T05": 0, "T07": 1, "T09": 1}
    expected = rows(spark, [("x", "trades"), ("x", "orderbooks")], "exchange string, kind string")
    assert [r.kind for r in validation.absent(expected, rows(spark, [("x", "trades", 2)], "exchange string, kind string, n long")).collect()] == ["orderbooks"]


def test_decompose(spark):
    ddl = """ts_us long, book struct<exchange:string,symbol:string,orderbook_ts_us:long,source_orderbook_ts_us:long,local_orderbook_ts_us:long>,
      trades array<struct<id:string>>, liquidations array<struct<id:string>>, funding array<struct<exchange:string,symbol:string,conn_epoch_us:long,recv_seq:long>>,
      open_interest array<struct<exchange:string,symbol:string,conn_epoch_us:long,recv_seq:long>>, settlements array<struct<exchange:string,symbol:string,funding_time_us:long>>, transactions array<struct<address:string,signature:string>>"""
    push = ("x", "A/B", 1, 5)
    loose = ("x", "A/B", 1, 0)
    snap = (10, ("x", "A/B", 7, 0, 0), [("1",)], [], [push, loose], [push], [("x", "A/B", 3)], [("a", "s")])
    got = repair.decompose(rows(spark, [snap, snap], ddl))
    assert {k: v.count() for k, v in got.items()} == {"orderbooks": 2, "trades": 2, "liquidations": 0, "funding_rates": 3, "open_interests": 1, "funding_settlements": 1, "transactions": 1}
    book = got["orderbooks"].first()
    assert (book.orderbook_ts_us, book.source_orderbook_ts_us) == (10, 7)


# ---- generators, configuration


def test_generators_are_deterministic(spark):
    from tickloom.sources import generators

    a = generators.trades(spark, 500, seed=3)
    assert sorted(a.collect()) == sorted(generators.trades(spark, 500, seed=3).repartition(7).collect())
    assert a.where("price <= 0 or amount <= 0").count() == 0 and generators.orders(spark, 10).count() == generators.liquidations(spark, 10).count() == 10
    made = books.metrics(generators.books(spark, 50))
    assert made.where("crossed or n_bids <> 10 or n_asks <> 10").count() == 0


def test_admission_and_durations():
    from tickloom import config

    good = config.Job("bybit", "linear", ("BTC/USDT",), ("orderbooks", "trades", "liquidations"), period="100ms")
    assert good.problems() == []
    bad = config.Job("kraken", "chain", (), ("liquidations", "odd"), clock="x", period="1 week", depth=25)
    assert len(bad.problems()) == 7
    assert [config.duration_us(t) for t in ("1500ns", "100ms", "1h")] == [1, 100_000, 3_600_000_000]
    assert config.mode_label("clock", "100ms") == "ON_CLOCK(100MS)"
    assert config.delay_ceiling(3) == 2.0 and config.delay_ceiling(50) == 30.0
    assert 1.0 <= config.delay(3, 5) <= 2.0 and config.delay(3, 5) == config.delay(3, 5)


# ---- feeds, ledgers, book lifecycle


def test_feed_lifecycle(spark):
    from tickloom.operators import feeds

    walk = ["subscribing", "live", "live", "stale", "live", "closed", "draining"]
    got = feeds.judged(rows(spark, [("a", n, s) for n, s in enumerate(walk)], "feed string, at int, state string"), ["feed"], ["at"]).orderBy("at")
    assert [r.verdict for r in got.collect()] == ["legal", "legal", "repeat", "legal", "legal", "illegal", "absorbed"]
    now = feeds.status(got.select("feed", "at", "state"), ["feed"], ["at"]).first()
    assert (now.state, now.terminal, now.changes, now.illegal) == ("closed", True, 5, 1)
    assert all(set(following) <= set(feeds.EDGES) for following in feeds.EDGES.values()) and feeds.TERMINAL == ("closed", "rejected", "failed")
    empty = rows(spark, [], "feed string, at int, state string")
    assert feeds.status(empty, ["feed"], ["at"]).count() == 0
    odd = feeds.judged(rows(spark, [("a", 1, None), ("a", 2, "flying")], "feed string, at int, state string"), ["feed"], ["at"])
    assert {r.verdict for r in odd.collect()} == {"illegal"}


def test_gap_ledger_is_appended(spark, tmp_path):
    from tickloom.operators import trades
    from tickloom.sources import files

    gaps = rows(spark, [("bitso", "BTC/MXN", 10, 30, 20, 2)], "exchange string, symbol string, opened_us long, closed_us long, window_us long, possible_dropped long")
    path = str(tmp_path / "gaps.jsonl")
    files.append_ledger(trades.ledger_rows(gaps, "resync"), path)
    files.append_ledger(trades.ledger_rows(gaps).drop("possible_dropped_trades"), path)
    got = sorted(files.ledger(spark, path).collect(), key=lambda r: r.cause)
    assert [(r.cause, r.window_us, r.possible_dropped_trades, r.blocks_lost) for r in got] == [("disconnect", 20, None, None), ("resync", 20, 2, None)]
    with pytest.raises(ValueError):
        trades.ledger_rows(gaps, "bored")


def test_segments_equal_one_long_fold(spark):
    """Books cut at snapshots against a plain fold over sorted dicts, with depth, sequence breaks, crossings and null keys; small batches."""
    draw = random.Random(11)
    data = []
    for book in (1, 2, None):
        last = 0
        for n in range(300):
            whole, uid = draw.random() < 0.05, last + draw.randint(1, 2)
            side = [(str(draw.randint(1, 30)), str(draw.randint(0, 2))) for _ in range(draw.randint(0, 3))]
            other = [(str(draw.randint(28, 60)), str(draw.randint(0, 2))) for _ in range(draw.randint(0, 3))]
            data.append((book, n, side, other, uid, last if draw.random() < 0.97 else last - 1, whole if draw.random() < 0.98 else None))
            last = uid
    level = "array<struct<price:string,size:string>>"
    frame = rows(spark, data, f"book long, n long, bids {level}, asks {level}, update_id long, sequence long, is_snapshot boolean").repartition(4)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 16)
    try:
        got = {(r.book, r.segment): r for r in folds.replayed(frame, ["n"], predicate="exact_prev", depth=5).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    for book in (1, 2, None):
        segment, at, own, state, seen = 0, None, {}, "empty", Counter()
        want = {}
        for _, _, bids, asks, uid, sequence, whole in (d for d in data if d[0] == book):
            if whole:
                segment, own, state, at, seen = segment + 1, {}, "empty", None, Counter()
            if state == "gapped":
                seen["rejected"] += 1
            else:
                good = whole or at is None or sequence == at
                for side, changes in (("bid", bids), ("ask", asks)) if good else ():
                    for p, z in changes:
                        own.pop((side, int(p)), None)
                        if z != "0":
                            own[side, int(p)] = z
                    best = sorted((p for s, p in own if s == side), reverse=side == "bid")
                    for p in best[5:]:
                        del own[side, p]
                sides = [[p for s, p in own if s == side] for side in ("bid", "ask")]
                if not good or (all(sides) and max(sides[0]) >= min(sides[1])):
                    own, state, at = {}, "gapped", None
                    seen["gaps"] += 1
                else:
                    state, at = "synced", uid
                    seen["applied"] += 1
            levels = [(side, k, str(p), own[side, p]) for side in ("bid", "ask") for k, p in enumerate(sorted((p for s, p in own if s == side), reverse=side == "bid"))]
            want[segment] = (seen["applied"], seen["rejected"], seen["gaps"], state, levels)
        for k, w in want.items():
            r = got.pop((book, k))
            assert (r.applied, r.rejected, r.gaps, r.state, [tuple(x) for x in r.levels]) == w
    assert not got


def test_pruned_state_counts_from_the_last_snapshot(spark):
    data = [(b, n, "bid", n, 1.0, n == 3 and b == 1) for b in (1, 2, None) for n in range(6)]
    frame = rows(spark, data, "book long, n long, side string, price long, size double, whole boolean")
    got = {(r.book, r.level): r.price for r in folds.pruned_state(frame, 4, ["n"], snapshot="whole").collect()}
    assert got == {(1, k): 5 - k for k in range(3)} | {(b, k): 5 - k for b in (2, None) for k in range(4)}


def test_one_sided_books_are_an_error_where_asked(spark):
    levels = rows(spark, [(1, "bid", 9.0, 1.0), (1, "ask", 11.0, 1.0), (7, "bid", 9.0, 1.0)], "book long, side string, price double, size double")
    assert books.two_sided(levels.where("book = 1")).first().mid_price == 10.0
    with pytest.raises(Exception, match="one-sided book: 7"):
        books.two_sided(levels).collect()


def test_forced_gap_and_close():
    book = books.Fold(predicate="exact_prev")
    assert book.apply([("bid", 10, 1)], 5, 4, True) and book.state == "synced"
    book.gap()
    assert (book.state, book.last, book.levels()) == ("gapped", None, []) and not book.apply([("bid", 10, 1)], 6, 5)
    assert book.apply([("bid", 9, 1)], 8, 7, True)
    book.close()
    assert not book.apply([("bid", 8, 1)], 9, 8, True) and len(book.levels()) == 1
    book.gap()
    assert (book.state, book.gaps) == ("closed", 1)


def test_a_named_dex_is_read_from_the_live_feed(spark):
    from tickloom.functions import scalars
    from tickloom.sources import venues

    got = rows(spark, [("XYZ:tsla",), ("@107",), ("a:b:c",), (":x",), ("btc",)], "raw string").select(scalars.wire_pair(F.col("raw"), F.lit("hyperliquid")).alias("p"))
    assert [r.p for r in got.collect()] == ["xyz:TSLA/USDC", None, None, None, "BTC/USDC"]
    frame = '{"channel":"trades","data":[{"coin":"xyz:TSLA","side":"B","px":"1.5","sz":"2","time":3,"tid":4}]}'
    assert venues.prints(rows(spark, [(frame,)], "value string"), "hyperliquid").first().symbol == "xyz:TSLA/USDC"


def _seeded(**bounds):
    return books.Seeded(books.Fold(predicate="range_inclusive"), **bounds)


def test_updates_wait_for_a_seed_and_are_replayed():
    book = _seeded()
    assert [book.update([("bid", 10 + n, 1)], n, n) for n in (4, 5, 6)] == ["waiting"] * 3
    assert book.seed([("ask", 100, 1)], 4) == 2 and not book.waiting and book.book.last == 6
    assert sorted(p for _, _, p, _ in book.book.levels()) == [15, 16, 100]
    assert book.update([], 6, 6) == "stale" and book.update([("bid", 9, 1)], 7, 7) == "applied"
    assert book.update([("bid", 8, 1)], 12, 12) == "gapped" and book.seeding and not book.book.levels()
    assert book.update([("bid", 7, 1)], 13, 13) == "waiting"
    assert book.seed([], 9) == 0 and book.seeding and len(book.waiting) == 2
    assert book.seed([], 11) == 2 and not book.seeding and book.asked == 0


def test_seeds_and_waiting_updates_are_bounded():
    book = _seeded(most=3, seeds=2)
    for n in range(10):
        book.update([("bid", n + 1, 1)], n, n)
    assert (len(book.waiting), book.lost) == (3, 7)
    assert book.seed([], 2) == 0 and book.seeding
    assert book.seed([], 6) == 3 and not book.seeding
    book.update([], 20, 20)
    assert [book.seed([], 1), book.exhausted, book.seed([], 1), book.exhausted] == [0, False, 0, True]
    late = _seeded(seeds=2)
    assert [late.failed() for _ in range(3)] == [250_000, 500_000, None]
    assert books.seed_delay_us(20) == 2_000_000
