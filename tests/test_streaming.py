"""Streaming operators against the batch operators over the same input."""

import datetime
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tickloom.functions import codecs
from tickloom.operators import books, chain, grid, trades
from tickloom.sources import mapping as m
from tickloom.streaming import stateful

SF = "/root/testdata/sf0.001"
HOUR = 3_600_000_000


@pytest.fixture
def replay(spark, tmp_path):
    """A frame as a stream of several micro-batches in order of seq."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")

    def play(frame, operator, parts=3, name="out"):
        rows = frame.orderBy("seq").collect()
        source = tmp_path / f"in-{name}"
        source.mkdir()
        step = -(-len(rows) // parts)
        schema = frame.schema
        for k in range(parts):
            part = rows[k * step : (k + 1) * step]
            spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{source}/p{k}")
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(str(source))
        query = operator(stream).writeStream.format("memory").queryName(name).option("checkpointLocation", str(tmp_path / f"ck-{name}")).trigger(availableNow=True).start()
        query.awaitTermination()
        return spark.table(name).toPandas()

    return play


def events(spark):
    quotes = m.quotes(spark, SF).select("exchange", "symbol", "seq", "ts_us", F.lit("book").alias("kind"), F.lit(0.0).alias("amount"), "bid", "ask")
    none = F.lit(None).cast("double")
    prints = m.trades(spark, SF).select("exchange", "symbol", "seq", "ts_us", F.lit("trade").alias("kind"), F.col("amount").cast("double").alias("amount"), none.alias("bid"), none.alias("ask"))
    liqs = m.liquidations(spark, SF).select("exchange", "symbol", "seq", "ts_us", F.lit("liq").alias("kind"), F.col("amount").cast("double").alias("amount"), none.alias("bid"), none.alias("ask"))
    return quotes.unionByName(prints).unionByName(liqs)


def test_grid_equals_batch(spark, replay):
    e = events(spark)
    got = replay(e, lambda s: stateful.grid(s, HOUR), name="grid").sort_values(["exchange", "symbol", "row"]).reset_index(drop=True)
    quotes = m.quotes(spark, SF)
    periods = grid.clock(quotes, HOUR)
    rows = grid.spine(periods, final=False)
    full = grid.as_of(rows, grid.book_states(quotes, HOUR), "book")
    placed = grid.placed(e.where("kind <> 'book'"), periods, HOUR).where("not late")
    facts = placed.groupBy("exchange", "symbol", "row").agg(F.count(F.when(F.col("kind") == "trade", 1)).alias("n_trades"), F.count(F.when(F.col("kind") == "liq", 1)).alias("n_liquidations"))
    want = full.join(facts, ["exchange", "symbol", "row"], "left").select("exchange", "symbol", "row", F.coalesce("n_trades", F.lit(0)).alias("n_trades"), F.coalesce("n_liquidations", F.lit(0)).alias("n_liquidations"), F.col("book.book_ts_us").alias("book_ts_us"))
    want = want.toPandas().sort_values(["exchange", "symbol", "row"]).reset_index(drop=True)
    assert len(got) == len(want) > 100
    for c in ("row", "n_trades", "n_liquidations", "book_ts_us"):
        assert (got[c].astype("Int64") == want[c].astype("Int64")).all(), c


def test_event_samples_equal_batch(spark, replay):
    e = events(spark)
    got = replay(e, lambda s: stateful.event_samples(s, ("liq",)), name="samples")
    batch = grid.event_samples(e.withColumn("rate", F.lit(None).cast("double")).withColumn("oi", F.lit(None).cast("double")), ["liq"])
    fired = batch.where("n_liquidations > 0").toPandas()
    fired = fired[fired.ts_us.isin(got.ts_us)]
    key = ["exchange", "symbol", "ts_us"]
    met = got.merge(fired, on=key, suffixes=("", "_b"))
    assert len(met) == len(got) > 10
    assert (met.n_trades == met.n_trades_b).all() and (met.bid == met.bid_b).all()


def test_continuity_equals_batch(spark, replay):
    t = m.trades(spark, SF).select("exchange", "symbol", "seq", F.when(F.col("seq") % 11 == 0, F.col("seq") - 40).otherwise(F.col("seq")).alias("number"))
    got = replay(t, stateful.continuity, name="loss").groupby(["exchange", "symbol"]).missed.sum()
    want = trades.loss(t, seq="number", arrival=("seq",)).toPandas().set_index(["exchange", "symbol"]).trades_lost
    assert (got.sort_index() == want.sort_index()).all()


def test_books_and_slots(spark, replay):
    level = "array<struct<price:string,size:string>>"
    rows = [
        ("k", "A/B", 1, [("100", "1"), ("99", "2")], [("101", "1")], 1, 0, True),
        ("k", "A/B", 2, [("100", "0")], [], 2, 1, False),
        ("k", "A/B", 3, [], [("102", "5")], 3, 2, False),
        ("k", "A/B", 4, [("98", "1")], [], 6, 5, False),
        ("k", "A/B", 5, [("97", "1")], [], 7, 6, False),
        ("k", "A/B", 6, [("50", "1")], [("60", "1")], 8, 0, True),
    ]
    frame = spark.createDataFrame(rows, f"exchange string, symbol string, seq long, bids {level}, asks {level}, update_id long, sequence long, is_snapshot boolean")
    got = replay(frame, lambda s: stateful.book_states(s, "exact_prev"), name="books").sort_values("update_id")
    assert got.state.tolist() == ["synced", "synced", "synced", "gapped", "gapped", "synced"]
    assert got.bid.tolist()[1] == 99.0 and got.bid.tolist()[-1] == 50.0

    chain = [(1, "tx", 10, None), (2, "tx", 10, None), (3, "meta", 10, 100), (4, "meta", 11, 101), (5, "meta", 11, 101), (6, "tx", 12, None), (7, "meta", 14, 104), (8, "meta", 20, 105), (9, "meta", 10, 100), (10, "meta", 60, 106)]
    frame = spark.createDataFrame([("c", *x) for x in chain], "chain string, seq long, kind string, slot long, block_height long")
    got = replay(frame, stateful.slots, name="slots")
    sealed = got[got.verdict == "sealed"]
    # 105 and 106 leave at once: their heights follow.
    assert sealed.slot.tolist() == [10, 11, 14, 20, 60] and sealed.blocks_lost.tolist() == [0, 0, 2, 0, 0]
    assert sealed.n_transactions.tolist()[0] == 2
    assert sorted(got[got.verdict != "sealed"].verdict) == ["abandoned", "duplicate", "late"]


@pytest.mark.parametrize(("recipe", "crc"), [("kraken", codecs.kraken_crc), ("okx", codecs.okx_crc)])
def test_lost_and_unchecked_deltas_gap_a_checksummed_book(spark, replay, recipe, crc):
    level = "array<struct<price:string,size:string>>"
    first = crc([("100.0", "1.50"), ("99.0", "0.20")], [("101.0", "1.00")])
    second = crc([("99.0", "0.20")], [("101.0", "1.00")])
    fourth = crc([("99.0", "0.20"), ("98.0", "3.00")], [("101.0", "1.00"), ("102.0", "5.00")])
    seed = [("100.0", "1.50"), ("99.0", "0.20")], [("101.0", "1.00")]
    updates = [
        (*seed, True, first), ([("100.0", "0")], [], False, second),
        # The delta that brings 102.0 is lost.
        ([("98.0", "3.00")], [], False, fourth), ([("97.0", "1.00")], [], False, fourth),
        # A snapshot may come without a checksum, a delta may not.
        (*seed, True, None), ([("100.0", "0")], [], False, None), (*seed, True, first), (*seed, True, second),
    ]
    rows = [(recipe, "A/B", k, *x) for k, x in enumerate(updates)]
    frame = spark.createDataFrame(rows, f"exchange string, symbol string, seq long, bids {level}, asks {level}, is_snapshot boolean, checksum long")
    frame = frame.withColumn("update_id", F.col("seq")).withColumn("sequence", F.lit(0).cast("long"))
    got = replay(frame, lambda s: stateful.book_states(s, depth=10, recipe=recipe), name=f"crc_{recipe}").sort_values("update_id")
    assert got.state.tolist() == ["synced", "synced", "gapped", "gapped", "synced", "gapped", "synced", "gapped"]
    assert got.gaps.tolist() == [0, 0, 1, 1, 1, 2, 2, 3] and got.bid.tolist()[1] == 99.0


def test_books_from_single_orders(spark, replay):
    updates = [
        ([("a", False, "100", "1", False), ("b", False, "100", "2", False), ("c", True, "102", "1", False), ("d", True, "103", "4", False)], True),
        # One of two orders of a level goes, another one moves, a third has no readable size and is gone.
        ([("a", False, "", "", True), ("c", True, "101", "1", False), ("d", True, "103", "x", False)], False),
        ([("b", False, "", "", True), ("e", False, "99", "1", False)], False),
        ([("f", False, "101", "1", False)], False), ([("g", False, "98", "1", False)], False), ([("h", False, "97", "1", False)], True),
    ]
    frame = spark.createDataFrame([("bitso", "A/B", k, *x) for k, x in enumerate(updates)], "exchange string, symbol string, seq long, orders array<struct<order_id:string,is_ask:boolean,price:string,size:string,removed:boolean>>, is_snapshot boolean")
    got = replay(frame.withColumn("update_id", F.col("seq")), lambda s: stateful.book_states(s, orders=True), name="orders").sort_values("update_id")
    assert got.state.tolist() == ["synced", "synced", "synced", "gapped", "gapped", "synced"]
    assert got.bid.tolist()[:3] == [100.0, 100.0, 99.0] and got.ask.tolist()[:3] == [102.0, 101.0, 101.0]
    assert got.n_asks.tolist() == [2, 1, 1, 0, 0, 0] and got.gaps.tolist()[-1] == 1


def test_order_books_are_bounded():
    book = books.OrderFold(most=2)
    assert book.apply_orders([("a", "bid", "1", "1", False), ("b", "bid", "1", "2", False)], 1, True) and [float(s) for *_, s in book.levels()] == [3.0]
    assert not book.apply_orders([("c", "bid", "1", "1", False)], 2) and book.state == "gapped"


def test_slots_partial_uncovered_abandoned_and_coverage(spark, replay):
    ok = (1, "h")
    events = [
        ("meta", 90, 0, 40, *ok), ("open", 100, 0, None, None, None), ("meta", 99, 0, 49, *ok), ("meta", 100, 0, 50, *ok),
        ("tx", 101, 0, None, None, None), ("meta", 101, 0, 51, None, "h"), ("meta", 102, 0, None, *ok), ("meta", 103, 0, 53, 1, ""),
        ("tx", 104, 0, None, None, None), ("undecodable", 104, 0, None, None, None), ("meta", 104, 0, 54, *ok),
        ("tx", 105, 1, None, None, None), ("tx", 105, 2, None, None, None), ("meta", 105, 2, 55, *ok), ("meta", 105, 1, 55, *ok),
        ("tx", 106, 0, None, None, None), ("tx", 139, 0, None, None, None), ("meta", 106, 0, 56, *ok), ("meta", 139, 0, 57, *ok),
        ("tx", 140, 0, None, None, None), ("close", None, 0, None, None, None), ("tx", 200, 0, None, None, None), ("open", None, 0, None, None, None),
        ("meta", 201, 0, 80, *ok), ("meta", 202, 0, 81, *ok), ("meta", 206, 0, 82, *ok),
    ]
    schema = "chain string, seq long, kind string, slot long, bank_id long, block_height long, block_time_secs long, blockhash string"
    frame = spark.createDataFrame([("c", k, *e) for k, e in enumerate(events)], schema)
    got = replay(frame, lambda s: stateful.slots(s, coverage=True), name="cover")
    told = [(int(r.slot), int(r.bank_id), r.verdict, int(r.n_transactions), int(r.blocks_lost)) for r in got.itertuples()]
    assert told == [
        (90, 0, "uncovered", 0, 0), (99, 0, "uncovered", 0, 0), (101, 0, "partial", 1, 0), (102, 0, "partial", 0, 0), (103, 0, "partial", 0, 0), (104, 0, "partial", 1, 0), (100, 0, "sealed", 0, 0),
        (105, 1, "duplicate", 1, 0), (106, 0, "abandoned", 1, 0), (106, 0, "abandoned", 0, 0), (105, 2, "sealed", 1, 4), (140, 0, "abandoned", 1, 0), (139, 0, "sealed", 1, 1),
        (201, 0, "uncovered", 0, 0), (202, 0, "sealed", 0, 23), (206, 0, "sealed", 0, 0),
    ]


class Map(dict):
    """A map state that counts what is written."""

    writes = 0

    def iterator(self):
        return iter(list(self.items()))

    def updateValue(self, key, value):
        self.writes += 1
        self[key] = value

    def removeKey(self, key):
        self.writes += 1
        del self[key]


class Value:
    def __init__(self):
        self.now, self.writes = None, 0

    def exists(self):
        return self.now is not None

    def get(self):
        return self.now

    def update(self, value):
        self.now, self.writes = value, self.writes + 1


class Handle:
    """The states and timers of one key."""

    def __init__(self):
        self.states, self.timers = {}, set()

    def getValueState(self, name, schema):
        return self.states.setdefault(name, Value())

    def getMapState(self, name, keys, values):
        return self.states.setdefault(name, Map())

    def registerTimer(self, at):
        self.timers.add(at)

    def deleteTimer(self, at):
        self.timers.remove(at)


class Expired:
    def __init__(self, at):
        self.at = at

    def get_expiry_time_in_ms(self):
        return self.at


def played(processor, batches, key=("c",)):
    """The processor's rows over micro-batches, and its handle."""
    handle, out = Handle(), []
    processor.init(handle)
    for rows in batches:
        out += [tuple(r) for f in processor.handleInputRows(key, iter([pd.DataFrame(rows)]), None) for r in f.itertuples(index=False)]
    return out, handle


def test_one_level_update_writes_one_entry():
    level = lambda p, z: {"price": str(p), "size": str(z)}
    whole = {"seq": 1, "update_id": 1, "sequence": 0, "is_snapshot": True, "bids": [level(p, 1) for p in range(100)], "asks": [level(p, 1) for p in range(200, 300)]}
    keeper = stateful.BookKeeper("exact_prev")
    _, handle = played(keeper, [[whole]], ("e", "s"))
    levels, values = handle.states["levels"], handle.states["values"]
    assert (levels.writes, values.writes, len(levels)) == (200, 1, 200)
    for n, change, writes in ((2, level(50, 7), 1), (3, level(50, 7), 0), (4, level(50, 0), 1)):
        before = levels.writes
        list(keeper.handleInputRows(("e", "s"), iter([pd.DataFrame([{"seq": n, "update_id": n, "sequence": n - 1, "is_snapshot": False, "bids": [change], "asks": []}])]), None))
        assert levels.writes - before == writes
    assert len(levels) == 199


def chain_of(draw, n):
    """Rows of a chain: banks in rough order, rivals, repeats, stragglers, coverage that closes and opens."""
    rows, slot, height = [], 100, 50
    for _ in range(n):
        x = draw.random()
        slot += draw.choice([0, 0, 0, 1, 1, 2, 9]) if x < 0.95 else 40
        height += draw.choice([0, 1, 1, 1, 2])
        own = slot - draw.choice([0, 0, 0, 1, 2, 5, 40, 70])
        kind = draw.choices(["tx", "meta", "undecodable", "open", "close"], [10, 6, 0.4, 0.15, 0.1])[0]
        whole = draw.random() < 0.93
        rows.append((kind, None if kind == "close" or (kind == "open" and draw.random() < 0.5) else own, draw.choice([0, 0, 0, 1]), draw.randint(0, 3), own - draw.randint(1, 3) if draw.random() < 0.8 else None, height - (slot - own) if whole else None, 1 if draw.random() < 0.97 else None, "h" if draw.random() < 0.97 else ""))
    return rows


SLOTS = "chain string, seq long, kind string, slot long, bank_id long, tx_index long, parent_slot long, block_height long, block_time_secs long, blockhash string"


@pytest.mark.parametrize("coverage", [False, True])
def test_blocks_in_batch_equal_the_stream(spark, coverage):
    """Random chains: the set version counts what the fold over every row takes, whatever the micro-batches."""
    draw, want, data = random.Random(3 + coverage), {}, []
    for own in ("a", "b", None, *range(12)):
        name = own if own is None else str(own)
        rows = [(name, n, *r) for n, r in enumerate(chain_of(draw, 250))]
        if coverage:
            rows[3] = (*rows[3][:2], "open", 100, *rows[3][4:])
        data += rows
        names = [x.split()[0] for x in SLOTS.split(", ")]
        cuts = sorted(draw.sample(range(1, 250), 5))
        batches = [[dict(zip(names, r, strict=True)) for r in rows[a:b]] for a, b in zip([0, *cuts], [*cuts, 250], strict=True)]
        out, _ = played(stateful.SlotAssembler(coverage=coverage), batches, (name,))
        want[name] = [(int(r[1]), int(r[2]), None if pd.isna(r[3]) else int(r[3]), int(r[4]), int(r[5]), r[6]) for r in out]
    frame = spark.createDataFrame(data, SLOTS).repartition(5)
    got = {}
    for r in chain.assembled(frame, coverage=coverage).orderBy("seq", "place").collect():
        got.setdefault(r.chain, []).append((r.slot, r.bank_id, r.block_height, r.n_transactions, r.blocks_lost, r.verdict))
    assert got == {k: v for k, v in want.items() if v}
    kinds = {x[5] for v in want.values() for x in v}
    assert {"sealed", "late", "duplicate", "partial", "abandoned"} <= kinds and (not coverage or "uncovered" in kinds)
    assert sum(x[3] for v in want.values() for x in v if x[5] == "sealed") > 30


def seeded_rows(rows):
    """(seq, ts in seconds, is_seed, update_id, sequence, price) as rows of one book."""
    return [{"seq": n, "ts": pd.Timestamp(t, unit="s"), "is_seed": seed, "update_id": uid, "sequence": q, "bids": [{"price": str(p), "size": "1"}], "asks": []} for n, t, seed, uid, q, p in rows]


def test_seeds_late_missing_and_repeated():
    keeper = stateful.SeedKeeper("exact_prev", wait_us=5_000_000, seeds=2)
    out, handle = played(keeper, [seeded_rows([(1, 10, False, 5, 4, 1), (2, 11, False, 6, 5, 2)])], ("e", "s"))
    assert [r[-4] for r in out] == ["waiting", "waiting"] and handle.timers == {16_000} and handle.states["waiting"].writes == 2

    def expire():
        at = min(handle.timers)
        handle.timers.remove(at)
        return [tuple(r) for f in keeper.handleExpiredTimer(("e", "s"), None, Expired(at)) for r in f.itertuples(index=False)]

    def play(*rows):
        return [r[-4] for f in keeper.handleInputRows(("e", "s"), iter([pd.DataFrame(seeded_rows(rows))]), None) for r in f.itertuples(index=False)]

    # No seed came: the next is asked for, after the wait before it.
    assert [r[-4:-1] for r in expire()] == [("reseed", 2, 1)] and handle.timers == {16_000 + 250 + 5_000}
    # A late one covers the first update; the second is replayed; the deadline is gone, a repeated seed changes nothing.
    assert play((3, 12, True, 5, None, 9), (4, 13, True, 5, None, 9), (5, 14, False, 7, 6, 3)) == ["seeded", "stale", "applied"]
    assert not handle.timers and not handle.states["waiting"] and sorted(p for _, p in handle.states["levels"]) == ["2", "3", "9"]
    # A break: what follows waits, and without seeds the connection must begin anew.
    assert play((6, 20, False, 9, 8, 4)) == ["gapped"] and handle.timers == {25_000}
    assert [r[-4] for r in expire()] == ["reseed"] and [r[-4] for r in expire()] == ["exhausted"] and not handle.timers
    assert play((7, 40, False, 10, 9, 4)) == ["waiting"] and not handle.timers


def test_seed_deadlines_run_by_the_watermark(spark, replay):
    """Of two books one gets its seed in time; the other is asked for again when the watermark passes its deadline."""
    level = "array<struct<price:string,size:string>>"
    rows = [(s, n, t, False, n, n - 1) for n, t in enumerate((1, 2, 30, 31, 60, 61), 1) for s in ("A/B", "C/D")]
    rows = sorted(rows + [("A/B", 2.5, 3, True, 2, None)], key=lambda r: (r[1], r[0]))
    data = [("e", s, k, datetime.datetime.fromtimestamp(t, datetime.UTC), seed, int(n), q, [(str(n), "1")], []) for k, (s, n, t, seed, _, q) in enumerate(rows)]
    frame = spark.createDataFrame(data, f"exchange string, symbol string, seq long, ts timestamp, is_seed boolean, update_id long, sequence long, bids {level}, asks {level}")
    got = replay(frame, lambda s: stateful.seeded_books(s, "exact_prev", wait_us=10_000_000), name="seeds")
    one, other = got[got.symbol == "A/B"].outcome.tolist(), got[got.symbol == "C/D"].outcome.tolist()
    assert one.count("seeded") == 1 and one.count("applied") == 4 and "reseed" not in one
    assert other.count("waiting") == 6 and other.count("reseed") >= 1


def test_watermark_versions(spark, tmp_path):
    t = m.trades(spark, SF).select("exchange", "symbol", "side", F.col("amount").cast("double").alias("amount"), F.timestamp_micros("ts_us").alias("ts"), F.col("seq").alias("id"))
    t.unionByName(t).coalesce(1).write.parquet(str(tmp_path / "w"))
    stream = spark.readStream.schema(t.schema).parquet(str(tmp_path / "w"))
    query = stateful.deduplicated(stream).writeStream.format("memory").queryName("once").option("checkpointLocation", str(tmp_path / "c1")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.table("once").count() == t.count()
    query = stateful.windowed_flow(stream, "1 hour").writeStream.format("memory").queryName("flow").option("checkpointLocation", str(tmp_path / "c2")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.table("flow").agg(F.sum("n_trades")).first()[0] >= t.count()


def test_foreach_batch_tables(spark, tmp_path):
    t = m.trades(spark, SF)
    t.coalesce(1).write.parquet(str(tmp_path / "t"))
    stream = spark.readStream.schema(t.schema).parquet(str(tmp_path / "t"))
    stateful.to_tables(stream, {"buys": "side = 'buy'", "sells": "side = 'sell'"}, str(tmp_path / "out"), str(tmp_path / "ck")).trigger(availableNow=True).start().awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out/buys")).count() + spark.read.parquet(str(tmp_path / "out/sells")).count() == t.count()


def test_pruned_fold_is_path_dependent():
    book = books.Fold(depth=2)
    for price in (10, 9, 8):
        book.apply([("bid", price, 1)])
    book.apply([("bid", 10, 0)])
    assert [p for _, _, p, _ in book.levels()] == [9]
