"""Faults that only show on larger tables or far keys, on small ones made to show them."""

import datetime
import random

import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from test_engine import normal
from tickloom.functions import codecs, scalars
from tickloom.operators import chain
from tickloom.plans import catalogue


def against_sql(spark, folder, name, **tables):
    """A query's rows over the given tables, held against its SQL."""
    connection = duckdb.connect()
    for table, data in tables.items():
        pq.write_table(pa.table(data), f"{folder}/{table}.parquet")
        connection.sql(f"create view {table} as select * from '{folder}/{table}.parquet'")
    got = catalogue.QUERIES[name](spark, str(folder)).toPandas()
    pd.testing.assert_frame_equal(normal(got), normal(connection.sql(catalogue.ORACLE_SQL[name]).df()), check_dtype=False)
    return got


def test_sums_of_times_pass_a_long(spark, tmp_path):
    kinds = ["signup", "error", "click", "view"]
    n = 400
    events = {
        "event_id": list(range(n)),
        "ts": pa.array([datetime.datetime(9999, 12, 1 + k % 30) for k in range(n)], pa.timestamp("us")),
        "user_id": [k % 9 for k in range(n)],
        "event_type": [kinds[k % 4] for k in range(n)],
        "value": [k / 4 for k in range(n)],
        "props": [f'{{"k": {k % 100}}}' for k in range(n)],
    }
    told = against_sql(spark, tmp_path, "stored_tables", events=events)
    assert told.set_index("datatype").total["funding_settlements"] > 2.0**63


def test_days_beyond_the_year_9999_have_no_sign(spark, tmp_path):
    keys = [0, 1, 2932, 2933, 14_999, 89_999]
    customer = {"c_custkey": keys, "c_name": [f"c{k}" for k in keys]}
    told = against_sql(spark, tmp_path, "instrument_tags", customer=customer)
    assert not told.day.str.contains("+", regex=False).any() and (told.day.str.len() > 10).any()


def test_days_beyond_the_last_timestamp(spark, tmp_path):
    """Held against numpy's days: at these keys the SQL itself overflows."""
    keys = [106_751, 106_752, 899_999, 2_147_484, 5_399_999, 10**12]
    pq.write_table(pa.table({"c_custkey": keys}), f"{tmp_path}/customer.parquet")
    got = {r.c_custkey: (r.kind, r.day, r.lost) for r in catalogue.QUERIES["instrument_tags"](spark, str(tmp_path)).collect()}
    assert got == {k: ("address" if k % 3 else "pair", str(np.datetime64(k * 1000, "D")), k - 101) for k in keys}


def test_days_of_all_times_as_duckdb_has_them(spark):
    draw = random.Random(5)
    times = [draw.randrange(-(2**63) + 10**15, 2**63 - 10**15) for _ in range(500)] + [draw.randrange(-(10**17), 10**16) for _ in range(1500)]
    times += [0, -1, 86_399_999_999, 86_400_000_000, -62_167_219_200_000_000, -62_167_219_200_000_001, -62_135_596_800_000_000, 253_402_300_800_000_000]
    got = {r.t: r.day for r in spark.createDataFrame([(t,) for t in times], "t long").select("t", scalars.day_of(F.col("t")).alias("day")).collect()}
    frame = pd.DataFrame({"t": times})  # noqa: F841
    assert got == dict(duckdb.sql("select t, strftime(make_timestamp(t), '%Y-%m-%d') from frame").fetchall())


@pytest.mark.parametrize("name", ["frames_htx", "frames_binance", "frames_bitso", "bitso_orders", "wire_contexts", "wire_liquidations", "wire_tickers"])
def test_a_frame_is_parsed_once(spark, name):
    text = catalogue.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    frames = 2 if name in ("frames_htx", "frames_binance") else 1
    assert text.count("from_json") == frames


def test_a_checksum_works_out_its_sides_once(spark):
    """Inside a lambda over the ranks a side was worked out again for each of them."""
    side = "transform(sequence(1, 3), x -> named_struct('price', cast(x * id as string), 'size', '1'))"
    rows = spark.range(50).select(F.expr(side).alias("bids"), F.expr(side).alias("asks"))
    text = rows.select(codecs.okx_checksum(F.col("bids"), F.col("asks")).alias("c"))._jdf.queryExecution().optimizedPlan().toString()
    assert "sequence(0, 24" not in text and "0, 1, 2, 3, 4, 5, 6, 7, 8" not in text
    levels = "array<struct<price:string,size:string>>"
    books = [([("2", "1")], None), (None, [("3", "1")]), ([], []), ([(str(k), "1") for k in range(30)], [(str(k), "2") for k in range(27)]), ([(None, None), ("1", None)], [("4", "1")])]
    got = [r.c for r in spark.createDataFrame(books, f"bids {levels}, asks {levels}").select(codecs.okx_checksum(F.col("bids"), F.col("asks")).alias("c")).collect()]
    shown = [[[tuple(x for x in level if x is not None) for level in side or ()] for side in book] for book in books]
    assert got == [codecs.okx_crc(*book) for book in shown]


def test_short_books_are_cut_in_one_window(spark):
    """No blocks, whose ends work out all messages a second time."""
    text = catalogue.QUERIES["book_replay_checksum"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 1 and "_block" not in text


@pytest.mark.parametrize("again", [False, True])
def test_cycles_of_a_chain_are_folded_apart(spark, monkeypatch, again):
    """A task for each cycle of the coverage; a chain as a whole only where slots come again after a close."""
    rows, seq = [], 0
    for cycle in range(4):
        start = 100 if again and cycle == 3 else 100 + 1000 * cycle
        for kind, slot, height in [("open", start, None), *(("meta", start + k, start + 2 * k) for k in range(30)), ("close", None, None)]:
            seq += 1
            rows.append(("c", seq, kind, slot, 0, height))
    dealt, real = [], type(spark.range(1)).repartition

    def repartition(self, *by):
        dealt.append(by)
        return real(self, *by)

    monkeypatch.setattr(type(spark.range(1)), "repartition", repartition)
    frame = spark.createDataFrame(rows, "chain string, seq long, kind string, slot long, bank_id long, block_height long")
    got = [(r.seq, r.place, r.slot, r.block_height, r.blocks_lost, r.verdict) for r in chain.assembled(frame, coverage=True).orderBy("seq", "place").collect()]
    assert dealt == [("key", "cycle"), *([("key",)] if again else [])]
    book, want = chain.SlotBook(coverage=True), []
    for _, n, kind, slot, bank, height in rows:
        want += [(n, place, x[0], *x[2:]) for place, x in enumerate(book.take(kind, slot, bank, None, height, 1, "-")[1])]
    assert got == want and max(x[4] for x in want) > 100
