"""Commits, archive objects, back-fill cycles and state over runs."""

import gzip
import hashlib
import os
import random
import time

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tickloom import schemas
from tickloom.operators import cumulative, reconcile
from tickloom.sources import archive, commits, files

DAY = 86_400_000_000


def prints(spark, ids, day=0, origin="ws"):
    return spark.createDataFrame([(DAY * day + k, "A/B", "buy", 1.0, 2.0, "x", str(k), 0, 0, origin) for k in ids], schemas.TRADES)


def ids(frame):
    return sorted(int(r.id) for r in frame.select("id").collect())


# ---- commits


def test_commits_are_listed_and_read(spark, tmp_path):
    leaf = commits.Leaf(spark, f"file://{tmp_path}/leaf")
    assert leaf.read("trades").count() == leaf.listed().count() == 0
    leaf.commit(prints(spark, range(5)).repartition(3), "trades")
    beats = spark.createDataFrame([(True, "A/B", 0, 5, 9, "trades.v1")], "heartbeat boolean, symbol string, rows long, t_min_us long, t_max_us long, schema_id string")
    leaf.commit(prints(spark, range(5, 9)), "trades", beats=beats)
    leaf.commit(prints(spark, []), "trades")
    assert ids(leaf.read("trades")) == list(range(9)) and len(leaf.commits()) == 3
    assert leaf.listed().agg(F.sum("rows")).first()[0] == 9 and leaf.lines().where("heartbeat").count() == 1
    for r in leaf.listed().collect():
        assert r.sha256 == hashlib.sha256((tmp_path / "leaf" / r.filename).read_bytes()).hexdigest()
    assert {r.intact for r in leaf.verified().collect()} == {True}
    gone = leaf.listed().first().filename
    (tmp_path / "leaf" / gone).unlink()
    assert [r.filename for r in leaf.verified().where("not intact").collect()] == [gone]
    assert "_lock" not in os.listdir(tmp_path / "leaf")


@pytest.mark.parametrize("step", ["stage", "describe", "move", "publish"])
@pytest.mark.parametrize("after", [False, True])
def test_a_killed_writer_leaves_nothing_that_is_listed(spark, tmp_path, monkeypatch, step, after):
    """Killed before or after each step, with its lock left behind; the next writer sweeps and goes on."""
    leaf = commits.Leaf(spark, f"file://{tmp_path}/leaf", lock_seconds=0.0)
    leaf.commit(prints(spark, [1, 2]), "trades")
    own = getattr(commits.Leaf, step)

    def killed(self, *args):
        if after:
            own(self, *args)
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(commits.Leaf, step, killed)
        # A process that dies removes no lock.
        patch.setattr(commits.Leaf, "held", lambda self, owner: _left(self, owner))
        with pytest.raises(KeyboardInterrupt):
            leaf.commit(prints(spark, [3, 4]), "trades", "dying")
    listed = [1, 2, 3, 4] if (step, after) == ("publish", True) else [1, 2]
    assert leaf.holder() == "dying" and ids(leaf.read("trades")) == listed
    time.sleep(0.01)
    leaf.commit(prints(spark, [5]), "trades")
    assert ids(leaf.read("trades")) == [*listed, 5] and leaf.holder() is None
    there = {n for n in os.listdir(tmp_path / "leaf") if n.endswith(".parquet")}
    assert there == {r.filename for r in leaf.listed().collect()} and not leaf.names("_staging")


class _left:
    """A lock that is taken and not given back."""

    def __init__(self, leaf, owner):
        leaf.acquire(owner)

    def __enter__(self):
        return self

    def __exit__(self, *_):
        return False


def test_one_writer_at_a_time(spark, tmp_path):
    first, second = (commits.Leaf(spark, f"file://{tmp_path}/leaf") for _ in range(2))
    with first.held("one"):
        with pytest.raises(commits.Locked, match="one"):
            second.commit(prints(spark, [1]), "trades", "two")
    second.commit(prints(spark, [1]), "trades", "two")
    (tmp_path / "leaf" / "_lock").write_text("")
    with pytest.raises(commits.Locked):
        first.acquire("one")
    os.utime(tmp_path / "leaf" / "_lock", (1, 1))
    first.acquire("one")
    assert first.holder() == "one"


# ---- archives


def test_archive_objects_in_order_from_a_cursor(spark, tmp_path):
    root = tmp_path / "objects"
    (root / "d1").mkdir(parents=True)
    (root / "d2").mkdir()
    (root / "d1" / "a").write_text("a1\r\na2\n")
    (root / "d1" / "b.gz").write_bytes(gzip.compress(b"b1\nb2\nb3"))
    with pa.CompressedOutputStream(str(root / "d2" / "c.lz4"), "lz4") as out:
        out.write(b"c1\n\nc3\n")
    (root / "d2" / "_SUCCESS").write_text("")
    (root / "d2" / "empty").write_text("")
    archive.register(spark)

    def read(**options):
        return sorted(tuple(r) for r in spark.read.format(archive.NAME).options(**options).load(str(root)).collect())

    assert read() == [("d1/a", 0, "a1"), ("d1/a", 1, "a2"), ("d1/b.gz", 0, "b1"), ("d1/b.gz", 1, "b2"), ("d1/b.gz", 2, "b3"), ("d2/c.lz4", 0, "c1"), ("d2/c.lz4", 1, ""), ("d2/c.lz4", 2, "c3")]
    assert {r[0] for r in read(cursor="d1/a")} == {"d1/b.gz", "d2/c.lz4"} and {r[0] for r in read(prefix="d2/")} == {"d2/c.lz4"}
    assert read(cursor="d9") == []
    for bad in ("../objects/d1/a", "d1/../../x"):
        with pytest.raises(ValueError):
            archive.content(str(root), bad)

    def streamed(name):
        stream = spark.readStream.format(archive.NAME).option("cursor", "d1/a").load(str(root))
        query = stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "ck")).start(str(tmp_path / "out"))
        query.processAllAvailable()
        query.stop()
        return sorted(r.value for r in spark.read.parquet(str(tmp_path / "out")).collect())

    assert streamed("one") == ["", "b1", "b2", "b3", "c1", "c3"]
    # Only what is new comes after a restart.
    (root / "d3").write_text("d1\n")
    assert streamed("two") == ["", "b1", "b2", "b3", "c1", "c3", "d1"]


# ---- back-fill


def test_cycles_take_each_row_once(spark, tmp_path):
    """After the mark, inside gaps that overlap, in the overlap before the mark; null keys are instruments like others."""
    draw = random.Random(2)
    source = reconcile.Source("ts", "id", ("k",))
    ddl = "k string, ts long, id long, v long"
    everything = [(k, t, i, t * 10 + i) for k in ("a", "b", None) for t in range(0, 1000, 3) for i in range(draw.randint(1, 2))]
    have = [r for r in everything if r[1] < 600 and not 100 <= r[1] <= 180 and not 300 <= r[1] <= 330 and r[0] != "b"]
    gaps = [(k, a, b) for k in ("a", None) for a, b in ((100, 180), (110, 120), (150, 170))]
    persisted, dump = spark.createDataFrame(have, ddl), spark.createDataFrame(everything + everything[::2], ddl).repartition(4)
    ledger = spark.createDataFrame(gaps, "k string, opened_us long, closed_us long")
    marks = {k: max((r[1], r[2]) for r in have if r[0] == k) for k in ("a", None)}

    def want(overlap, named):
        out = set()
        for r in set(everything) - set(have):
            mark = marks.get(r[0])
            if mark is None or r[1:3] > mark or (overlap and r[1] >= mark[0] - overlap) or (named and any(g[0] == r[0] and g[1] <= r[1] <= g[2] for g in gaps)):
                out.add(r)
        return sorted(out, key=str)

    for overlap, named in ((0, False), (350, False), (0, True), (350, True)):
        got = reconcile.found(persisted, dump, source, overlap, ledger if named else None)
        assert sorted(map(tuple, got.collect()), key=str) == want(overlap, named)
    both = persisted.unionByName(reconcile.found(persisted, dump, source, 350, ledger))
    assert reconcile.found(both, dump, source, 350, ledger).count() == 0


def test_a_cycle_run_again_adds_nothing(spark, tmp_path):
    leaf, source = commits.Leaf(spark, f"file://{tmp_path}/leaf"), reconcile.Source("source_trade_ts_us", "id")
    leaf.commit(prints(spark, [1, 2, 5]), "trades")
    gaps = spark.createDataFrame([("x", "A/B", 3, 4)], "exchange string, symbol string, opened_us long, closed_us long")
    for _ in range(2):
        reconcile.cycle(leaf, "trades", prints(spark, range(9), origin="rest"), source, gaps=gaps)
    got = {int(r.id): r.origin for r in leaf.read("trades").collect()}
    assert got == {1: "ws", 2: "ws", 5: "ws"} | dict.fromkeys((3, 4, 6, 7, 8), "rest") and leaf.read("trades").count() == 8


# ---- state over runs


def test_runs_in_turn_equal_one_run(spark, tmp_path):
    ddl = "k string, n long, low long, high long"
    draw = random.Random(1)
    data = [(draw.choice(["a", "b", None]), 1, v := draw.randint(-9, 9), v) for _ in range(90)]
    merges = {"n": "sum", "low": "min", "high": "max"}
    one, three = (cumulative.State(spark, f"{tmp_path}/{n}", ["k"], merges) for n in ("one", "three"))
    one.add("all", spark.createDataFrame(data, ddl))
    for run in (0, 1, 2, 1):
        three.add(str(run), spark.createDataFrame(data[run::3], ddl))
    assert sorted(map(tuple, three.total().collect()), key=str) == sorted(map(tuple, one.total().collect()), key=str)
    assert three.runs().select("run").distinct().count() == 3
    with pytest.raises(ValueError):
        cumulative.State(spark, str(tmp_path), ["k"], {"n": "avg"})


def test_metrics_are_measured_while_a_frame_is_written(spark, tmp_path):
    found = cumulative.measured(spark.range(100), {"rows": F.count("*"), "odd": F.count(F.when(F.col("id") % 2 == 1, 1))}, lambda f: f.write.parquet(str(tmp_path / "t")))
    assert found == {"rows": 100, "odd": 50} and spark.read.parquet(str(tmp_path / "t")).count() == 100
    assert [(r.metric, r.value) for r in cumulative.counters(spark, "1", found).collect()] == [("odd", "50"), ("rows", "100")]
