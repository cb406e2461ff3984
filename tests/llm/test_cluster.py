"""What a cluster asks of the operators: workers without the package, intermediates of several threads, runs of license diagonals."""

import os
import random
import subprocess
import sys
import threading
from pathlib import Path

from pyspark.sql import functions as F

from tickloom.llm import licenses
from tickloom.llm._common import Store, cleaned

ROOT = str(Path(__file__).resolve().parents[2])

ALONE = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
from tickloom.llm import queries
import corpus_pipeline
spark = SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").getOrCreate()
def lacking(_):
    try:
        import tickloom
    except ModuleNotFoundError:
        return [True]
    return [False]
assert all(spark.sparkContext.parallelize(range(4), 4).mapPartitions(lacking).collect()), "the workers have the package"
for name, query in (queries.QUERIES | {{"pipeline": corpus_pipeline.run}}).items():
    query(spark, "/root/testdata/sf0.001").write.format("noop").mode("overwrite").save()
    print("done", name, flush=True)
"""


def test_workers_need_no_package(tmp_path):
    """Every query and the pipeline run where executors can't import this package."""
    script = tmp_path / "alone.py"
    script.write_text(ALONE.format(root=ROOT))
    env = {k: v for k, v in os.environ.items() if k not in ("PYTHONPATH", "SPARK_HOME") and "PYSPARK_GATEWAY" not in k}
    ran = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    assert ran.returncode == 0, ran.stderr[-3000:]
    assert ran.stdout.count("done ") == 14


def test_a_block_cleans_its_own_threads_intermediates(spark):
    """A ``cleaned`` block that ends in one thread leaves what another wrote."""
    inside, wrote, kept = threading.Event(), threading.Event(), []

    def other():
        inside.wait(60)
        kept.append(Store(spark).keep(spark.range(10)))
        wrote.set()

    thread = threading.Thread(target=other)
    thread.start()
    with cleaned():
        own = Store(spark).keep(spark.range(5))
        with cleaned():
            inner = Store(spark).keep(spark.range(7))
        inside.set()
        assert wrote.wait(60)
        assert own.count() == 5 and not os.path.exists(inner._stored_at.removeprefix("file://"))
    thread.join()
    assert kept[0].count() == 10 and not os.path.exists(own._stored_at.removeprefix("file://"))


def plain_scan(text, texts):
    """(labels, greatest share) by comparing every place of a text with every place of a template."""
    words = licenses.words_of(text.encode())
    found = {}
    for label, template in texts:
        own = licenses.words_of(template.encode())
        span = min(licenses.GRAM, len(own))
        hits = {}
        for i in range(len(words) - span + 1):
            for j in range(len(own) - span + 1):
                if words[i : i + span] == own[j : j + span]:
                    hits.setdefault(i - j, []).append((i, j))
        # (diagonal, first place, end, matched template words)
        runs = [[(d, min(i for i, _ in h), max(i for i, _ in h) + span, {j + k for _, j in h for k in range(span)})] for d, h in sorted(hits.items())]
        runs = [[r[0] for r in runs]]
        for order, apart in (
            (lambda r: (r[0], r[1]), lambda run, r: r[0] - run[-1][0] > licenses.DRIFT),
            (lambda r: (r[1], r[0]), lambda run, r: r[1] - max(x[2] for x in run) > 2 * licenses.DRIFT),
            (lambda r: (r[0], r[1]), lambda run, r: r[0] - run[-1][0] > licenses.DRIFT),
        ):
            parted = []
            for run in runs:
                for k, r in enumerate(sorted(run, key=order)):
                    if not k or apart(parted[-1], r):
                        parted.append([])
                    parted[-1].append(r)
            runs = parted
        for run in runs:
            n, spans = len(set().union(*(r[3] for r in run))), max(r[2] for r in run) - min(r[1] for r in run)
            if n >= licenses.DENSITY * spans and (n >= licenses.LEAST_WORDS or n >= len(own)) and n >= licenses.LEAST_SHARE * len(own):
                found[label] = max(found.get(label, 0), min(n / len(own), 1.0))
    return ",".join(sorted(found)), round(max(found.values(), default=0.0), 6)


def test_runs_equal_plain_merging(spark):
    """Templates that repeat words, texts with words put in, left out and swapped."""
    draw = random.Random(8)
    words = [f"w{k}" for k in range(400)]
    texts, rows = [], []
    for k in range(4):
        body = [draw.choice(words) for _ in range(90)]
        for _ in range(draw.randint(1, 4)):
            at = draw.randrange(80)
            body[at : at + 6] = [draw.choice(["la", "lo"])] * 6
        texts.append((f"t{k}", " ".join(body)))
    texts.append(("chorus", " ".join(["la"] * 5 + [f"v{k}" for k in range(90)])))
    for k in range(120):
        body = texts[k % 5][1].split()[draw.randint(0, 30) :][: draw.randint(30, 95)]
        for _ in range(draw.randint(0, 4)):
            at = draw.randrange(len(body))
            body[at : at + draw.randint(0, 2)] = draw.choices(["la", "new", "w1"], k=draw.randint(0, 3))
        rows.append((k, " ".join(draw.choices(words, k=20) + body + draw.choices(["la", *words[:5]], k=20))))
    lost = ["la"] * 5 + [f"v{k}" for k in range(60)]
    rows.append((500, " ".join([*lost[:35], "two", "more", *lost[35:]])))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = {r.doc_id: (r.labels, r.score) for r in licenses.scan(docs, tuple(texts)).where(F.col("n_base") == 0).collect()}
    assert found == {i: plain_scan(t, texts) for i, t in rows}
    assert "chorus" in found[500][0] and sum(bool(x) for x, _ in found.values()) > 60
