"""Quality classifier: a generalised additive model with pairwise interactions.

Cyclic boosting fits shallow trees to one feature at a time; each tree only
adds to that feature's lookup table. The strongest pairs of the residual get
two-dimensional tables in the same way. A score is a sum of table entries at
the document's bins, so scoring is vectorised additions.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm._common import Store, byte_texts, fresh, slices

#: Labelled rows that the fit takes at most (about), drawn by a hash of doc_id.
SAMPLE = 40_000
BINS, PAIR_BINS, PAIRS = 32, 8, 6
ROUNDS, PAIR_ROUNDS, RATE, LEAST = 120, 60, 0.15, 8.0

FEATURES = (
    "log_bytes",
    "log_words",
    "word_length",
    "upper",
    "digits",
    "symbols",
    "exclamations",
    "blanks",
    "brackets",
    "distinct_words",
    "repeated_runs",
    "repeated_lines",
    "log_line",
    "short_words",
    "sentence_ends",
    "entropy",
    "beyond_ascii",
    "log_longest_word",
)
PLAIN = frozenset(b".,;:?!'\"()-")
BRACKETS = frozenset(b"|<>{}[]\\/=_")
SYMBOLS = np.array([33 <= c < 127 and not chr(c).isalnum() and c not in PLAIN for c in range(256)])
BRACKET = np.array([c in BRACKETS for c in range(256)])


def features(data: bytes) -> list[float]:
    """Numbers that describe a text's form; the empty text is all zero."""
    if not data:
        return [0.0] * len(FEATURES)
    n = len(data)
    seen = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    words, lines = data.split(), [x for x in data.split(b"\n") if x.strip()]
    m, upper, lower = len(words), int(seen[65:91].sum()), int(seen[97:123].sum())
    runs = m - 2
    shares = seen[seen > 0] / n
    return [
        math.log1p(n),
        math.log1p(m),
        sum(map(len, words)) / max(1, m),
        upper / max(1, upper + lower),
        int(seen[48:58].sum()) / n,
        int(seen[SYMBOLS].sum()) / n,
        int(seen[33]) / max(1, m),
        int(seen[9:14].sum() + seen[32]) / n,
        int(seen[BRACKET].sum()) / n,
        len(set(words)) / max(1, m),
        1 - len(set(zip(words, words[1:], words[2:], strict=False))) / runs if runs > 0 else 0.0,
        1 - len(set(lines)) / max(1, len(lines)),
        math.log1p(n / max(1, len(lines))),
        sum(len(w) <= 3 for w in words) / max(1, m),
        int(seen[46] + seen[63]) / max(1, m),
        float(-(shares * np.log2(shares)).sum()),
        int(seen[128:].sum()) / n,
        math.log1p(max(map(len, words), default=0)),
    ]


@dataclass
class Model:
    """Bin edges, one table for each feature, and tables for pairs."""

    base: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    pairs: dict[tuple[int, int], np.ndarray] = field(default_factory=dict)

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)], axis=1)

    def raw(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        if not self.edges or not len(x):
            return total
        at = self.bins(x)
        for j, table in enumerate(self.tables):
            total += table[at[:, j]]
        for (i, j), table in self.pairs.items():
            total += table[self.coarse[i][at[:, i]], self.coarse[j][at[:, j]]]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(x), -30, 30)))


def _tree(g: np.ndarray, h: np.ndarray, leaves: int = 3) -> np.ndarray:
    """The step of a shallow regression tree over ordered bins: best splits first, Newton leaf values."""
    cuts = [0, len(g)]

    def gain(a: int, b: int) -> tuple[float, int]:
        gl, hl = np.cumsum(g[a:b])[:-1], np.cumsum(h[a:b])[:-1]
        gr, hr = g[a:b].sum() - gl, h[a:b].sum() - hl
        value = np.where((hl * 4 >= LEAST) & (hr * 4 >= LEAST), gl**2 / (hl + 1) + gr**2 / (hr + 1), -1.0)
        k = int(np.argmax(value)) if len(value) else 0
        return (float(value[k]) - g[a:b].sum() ** 2 / (h[a:b].sum() + 1), a + k + 1) if len(value) and value[k] >= 0 else (-1.0, a)

    while len(cuts) <= leaves:
        best = max((gain(a, b) for a, b in zip(cuts, cuts[1:], strict=False)), default=(-1.0, 0))
        if best[0] <= 1e-6:
            break
        cuts = sorted({*cuts, best[1]})
    step = np.zeros(len(g))
    for a, b in zip(cuts, cuts[1:], strict=False):
        step[a:b] = g[a:b].sum() / (h[a:b].sum() + 1)
    return step


def _pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, float]:
    """Four leaves over a grid: one cut in each direction. The step and its gain."""
    sums_g, sums_h = (np.pad(x.cumsum(0).cumsum(1), ((1, 0), (1, 0))) for x in (g, h))
    best, cut = -1.0, (0, 0)
    rows, columns = g.shape

    def quarters(s: np.ndarray, i: int, j: int) -> list[float]:
        a, b, c, d = s[i, j], s[i, columns], s[rows, j], s[rows, columns]
        return [a, b - a, c - a, d - b - c + a]

    for i in range(1, rows):
        for j in range(1, columns):
            value = sum(x * x / (y + 1) for x, y in zip(quarters(sums_g, i, j), quarters(sums_h, i, j), strict=True))
            if value > best:
                best, cut = value, (i, j)
    step = np.zeros_like(g, dtype=float)
    if cut != (0, 0):
        i, j = cut
        v = [x / (y + 1) for x, y in zip(quarters(sums_g, i, j), quarters(sums_h, i, j), strict=True)]
        step[:i, :j], step[:i, j:], step[i:, :j], step[i:, j:] = v
    return step, best


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """A model of labels 0/1. One class only, or no rows: a constant. Leaves need weight, so few rows give few cuts or none."""
    rate = (y.sum() + 1) / (len(y) + 2) if len(y) else 0.5
    model = Model(base=math.log(rate / (1 - rate)))
    if not len(y) or y.min() == y.max():
        return model
    for j in range(x.shape[1]):
        model.edges.append(np.unique(np.quantile(x[:, j], np.arange(1, BINS) / BINS)))
        size = len(model.edges[-1]) + 1
        model.tables.append(np.zeros(size))
        model.coarse.append(np.arange(size) * PAIR_BINS // size)
    at, total = model.bins(x), np.full(len(y), model.base)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for j, table in enumerate(model.tables):
            g, h = slopes()
            b = at[:, j]
            step = RATE * _tree(np.bincount(b, g, len(table)), np.bincount(b, h, len(table)))
            table += step
            total += step[b]

    rough = np.stack([c[at[:, j]] for j, c in enumerate(model.coarse)], axis=1)

    def grid(i: int, j: int) -> tuple[np.ndarray, float]:
        g, h = slopes()
        cell = rough[:, i] * PAIR_BINS + rough[:, j]
        return _pair_tree(*(np.bincount(cell, v, PAIR_BINS**2).reshape(PAIR_BINS, PAIR_BINS) for v in (g, h)))

    ranked = sorted(combinations(range(x.shape[1]), 2), key=lambda p: -grid(*p)[1])[:PAIRS]
    model.pairs = {p: np.zeros((PAIR_BINS, PAIR_BINS)) for p in ranked}
    for _ in range(PAIR_ROUNDS):
        for (i, j), table in model.pairs.items():
            step = RATE * grid(i, j)[0]
            table += step
            total += step[rough[:, i], rough[:, j]]
    return model


def described(docs: DataFrame) -> DataFrame:
    """(doc_id, x array<double>) for each row."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = pa.array([features(t) for t in byte_texts(batch)], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), rows], ["doc_id", "x"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(scan, "doc_id long, x array<double>")


def fold(doc_id="doc_id"):
    """crc32 of doc_id as text, modulo 3; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % 3


def labelled(labels: DataFrame, label: str) -> DataFrame:
    """(doc_id, y): one label for each id outside fold 1; null ids and labels are dropped, contradicting rows give their mean's side."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("double").alias("y")).dropna()
    return known.where(fold() != 1).groupBy("doc_id").agg((F.avg("y") >= 0.5).cast("int").alias("y"))


def sampled(rows: DataFrame, most: int, salt: str) -> DataFrame:
    """All rows up to ``most``, else about so many, by a hash of doc_id: the same at every run."""
    n = rows.count()
    if n <= most:
        return rows
    return rows.where(F.pmod(F.xxhash64(F.lit(salt), "doc_id"), F.lit(1 << 30)) < int((1 << 30) * most / n))


def quality(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row of ``docs``.

    Learns from ``labels.quality`` of rows whose crc32(doc_id) mod 3 is not 1,
    ``sample`` of them at most (about). Only the text is an input of a score.
    Nulls: a null text is empty, a null doc_id is not held out. Repeated rows
    repeat; equal texts score alike. Of several texts of one labelled doc_id
    the one with the least features is learnt from. Without labels of both
    kinds every score is the labels' rate (0.5 without any). Other columns are
    not read.
    """
    rows = Store(docs.sparkSession).keep(described(docs))
    train = sampled(labelled(labels, "quality"), sample, "quality").join(rows, "doc_id").groupBy("doc_id", "y").agg(F.min("x").alias("x"))
    got = train.orderBy("doc_id").toPandas()
    model = fit(np.array(got["x"].tolist(), float).reshape(-1, len(FEATURES)), got["y"].to_numpy(float))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.asarray(batch.column("x").flatten()).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.round(model.score(x), 6))], ["doc_id", "score"])

    scored = rows.mapInArrow(score, "doc_id long, score double")
    return scored.select("doc_id", (fold() == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def good_documents(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The rows of ``docs`` that the classifier accepts, with their own columns; each row is judged by its own text.

    Learns as ``quality`` does; of several texts of one labelled doc_id the one
    with the least hash is learnt from. Nulls: a null text is judged as the
    empty one, a null doc_id keeps its row if the text is accepted. Repeated
    rows stay or go together. An empty table gives an empty one; without labels
    of both kinds all rows stay if the labels' rate is half or more (without
    any: all), else none.
    """
    tag = fresh(docs, "tag")
    texts = docs.withColumn(tag, F.xxhash64(F.coalesce("text", F.lit("")), F.length(F.coalesce("text", F.lit("")))))
    # Copies are described again rather than moved to be compared.
    rows = Store(docs.sparkSession).keep(described(texts.select(F.col(tag).alias("doc_id"), "text")))
    ids = texts.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(tag).alias("text_id"))
    train = sampled(labelled(labels, "quality"), sample, "quality").join(ids, "doc_id").groupBy("doc_id", "y").agg(F.min("text_id").alias("text_id")).join(rows.dropDuplicates(["doc_id"]).withColumnRenamed("doc_id", "text_id"), "text_id")
    got = train.select("doc_id", "y", "x").orderBy("doc_id").toPandas()
    model = fit(np.array(got["x"].tolist(), float).reshape(-1, len(FEATURES)), got["y"].to_numpy(float))

    def refuse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.asarray(batch.column("x").flatten()).reshape(-1, len(FEATURES))
            yield batch.select(["doc_id"]).filter(pa.array(np.round(model.score(x), 6) < 0.5))

    bad = rows.mapInArrow(refuse, "doc_id long").distinct().withColumnRenamed("doc_id", tag)
    return texts.join(bad, tag, "left_anti").select(*docs.columns)
