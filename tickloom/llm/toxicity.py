"""Toxicity by maximum-scoring segments of token log-odds.

Words and their first five characters get log-odds of toxic against other
training documents under an informative Dirichlet prior; of near copies among
the training documents one counts. A linear scan finds every
maximal segment of a document's token scores. Segment scores follow an
extreme-value law on clean text; its rate and place are fitted on the clean
training documents, and a document's score adds up what its segments exceed
the law by, mapped to 0..1 so that the best training cut lies at ``CUT``.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import repeat
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm._common import Store, slices
from tickloom.llm.decontaminate import WORDS, run_hashes, word_codes
from tickloom.llm.quality import fold, labelled, sampled

#: Training documents at most (about), drawn by a hash of doc_id.
SAMPLE = 40_000
#: Score from which a document is called toxic.
CUT = 0.7
#: Weight of the Dirichlet prior, in documents; least likelihood-ratio statistic of a scored token (about one in a million by chance); expected chance segments below which one is significant.
PRIOR, LEAST_G, EXPECT = 20.0, 24.0, 0.01
STEM = 5
STEMS = itemgetter(slice(STEM))
#: Share of word triples from which two training documents count as one.
COPY = 0.8
#: Score of a token that the model doesn't know: text drifts down between toxic words.
DRIFT = -0.5


def words_of(text: str | None) -> list[str]:
    """Lower-case words: runs of digits, letters a-z and non-ASCII characters."""
    parts = (text or "").lower().encode().translate(WORDS).decode()
    return parts.split() if parts.isascii() else [w for w in parts.split(" ") if w]


@dataclass
class Model:
    words: dict[str, float] = field(default_factory=dict)
    stems: dict[str, float] = field(default_factory=dict)
    rate: float = 1.0
    log_k: float = 0.0
    slope: float = 0.0
    shift: float = 0.0

    def scores(self, words: list[str]) -> np.ndarray:
        whole = np.fromiter(map(self.words.get, words, repeat(DRIFT)), float, len(words))
        if self.stems:
            np.maximum(whole, np.fromiter(map(self.stems.get, map(STEMS, words), repeat(DRIFT)), float, len(words)), out=whole)
        return whole


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, sum), in linear time.

    Candidates keep the sums before and after them; each knows the last
    candidate before it that starts lower, so every one is passed once.
    """
    total = np.concatenate(([0.0], np.cumsum(scores)))
    left, right, start, end, lower = [], [], [], [], []
    for i in np.flatnonzero(scores > 0).tolist():
        a, b, s = total[i], total[i + 1], i
        while True:
            j = len(left) - 1
            while j >= 0 and left[j] >= a:
                j = lower[j]
            if j < 0 or right[j] >= b:
                break
            a, s = left[j], start[j]
            del left[j:], right[j:], start[j:], end[j:], lower[j:]
        left.append(a)
        right.append(b)
        start.append(s)
        end.append(i + 1)
        lower.append(j)
    return [(s, e, float(b - a)) for s, e, a, b in zip(start, end, left, right, strict=True)]


def _excess(model: Model, found: list[tuple[int, int, float]], size: int) -> list[tuple[int, int, float]]:
    """Segments with what they exceed the extreme-value law by, for a text of ``size`` tokens; only the significant ones."""
    place = model.log_k + math.log(max(size, 1))
    over = [(s, e, model.rate * x - place) for s, e, x in found]
    return [x for x in over if x[2] >= -math.log(EXPECT)]


def _triples(text: str | None) -> np.ndarray:
    """The distinct hashes of a text's word triples; a shorter text is one run."""
    codes = word_codes([w.encode() for w in words_of(text)])
    return np.unique(run_hashes(codes, min(3, len(codes)))) if len(codes) else np.empty(0, np.int64)


def _signed(docs: DataFrame) -> DataFrame:
    """(doc_id, y, text, sign): the least hash of the text's word triples, which near copies mostly share."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            least = [int(own[0]) if len(own := _triples(text)) else 0 for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "y", "text")), pa.array(least, pa.int64())], ["doc_id", "y", "text", "sign"])

    return docs.select("doc_id", "y", "text").mapInArrow(sign, "doc_id long, y int, text string, sign long")


def _single(rows: DataFrame) -> DataFrame:
    """(y, text): the signed rows without those whose text is a copy of the first one with their sign and label.

    A sign only proposes: the triples of both texts are compared, and a row
    below COPY stays. Texts without words are copies where they are equal.
    """
    text = F.coalesce("text", F.lit(""))
    first = rows.groupBy("sign", "y").agg(F.min(F.struct("doc_id", text.alias("text"))).alias("first"))
    met = rows.join(first, ["sign", "y"]).select("doc_id", "y", text.alias("text"), F.col("first.doc_id").alias("first_id"), F.col("first.text").alias("first_text"))
    others = met.where("text <> first_text").dropDuplicates(["y", "text"])

    def differ(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            kept = []
            for own, other in zip(batch.column("text").to_pylist(), batch.column("first_text").to_pylist(), strict=True):
                a, b = _triples(own), _triples(other)
                common = len(np.intersect1d(a, b, assume_unique=True))
                kept.append(not common or common < COPY * (len(a) + len(b) - common))
            yield batch.select(["y", "text"]).filter(pa.array(kept))

    return first.select("y", "first.text").unionByName(others.select("y", "text", "first_text").mapInArrow(differ, "y int, text string"))


def _counted(docs: DataFrame) -> DataFrame:
    """(token, stem, toxic, other): in how many training documents of each kind a word or stem occurs."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            tally = {key: Counter() for key in ((0, False), (0, True), (1, False), (1, True))}
            for y, text in zip(batch.column("y").to_pylist(), batch.column("text").to_pylist(), strict=True):
                words = set(words_of(text))
                tally[y, False].update(words)
                tally[y, True].update({w[:STEM] for w in words if len(w) > STEM})
            for (y, stem), counts in tally.items():
                n = np.fromiter(counts.values(), np.int64, len(counts))
                none = np.zeros(len(n), np.int64)
                columns = [pa.array(list(counts), pa.string()), pa.array(np.full(len(n), stem)), pa.array(n if y else none), pa.array(none if y else n)]
                yield pa.RecordBatch.from_arrays(columns, ["token", "stem", "toxic", "other"])

    counted = docs.mapInArrow(count, "token string, stem boolean, toxic long, other long")
    return counted.groupBy("token", "stem").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))


def _log_odds(counts: DataFrame, toxic: int, other: int) -> DataFrame:
    """Each token's log-odds with the pooled rate as the prior, its likelihood-ratio statistic and its chance in other documents."""
    n = F.col("toxic") + F.col("other")
    share = n / float(toxic + other)
    a, b = F.col("toxic") + share * PRIOR, F.col("other") + share * PRIOR
    delta = F.log(a / (toxic + PRIOR - a + 1)) - F.log(b / (other + PRIOR - b + 1))

    def part(seen: str, kind: int):
        return F.when(F.col(seen) > 0, F.col(seen) * F.log(F.col(seen) * float(toxic + other) / (n * float(kind)))).otherwise(0.0)

    g = 2 * (part("toxic", toxic) + part("other", other))
    return counts.withColumn("delta", delta).withColumn("g", g).withColumn("chance", b / (other + PRIOR))


def _law(tokens, mean_size: float) -> float:
    """The decay rate of chance segments: the root of E[exp(rate * score)] = 1 on clean text."""
    score = np.array([t["delta"] for t in tokens if not t["stem"]])
    chance = np.array([t["chance"] for t in tokens if not t["stem"]]) / max(mean_size, 1.0)
    if not len(score):
        return 1.0
    rest = max(0.0, 1 - chance.sum())
    low, high = 1e-6, 1.0
    value = lambda r: float((chance * np.exp(r * score)).sum() + rest * math.exp(r * DRIFT)) - 1
    while value(high) < 0 and high < 64:
        high *= 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if value(mid) < 0 else (low, mid)
    return high


def _scan(docs: DataFrame, model: Model) -> DataFrame:
    """Per row: doc_id, size, most (best segment), excess, and the significant passages (start word, end word, excess)."""
    passages = pa.list_(pa.struct([("first_word", pa.int64()), ("end_word", pa.int64()), ("excess", pa.float64())]))
    schema = "doc_id long, size long, most double, excess double, passages array<struct<first_word:long,end_word:long,excess:double>>"
    # As large as the tokens of the bounded training sample. Plain values: a broadcast names classes by their module, which workers may lack.
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(**shared.value)
        for batch in slices(batches):
            size, most, excess, spans = [], [], [], []
            for text in batch.column("text").to_pylist():
                words = words_of(text)
                found = segments(model.scores(words)) if words else []
                over = _excess(model, found, len(words))
                size.append(len(words))
                most.append(max((x for _, _, x in found), default=0.0))
                excess.append(sum(x for _, _, x in over))
                spans.append([{"first_word": s, "end_word": e, "excess": x} for s, e, x in over])
            columns = [batch.column("doc_id"), pa.array(size, pa.int64()), pa.array(most, pa.float64()), pa.array(excess, pa.float64()), pa.array(spans, passages)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "size", "most", "excess", "passages"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(scan, schema)


def _calibrate(excess: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve whose value is CUT at the cut of the best balanced accuracy."""
    order = np.argsort(excess)
    x, t = excess[order], y[order]
    below_clean, below_toxic = np.cumsum(1 - t), np.cumsum(t)
    right = below_clean / max(1, (1 - t).sum()) + 1 - below_toxic / max(1, t.sum())
    ends = np.flatnonzero(np.append(np.diff(x) > 0, False))
    if not len(ends):
        return 1.0, float(x[-1]) + 1.0
    k = ends[int(np.argmax(right[ends]))]
    gap = float(x[k] + x[k + 1]) / 2
    slope = 4.0 / max(gap, 1e-3)
    return slope, gap - math.log(CUT / (1 - CUT)) / slope


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model | None:
    """A model from ``labels.toxic`` outside fold 1; None if one kind of label is missing."""
    store = Store(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # The sample bounds the broadcast side, so the texts need not move.
    drawn = sampled(labelled(labels, "toxic"), sample, "toxic")
    rows = store.keep(_signed(texts.join(F.broadcast(drawn), "doc_id")))
    # Copies would make every word of theirs look telling, so one of each counts.
    single = store.keep(_single(rows))
    kinds = {r["y"]: r["n"] for r in single.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if len(kinds) < 2:
        return None
    scored = _log_odds(_counted(single), kinds[1], kinds[0])
    # The sample bounds the tokens: each stands in three of its toxic documents.
    kept = scored.where((F.col("g") >= LEAST_G) & (F.col("toxic") >= 3) & (F.col("delta") > 1)).orderBy(F.desc("g"), "token", "stem").collect()
    model = Model()
    for t in kept:
        (model.stems if t["stem"] else model.words)[t["token"]] = t["delta"]
    seen = store.keep(_scan(rows.select("doc_id", "text"), model).select("doc_id", "size", "most").join(rows.select("doc_id", "y"), "doc_id"))
    clean = seen.where("y = 0 and size > 0").agg(F.avg("size").alias("size"), F.avg("most").alias("most"), F.avg(F.log("size")).alias("log_size")).first()
    if clean["size"]:
        model.rate = min(_law(kept, clean["size"]), 8.0)
        model.log_k = min(0.0, model.rate * clean["most"] - clean["log_size"] - 0.5772156649)
    got = _scan(rows.select("doc_id", "text"), model).select("doc_id", "excess").join(rows.select("doc_id", "y"), "doc_id").select("excess", "y").toPandas()
    model.slope, model.shift = _calibrate(got["excess"].to_numpy(float), got["y"].to_numpy(float))
    store.drop(seen, single, rows)
    return model


def toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, held_out, score, predicted, n_passages, passages) for each row of ``docs``.

    ``passages`` are the significant toxic segments as start:end word places.
    Learns from rows whose crc32(doc_id) mod 3 is not 1, ``sample`` of them at
    most (about), and counts a training text once with its copies: equal ones,
    and those that share its least word triple and COPY of all triples. Only
    the text is an input of a score. Nulls: a null text is
    empty (no passages, the lowest score), a null doc_id is not held out.
    Repeated rows repeat. Without labels of both kinds all scores are 0.
    """
    model = train(docs, labels, sample)
    if model is None:
        model = Model(slope=0.0, shift=0.0)
    found = _scan(docs, model)
    score = F.round(1 / (1 + F.exp(-F.greatest(F.least(model.slope * (F.col("excess") - model.shift), F.lit(30.0)), F.lit(-30.0)))), 6) if model.slope else F.lit(0.0)
    spans = F.array_join(F.transform("passages", lambda p: F.concat_ws(":", p["first_word"].cast("string"), p["end_word"].cast("string"))), ",")
    told = found.select("doc_id", (fold() == 1).alias("held_out"), score.alias("score"), F.size("passages").cast("long").alias("n_passages"), spans.alias("passages"))
    return told.select("doc_id", "held_out", "score", (F.col("score") >= CUT).cast("int").alias("predicted"), "n_passages", "passages")
