"""A hidden Markov language model over the whole vocabulary.

Texts are written once as blocks of token numbers with the block's own list of
words, so what a pass needs of the vocabulary is one row for each word of each
block. Word counts and base scores come from one join of those lists with the
counts. Words that occur LEAST times in training have emissions of their own;
the rarer ones share one emission and split it by their base chances, which
leaves nothing out: every word has its chance in every state. Each round of
Baum-Welch adds up expected counts of all partitions by word; a table of
emissions that fits BROADCAST bytes is broadcast, a larger one is joined to the
blocks that need it.

The chance of a known word w in state k is
(1 - MIX) * (1 - u) * e[w, k] / sum of e[., k] + MIX * base(w), where
base is (c + 0.5) / (N + 0.5 * (V + 1)) and u the base of an unknown word, which
is an unknown word's chance in every state. So chances over V + 1 words add to 1.
"""

from __future__ import annotations

import itertools
import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm import forward
from tickloom.llm._common import Store, slices

STATES, ROUNDS = 6, 3
#: Occurrences in training from which a word has emissions of its own.
LEAST = 50
#: The weight of the base in each emission.
MIX = 0.1
#: Bytes of emissions that are broadcast at most.
BROADCAST = 32 << 20
#: Bytes of texts in a block.
BLOCK = 8 << 20
#: Bytes of a text that are split at once.
PIECE = 1 << 20
#: The chance to stay in a state before the first round.
STAYS = 0.97
#: The first rounds see weights of words in states between 1 and e to this.
SPREAD = 3.0

# Numbers of what isn't a word with emissions of its own.
RARE, HELD, BEGUN, MOVED = -1, -2, -3, -4
GAP = re.compile(rb"[\x20\x09-\x0d]")


class Numbers(dict):
    """Words to numbers, in the order of their first use."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


def pieces(raw: bytes, most: int = PIECE) -> Iterator[bytes]:
    """A text in parts that end between words."""
    start = 0
    while len(raw) - start > most:
        found = GAP.search(raw, start + most)
        if not found:
            break
        yield raw[start : found.start()]
        start = found.start()
    yield raw[start:] if start else raw


def numbered(text: str | None, numbers: Numbers) -> np.ndarray:
    """The numbers of a text's words, and of the end, which is the empty word."""
    # bytes.lower knows A-Z only, and bytes.split cuts at space and 09-0D.
    raw = (text or "").encode().lower()
    parts = [np.fromiter(map(numbers.__getitem__, words), np.uint32, len(words)) for words in map(bytes.split, pieces(raw))]
    return np.concatenate([*parts, np.array([numbers[b""]], np.uint32)])


def packed(numbers: np.ndarray) -> bytes:
    """Numbers below 2**32 by falling bytes as far as any needs them, compressed; the first byte is their width."""
    wide = max(1, -(-int(numbers.max(initial=0)).bit_length() // 8))
    planes = np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T[:wide])
    return bytes([wide]) + zlib.compress(planes.tobytes(), 1)


def unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(data[1:]), np.uint8).reshape(data[0], -1)
    numbers = np.zeros((planes.shape[1], 4), np.uint8)
    numbers[:, : len(planes)] = planes.T
    return numbers.view("<u4").ravel().astype(np.int64)


def trained() -> Column:
    """Whether a document is learned from; a null id is."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 != 1, F.lit(True))


def encode(docs: DataFrame) -> DataFrame:
    """Blocks: (block, doc_ids, trains, lengths, tokens, words, counts); ``counts`` are the words' occurrences in training."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        blocks = itertools.count(TaskContext.get().partitionId() << 32)
        for batch in slices(batches, most=BLOCK):
            numbers = Numbers()
            texts = [numbered(t, numbers) for t in batch.column("text").to_pylist()]
            lengths, tokens = np.array([len(t) for t in texts]), np.concatenate(texts)
            trains = np.asarray(batch.column("trains"))
            counts = np.bincount(tokens[np.repeat(trains, lengths)], minlength=len(numbers))
            one = [batch.column("doc_id"), batch.column("trains"), pa.array(lengths), pa.array(list(numbers), pa.binary()), pa.array(counts)]
            ids, trains, lengths, words, counts = (pa.ListArray.from_arrays(pa.array([0, len(c)], pa.int32()), c) for c in one)
            yield pa.RecordBatch.from_arrays([pa.array([next(blocks)]), ids, trains, lengths, pa.array([packed(tokens)], pa.binary()), words, counts], ["block", "doc_ids", "trains", "lengths", "tokens", "words", "counts"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).select("doc_id", "text", trained().alias("trains"))
    return rows.mapInArrow(cut, "block long, doc_ids array<long>, trains array<boolean>, lengths array<long>, tokens binary, words array<binary>, counts array<long>")


@dataclass
class Base:
    """Training totals: tokens, distinct words, and both of the words below ``least``."""

    tokens: int
    words: int
    rare_tokens: int
    rare_words: int

    def chance(self, count: np.ndarray) -> np.ndarray:
        return (count + 0.5) / (self.tokens + 0.5 * (self.words + 1))

    def rare(self) -> float:
        """The chance of all rare words together."""
        return (self.rare_tokens + 0.5 * self.rare_words) / (self.tokens + 0.5 * (self.words + 1))


@dataclass
class Chain:
    """First states, moves and the emissions' totals of the states."""

    begins: np.ndarray
    moves: np.ndarray
    totals: np.ndarray
    #: A table (word_id, e0, e1, ...) of expected counts.
    emissions: DataFrame = field(repr=False)


def vocabulary(blocks: DataFrame) -> DataFrame:
    """(word, count, word_id) of the words in training texts."""
    each = blocks.select(F.explode(F.arrays_zip("words", "counts")).alias("w")).select("w.words", "w.counts").where("counts > 0")
    return each.groupBy(F.col("words").alias("word")).agg(F.sum("counts").alias("count")).withColumn("word_id", F.monotonically_increasing_id())


def resolve(blocks: DataFrame, words: DataFrame, base: Base, least: int = LEAST) -> DataFrame:
    """Blocks whose tokens are 0 (rare), 1 (unknown) or number a word of ``word_ids``; with each document's known tokens, base score and what its rare words' shares add to any score."""
    listed = blocks.select(F.col("block").alias("of"), F.posexplode("words").alias("place", "word"))
    found = listed.join(words, "word").select("of", "place", "count", "word_id")
    schema = "doc_ids array<long>, trains array<boolean>, lengths array<long>, known array<long>, base array<double>, rest array<double>, tokens binary, word_ids array<long>, word_counts array<long>"

    def settle(key, left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.combine_chunks()
        tokens = unpacked(left["tokens"][0].as_py())
        n = int(tokens.max()) + 1
        count, word_id = np.zeros(n, np.int64), np.full(n, -1)
        place = right["place"].to_numpy()
        count[place], word_id[place] = right["count"].to_numpy(), right["word_id"].to_numpy()
        own = np.flatnonzero(count >= least)
        fresh = np.where(count > 0, 0, 1)
        fresh[own] = np.arange(len(own)) + 2
        score = np.log10(base.chance(count))
        share = np.where((count > 0) & (count < least), score - np.log10(base.rare() or 1.0), 0.0)
        starts = np.append(0, np.cumsum(left["lengths"][0].values.to_numpy())[:-1])
        sums = [np.add.reduceat(x[tokens], starts) for x in ((count > 0).astype(np.int64), score, share)]
        columns = [left[c] for c in ("doc_ids", "trains", "lengths")]
        columns += [pa.array([s], pa.list_(k)) for s, k in zip(sums, (pa.int64(), pa.float64(), pa.float64()), strict=True)]
        columns += [pa.array([packed(fresh[tokens])], pa.binary()), pa.array([word_id[own]], pa.list_(pa.int64())), pa.array([count[own]], pa.list_(pa.int64()))]
        return pa.table(columns, names=[c.split()[0] for c in schema.split(", ")])

    texts = blocks.select("block", "doc_ids", "trains", "lengths", "tokens")
    return texts.groupBy("block").cogroup(found.groupBy("of")).applyInArrow(settle, schema)


def chances(emitted: np.ndarray, counts: np.ndarray, base: Base, totals: np.ndarray) -> np.ndarray:
    """Each token's chance in each state: rare, unknown, then the words with ``emitted`` rows (rare words' first)."""
    unknown = float(base.chance(np.array(0)))
    at_base = np.append(base.rare(), base.chance(counts))
    known = (1 - MIX) * (1 - unknown) * emitted / np.maximum(totals, 1e-300) + MIX * at_base[:, None]
    # Without training nothing is known, and a text consists of unknown words.
    return np.concatenate([known[:1], np.full((1, emitted.shape[1]), unknown), known[1:]])


def states(n: int) -> list[str]:
    return [f"e{k}" for k in range(n)]


def passed(ready: DataFrame, chain: Chain, base: Base, work: Callable, schema: str, broadcast: int = BROADCAST) -> DataFrame:
    """``work(block, table)`` for every block, an iterator of record batches; ``table`` holds the chances of its tokens.

    Blocks stay where they are while the emissions fit the broadcast; else the
    emissions come to the blocks by two shuffles.
    """
    n = len(chain.begins)
    begins, moves, totals = chain.begins, chain.moves, chain.totals
    names = states(n)

    def table_of(block: dict, own: np.ndarray, rare: np.ndarray) -> np.ndarray:
        return chances(np.concatenate([rare[None], own]), np.array(block["word_counts"], np.int64), base, totals)

    columns = ["doc_ids", "trains", "lengths", "known", "base", "rest", "tokens", "word_ids", "word_counts"]
    rows = ready.select(*columns)
    rare = next((np.array(r) for r in chain.emissions.where(F.col("word_id") == RARE).select(*names).collect()), np.zeros(n))
    emissions = chain.emissions.where("word_id >= 0")
    if emissions.count() * 8 * (n + 1) <= broadcast:
        told = emissions.toArrow()
        ids = told["word_id"].to_numpy()
        order = np.argsort(ids)
        values = np.stack([told[c].to_numpy() for c in names], axis=1).reshape(-1, n)
        shared = ready.sparkSession.sparkContext.broadcast((ids[order], values[order]))

        def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            ids, values = shared.value
            for batch in batches:
                for k in range(batch.num_rows):
                    block = batch.slice(k, 1).to_pylist()[0]
                    at = np.searchsorted(ids, np.array(block["word_ids"], np.int64))
                    yield from work(block, table_of(block, values[at], rare), begins, moves)

        return rows.mapInArrow(near, schema)

    numbered = ready.withColumn("block", F.monotonically_increasing_id())
    listed = numbered.select(F.col("block").alias("of"), F.posexplode("word_ids").alias("place", "word_id"))
    found = listed.join(emissions, "word_id").select("of", "place", *names)

    def far(key, left: pa.Table, right: pa.Table) -> pa.Table:
        block = left.to_pylist()[0]
        own = np.zeros((len(block["word_ids"]), n))
        own[right["place"].to_numpy()] = np.stack([right[c].to_numpy() for c in names], axis=1).reshape(-1, n)
        return pa.Table.from_batches(work(block, table_of(block, own, rare), begins, moves))

    return numbered.select("block", *columns).groupBy("block").cogroup(found.groupBy("of")).applyInArrow(far, schema)


def expected(block: dict, table: np.ndarray, begins: np.ndarray, moves: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A block's expected counts: (word_id, e0, e1, ...)."""
    n = len(begins)
    lengths, trains = np.array(block["lengths"]), np.array(block["trains"])
    tokens = unpacked(block["tokens"])[np.repeat(trains, lengths)]
    emitted, started, moved = forward.counts(tokens, lengths[trains], table, begins, moves) if trains.any() else (np.zeros_like(table), np.zeros(n), np.zeros((n, n)))
    ids = np.concatenate([[RARE, HELD, BEGUN], MOVED - np.arange(n), np.array(block["word_ids"], np.int64)]).astype(np.int64)
    values = np.concatenate([emitted[:1], emitted[:1] + emitted[2:].sum(axis=0), started[None], moved, emitted[2:]])
    some = values.any(axis=1)
    yield pa.RecordBatch.from_arrays([pa.array(ids[some]), *(pa.array(v[some]) for v in values.T)], ["word_id", *states(n)])


def settled(store: Store, counted: DataFrame, n: int) -> Chain:
    """A chain from expected counts, one more for each first state and move."""
    emissions = store.keep(counted)
    few = {r["word_id"]: np.array([r[c] for c in states(n)]) for r in emissions.where(F.col("word_id") < RARE).collect()}
    none = np.zeros(n)
    begins = few.get(BEGUN, none) + 1
    moves = np.stack([few.get(MOVED - k, none) for k in range(n)]) + 1
    return Chain(begins / begins.sum(), moves / moves.sum(axis=1, keepdims=True), few.get(HELD, none), emissions)


def first_chain(store: Store, words: DataFrame, base: Base, least: int, n: int) -> Chain:
    """Counts dealt to the states by weights from each word's hash, and states that mostly stay."""
    weights = [F.exp(F.pmod(F.xxhash64("word", F.lit(k)), F.lit(1000)) / 1000.0 * SPREAD) for k in range(n)]
    own = words.where(F.col("count") >= least).select("word_id", *((F.col("count") * w).alias(c) for w, c in zip(weights, states(n), strict=True)))
    emissions = store.keep(own.unionByName(own.sparkSession.createDataFrame([(RARE, *[float(base.rare_tokens)] * n)], own.schema)))
    sums = emissions.agg(*(F.sum(c).alias(c) for c in states(n))).first()
    moves = np.full((n, n), (1 - STAYS) / max(1, n - 1)) * (1 - np.eye(n)) + np.eye(n) * (STAYS if n > 1 else 1.0)
    return Chain(np.full(n, 1 / n), moves, np.array(sums, float), emissions)


def fit(ready: DataFrame, words: DataFrame, base: Base, store: Store, n: int = STATES, rounds: int = ROUNDS, least: int = LEAST, broadcast: int = BROADCAST) -> Chain:
    """Rounds of Baum-Welch over all training texts."""
    chain = first_chain(store, words, base, least, n)
    schema = "word_id long, " + ", ".join(f"{c} double" for c in states(n))
    for _ in range(rounds):
        each = passed(ready, chain, base, expected, schema, broadcast)
        old, chain = chain, settled(store, each.groupBy("word_id").agg(*(F.sum(c).alias(c) for c in states(n))), n)
        store.drop(old.emissions)
    return chain


def likelihood(block: dict, table: np.ndarray, begins: np.ndarray, moves: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(doc_id, held_out, n_tokens, n_known, base_score, score) of a block's documents."""
    lengths = np.array(block["lengths"])
    score = forward.likelihoods(unpacked(block["tokens"]), lengths, table, begins, moves) / np.log(10) + np.array(block["rest"])
    arrays = [pa.array(block["doc_ids"], pa.int64()), pa.array(~np.array(block["trains"])), pa.array(lengths), pa.array(block["known"], pa.int64()), pa.array(block["base"], pa.float64()), pa.array(score)]
    yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"])


def scores(docs: DataFrame, n: int = STATES, rounds: int = ROUNDS, least: int = LEAST, broadcast: int = BROADCAST) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for each row of ``docs``.

    ``score`` is the base-10 logarithm of the text's likelihood under the
    model. Learns from the rows whose crc32(doc_id) mod 5 is not 1. Nulls: a
    null text is empty (its one token is the end), a null doc_id is learned
    from. Repeated rows repeat, and count each time. Texts of any length are
    split in parts of 1 MB and held as numbers. Without training rows every
    score is 0, as the one unknown word has all the chance. Sums of doubles
    may differ in the last digits from run to run.
    """
    store = Store(docs.sparkSession)
    blocks = store.keep(encode(docs))
    words = store.keep(vocabulary(blocks))
    few = F.col("count") < least
    sums = words.agg(F.sum("count"), F.count("*"), F.sum(F.when(few, F.col("count"))), F.count(F.when(few, 1))).first()
    base = Base(*(int(x or 0) for x in sums))
    ready = store.keep(resolve(blocks, words, base, least))
    store.drop(blocks)
    chain = fit(ready, words, base, store, n, rounds, least, broadcast)
    told = passed(ready, chain, base, likelihood, "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double", broadcast)
    return told.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(base.tokens).cast("long").alias("train_tokens"), "base_score", "score")
