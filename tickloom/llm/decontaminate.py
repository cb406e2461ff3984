"""Benchmark decontamination by a prefix-filtered set join.

A window is 13 consecutive words of a benchmark item (a shorter item is one
window). Its tokens are its five-word shingles (a window below five words is
its own token). A document holds a window only if it holds all its tokens, so
the necessary prefix is one token: the one that is rarest in the whole corpus.
Documents are joined to windows on that token alone; the window's length and
the token's place in it fix where the window would have to start, bounds drop
the starts that fall outside the document, and the words themselves are
compared at last.

A bit table of fixed size keeps tokens of no window out of the join. It fills
up as the benchmark grows and then drops less, never a match.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm._common import KEY, Store, byte_texts, fresh, keyed, slices

WINDOW = 13
SHINGLE = 5
#: Bits of a token's hash that address the bit table.
TABLE_BITS = 24
#: Prefix rows below which the join broadcasts them; above, it shuffles both sides.
BROADCAST_ROWS = 50_000

WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words_of(data: bytes) -> list[bytes]:
    """A-Z lowered; words are runs of digits, letters a-z and non-ASCII characters."""
    return data.translate(WORDS).split()


def run_hashes(codes: np.ndarray, length: int) -> np.ndarray:
    """A mixed 64-bit hash of every run of ``length`` words, from the words' hashes."""
    n = len(codes) - length + 1
    if n <= 0:
        return np.empty(0, np.int64)
    h = np.full(n, length, np.uint64)
    for k in range(length):
        h = h * np.uint64(0x9E3779B97F4A7C15) + codes[k : k + n]
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC2B2AE3D27D4EB4F)
    h ^= h >> np.uint64(29)
    return h.view(np.int64)


def word_codes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words, repeat(0)), np.uint64, len(words))


def _windows(items: DataFrame) -> DataFrame:
    """(window string, size int, items array<string>, tokens array<struct<token, at>>): one row per distinct window."""
    schema = "item string, window string, size int, tokens array<struct<token:long,at:int>>"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out = []
            for item, data in zip(batch.column("item").to_pylist(), byte_texts(batch), strict=True):
                words = words_of(data)
                if item is None or not words:
                    continue
                size, span = min(WINDOW, len(words)), min(SHINGLE, len(words))
                tokens = run_hashes(word_codes(words), span).tolist()
                for s in range(len(words) - size + 1):
                    own = [{"token": tokens[s + k], "at": k} for k in range(size - span + 1)]
                    out.append({"item": item, "window": b" ".join(words[s : s + size]).decode("utf-8", "replace"), "size": size, "tokens": own})
            yield pa.RecordBatch.from_pylist(out, _arrow("item string, window string, size int", tokens=True))

    rows = items.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("string").alias("text"))
    cutted = rows.mapInArrow(cut, schema)
    return cutted.groupBy("window").agg(F.first("size").alias("size"), F.collect_set("item").alias("items"), F.first("tokens").alias("tokens"))


def _arrow(ddl: str, tokens: bool = False) -> pa.Schema:
    kinds = {"string": pa.string(), "int": pa.int32(), "long": pa.int64()}
    fields = [pa.field(n, kinds[t]) for n, t in (x.split() for x in ddl.split(", "))]
    if tokens:
        fields.append(pa.field("tokens", pa.list_(pa.struct([("token", pa.int64()), ("at", pa.int32())]))))
    return pa.schema(fields)


def _bit_table(tokens: DataFrame) -> bytes:
    """One bit for each value of the leading hash bits: 2 MB whatever the benchmark's size."""
    place = F.shiftrightunsigned("token", 64 - TABLE_BITS) + 1
    parts = tokens.groupBy(F.expr("0").alias("_"), F.bitmap_bucket_number(place).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
    bits = bytearray(1 << (TABLE_BITS - 3))
    for row in parts.collect():
        at = (row["bucket"] - 1) * 4096
        bits[at : at + 4096] = row["bits"]
    return bytes(bits)


class _Filter:
    """Token lengths and the bit table, for the document scans."""

    def __init__(self, spark, tokens: DataFrame, lengths: list[int]):
        self.lengths = lengths
        self.bits = spark.sparkContext.broadcast(_bit_table(tokens))

    def hits(self, words: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
        """(places, tokens, length): the runs of each length whose bit is set."""
        codes = word_codes(words)
        table = np.frombuffer(self.bits.value, np.uint8)
        for length in self.lengths:
            tokens = run_hashes(codes, length)
            place = tokens.view(np.uint64) >> np.uint64(64 - TABLE_BITS)
            at = np.flatnonzero(table[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & 1)
            yield at, tokens[at], length


def _rarity(docs: DataFrame, seen: _Filter) -> DataFrame:
    """(token, n): how often each token that the bit table lets through occurs in all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [tokens for data in byte_texts(batch) for _, tokens, _ in seen.hits(words_of(data))]
            token, n = np.unique(np.concatenate(found) if found else np.empty(0, np.int64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(token), pa.array(n)], ["token", "n"])

    return docs.select("text").mapInArrow(count, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))


def _candidates(docs: DataFrame, seen: _Filter) -> DataFrame:
    """Per document its key, n_words and the candidate tokens with their place and the words around it."""
    near = pa.list_(pa.struct([("token", pa.int64()), ("place", pa.int64()), ("lead", pa.int32()), ("around", pa.string())]))
    schema = "doc_id long, h1 long, h2 long, n_words long, near array<struct<token:long,place:long,lead:int,around:string>>"

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sizes, rows = [], []
            for data in byte_texts(batch):
                words = words_of(data)
                sizes.append(len(words))
                own = []
                for places, tokens, length in seen.hits(words) if words else ():
                    for place, token in zip(places.tolist(), tokens.tolist(), strict=True):
                        first = max(0, place - WINDOW + 1)
                        around = b" ".join(words[first : place + length + WINDOW - 1]).decode("utf-8", "replace")
                        own.append({"token": token, "place": place, "lead": place - first, "around": around})
                rows.append(own)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in KEY), pa.array(sizes, pa.int64()), pa.array(rows, near)], [*KEY, "n_words", "near"])

    return docs.select(*KEY, "text").mapInArrow(scan, schema)


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) for each row of ``docs``.

    A document word inside any occurrence of a window is hit; a document is
    contaminated if it has a hit and 20 * n_hit >= n_words. Nulls: a null text
    has no words; a null doc_id keeps its row; a benchmark row without id or
    words has no windows. Repeated rows repeat; rows of one doc_id with other
    texts are judged on their own. An empty benchmark hits nothing. Only
    doc_id and text, item_id and text are read.
    """
    spark = docs.sparkSession
    store = Store(spark)
    rows = keyed(docs)
    windows = store.keep(_windows(benchmark))
    tokens = windows.select("window", F.explode("tokens").alias("t")).select("window", "t.token", "t.at")
    lengths = [r[0] for r in windows.select(F.least("size", F.lit(SHINGLE)).alias("n")).distinct().orderBy("n").collect()]
    counts = store.keep(_rarity(rows, _Filter(spark, tokens, lengths)))
    ranked = tokens.join(counts, "token", "left").groupBy("window").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token", "at")).alias("rare"))
    prefix = store.keep(ranked.join(windows, "window").select("window", "size", "items", F.col("rare.token").alias("token"), F.col("rare.at").alias("at")).where("rare.n > 0"))
    scanned = store.keep(_candidates(rows, _Filter(spark, prefix.select("token"), lengths)))

    near = scanned.select(*KEY, "n_words", F.explode("near").alias("near")).select(*KEY, "n_words", "near.*")
    small = prefix.count() <= BROADCAST_ROWS
    met = near.join(F.broadcast(prefix) if small else prefix, "token")
    start = F.col("place") - F.col("at")
    met = met.where((start >= 0) & (start + F.col("size") <= F.col("n_words")))
    words = F.slice(F.split("around", " "), F.col("lead") - F.col("at") + 1, F.col("size"))
    found = met.where(F.array_join(words, " ") == F.col("window")).select(
        *KEY, F.lit(None).cast("long").alias("n_words"), F.lit(0).alias("copy"), F.struct(start.alias("s"), (start + F.col("size")).alias("e")).alias("span"), "items"
    )
    plain = scanned.select(*KEY, "n_words", F.lit(1).alias("copy"), F.lit(None).cast(found.schema["span"].dataType).alias("span"), F.lit(None).cast("array<string>").alias("items"))
    by_doc = (
        plain.unionByName(found)
        .groupBy(*KEY)
        .agg(
            F.sum("copy").cast("int").alias("copies"),
            F.max("n_words").alias("n_words"),
            F.array_sort(F.collect_set("span")).alias("spans"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
        )
    )
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("to")),
        lambda acc, x: F.struct(
            (acc["n"] + F.greatest(x["e"] - F.greatest(x["s"], acc["to"]), F.lit(0))).cast("long").alias("n"),
            F.greatest(acc["to"], x["e"]).cast("long").alias("to"),
        ),
        lambda acc: acc["n"],
    )
    told = by_doc.select("doc_id", "copies", "n_words", covered.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"))
    told = told.withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))
    return told.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", F.explode(F.array_repeat(F.lit(1), F.col("copies"))).alias("_")).drop("_")


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with their own columns.

    Rows of one doc_id with other texts are judged on their own.
    """
    tag = fresh(docs, "tag")
    tagged = docs.withColumn(tag, F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit("\0"), F.coalesce("text", F.lit(""))))
    verdict = contamination(tagged.select(F.col(tag).alias("doc_id"), "text"), benchmark)
    bad = verdict.where("contaminated").select(F.col("doc_id").alias(tag)).distinct()
    return tagged.join(bad, tag, "left_anti").select(*docs.columns)


ORACLE_SQL = r"""
with bench as (
  select cast(item_id as varchar) item, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w
  from benchmark where item_id is not null and text is not null),
sized as (select item, w, least(13, len(w)) k from bench where len(w) > 0),
win as (select distinct item, k, array_to_string(w[i:i + k - 1], ' ') g from (select item, w, k, unnest(range(1, len(w) - k + 2)) i from sized)),
docs as (
  select doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) w from documents),
grams as (
  select doc_id, i, k, array_to_string(w[i:i + k - 1], ' ') g
  from (select doc_id, w, k, unnest(range(1, len(w) - k + 2)) i from docs, (select distinct k from win))),
hits as (select doc_id, i, grams.k, item from grams join win on grams.k = win.k and grams.g = win.g),
covered as (select doc_id, count(distinct p) n_hit from (select doc_id, unnest(range(i, i + k)) p from (select distinct doc_id, i, k from hits)) group by doc_id),
named as (select doc_id, count(*) n_items, sha256(string_agg(item, ',' order by item)) items_sha256 from (select distinct doc_id, item from hits) group by doc_id)
select docs.doc_id, cast(len(w) as bigint) n_words, cast(coalesce(n_hit, 0) as bigint) n_hit, cast(coalesce(n_items, 0) as bigint) n_items,
  coalesce(items_sha256, sha256('')) items_sha256, coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) contaminated
from docs left join covered on docs.doc_id = covered.doc_id left join named on docs.doc_id = named.doc_id
"""
