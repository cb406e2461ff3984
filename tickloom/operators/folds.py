"""Books folded where the outcome depends on the path: depth cut at each update, sequences, checksums, single orders.

A snapshot makes a book anew, whatever came before. So a book is cut at its
snapshots, and its segments are folded in parallel; each is sorted in its task
and read in Arrow batches, and what is held is one batch and one book. Only a
stretch without a snapshot is one task's work.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.operators import blocked
from tickloom.operators.books import BOOK, Fold, OrderFold, checked, since_snapshot

REPORT = "applied long, rejected long, gaps long, state string, n_orders long, levels array<struct<side:string,level:long,price:string,size:string>>"


def segmented(messages: DataFrame, order: Sequence[str], key: Sequence[str] = BOOK, snapshot: str = "is_snapshot", blocks: bool = True) -> DataFrame:
    """``messages`` with ``segment``: how many snapshots of their book came up to them."""
    flag = F.coalesce(F.col(snapshot), F.lit(False)).cast("long")
    return blocked.scanned(messages, key, order, upto={"segment": ("sum", flag)}, blocks=blocks)


def _values(column: pa.Array, fields: Sequence[str] | None) -> list:
    """A column's values; with ``fields``, arrays of structs as lists of these fields' tuples."""
    if not fields:
        return column.to_pylist()
    items = column.flatten()
    names = [f.name for f in items.type]
    parts = dict(zip(names, items.flatten(), strict=True))
    tuples, out, at = list(zip(*(parts[f].to_pylist() for f in fields), strict=True)), [], 0
    for n in column.value_lengths().to_pylist():
        out.append(None if n is None else tuples[at : at + n])
        at += n or 0
    return out


def _levels(books: Sequence[Fold]) -> pa.Array:
    """The books' levels as REPORT has them."""
    each = [b.levels() for b in books]
    flat = [x for own in each for x in own]
    ends = pa.array(accumulate(map(len, each), initial=0), pa.int32())
    columns = ([x[0] for x in flat], pa.string()), ([x[1] for x in flat], pa.int64()), ([str(x[2]) for x in flat], pa.string()), ([str(x[3]) for x in flat], pa.string())
    return pa.ListArray.from_arrays(ends, pa.StructArray.from_arrays([pa.array(*c) for c in columns], ["side", "level", "price", "size"]))


def folded(messages: DataFrame, order: Sequence[str], key: Sequence[str], begin: Callable[[], Fold], take: Callable[[Fold, dict], bool], items: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """(key, applied, rejected, gaps, state, n_orders, levels) after all messages of each key, in order.

    ``begin`` makes an empty book and ``take`` applies a message, a row as a
    dict, in which the columns of ``items``, arrays of structs, are lists of
    their fields' tuples; levels are told as text, best first.
    """
    fields = {f.name: f for f in messages.schema.fields}
    out = T.StructType([*(fields[c] for c in key), *T._parse_datatype_string(REPORT).fields])
    kinds = T.StructType(out.fields[: len(key)])

    def tell(keys: list[tuple], books: list[tuple[Fold, int]]) -> pa.RecordBatch:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrays = [pa.array(list(c), f.type) for c, f in zip(zip(*keys, strict=True), to_arrow_schema(kinds), strict=True)]
        arrays += [pa.array([n for _, n in books], pa.int64())]
        arrays += [pa.array([getattr(b, name) for b, _ in books], kind) for name, kind in (("rejected", pa.int64()), ("gaps", pa.int64()), ("state", pa.string()))]
        arrays += [pa.array([len(b.orders) if isinstance(b, OrderFold) else None for b, _ in books], pa.int64())]
        arrays += [_levels([b for b, _ in books])]
        return pa.RecordBatch.from_arrays(arrays, [f.name for f in out.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, book, applied, keys, done = None, None, 0, [], []
        for batch in batches:
            names = batch.schema.names
            columns = [_values(c, (items or {}).get(n)) for n, c in zip(names, batch.columns, strict=True)]
            owners = zip(*(columns[names.index(c)] for c in key), strict=True)
            for own, values in zip(owners, zip(*columns, strict=True), strict=True):
                row = dict(zip(names, values))
                if book is None or own != now:
                    if book is not None:
                        keys.append(now)
                        done.append((book, applied))
                    now, book, applied = own, begin(), 0
                applied += bool(take(book, row))
            if len(done) >= 1000:
                yield tell(keys, done)
                keys, done = [], []
        if book is not None:
            yield tell([*keys, now], [*done, (book, applied)])

    return messages.repartition(*key).sortWithinPartitions(*key, *order).mapInArrow(run, out)


def replayed(messages: DataFrame, order: Sequence[str], key: Sequence[str] = BOOK, predicate: str | None = None, depth: int | None = None, recipe: str | None = None, blocks: bool = True) -> DataFrame:
    """The report of every segment of every book: (key, segment, applied, rejected, gaps, state, n_orders, levels).

    ``messages``: bids and asks (arrays of struct price, size as sent),
    update_id, sequence, is_snapshot and, with ``recipe`` ("okx" or "kraken"),
    checksum. A delta that breaks the sequence, crosses a gated book or doesn't
    lead to its checksum gaps the book; what follows is rejected up to the next
    snapshot. A null array is empty, a null flag is no snapshot. Where a book has
    few messages by construction, ``blocks=False`` finds its segments in one window.
    """

    def take(book: Fold, row: dict) -> bool:
        changes = [("bid", *x) for x in row["bids"] or ()] + [("ask", *x) for x in row["asks"] or ()]
        whole = bool(row["is_snapshot"])
        return book.apply(changes, row["update_id"], row["sequence"], whole, checked(recipe, row["checksum"], whole) if recipe else None)

    columns = [*key, *order, "bids", "asks", "update_id", "sequence", "is_snapshot", *(["checksum"] if recipe else [])]
    rows = segmented(messages.select(*dict.fromkeys(columns)), order, key, blocks=blocks)
    return folded(rows, order, [*key, "segment"], lambda: Fold(depth, predicate), take, {"bids": ("price", "size"), "asks": ("price", "size")})


def orders_replayed(messages: DataFrame, order: Sequence[str], key: Sequence[str] = BOOK, depth: int | None = None, most: int | None = None) -> DataFrame:
    """The same from single orders: ``orders`` (arrays of order_id, is_ask, price, size, removed), update_id and is_snapshot. A book of more than ``most`` orders is gapped."""

    def begin() -> OrderFold:
        return OrderFold(depth, most) if most else OrderFold(depth)

    def take(book: OrderFold, row: dict) -> bool:
        changes = [(order_id, "ask" if is_ask else "bid", price, size, bool(removed)) for order_id, is_ask, price, size, removed in row["orders"] or ()]
        return book.apply_orders(changes, row["update_id"], bool(row["is_snapshot"]))

    rows = segmented(messages.select(*dict.fromkeys([*key, *order, "orders", "update_id", "is_snapshot"])), order, key)
    return folded(rows, order, [*key, "segment"], begin, take, {"orders": ("order_id", "is_ask", "price", "size", "removed")})


def pruned_state(deltas: DataFrame, depth: int, order: Sequence[str], key: Sequence[str] = BOOK, snapshot: str | None = None) -> DataFrame:
    """(key, side, level, price, size): the levels of each book when its depth is cut after every update. With ``snapshot``, only what came since the last one is folded."""
    if snapshot:
        deltas = since_snapshot(deltas, order, key, snapshot)
    rows = deltas.select(*dict.fromkeys([*key, *order, "side", "price", "size"]))
    told = folded(rows, order, key, lambda: Fold(depth), lambda book, row: book.apply([(row["side"], row["price"], row["size"])]))
    return told.select(*key, F.explode("levels").alias("l")).select(*key, "l.side", "l.level", F.col("l.price").cast("double").alias("price"), F.col("l.size").cast("double").alias("size"))
