"""Scans over a long sequence in blocks.

One instrument's years are one partition of a plain window, hence one task's
sort. Here a sequence is cut into blocks by the first column of its order. What
a block adds to the scan is one row for each block; the scan over those rows
tells what enters a block, and that comes to it as one more row, ahead of its
own. So rows are shuffled once, never joined, and meet one window over
(key, block). Null keys and null orders are groups like any other: as in a plain
window, rows with a null order come first.

A scan's parts must combine associatively: the greatest value (``max``), the
sum (``sum``), the last value that isn't null (``last``) and the value of the
row before, null or not (``lag``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Widths of a block: a day of microseconds, or so many sequence numbers.
DAY_US, NUMBERS = 86_400_000_000, 1 << 16

#: What a scan adds up: the kind and the value.
Part = tuple[str, Column]


def width_of(column: str) -> int:
    """A block's width for an order column, by its name."""
    return DAY_US if column.endswith("_us") else NUMBERS


def in_blocks(frame: DataFrame, order: Sequence[str], width: int | None = None) -> DataFrame:
    """``frame`` with ``_block``, the number of each row's block; null where the order is."""
    width = width or width_of(order[0])
    at = F.col(order[0]).cast("long")
    return frame.withColumn("_block", F.when(at < 0, F.expr(f"(cast({order[0]} as bigint) + 1) div {width} - 1")).otherwise(F.expr(f"cast({order[0]} as bigint) div {width}")))


def _folded(kind: str, value: str | Column) -> Column:
    """A part's window function."""
    return {"max": F.max, "sum": F.sum}[kind](value) if kind in ("max", "sum") else F.last(value, ignorenulls=True)


def _place(frame: DataFrame, order: Sequence[str]) -> Column:
    """A row's place in the order, never null."""
    whole = isinstance(frame.schema[order[0]].dataType, T.LongType | T.IntegerType)
    # A plain number keeps the aggregation hashed.
    return F.coalesce(F.col(order[0]).cast("long"), F.lit(-(1 << 63))) if len(order) == 1 and whole else F.struct(*order)


def _end(kind: str, value: str, place: Column) -> Column:
    """What a block adds to a part."""
    if kind in ("max", "sum"):
        return _folded(kind, value)
    if kind == "lag":
        return F.struct(F.max_by(F.col(value)["v"], place).alias("v"))
    return F.max_by(value, F.when(F.col(value).isNotNull(), place))


def scanned(frame: DataFrame, key: Sequence[str], order: Sequence[str], before: Mapping[str, Part] | None = None, upto: Mapping[str, Part] | None = None, width: int | None = None, blocks: bool = True) -> DataFrame:
    """``frame`` with a column for each part: over the rows before each row (``before``), or with it (``upto``). ``order`` must be total or ties must not matter.

    ``frame`` is worked out twice, once for the blocks' ends. Where a key has
    few rows by construction, ``blocks=False`` takes one window over the key.
    """
    parts = [(name, kind, value, -1) for name, (kind, value) in (before or {}).items()] + [(name, kind, value, 0) for name, (kind, value) in (upto or {}).items()]
    values = {f"_v{i}": F.struct(value.alias("v")) if kind == "lag" else value for i, (_, kind, value, _) in enumerate(parts)}
    if not blocks:
        return _over(frame.withColumns(values), parts, Window.partitionBy(*key).orderBy(*order)).select(*frame.columns, *(p[0] for p in parts))
    rows = in_blocks(frame, order, width).withColumns(values)
    ends = rows.groupBy(*key, "_block").agg(*(_end(kind, f"_v{i}", _place(frame, order)).alias(f"_v{i}") for i, (_, kind, _, _) in enumerate(parts)))
    earlier = Window.partitionBy(*key).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    enters = ends.select(*key, "_block", F.lit(False).alias("_in_block"), *(_folded(kind, f"_v{i}").over(earlier).alias(f"_v{i}") for i, (_, kind, _, _) in enumerate(parts)))
    both = rows.withColumn("_in_block", F.lit(True)).unionByName(enters, allowMissingColumns=True)
    told = _over(both, parts, Window.partitionBy(*key, "_block").orderBy("_in_block", *order))
    return told.where("_in_block").select(*frame.columns, *(p[0] for p in parts))


def _over(rows: DataFrame, parts: Sequence[tuple], order) -> DataFrame:
    """``rows`` with each part's column from its values ``_v0``, ``_v1`` and so on."""
    found = {}
    for i, (name, kind, _, last) in enumerate(parts):
        value = _folded(kind, f"_v{i}").over(order.rowsBetween(Window.unboundedPreceding, last))
        found[name] = value["v"] if kind == "lag" else value
    return rows.withColumns(found)


def with_highest(frame: DataFrame, value: Column, name: str, key: Sequence[str], order: Sequence[str], width: int | None = None) -> DataFrame:
    """``frame`` with the greatest ``value`` of all rows before each row; null for the first."""
    return scanned(frame, key, order, {name: ("max", value)}, width=width)


def count_within(frame: DataFrame, span: int, name: str, key: Sequence[str], ts: str, width: int | None = None) -> DataFrame:
    """``frame`` with the number of rows in the span up to and with each row's ``ts``. Rows near a block's end are lent to the next block."""
    width = max(width or width_of(ts), 4 * span)
    rows = in_blocks(frame, [ts], width)
    lent = (F.col("_block") + 1) * width - F.col(ts) <= span
    places = F.array_compact(F.array(F.struct(F.col("_block").alias("b"), F.lit(True).alias("own")), F.when(lent, F.struct((F.col("_block") + 1).alias("b"), F.lit(False).alias("own")))))
    each = rows.withColumn("_to", F.explode(places)).withColumn("_block", F.col("_to.b")).withColumn("_own", F.col("_to.own")).drop("_to")
    reach = Window.partitionBy(*key, "_block").orderBy(ts).rangeBetween(-span, 0)
    return each.withColumn(name, F.count("*").over(reach)).where("_own").drop("_own", "_block")


def averaged(frame: DataFrame, value: str, alpha: float, key: Sequence[str], order: Sequence[str], name: str = "smoothed", width: int | None = None) -> DataFrame:
    """(key, order, ``name``): the exponential average of ``value``, seeded by the key's first sample that isn't null.

    A sample x is the map s -> (1 - alpha) s + alpha x, a null one leaves s as
    it is. A block's maps compose to one factor and one offset, and these chain
    over the blocks; inside a block maps compose by doubling, with no power but
    those of 1 - alpha up to the block's rows.
    """
    keep = 1.0 - alpha
    fields = {f.name: f for f in frame.schema.fields}
    rows = in_blocks(frame.select(*key, *(c for c in order if c not in key), F.col(value).cast("double").alias("_x")), order, width)
    by = [*key, "_block"]
    order_in = [c for c in order if c not in by]
    end = T.StructType([*(fields[c] for c in key), T.StructField("_block", T.LongType()), *(T.StructField(c, T.DoubleType()) for c in ("_factor", "_offset", "_seeded"))])
    ends = rows.groupBy(*by).applyInArrow(_block_end(keep, alpha, order_in, key), end)
    # A block's row is small, and a key has one for each of its days.
    entry = T.StructType([*(fields[c] for c in key), T.StructField("_block", T.LongType()), T.StructField("_start", T.DoubleType())])
    starts = ends.groupBy(*key).applyInArrow(_chained(key), entry)
    both = rows.withColumn("_own", F.lit(True)).unionByName(starts.withColumn("_own", F.lit(False)), allowMissingColumns=True)
    out = T.StructType([*(fields[c] for c in dict.fromkeys([*key, *order])), T.StructField(name, T.DoubleType())])
    return both.groupBy(*by).applyInArrow(_smoothed(keep, alpha, order_in, [f.name for f in out][:-1], name), out)


def _sorted_by(table, order: Sequence[str]):
    """Rows by ``order``, nulls first."""
    import pyarrow as pa
    import pyarrow.compute as pc

    if not order:
        return table
    return table.take(pc.sort_indices(table, sort_keys=[(c, "ascending") for c in order], null_placement="at_start")) if isinstance(table, pa.Table) else table


def _maps(x, keep: float, alpha: float):
    """(factors, offsets) of the samples one by one."""
    import numpy as np

    there = ~np.isnan(x)
    return np.where(there, keep, 1.0), np.where(there, alpha * np.nan_to_num(x), 0.0)


def _composed(factor, offset):
    """The maps composed from the first on, in log2(n) steps."""
    step = 1
    while step < len(factor):
        offset[step:], factor[step:] = offset[step:] + factor[step:] * offset[:-step], factor[step:] * factor[:-step]
        step *= 2
    return factor, offset


def _samples(table):
    """The values as doubles; null and NaN are no samples."""
    return table["_x"].combine_chunks().to_numpy(zero_copy_only=False).astype(float)


def _block_end(keep: float, alpha: float, order: Sequence[str], key: Sequence[str]):
    def end(table):
        import numpy as np
        import pyarrow as pa

        x = _samples(_sorted_by(table, order))
        factor, offset = _composed(*_maps(x, keep, alpha))
        some = np.flatnonzero(~np.isnan(x))
        seeded = None
        if len(some):
            first, moved = _maps(x, keep, alpha)
            first[some[0]], moved[some[0]] = 0.0, x[some[0]]
            seeded = float(_composed(first, moved)[1][-1])
        one = table.slice(0, 1).select([*key, "_block"])
        for name, v in (("_factor", float(factor[-1])), ("_offset", float(offset[-1])), ("_seeded", seeded)):
            one = one.append_column(name, pa.array([v], pa.float64()))
        return one

    return end


def _chained(key: Sequence[str]):
    def chain(table):
        import pyarrow as pa

        table, now, starts = _sorted_by(table, ["_block"]), None, []
        for factor, offset, seeded in zip(*(table[c].to_pylist() for c in ("_factor", "_offset", "_seeded")), strict=True):
            starts.append(now)
            now = seeded if now is None else factor * now + offset
        return table.select([*key, "_block"]).append_column("_start", pa.array(starts, pa.float64()))

    return chain


def _smoothed(keep: float, alpha: float, order: Sequence[str], columns: Sequence[str], name: str):
    def smooth(table):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        start = pc.max(table["_start"]).as_py()
        table = _sorted_by(table.filter(table["_own"]), order)
        x = _samples(table)
        factor, offset = _maps(x, keep, alpha)
        some = np.flatnonzero(~np.isnan(x))
        begun = np.full(len(x), True)
        if start is None:
            begun = np.arange(len(x)) >= (some[0] if len(some) else len(x))
            if len(some):
                factor[some[0]], offset[some[0]] = 0.0, x[some[0]]
        factor, offset = _composed(factor, offset)
        values = factor * (start or 0.0) + offset
        return table.select(columns).append_column(name, pa.array(values, pa.float64(), mask=~begun))

    return smooth


def folded(frame: DataFrame, value: str, key: Sequence[str], order: Sequence[str], kind: str, step, name: str) -> DataFrame:
    """``frame`` with ``step(state, value)`` over each key's rows in order; the state is null before a key's first row.

    For steps that don't compose. Keys are dealt to tasks and sorted there, and
    the state goes on from one Arrow batch to the next, so a task holds one
    batch; but a key's rows are one task's work.
    """
    columns = frame.columns
    out = T.StructType([*frame.schema.fields, T._parse_datatype_string(f"{name} {kind}").fields[0]])
    at = [columns.index(c) for c in key]

    def run(batches):
        import pyarrow as pa

        now, state = None, None
        for batch in batches:
            keys = list(zip(*(batch.column(i).to_pylist() for i in at), strict=True))
            found = []
            for own, x in zip(keys, batch.column(value).to_pylist(), strict=True):
                state = step(None if own != now else state, x)
                now = own
                found.append(state)
            arrays = [*batch.columns, pa.array(found)]
            yield pa.RecordBatch.from_arrays(arrays, [*columns, name])

    return frame.repartition(*key).sortWithinPartitions(*key, *order).mapInArrow(run, out)
