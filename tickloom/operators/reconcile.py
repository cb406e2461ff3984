"""Back-fill in cycles: what a second source brings after what is persisted, or inside its gaps, once and only once.

A cycle reads the persisted rows' high-water mark (time, then id) of each
instrument and takes from a dump what lies after it, and an overlap before it,
that isn't there yet. Rows inside gaps that a ledger names are taken wherever
they lie. A cycle that is run again finds nothing new, so one that died is
simply run again; what it writes is one commit of the leaf.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.operators import blocked
from tickloom.sources.commits import Leaf

#: How far before the mark a settlement may still come.
OVERLAP_US = 3_600_000_000


@dataclass(frozen=True)
class Source:
    """The columns of a kind of rows: what tells a row from others, when it happened, and its id inside a time."""

    ts: str
    id: str
    key: tuple[str, ...] = ("exchange", "symbol")

    @property
    def identity(self) -> tuple[str, ...]:
        return tuple(dict.fromkeys((*self.key, self.ts, self.id)))

    def at(self) -> Column:
        return F.struct(self.ts, self.id)


def marks(persisted: DataFrame, source: Source) -> DataFrame:
    """(key, mark): the last row of each instrument, as struct(time, id)."""
    return persisted.groupBy(*source.key).agg(F.max(source.at()).alias("mark"))


def _same(left: str, right: str, columns: Sequence[str]) -> Column:
    return F.expr(" and ".join(f"{left}.`{c}` <=> {right}.`{c}`" for c in columns))


def after_marks(dump: DataFrame, last: DataFrame, source: Source, overlap_us: int = 0) -> DataFrame:
    """A dump's rows strictly after the mark of their instrument; with an overlap, those up to so long before it too. Instruments without a mark are taken whole."""
    met = dump.alias("d").join(last.alias("m"), _same("d", "m", source.key), "left")
    later = F.struct(F.col(f"d.{source.ts}"), F.col(f"d.{source.id}")) > F.col("m.mark")
    near = F.col(f"d.{source.ts}") >= F.col(f"m.mark.{source.ts}") - overlap_us if overlap_us else F.lit(False)
    return met.where(F.col("m.mark").isNull() | later | near).select("d.*")


def inside(dump: DataFrame, gaps: DataFrame, source: Source, opened: str = "opened_us", closed: str = "closed_us") -> DataFrame:
    """A dump's rows inside a gap of their instrument (bounds included): one union and one scan, no range join. Gaps may overlap."""
    edges = gaps.select(*source.key, F.col(opened).alias(source.ts), F.col(closed).alias("_closed"))
    both = dump.withColumn("_closed", F.lit(None).cast("long")).withColumn("_row", F.lit(1)).unionByName(edges.withColumn("_row", F.lit(0)), allowMissingColumns=True)
    # The furthest end of the gaps that opened so far.
    told = blocked.scanned(both, source.key, [source.ts, "_row"], upto={"_until": ("max", F.col("_closed"))}, width=blocked.DAY_US)
    return told.where((F.col("_row") == 1) & (F.col(source.ts) <= F.col("_until"))).select(*dump.columns)


def found(persisted: DataFrame, dump: DataFrame, source: Source, overlap_us: int = 0, gaps: DataFrame | None = None) -> DataFrame:
    """The rows of a dump that a cycle adds, each once. Of equal identities in a dump the least row counts."""
    rows = after_marks(dump, marks(persisted, source), source, overlap_us)
    if gaps is not None:
        rows = rows.unionByName(inside(dump, gaps, source))
    rest = [c for c in dump.columns if c not in source.identity]
    least = F.struct(*rest) if rest else F.lit(1)
    one = rows.groupBy(*source.identity).agg(F.min(least).alias("_rest")).select(*source.identity, *(F.col(f"_rest.{c}").alias(c) for c in rest)).select(*dump.columns)
    return one.alias("n").join(persisted.select(*source.identity).distinct().alias("p"), _same("n", "p", source.identity), "left_anti")


def cycle(leaf: Leaf, datatype: str, dump: DataFrame, source: Source, overlap_us: int = 0, gaps: DataFrame | None = None, owner: str = "back-fill") -> str:
    """One cycle into a leaf; the id of its commit."""
    return leaf.commit(found(leaf.read(datatype), dump, source, overlap_us, gaps), datatype, owner)
