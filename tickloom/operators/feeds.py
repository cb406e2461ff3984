"""Lifecycle of feeds: the states that a subscription went through, held against the edges that it may take."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# A feed's states and the states that may follow each.
EDGES: dict[str, tuple[str, ...]] = {
    "requested": ("subscribing", "draining"),
    "subscribing": ("live", "resubscribing", "reconnecting", "draining"),
    "live": ("stale", "resubscribing", "reconnecting", "draining"),
    "stale": ("live", "resubscribing", "reconnecting", "draining"),
    "resubscribing": ("live", "reconnecting", "draining"),
    "reconnecting": ("subscribing", "rejected", "failed", "draining"),
    "draining": ("closed",),
    "closed": (),
    "rejected": (),
    "failed": (),
}
TERMINAL = tuple(state for state, following in EDGES.items() if not following)


def may_follow(before: Column, state: Column) -> Column:
    """Whether an edge leads from one state to the other; unknown states have none."""
    arrows = [f"{a}>{b}" for a, following in EDGES.items() for b in following]
    return F.coalesce(F.concat_ws(">", before, state).isin(arrows), F.lit(False))


def judged(changes: DataFrame, key: Sequence[str], order: Sequence[str], state: str = "state") -> DataFrame:
    """State changes with ``before`` and ``verdict``: legal, illegal, repeat, absorbed.

    A feed begins as requested. An illegal change counts as made, but nothing
    follows a terminal state: later rows are absorbed. ``order`` must place each
    feed's rows; a feed changes seldom, so a window by feed stays small.
    """
    own = Window.partitionBy(*key).orderBy(*order)
    before = F.coalesce(F.lag(state).over(own), F.lit("requested"))
    ended = F.max(F.col(state).isin(*TERMINAL)).over(own.rowsBetween(Window.unboundedPreceding, -1))
    rows = changes.withColumn("before", before).withColumn("_ended", F.coalesce(ended, F.lit(False)))
    verdict = F.when(F.col("_ended"), "absorbed").when(F.col("before") == F.col(state), "repeat").when(may_follow(F.col("before"), F.col(state)), "legal").otherwise("illegal")
    return rows.withColumn("verdict", verdict).drop("_ended")


def status(changes: DataFrame, key: Sequence[str], order: Sequence[str], state: str = "state") -> DataFrame:
    """(key, state, terminal, changes, illegal): where each feed stands."""
    rows = judged(changes, key, order, state).where("verdict <> 'absorbed'")
    made = rows.groupBy(*key).agg(
        F.max_by(state, F.struct(*order)).alias("state"),
        F.count(F.when(F.col("verdict") != "repeat", 1)).alias("changes"),
        F.count(F.when(F.col("verdict") == "illegal", 1)).alias("illegal"),
    )
    return made.select(*key, "state", F.col("state").isin(*TERMINAL).alias("terminal"), "changes", "illegal")
