"""Connected components of an edge table: distributed union-find by hooking and contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm._common import Store


def _followed(hooks: DataFrame, above: DataFrame) -> DataFrame:
    """``hooks`` (node, root) whose roots follow ``above`` (node, root) where they stand in it; ``moved`` tells which did."""
    up = above.select(F.col("node").alias("root"), F.col("root").alias("top"))
    return hooks.join(up, "root", "left").select("node", F.coalesce("top", "root").alias("root"), F.col("top").isNotNull().alias("moved"))


def components(edges: DataFrame, store: Store) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b long); root is the smallest node reachable.

    Every round hooks each node under its smallest neighbour, if that is
    smaller, lets the hooks be followed up to their trees' tops (pointer
    jumping, twice as far with every step) and contracts the edges to the tops.
    What is left are edges between trees; at least the nodes that are no local
    minimum go, so that rounds grow with the logarithm of the number of nodes
    whatever the diameter, and each reads a fraction of the one before. At the
    end the rounds' hooks are chained from the last to the first. All steps are
    written tables, so a lost executor costs one step at most. Repeated edges,
    loops and empty tables are allowed; null ends are ignored.
    """
    ends = edges.where("a is not null and b is not null and a <> b")
    links = store.keep(ends.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    nodes = links
    rounds: list[DataFrame] = []
    while not rounds or not links.isEmpty():
        hooks = store.keep(links.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root")))
        while True:
            # A top is a node that hangs under none; the others' roots move up.
            jumped = store.keep(_followed(hooks, hooks))
            store.drop(hooks)
            hooks = jumped
            if hooks.where("moved").isEmpty():
                break
            hooks = hooks.select("node", "root")
            hooks._stored_at = jumped._stored_at
        tops = hooks.select("node", "root")
        left = links.join(tops.withColumnRenamed("node", "a"), "a").select(F.col("root").alias("a"), "b")
        both = left.join(tops.select(F.col("node").alias("b"), F.col("root").alias("top")), "b", "left").select("a", F.coalesce("top", "b").alias("b"))
        contracted = store.keep(both.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
        if rounds:
            store.drop(links)
        rounds.append(hooks)
        links = contracted
    store.drop(links)
    named = rounds[-1].select("node", "root")
    for hooks in reversed(rounds[:-1]):
        own = _followed(hooks.select("node", "root"), named).select("node", "root")
        named = store.keep(own.unionByName(named))
    # Nodes that never hung under another are the components' roots.
    roots = nodes.select(F.col("b").alias("node")).distinct().join(named.select("node"), "node", "left_anti")
    return named.unionByName(roots.select("node", F.col("node").alias("root")))
