"""Connected components of a link table, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quiver.llm.common import staged, unstaged


def components(links: DataFrame, rounds: list | None = None) -> DataFrame:
    """``(node, component)`` for every node of ``links (a, b)``; the component
    is named by its smallest node.

    Each round sends every node to the first of its neighbours and itself,
    and replaces links by links between those targets; links inside a target
    vanish. In the first of three rounds "first" means the smallest id, which
    ends a star around its smallest node at once; in the other two it goes by
    a hash of the node and the round, which about halves every component
    whatever the order of its ids. So the rounds grow with the logarithm of
    the nodes, also on chains. Targets are joined from the last round back to
    the first, over tables that shrink as fast.

    Every table is written to the shared folder; a node with many links is
    aggregated partially, and its lookups are joins of two written tables that
    AQE can split. Nothing passes through the driver but "is there a link
    left". ``rounds``, if given, gets an entry per round.
    """
    links = staged(links.select("a", "b").where("a <> b").distinct(), "links")
    targets: list[DataFrame] = []
    while not links.isEmpty():
        turn = len(targets)

        def place(node: str):
            return F.col(node) if turn % 3 == 0 else F.xxhash64(F.lit(turn), F.col(node))

        both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        first = F.min(F.struct(place("b").alias("place"), F.col("b").alias("node")))
        own = F.struct(place("a").alias("place"), F.col("a").alias("node"))
        target = staged(
            both.groupBy("a").agg(first.alias("first")).select(F.col("a").alias("node"), F.least("first", own)["node"].alias("to")),
            "targets",
        )
        targets.append(target)
        moved = links.join(target.toDF("a", "ta"), "a").join(target.toDF("b", "tb"), "b").where("ta <> tb")
        before, links = links, staged(
            moved.select(F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b")).distinct(), "links"
        )
        unstaged(before)
        if rounds is not None:
            rounds.append(turn)
    if not targets:
        return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    labels = targets[-1].toDF("node", "component")
    for target in reversed(targets[:-1]):
        onward = labels.toDF("to", "component")
        labels = target.join(onward, "to", "left").select("node", F.coalesce("component", "to").alias("component"))
    labels = staged(labels, "labels")
    unstaged(links, *targets)
    if len(targets) == 1:
        # By ids alone: the target is the smallest node.
        return labels
    names = staged(labels.groupBy("component").agg(F.min("node").alias("name")), "component-names")
    out = staged(labels.join(names, "component").select("node", F.col("name").alias("component")), "components")
    unstaged(labels, names)
    return out
