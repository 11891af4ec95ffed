"""Closures per edge: intersection of sorted neighbour blocks.

For an edge ``x -> y`` a closure is a user ``c`` with ``c -> x`` and ``y ->
c``. Three users that close one another's edges are a cycle, so each cycle is
found once, from its lowest-ranked user (see :mod:`quiver.operators.cycles`),
and counts for its three edges. The lists that are intersected are blocks of
:mod:`quiver.operators.adjacency`: the higher-ranked out-neighbours of a user
and the in-neighbours of the user they are sent to. No wedge is ever a row of
a table, and a block is copied once per higher-ranked in-neighbour of its user.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quiver.operators.adjacency import BLOCK_LENGTH, adjacency_blocks
from quiver.operators.cycles import closed_wedges
from quiver.operators.joins import DEFAULT_BROADCAST_MAX_ROWS, JoinPlan
from quiver.operators.edges import cap_edges, weighted_edges
from quiver.operators.numbering import written
from quiver.operators.triangles import at_salts, hot_centres, loop_pairs, loops_of, oriented_edges, wedges_of

#: Wedges of a centre, and edges of a user, beyond which they are split.
CELL_IDS = 2_000_000


def edge_closures(
    edges: DataFrame, max_id: int | None = None, length: int = BLOCK_LENGTH, cell_ids: int = CELL_IDS
) -> DataFrame:
    """``(follower, followee, w, closures)`` of every distinct edge; ``w`` is
    its multiplicity, so the sum of ``w * closures`` is the closing count of
    the ``probe_bag`` triangle mode. Self-loops are kept and close like any
    other edge; an edge that nothing closes has 0.
    """
    weighted = written(weighted_edges(cap_edges(edges, max_id)), "closure-edges")
    pairs = weighted.select(F.col("src").alias("follower"), F.col("dst").alias("followee"))
    oriented, rows, hot = oriented_edges(pairs, hot_rows=cell_ids)
    plan = JoinPlan("auto")
    no_weights = F.lit(None).cast("array<bigint>").alias("ws")
    upward = oriented.where("up").select(F.col("src").alias("follower"), F.col("dst").alias("followee"))
    lists = adjacency_blocks(upward, "out", length).select(
        F.col("user").alias("a"), F.col("block").alias("part"), F.col("neighbours").alias("ids"), no_weights
    )
    simple = oriented.where(F.col("up").isNotNull())
    into = adjacency_blocks(simple.select(F.col("src").alias("follower"), F.col("dst").alias("followee")), "in", length)
    degree = simple.select(F.col("dst").alias("user"), F.col("deg_dst").alias("deg_c")).distinct()
    closing = into.join(degree, "user").select(F.col("user").alias("c"), "deg_c", F.col("neighbours").alias("ids"), no_weights)
    centres = hot_centres(oriented, "degree", rows, cell_ids, DEFAULT_BROADCAST_MAX_ROWS)
    cycles = closed_wedges(wedges_of(oriented, lists, plan, hot, centres), at_salts(closing, hot))

    def three(rows: DataFrame, a: str, b: str, c: str) -> DataFrame:
        ends = [F.struct(F.col(x).alias("src"), F.col(y).alias("dst")) for x, y in ((a, b), (b, c), (c, a))]
        return rows.select(F.explode(F.array(*ends)).alias("e")).select("e.*")

    closed = three(cycles, "a", "b", "c").unionByName(three(loop_pairs(oriented, plan), "x", "x", "y")).unionByName(
        loops_of(oriented).select(F.col("x").alias("src"), F.col("x").alias("dst"))
    ).groupBy("src", "dst").agg(F.count(F.lit(1)).alias("closures"))
    return weighted.join(closed, ["src", "dst"], "left").select(
        F.col("src").alias("follower"), F.col("dst").alias("followee"), "w",
        F.coalesce(F.col("closures"), F.lit(0)).cast("bigint").alias("closures"),
    )
