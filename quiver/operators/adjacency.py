"""Adjacency lists as data: sorted neighbour blocks of bounded length.

One array per user would put a celebrity's followers into a single row. Here
a user's sorted neighbour set is cut into blocks of at most ``length``
neighbours, ``(user, block, first, last, n, neighbours)``. Blocks of a user do
not overlap, so two lists can be intersected block by block.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quiver.operators.numbering import numbered

BLOCK_LENGTH = 1024
DIRECTIONS = {"in": ("followee", "follower"), "out": ("follower", "followee")}


def adjacency_blocks(edges: DataFrame, direction: str = "in", length: int = BLOCK_LENGTH) -> DataFrame:
    """Blocks of each user's in- or out-neighbour set.

    Neighbours are numbered over range partitions, so no task sorts or
    gathers a whole hub. Repeated edges count once; null ids are left out.
    """
    if direction not in DIRECTIONS:
        raise ValueError(f"direction must be one of {tuple(DIRECTIONS)}, got {direction!r}")
    if length < 1:
        raise ValueError("length must be >= 1")
    user, neighbour = DIRECTIONS[direction]
    pairs = edges.where(F.col(user).isNotNull() & F.col(neighbour).isNotNull()).select(
        F.col(user).cast("bigint").alias("user"), F.col(neighbour).cast("bigint").alias("neighbour")
    ).distinct()
    placed = numbered(pairs, ["user", "neighbour"], ["user"])
    return placed.groupBy("user", F.expr(f"idx div {length}").alias("block")).agg(
        F.min("neighbour").alias("first"), F.max("neighbour").alias("last"),
        F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_list("neighbour")).alias("neighbours"),
    )
