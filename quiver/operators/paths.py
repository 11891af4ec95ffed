"""Materialised two-paths ``a -> b -> c`` (the edge self-join).

Repeated edges are counted first, so the join sees each distinct edge once
and its copies are made afterwards. An edge of very many copies is cut into
chunks, which the grid of a hub spreads like different edges.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quiver.operators.edges import weighted_edges
from quiver.operators.joins import DEFAULT_BROADCAST_MAX_ROWS, grid_join, hot_products, resolve_strategy
from quiver.operators.numbering import written
from quiver.operators.triangles import hot_centres, loop_pairs, loops_of, oriented_edges, simple_cycles

# Paths through one user that a task makes before that user is split.
TARGET_PATHS = 4_000_000

# Default of a parameter of closed paths that is no longer used.
FILTER_WORDS = 1 << 21


def _path_join(weighted: DataFrame, strategy: str, target_paths: int) -> DataFrame:
    """``(src, mid, dst, copies)``: the join of the distinct edges ``(src,
    dst, w)`` on the middle user; ``copies`` of each path in the bag."""
    # A bag of edges has no static size bound, so a broadcast is checked by count.
    plan = resolve_strategy(strategy, weighted)
    hot = None
    if plan.strategy != "broadcast":
        # A join key's output is in x out rows, which AQE does not see from its
        # input. A broadcast join has no key to split: its tasks follow the scan.
        ends = weighted.select(F.explode(F.array(
            F.struct(F.col("src").alias("mid"), F.lit(0).cast("bigint").alias("i"), F.col("w").alias("o")),
            F.struct(F.col("dst").alias("mid"), F.col("w").alias("i"), F.lit(0).cast("bigint").alias("o")),
        )).alias("e")).select("e.*")
        per_mid = ends.groupBy("mid").agg(F.sum("i").alias("n_left"), F.sum("o").alias("n_right"))
        hot = hot_products(per_mid, "mid", target_paths, DEFAULT_BROADCAST_MAX_ROWS)
    edges = weighted.withColumn("chunk", F.lit(0))
    if hot is not None:
        size = max(1, math.isqrt(target_paths))
        chunks = F.explode(F.sequence(F.lit(0), F.expr(f"(w - 1) div {size}").cast("int"))).alias("chunk")
        edges = weighted.select("src", "dst", "w", chunks).withColumn("w", F.least(F.lit(size), F.col("w") - F.col("chunk") * size))
    first = edges.select("src", F.col("dst").alias("mid"), F.col("w").alias("w1"), F.col("chunk").alias("chunk1"))
    second = edges.select(F.col("src").alias("mid"), "dst", F.col("w").alias("w2"), F.col("chunk").alias("chunk2"))
    if hot is None:
        met = first.join(plan.side(second), "mid")
    else:
        met = grid_join(first, second, "mid", ("src", "chunk1"), ("dst", "chunk2"), hot, plan)
    return met.select("src", "mid", "dst", (F.col("w1") * F.col("w2")).alias("copies"))


def _copied(paths: DataFrame, *columns: Column) -> DataFrame:
    """One row per copy of each path."""
    copies = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies")))
    return paths.select(*columns, copies.alias("_copy")).drop("_copy")


def _weighted(edges: DataFrame, max_id: int | None) -> DataFrame:
    """The distinct edges with their multiplicities, written once."""
    return written(weighted_edges(edges, max_id), "path-edges")


def two_paths(edges: DataFrame, max_id: int | None = None, strategy: str = "auto", target_paths: int = TARGET_PATHS) -> DataFrame:
    """``(src, mid, dst)``, one row per two-path, a bag: every pair of edge
    occurrences ``src -> mid``, ``mid -> dst`` (``src = dst`` and self-loops
    kept).

    A hub ``mid`` makes in-degree x out-degree rows: beyond ``target_paths``
    its in-edges and out-edges are cut into a grid of sub-keys.
    """
    paths = _path_join(_weighted(edges, max_id), strategy, target_paths)
    return _copied(paths, F.col("src"), F.col("mid"), F.col("dst"))


def two_paths_nested(
    edges: DataFrame, max_id: int | None = None, strategy: str = "auto", target_paths: int = TARGET_PATHS
) -> DataFrame:
    """The same join keeping both matched edges whole, as two struct columns
    ``first`` and ``second`` of ``(follower, followee)``."""
    return _copied(
        _path_join(_weighted(edges, max_id), strategy, target_paths),
        F.struct(F.col("src").alias("follower"), F.col("mid").alias("followee")).alias("first"),
        F.struct(F.col("mid").alias("follower"), F.col("dst").alias("followee")).alias("second"),
    )


def closed_paths(
    edges: DataFrame, max_id: int | None = None, strategy: str = "auto", target_paths: int = TARGET_PATHS,
    filter_words: int = FILTER_WORDS,
) -> DataFrame:
    """``(src, mid, dst)`` of the two-paths that an edge ``dst -> src``
    closes: the paths are a bag, the closing edges a set (a left semi join).

    A closed path and its closing edge are a cycle, and the three paths along
    a cycle all close. So each cycle is found once (see
    :mod:`quiver.operators.triangles`) and gives its paths; paths that do not
    close are never made. ``target_paths``: centres of more wedges are split.
    ``filter_words`` is kept for callers: there are no paths left to filter.
    """
    oriented, rows, hot = oriented_edges(edges, max_id)
    plan = resolve_strategy(strategy, oriented, known_rows=rows)
    centres = None
    if plan.strategy != "broadcast":
        centres = hot_centres(oriented, "degree", rows, target_paths, DEFAULT_BROADCAST_MAX_ROWS)

    def along(cycles: DataFrame, a: str, b: str, c: str, *weights: str) -> DataFrame:
        """The three paths along each cycle ``a -> b -> c -> a``."""
        w_ab, w_bc, w_ca = (F.col(w) for w in weights)
        turns = ((a, b, c, w_ab * w_bc), (b, c, a, w_bc * w_ca), (c, a, b, w_ca * w_ab))
        paths = [
            F.struct(F.col(x).alias("src"), F.col(y).alias("mid"), F.col(z).alias("dst"), copies.alias("copies"))
            for x, y, z, copies in turns
        ]
        return cycles.select(F.explode(F.array(*paths)).alias("p")).select("p.*")

    closed = along(simple_cycles(oriented, "degree", plan, hot, centres), "a", "b", "c", "w_ab", "w_bc", "w_ca")
    closed = closed.unionByName(along(loop_pairs(oriented, plan), "x", "x", "y", "w_xx", "w_xy", "w_yx"))
    alone = loops_of(oriented).select(
        F.col("x").alias("src"), F.col("x").alias("mid"), F.col("x").alias("dst"), (F.col("w_xx") * F.col("w_xx")).alias("copies")
    )
    return _copied(closed.unionByName(alone), F.col("src"), F.col("mid"), F.col("dst"))
