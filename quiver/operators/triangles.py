"""Directed triangle (3-cycle) count.

A closing is a triple ``(a, b, c)`` with edges ``a -> b``, ``b -> c`` and
``c -> a``; every cycle on three distinct users is closed from each of its
three rotations, so ``triangles = closings div 3``. How repeated edges count
is the ``mode`` (see :mod:`quiver.functions.weights`).

Plan (one write of the oriented edge table, then one lazy final aggregate):

1. Cap and pre-aggregate the edge bag to ``(src, dst, w)``: later joins see
   each distinct edge once. Orient each edge (up / down / loop) and write
   the result once below the checkpoint folder; every later branch reads it.
2. Rank users by ``(degree, id)`` and enumerate every cycle on three distinct
   users exactly once, from its lowest-ranked user ``a``: join ``a``'s
   out-edges to higher-ranked users with ``a``'s in-edges from higher-ranked
   users (the wedge ``c -> a -> b``), then look for the closing edge ``b -> c``.
   Shuffled, the out-neighbours go to ``c`` as sorted lists and are intersected
   with the in-neighbours of ``c`` (:mod:`quiver.operators.cycles`); with a
   broadcast table the wedges probe it on its two-column key. Under a degree
   order a user has at most ``sqrt(2 * edges)`` higher-ranked neighbours, so no
   join key fans out more than that however large a hub is; a centre with many
   wedges is cut into a grid of sub-keys.
3. Add the mode's weight summed over the cycle's three rotations.
4. With self-loops allowed, add the degenerate cycles: a loop alone
   (``a -> a``, one rotation) and a loop plus a 2-cycle (``x -> x``,
   ``x -> y``, ``y -> x``, three rotations).
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from quiver.functions.weights import check_mode, loop_weight, rotation_sum
from quiver.operators.cycles import LIST_LENGTH, closed_wedges, list_parts, neighbour_lists
from quiver.operators.edges import weighted_edges
from quiver.operators.joins import (
    DEFAULT_BROADCAST_MAX_ROWS,
    JoinPlan,
    check_strategy,
    grid_join,
    hot_products,
    resolve_strategy,
    salted_join,
)
from quiver.operators.numbering import written
from quiver.session import checkpoint_dir, staging_path

ORDERS = ("degree", "id")

# Wedges of one centre that a task makes before that centre is split.
TARGET_WEDGES = 4_000_000


def _ranks_before(deg_u: Column, u: Column, deg_v: Column, v: Column) -> Column:
    """``u`` ranks below ``v`` in the total order ``(degree, id)``."""
    return (deg_u < deg_v) | ((deg_u == deg_v) & (u < v))


def _oriented(
    weighted: DataFrame, order: str, plan: JoinPlan, hot_rows: int | None = None
) -> DataFrame:
    """``(src, dst, w, up)``: ``up`` is true for an edge towards a
    higher-ranked user, false towards a lower-ranked one, NULL for a loop.

    With ``hot_rows``, users with more than that many edges are split across
    tasks when their degree is attached (see :func:`salted_join`); the
    caller proves that the list of such users is small enough to broadcast.
    """
    no_degree = F.lit(None).cast("bigint")
    loops = weighted.where(F.col("src") == F.col("dst")).select(
        "src", "dst", "w", F.lit(None).cast("boolean").alias("up"),
        no_degree.alias("deg_src"), no_degree.alias("deg_dst"),
    )
    simple = weighted.where(F.col("src") != F.col("dst"))
    if order == "id":
        ranked = simple.select(
            "src", "dst", "w", (F.col("src") < F.col("dst")).alias("up"),
            no_degree.alias("deg_src"), no_degree.alias("deg_dst"),
        )
        return ranked.unionByName(loops)
    degree = (
        simple.select(F.explode(F.array("src", "dst")).alias("node"))
        .groupBy("node")
        .agg(F.count(F.lit(1)).alias("deg"))
    )
    # Read up to four times below, and a row per user: counted once.
    degree = written(degree, "triangle-degrees")
    deg_src = degree.select(F.col("node").alias("src"), F.col("deg").alias("deg_src"))
    deg_dst = degree.select(F.col("node").alias("dst"), F.col("deg").alias("deg_dst"))
    if hot_rows is None:
        with_degrees = simple.join(plan.side(deg_src), "src").join(plan.side(deg_dst), "dst")
    else:
        # A hub's edges would all meet its single degree row in one task;
        # split them by the other endpoint instead.
        hot = degree.where(F.col("deg") > hot_rows).select(
            "node", F.ceil(F.col("deg") / hot_rows).alias("salts")
        )
        with_src = salted_join(simple, deg_src, "src", "dst", hot.withColumnRenamed("node", "src"))
        with_degrees = salted_join(with_src, deg_dst, "dst", "src", hot.withColumnRenamed("node", "dst"))
    ranked = with_degrees.select(
        "src", "dst", "w",
        _ranks_before(F.col("deg_src"), F.col("src"), F.col("deg_dst"), F.col("dst")).alias("up"),
        F.col("deg_src").cast("bigint").alias("deg_src"),
        F.col("deg_dst").cast("bigint").alias("deg_dst"),
    )
    return ranked.unionByName(loops)


def _pair_salts(deg_b: Column, deg_c: Column, hot_rows: int | None) -> Column:
    """Sub-keys for the closing pair ``(b, c)``. A pair has at most
    ``min(deg b, deg c)`` wedges, so only pairs of two hubs can be hot; they
    get ``ceil(min / hot_rows)`` sub-keys. Unknown degrees give 1."""
    if hot_rows is None:
        return F.lit(1)
    smaller = F.least(deg_b, deg_c)
    return F.when(smaller > hot_rows, F.ceil(smaller / hot_rows)).otherwise(1).cast("int")


def hot_centres(
    oriented: DataFrame, order: str, edges: int, target_wedges: int, max_keys: int
) -> DataFrame | None:
    """Centres ``a`` with more than ``target_wedges`` wedges, and their parts
    (see :func:`hot_products`); None if there is none."""
    # With h edges to higher-ranked users a centre makes at most (h / 2) ** 2
    # wedges. Under the degree order these are at least h / 2 users of degree
    # h or more, so h * h / 2 <= 2 * edges and the wedges are at most `edges`.
    if (edges if order == "degree" else edges * edges // 4) <= target_wedges:
        return None
    lower = F.when(F.col("up"), F.col("src")).otherwise(F.col("dst"))
    per_centre = oriented.where(F.col("up").isNotNull()).groupBy(lower.alias("a")).agg(
        F.count_if("up").alias("n_left"), F.count_if(~F.col("up")).alias("n_right")
    )
    return hot_products(per_centre, "a", target_wedges, max_keys)


def _probed_cycles(oriented: DataFrame, plan: JoinPlan) -> DataFrame:
    """Cycles on three users by wedges that probe a broadcast edge table."""
    out_a = oriented.where(F.col("up")).select(
        F.col("src").alias("a"), F.col("dst").alias("b"), F.col("w").alias("w_ab")
    )
    in_a = oriented.where(~F.col("up")).select(
        F.col("dst").alias("a"), F.col("src").alias("c"), F.col("w").alias("w_ca")
    )
    closing = oriented.where(F.col("up").isNotNull()).select(
        F.col("src").alias("b"), F.col("dst").alias("c"), F.col("w").alias("w_bc")
    )
    return out_a.join(plan.side(in_a), "a").join(plan.side(closing), ["b", "c"])


def wedges_of(
    oriented: DataFrame, lists: DataFrame, plan: JoinPlan, hot_rows: int | None = None, hot_centres: DataFrame | None = None
) -> DataFrame:
    """The wedges ``c -> a -> b`` as ``(c, salt, a, w_ca, ids, ws)``, a row per
    edge ``c -> a`` and list of out-neighbours of ``a`` (``lists (a, part, ids, ws)``).

    The wedges of each of ``hot_centres`` are made in a grid of sub-keys. With
    ``hot_rows``, the lists that meet at a hub ``c`` are spread over sub-keys.
    """
    in_a = oriented.where(~F.col("up")).select(
        F.col("dst").alias("a"), F.col("src").alias("c"), F.col("w").alias("w_ca"), F.col("deg_src").alias("deg_c")
    )
    if hot_centres is None:
        met = in_a.join(plan.side(lists), "a")
    else:
        met = grid_join(in_a, lists, "a", "c", "part", hot_centres, plan)
    salt = F.pmod(F.xxhash64("a"), _pair_salts(F.col("deg_c"), F.col("deg_c"), hot_rows))
    return met.select("c", salt.cast("int").alias("salt"), "a", "w_ca", "ids", "ws")


def at_salts(closing: DataFrame, hot_rows: int | None) -> DataFrame:
    """``closing (c, deg_c, ids, ws)`` at every sub-key of its user ``c``."""
    salts = _pair_salts(F.col("deg_c"), F.col("deg_c"), hot_rows)
    return closing.select("c", F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt"), "ids", "ws")


def _longest(edges: DataFrame, *ends: str) -> int:
    """Most edges that a user has at one of ``ends``."""
    return max(edges.groupBy(end).count().agg(F.max("count")).first()[0] or 1 for end in ends)


def simple_cycles(
    oriented: DataFrame, order: str, plan: JoinPlan, hot_rows: int | None = None, hot_centres: DataFrame | None = None,
    length: int = LIST_LENGTH,
) -> DataFrame:
    """``(a, b, c, w_ab, w_bc, w_ca)`` of the cycles on three distinct users,
    one row per cycle."""
    if plan.strategy == "broadcast":
        # Its tasks follow the scan, not the keys; the proven row count holds
        # for the sides as they are, without copies.
        return _probed_cycles(oriented, plan)
    simple = oriented.where(F.col("up").isNotNull())
    if order == "degree":
        out_parts, in_parts = list_parts(F.col("deg_src"), length), list_parts(F.col("deg_dst"), length)
    else:
        out_parts = in_parts = list_parts(F.lit(_longest(simple, "src", "dst")), length)
    lists = neighbour_lists(oriented.where("up"), "src", "dst", out_parts).withColumnRenamed("src", "a")
    closing = neighbour_lists(simple, "dst", "src", in_parts, "deg_dst")
    closing = closing.withColumnRenamed("dst", "c").withColumnRenamed("deg_dst", "deg_c")
    return closed_wedges(wedges_of(oriented, lists, plan, hot_rows, hot_centres), at_salts(closing, hot_rows))


def loops_of(oriented: DataFrame) -> DataFrame:
    """``(x, w_xx)`` of the self-loops."""
    return oriented.where(F.col("up").isNull()).select(F.col("src").alias("x"), F.col("w").alias("w_xx"))


def loop_pairs(oriented: DataFrame, plan: JoinPlan) -> DataFrame:
    """``(x, y, w_xx, w_xy, w_yx)``: a self-loop and a 2-cycle through its user."""
    simple = oriented.where(F.col("up").isNotNull())
    out_x = simple.select(F.col("src").alias("x"), F.col("dst").alias("y"), F.col("w").alias("w_xy"))
    back = plan.side(
        simple.select(F.col("src").alias("y"), F.col("dst").alias("x"), F.col("w").alias("w_yx"))
    )
    return plan.side(loops_of(oriented)).join(out_x, "x").join(back, ["x", "y"])


def oriented_edges(
    edges: DataFrame, max_id: int | None = None, allow_loops: bool = True, order: str = "degree",
    broadcast_max_rows: int = DEFAULT_BROADCAST_MAX_ROWS, hot_rows: int = 1_000_000,
) -> tuple[DataFrame, int, int | None]:
    """The oriented edge table (see :func:`_oriented`), its exact row count,
    and the edges beyond which a user is split (None: no user has so many)."""
    checkpoint_dir(edges.sparkSession)
    # The input is read once: the weighted edges are cached while the
    # oriented table is built from them.
    weighted = weighted_edges(edges, max_id, allow_loops).persist(StorageLevel.MEMORY_AND_DISK)
    distinct_edges = weighted.count()
    # At most 2 * edges / hot users have more than hot edges. The threshold
    # rises with the table, so that this list always fits the broadcast bound.
    hot = max(hot_rows, -(-2 * distinct_edges // max(1, broadcast_max_rows)))
    # No user has more edges than the table, so below the threshold there is
    # no hub and the plain join is exact and cheaper.
    hot = hot if order == "degree" and distinct_edges > hot else None
    # Every branch below reads this one table: written once below the shared
    # checkpoint folder, split by `up`, so that a branch reads its own part
    # and columns. Its exact row count is observed while it is written, so
    # the broadcast size check needs no pass of its own.
    observation = Observation("triangle-edges")
    table = _oriented(weighted, order, JoinPlan("auto"), hot).observe(observation, F.count(F.lit(1)).alias("rows"))
    path = staging_path(edges.sparkSession, "triangle-edges")
    table.write.partitionBy("up").parquet(path)
    oriented = edges.sparkSession.read.schema(table.schema).parquet(path)
    weighted.unpersist()
    return oriented, observation.get["rows"], hot


def triangle_count(
    edges: DataFrame,
    mode: str = "bag",
    max_id: int | None = None,
    allow_loops: bool = True,
    strategy: str = "auto",
    order: str = "degree",
    broadcast_max_rows: int = DEFAULT_BROADCAST_MAX_ROWS,
    hot_rows: int = 1_000_000,
    target_wedges: int = TARGET_WEDGES,
) -> DataFrame:
    """``(closings, triangles)`` of a follower edge bag, one row.

    ``mode``: ``bag`` | ``path_bag`` | ``probe_bag`` | ``set``.
    ``max_id``: keep edges whose endpoints are both ``< max_id``.
    ``allow_loops``: False drops self-loop edges first (only simple cycles).
    ``strategy``: ``auto`` | ``shuffle`` | ``broadcast`` (the edge table is
    replicated only when its exact row count proves it fits).
    ``order``: ``degree`` (hub-safe) or ``id`` (skips the degree joins; for
    graphs without hubs). ``hot_rows``: users with more edges than this are
    split across tasks when their degree is attached. ``target_wedges``:
    centres with more wedges are split across tasks. The result does not
    depend on strategy, order, ``hot_rows`` or ``target_wedges``.
    """
    check_mode(mode)
    if hot_rows < 1:
        raise ValueError("hot_rows must be >= 1")
    if order not in ORDERS:
        raise ValueError(f"order must be one of {ORDERS}, got {order!r}")
    check_strategy(strategy)
    oriented, rows, hot = oriented_edges(edges, max_id, allow_loops, order, broadcast_max_rows, hot_rows)
    plan = resolve_strategy(strategy, oriented, broadcast_max_rows, known_rows=rows)
    centres = None
    if plan.strategy != "broadcast":
        centres = hot_centres(oriented, order, rows, target_wedges, broadcast_max_rows)
    cycles = simple_cycles(oriented, order, plan, hot, centres)
    parts = cycles.select(rotation_sum(mode, F.col("w_ab"), F.col("w_bc"), F.col("w_ca")).alias("c"))
    if allow_loops:
        alone = loops_of(oriented).select(loop_weight(mode, F.col("w_xx")).alias("c"))
        paired = loop_pairs(oriented, plan).select(
            rotation_sum(mode, F.col("w_xx"), F.col("w_xy"), F.col("w_yx")).alias("c")
        )
        parts = parts.unionByName(alone).unionByName(paired)
    total = parts.agg(F.coalesce(F.sum("c"), F.lit(0)).cast("bigint").alias("closings"))
    return total.select("closings", F.expr("closings div 3").alias("triangles"))
