"""PageRank without damping, with dangling mass spread over all nodes.

Graph: ``(src, dst)`` rows, a bag; ``dst IS NULL`` is an edge into the sink.
Each round a node sends ``rank * w / out_rows`` along each of its out-edges.
What reaches the sink, plus the whole rank of nodes with no out-edge, is the
dangling mass ``D``; every node then gets ``received + D / n``.

``dangling="same"``    round t adds the ``D`` of round t (mass stays 1).
``dangling="lagged"``  round t adds the ``D`` of round t-1 (0 in round 1),
                       the way a chain of batch jobs passes it on.
``absent="add"``       a target without out-rows or start rank is a node too.
``absent="drop"``      nodes are the sources and the ids of ``initial`` alone;
                       a message to any other id is lost.
``dangling_scale``     if set, each message into the sink is truncated to whole
                       ``1 / dangling_scale`` units before summing (mass leaks).

Physical layout (per run, not per round):

* the input is read once, pre-aggregated to weighted edges; the graph
  ``(src, part, dst, w)`` is persisted, hash-partitioned by
  ``(src, part)`` and sorted by ``dst`` in a partition (its lineage is one scan and a few aggregates, so a lost
  block is cheap to rebuild); a source
  with more than ``split_rows`` out-edges is split into several parts
  (salted by ``dst``), so one hub cannot put a third of the graph into one
  task;
* the node-part table ``(id, part, out_rows)`` (one row per node, more for a
  split hub) is persisted once, partitioned by ``id``; the out-degree travels
  with the rank, so it is never joined to the edges on its own.

Persisted tables keep their hash partitioning in later plans (a checkpoint
does not), so the graph is never shuffled again after the first round.

Each round then moves only the rank table (one row per node part) to the
graph, where a hash join built on the ranks streams the graph without
sorting it again, and the partially aggregated messages to their targets. The
rank table is shuffled, or broadcast when its exact row count (taken once
before the first round) is at most ``broadcast_max_rows``. The
messages of every round are checkpointed to the shared folder, which cuts
the lineage (a lost executor recomputes one round, and the plan does not
grow with the round count). Two doubles are observed while that checkpoint
is written and read back to the driver: the dangling mass and the mass that
reached real nodes (the per-round ``dangling`` and ``mass`` outputs). So a
round is one job.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from quiver.functions.formatting import truncate_units
from quiver.operators.joins import DEFAULT_BROADCAST_MAX_ROWS
from quiver.session import checkpoint_dir

DANGLING = ("same", "lagged")
ABSENT = ("add", "drop")


@dataclass
class PageRankResult:
    ranks: DataFrame  # (id, rank): every real node after the last round
    dangling: DataFrame  # (iteration, dangling): D of each round
    mass: DataFrame  # (iteration, mass): sum of ranks after each round
    nodes: int  # n


@dataclass
class _Layout:
    graph: DataFrame  # (src, part, dst, w), partitioned by (src, part)
    parts: DataFrame  # (id, part, out_rows): one row per node part, partitioned by id
    n: int
    part_rows: int
    fingerprint: str  # of the weighted edges


def layout_partitions(spark, rows: int, rows_per_partition: int) -> int:
    """Partitions for a persisted layout of ``rows`` rows: about
    ``rows_per_partition`` each, never fewer than the cluster's default
    parallelism. A cached plan's final shuffle is not coalesced by AQE, so
    the count must come from the data, not from ``spark.sql.shuffle.partitions``.
    """
    return max(spark.sparkContext.defaultParallelism, -(-rows // rows_per_partition), 1)


def _layout(
    graph: DataFrame,
    extra_nodes: DataFrame | None,
    split_rows: int,
    rows_per_partition: int,
    broadcast_max_rows: int = DEFAULT_BROADCAST_MAX_ROWS,
    absent: str = "add",
) -> _Layout:
    spark = graph.sparkSession
    g = graph.select(F.col("src").cast("bigint").alias("src"), F.col("dst").cast("bigint").alias("dst"))
    # The input is read once: every table below derives from the weighted
    # edges, which are cached until the layout is built.
    weighted = g.where(F.col("src").isNotNull()).groupBy("src", "dst").agg(F.count(F.lit(1)).alias("w")).persist(
        StorageLevel.MEMORY_AND_DISK
    )
    read = weighted.agg(F.sum("w").alias("rows"), F.bit_xor(F.xxhash64("src", "dst", "w")).alias("mark")).first()
    rows = read["rows"] or 0
    partitions = layout_partitions(spark, int(rows), rows_per_partition)
    # The list of split sources (at most rows / split_rows) always fits the
    # broadcast bound: the threshold rises with the graph.
    split_rows = max(split_rows, -(-int(rows) // max(1, broadcast_max_rows)))

    # One pass gives the nodes and their out-rows (null: none).
    ids = weighted.select(F.col("src").alias("id"), F.col("w").alias("out_rows"))
    none = F.lit(None).cast("bigint").alias("out_rows")
    if absent == "add":
        ids = ids.unionByName(weighted.where(F.col("dst").isNotNull()).select(F.col("dst").alias("id"), none))
    if extra_nodes is not None:
        ids = ids.unionByName(extra_nodes.select(F.col("id").cast("bigint").alias("id"), none))
    nodes = ids.groupBy("id").agg(F.sum("out_rows").alias("out_rows")).select(
        "id", "out_rows", F.coalesce(F.ceil(F.col("out_rows") / split_rows), F.lit(1)).alias("parts")
    ).persist(StorageLevel.MEMORY_AND_DISK)
    counts = nodes.agg(
        F.count(F.lit(1)).alias("nodes"), F.sum("parts").alias("rows"), F.max("parts").alias("most")
    ).first()

    # Nodes without any out-row hand their whole rank to the sink.
    edges = weighted.unionByName(nodes.where("out_rows IS NULL").select(
        F.col("id").alias("src"), F.lit(None).cast("bigint").alias("dst"), F.lit(1).cast("bigint").alias("w")
    ))
    part = F.lit(0).cast("bigint")
    if counts["most"] and counts["most"] > 1:
        # At most rows / split_rows sources are split, so that list is
        # provably small enough to broadcast; a hub's edges then meet its
        # out-degree in several tasks instead of one.
        hubs = nodes.where("parts > 1").select(F.col("id").alias("src"), F.col("parts").alias("salts"))
        edges = edges.join(F.broadcast(hubs), "src", "left")
        part = F.when(F.col("salts").isNotNull(), F.pmod(F.xxhash64("dst"), F.col("salts"))).otherwise(part)
    # The edges are moved once; the out-degree of a source goes with its rank.
    # Sorted by target, messages to one target follow each other in a round.
    routed = (
        edges.select("src", part.alias("part"), "dst", "w")
        .repartition(partitions, "src", "part")
        .sortWithinPartitions("dst")
        .persist(StorageLevel.MEMORY_AND_DISK)
    )
    parts = nodes.select(
        "id", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)).alias("part"),
        F.coalesce("out_rows", F.lit(1)).alias("out_rows"),
    ).repartition(partitions, "id").persist(StorageLevel.MEMORY_AND_DISK)
    # Build both layouts now, so that what they derive from can go.
    routed.count()
    parts.count()
    weighted.unpersist()
    nodes.unpersist()
    return _Layout(routed, parts, counts["nodes"], int(counts["rows"] or 0), f"{rows}/{read['mark'] or 0}")


def pagerank(
    graph: DataFrame,
    iterations: int = 10,
    dangling: str = "same",
    dangling_scale: int | None = None,
    initial: DataFrame | None = None,
    split_rows: int = 1_000_000,
    broadcast_max_rows: int = DEFAULT_BROADCAST_MAX_ROWS,
    rows_per_partition: int = 4_000_000,
    absent: str = "add",
) -> PageRankResult:
    """Run ``iterations`` rounds; see the module docstring for semantics.

    ``initial``: optional start ranks ``(id, rank)``; default ``1 / n``.
    ``split_rows``: out-edges per part of a hub source.
    ``broadcast_max_rows``: when the node-part table is at most this many rows
    (its size is counted exactly once, before the first round), each round
    broadcasts the ranks to the graph instead of shuffling them.
    ``rows_per_partition``: sizing of the persisted graph layout (about
    128 MB of graph rows per partition).
    The returned ranks are checkpointed and every cache is released.
    """
    _check(dangling, absent, split_rows, rows_per_partition)
    spark = graph.sparkSession
    checkpoint_dir(spark)
    layout = _layout(graph, initial, split_rows, rows_per_partition, broadcast_max_rows, absent)
    fanned = _start(layout, initial)
    carried = 0.0
    stats: list[tuple[int, float, float]] = []
    for it in range(1, iterations + 1):
        received, d_now, reached = _round(layout, fanned, it, dangling_scale, broadcast_max_rows, absent)
        spread = d_now if dangling == "same" else carried
        carried = d_now
        # Every node gets spread / n, so the total is reached + spread.
        stats.append((it, d_now, reached + spread))
        fanned = _delivered(layout, received, spread)

    ranks = fanned.where(F.col("part") == 0).select("id", "rank").checkpoint()
    for frame in (layout.graph, layout.parts):
        frame.unpersist()
    per_round = spark.createDataFrame(stats, "iteration int, dangling double, mass double")
    return PageRankResult(
        ranks, per_round.select("iteration", "dangling"), per_round.select("iteration", "mass"), layout.n
    )


def _check(dangling: str, absent: str, split_rows: int, rows_per_partition: int) -> None:
    if dangling not in DANGLING:
        raise ValueError(f"dangling must be one of {DANGLING}, got {dangling!r}")
    if absent not in ABSENT:
        raise ValueError(f"absent must be one of {ABSENT}, got {absent!r}")
    if split_rows < 1 or rows_per_partition < 1:
        raise ValueError("split_rows and rows_per_partition must be >= 1")


def _start(layout: _Layout, initial: DataFrame | None) -> DataFrame:
    """Start rank of every node part; part 0 is the node's own row."""
    if initial is None:
        return layout.parts.withColumn("rank", F.lit(1.0 / max(1, layout.n)))
    return layout.parts.join(initial.select("id", "rank"), "id", "left").select(
        "id", "part", "out_rows", F.coalesce(F.col("rank").cast("double"), F.lit(0.0)).alias("rank")
    )


def _round(
    layout: _Layout, fanned: DataFrame, it: int, dangling_scale: int | None, broadcast_max_rows: int, absent: str
) -> tuple[DataFrame, float, float]:
    """Send one round of messages: ``(dst, m)`` checkpointed, the dangling
    mass and the mass that reached real nodes."""
    # The rank side is small (one row per node part): build the hash
    # table on it and stream the graph, which is never sorted or moved.
    messages = layout.graph.join(
        F.broadcast(fanned) if layout.part_rows <= broadcast_max_rows else fanned.hint("shuffle_hash"),
        (layout.graph.src == fanned.id) & (layout.graph.part == fanned.part),
    ).select("dst", (F.col("w") / F.col("out_rows") * F.col("rank")).alias("m"))
    if dangling_scale is not None:
        # Into the sink, whole units are summed (exact in a double).
        units = truncate_units(F.col("m"), dangling_scale).cast("double")
        messages = messages.select("dst", F.when(F.col("dst").isNull(), units).otherwise(F.col("m")).alias("m"))
    d_col = F.col("m") / F.lit(float(dangling_scale or 1))
    received = messages.groupBy("dst").agg(F.sum("m").alias("m"))
    if absent == "drop":
        # One row per target by now, so no target is hot in this join.
        own = layout.parts.where(F.col("part") == 0).select(F.col("id").alias("node"))
        received = received.join(own, F.col("dst") == F.col("node"), "left").where(
            F.col("dst").isNull() | F.col("node").isNotNull()
        ).drop("node")
    # One job per round: the checkpoint cuts the lineage (a lost executor
    # recomputes one round; the plan does not grow), and the dangling
    # mass and the mass that reached real nodes are observed while it is
    # written, with no second pass.
    observation = Observation(f"pagerank-round-{it}")
    received = received.observe(
        observation,
        F.coalesce(F.sum(F.when(F.col("dst").isNull(), d_col)), F.lit(0.0)).alias("dangling"),
        F.coalesce(F.sum(F.when(F.col("dst").isNotNull(), F.col("m"))), F.lit(0.0)).alias("reached"),
    ).checkpoint()
    row = observation.get
    return received, float(row["dangling"]), float(row["reached"])


def _delivered(layout: _Layout, received: DataFrame, spread: float) -> DataFrame:
    """Rank of every node part after a round."""
    parts = layout.parts
    to_nodes = received.where(F.col("dst").isNotNull())
    return parts.join(to_nodes, parts.id == to_nodes.dst, "left").select(
        "id", "part", "out_rows", (F.coalesce(F.col("m"), F.lit(0.0)) + F.lit(spread / max(1, layout.n))).alias("rank")
    )


def top_k(ranks: DataFrame, k: int) -> DataFrame:
    """The ``k`` highest-ranked nodes; ties by ascending id.

    ``orderBy + limit`` plans as a per-partition top-k merged on one task,
    which holds ``k`` rows per partition, never the whole table.
    """
    return ranks.orderBy(F.col("rank").desc(), F.col("id").asc()).limit(k)


def ranks_by_id(ranks: DataFrame) -> DataFrame:
    """All ranks ordered by numeric id (a range-partitioned sort)."""
    return ranks.orderBy("id")
