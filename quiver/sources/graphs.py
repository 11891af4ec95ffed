"""PageRank graph sources.

A PageRank graph is ``(src BIGINT, dst BIGINT NULL)``: one row per out-edge,
``dst IS NULL`` for an edge into the sink (rank that leaves the graph and is
spread evenly over all nodes again as dangling mass).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quiver.functions.parsing import to_id

NODE_TABLE_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType(), True),
        T.StructField("neighbour", T.StringType(), True),
        T.StructField("rank", T.StringType(), True),
    ]
)


def kchain_graph(spark: SparkSession, k: int) -> DataFrame:
    """``k`` chains of ``k`` nodes, ids ``1 .. k*k``: node ``i`` points at
    ``i + 1``; the tail of each chain (``i % k == 0``) points at the sink.

    Generated by ``spark.range`` on the executors; nothing is built on the
    driver.
    """
    if k < 1:
        raise ValueError("k must be >= 1")
    ids = spark.range(1, k * k + 1).select(F.col("id").alias("src"))
    return ids.select(
        "src",
        F.when(F.col("src") % k == 0, F.lit(None).cast("bigint"))
        .otherwise(F.col("src") + 1)
        .alias("dst"),
    )


def kchain_initial_ranks(spark: SparkSession, k: int) -> DataFrame:
    """Uniform start rank ``1 / k^2`` for every K-chain node."""
    return spark.range(1, k * k + 1).select("id", F.lit(1.0 / (k * k)).alias("rank"))


def read_node_table(
    spark: SparkSession, path: str, sink_id: int | None = 0, sep: str = "\t"
) -> DataFrame:
    """Node lines ``id <TAB> neighbour <TAB> rank`` -> ``(id, neighbour, rank)``.

    ``neighbour`` is NULL for an empty field or for ``sink_id`` (the sink
    pseudo-node). A node may have several lines, one per out-edge, carrying
    the same rank. Lines whose id, rank or non-empty neighbour does not parse
    are dropped.
    """
    raw = spark.read.schema(NODE_TABLE_SCHEMA).option("sep", sep).csv(path)
    given = F.trim(F.coalesce("neighbour", F.lit("")))
    raw = raw.where((given == "") | to_id(given).isNotNull())
    neighbour = to_id(given)
    if sink_id is not None:
        neighbour = F.when(neighbour != F.lit(sink_id), neighbour)
    return (
        raw.select(
            to_id(F.trim(F.col("id"))).alias("id"),
            neighbour.alias("neighbour"),
            F.col("rank").try_cast("double").alias("rank"),
        )
        .where(F.col("id").isNotNull() & F.col("rank").isNotNull())
    )


def node_table_graph(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split a node table into ``graph(src, dst)`` and start ``ranks(id, rank)``."""
    graph = nodes.select(F.col("id").alias("src"), F.col("neighbour").alias("dst"))
    ranks = nodes.groupBy("id").agg(F.max("rank").alias("rank"))
    return graph, ranks


def edges_to_graph(edges: DataFrame) -> DataFrame:
    """A follower edge bag as a PageRank graph ``(src, dst)``."""
    return edges.select(F.col("follower").alias("src"), F.col("followee").alias("dst"))
