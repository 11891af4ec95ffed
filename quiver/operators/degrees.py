"""Per-user counts: followers, in-neighbour sets, two-paths.

Each is one aggregation with map-side partial aggregation, so the shuffle
carries at most one row per (map task, key) no matter how many edges a
celebrity user has.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quiver.operators.edges import cap_edges


def follower_count(edges: DataFrame) -> DataFrame:
    """``(user, followers)``: rows in which the user is the followee."""
    return edges.groupBy(F.col("followee").alias("user")).agg(
        F.count(F.lit(1)).alias("followers")
    )


def follower_count_grouped(edges: DataFrame, salt_buckets: int = 32) -> DataFrame:
    """Follower count by grouping first and summing the groups after.

    Groups are ``(user, salt)`` with the salt taken from the follower id, so
    no group is larger than a ``1 / salt_buckets`` share of a user's
    followers; the second level sums at most ``salt_buckets`` partial counts
    per user. Same rows as :func:`follower_count`.
    """
    salted = edges.select(
        F.col("followee").alias("user"),
        F.pmod(F.xxhash64("follower"), F.lit(salt_buckets)).alias("salt"),
    )
    per_group = salted.groupBy("user", "salt").agg(F.count(F.lit(1)).alias("n"))
    return per_group.groupBy("user").agg(F.sum("n").alias("followers"))


def in_neighbours(edges: DataFrame) -> DataFrame:
    """``(user, n_in, n_in_distinct)``: the in-neighbour bag and set of each
    user, reported by size.

    The adjacency itself stays a ``(user, neighbour)`` table that joins
    consume; one array per user would put a celebrity's whole follower list
    into a single row.
    """
    return edges.groupBy(F.col("followee").alias("user")).agg(
        F.count(F.lit(1)).alias("n_in"),
        F.count_distinct("follower").alias("n_in_distinct"),
    )


def _roles(edges: DataFrame) -> DataFrame:
    """Each edge as an out-row at the follower and an in-row at the followee."""
    role = F.explode(
        F.array(
            F.struct(
                F.col("follower").alias("user"),
                F.lit(0).alias("i"),
                F.lit(1).alias("o"),
            ),
            F.struct(
                F.col("followee").alias("user"),
                F.lit(1).alias("i"),
                F.lit(0).alias("o"),
            ),
        )
    )
    return edges.select(role.alias("r")).select("r.*")


def two_path_per_user(edges: DataFrame, max_id: int | None = None) -> DataFrame:
    """``(user, n_in, n_out, paths)``: two-paths ``a -> user -> c`` through
    each user, ``paths = n_in * n_out`` (bag semantics, self-loops included).

    Users with only one role get a row with ``paths = 0``. One scan, one
    shuffle: the two degrees come from the same aggregation.
    """
    per_user = _roles(cap_edges(edges, max_id)).groupBy("user").agg(
        F.sum("i").cast("bigint").alias("n_in"),
        F.sum("o").cast("bigint").alias("n_out"),
    )
    return per_user.withColumn("paths", F.col("n_in") * F.col("n_out"))


def two_path_total(edges: DataFrame, max_id: int | None = None) -> DataFrame:
    """``(paths)``: number of two-paths in the graph, without materialising
    them (sum of in-degree x out-degree over the middle users). With
    ``max_id`` this is the row count of the capped path join."""
    return two_path_per_user(edges, max_id).agg(
        F.coalesce(F.sum("paths"), F.lit(0)).cast("bigint").alias("paths")
    )
