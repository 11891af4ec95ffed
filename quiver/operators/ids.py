"""Dictionary of text ids: every token gets a dense number.

Triangles, paths and PageRank take numeric ids. Edges whose ids are text are
encoded with a dictionary ``(token, id)``: ids run from 0 without gaps in code
point order of the tokens, so they do not depend on partitioning. No token
passes the driver and no task sees them all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quiver.operators.joins import DEFAULT_BROADCAST_MAX_ROWS, salted_join
from quiver.operators.numbering import numbered, written

HOT_ROWS = 1_000_000


def id_dictionary(edges: DataFrame, columns: tuple[str, ...] = ("follower", "followee")) -> DataFrame:
    """``(token, id, n)`` of all tokens in ``columns``; ``n`` is how often
    the token occurs. Null tokens have no id."""
    tokens = edges.select(F.explode(F.array(*[F.col(c).cast("string") for c in columns])).alias("token"))
    counted = tokens.where(F.col("token").isNotNull()).groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    return written(numbered(counted, ["token"], name="id").select("token", "id", "n"), "id-dictionary")


def encode_edges(
    edges: DataFrame, dictionary: DataFrame, hot_rows: int = HOT_ROWS, max_hot: int = DEFAULT_BROADCAST_MAX_ROWS
) -> DataFrame:
    """``edges (follower, followee)`` with both tokens replaced by their ids.

    A token of more than ``hot_rows`` occurrences would meet its one
    dictionary row in a single task: its edges are spread over sub-keys by the
    other end. At most occurrences / ``hot_rows`` tokens are hot; the
    threshold rises until they are at most ``max_hot``.
    """
    total = dictionary.agg(F.sum("n")).first()[0] or 0
    hot_rows = max(hot_rows, -(-total // max_hot))
    hot = dictionary.where(F.col("n") > hot_rows).select("token", F.ceil(F.col("n") / hot_rows).alias("salts"))
    out = edges.select(F.col("follower").cast("string").alias("follower"), F.col("followee").cast("string").alias("followee"))
    for own, other in (("follower", "followee"), ("followee", "follower")):
        table = dictionary.select(F.col("token").alias(own), F.col("id").alias("_id"))
        if total > hot_rows:
            met = salted_join(out, table, own, other, hot.withColumnRenamed("token", own))
        else:
            met = out.join(table, own)
        out = met.select(F.col("_id").alias(own), F.col(other)) if own == "follower" else met.select(other, F.col("_id").alias(own))
    return out.select("follower", "followee")


def decode_ids(rows: DataFrame, dictionary: DataFrame, column: str = "id") -> DataFrame:
    """``rows`` (one row per id) with ``column`` replaced by its token."""
    names = dictionary.select(F.col("id").alias(column), F.col("token").alias("_token"))
    columns = [F.col("_token").alias(c) if c == column else F.col(c) for c in rows.columns]
    return rows.join(names, column).select(*columns)
