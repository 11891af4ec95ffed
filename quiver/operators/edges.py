"""Row-level edge operators: id cap, de-duplication, multiplicities."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def cap_edges(edges: DataFrame, max_id: int | None) -> DataFrame:
    """Keep edges whose two endpoints are both ``< max_id`` (no cap: None).

    A plain ``where`` so Catalyst pushes it into the scan.
    """
    if max_id is None:
        return edges
    return edges.where((F.col("follower") < max_id) & (F.col("followee") < max_id))


def drop_loops(edges: DataFrame) -> DataFrame:
    return edges.where(F.col("follower") != F.col("followee"))


def distinct_edges(edges: DataFrame) -> DataFrame:
    """The edge set (duplicates removed)."""
    return edges.select("follower", "followee").distinct()


def edge_multiplicity(edges: DataFrame) -> DataFrame:
    """``(follower, followee, n)``: how often each edge occurs.

    Partial aggregation before the shuffle, so an edge repeated in a third of
    all rows leaves each map task as a single row.
    """
    return edges.groupBy("follower", "followee").agg(F.count(F.lit(1)).alias("n"))


def line_multiplicity(lines: DataFrame) -> DataFrame:
    """``(line, n)``: how often each raw text line occurs (no parsing, so
    ``1,2`` and ``1,2,`` are different keys)."""
    return lines.groupBy(F.col("value").alias("line")).agg(F.count(F.lit(1)).alias("n"))


def weighted_edges(
    edges: DataFrame, max_id: int | None = None, allow_loops: bool = True
) -> DataFrame:
    """Pre-aggregate a bag of edges to ``(src, dst, w)``, ``w`` = multiplicity.

    Every later join then sees each distinct edge once; duplicate semantics
    are carried by ``w`` instead of by repeated rows.
    """
    capped = cap_edges(edges, max_id)
    if not allow_loops:
        capped = drop_loops(capped)
    return capped.groupBy(
        F.col("follower").alias("src"), F.col("followee").alias("dst")
    ).agg(F.count(F.lit(1)).alias("w"))
