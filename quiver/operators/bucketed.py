"""Edges in bucketed tables, laid out once and reused by many joins.

The distinct edges ``(src, dst, w, up)`` are saved three times, bucketed and sorted
by ``src``, by ``dst`` and by the pair, with equal bucket counts; ``up`` tells an
edge towards a higher-ranked user (:mod:`quiver.operators.triangles`). A join on one
of these keys then reads its edge side bucket by bucket without an exchange:
the path join (``dst`` of the one with ``src`` of the other), the join that
attaches ranks to the edges of their source, and the closing join, whose paths
alone are moved.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quiver.operators.triangles import oriented_edges
from quiver.session import staging_path

LAYOUTS = {"src": ("src",), "dst": ("dst",), "pair": ("src", "dst")}


@dataclass(frozen=True)
class BucketedEdges:
    """Common name of the three tables and their number of buckets."""

    name: str
    buckets: int

    def read(self, spark: SparkSession, layout: str) -> DataFrame:
        return spark.table(f"{self.name}_{layout}")

    def drop(self, spark: SparkSession) -> None:
        for layout in LAYOUTS:
            spark.sql(f"DROP TABLE IF EXISTS {self.name}_{layout}")


def write_bucketed(
    edges: DataFrame, buckets: int, name: str | None = None, folder: str | None = None, max_id: int | None = None
) -> BucketedEdges:
    """Save the layouts of ``edges``. ``buckets``: about as many as give 128
    to 256 MB each. ``folder``: where (shared storage); by default a staging
    folder that goes with the application."""
    if buckets < 1:
        raise ValueError("buckets must be >= 1")
    spark = edges.sparkSession
    saved = BucketedEdges(name or f"quiver_edges_{uuid.uuid4().hex}", buckets)
    # Edges with a NULL end lead nowhere and are left out.
    rows = oriented_edges(edges, max_id)[0].select("src", "dst", "w", "up")
    for layout, keys in LAYOUTS.items():
        path = f"{folder}/{layout}" if folder else staging_path(spark, f"edges-by-{layout}")
        # One task per bucket, so one file per bucket.
        rows.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys).format("parquet").option(
            "path", path
        ).saveAsTable(f"{saved.name}_{layout}")
        # The other layouts are made from the first, not from the input again.
        rows = saved.read(spark, "src")
    return saved


def bucketed_paths(spark: SparkSession, edges: BucketedEdges) -> DataFrame:
    """``(src, mid, dst, copies)`` of the distinct two-paths. Both sides are
    bucketed by the middle user: a sort-merge join without an exchange."""
    first = edges.read(spark, "dst").select("src", F.col("dst").alias("mid"), F.col("w").alias("w1"))
    second = edges.read(spark, "src").select(F.col("src").alias("mid"), "dst", F.col("w").alias("w2"))
    met = first.hint("merge").join(second, "mid")
    return met.select("src", "mid", "dst", (F.col("w1") * F.col("w2")).alias("copies"))


def bucketed_closings(spark: SparkSession, edges: BucketedEdges) -> DataFrame:
    """``(closings, triangles)`` in the path-bag mode. Each cycle is found once:
    the wedges ``c -> a -> b`` of its lowest-ranked user, made without an
    exchange, are dealt to the buckets of their closing edge ``b -> c``; the
    edges stay where they are. A self-loop leads neither up nor down: it
    enters its user, and leaves it only on the cycle of itself alone."""
    up = F.col("up")
    out_a = edges.read(spark, "src").where(F.coalesce(up, F.lit(True))).select(
        F.col("src").alias("a"), F.col("dst").alias("b"), F.col("w").alias("w_ab")
    )
    in_a = edges.read(spark, "dst").where(~F.coalesce(up, F.lit(False))).select(
        F.col("dst").alias("a"), F.col("src").alias("c"), F.col("w").alias("w_ca")
    )
    met = in_a.hint("merge").join(out_a, "a").where((F.col("b") != F.col("a")) | (F.col("c") == F.col("a")))
    # Three rotations weigh w_ab * w_ca + w_bc * (w_ab + w_ca), a loop alone w * w.
    alone = (F.col("b") == F.col("a")) & (F.col("c") == F.col("a"))
    ends = met.select(
        F.col("b").alias("src"), F.col("c").alias("dst"), (F.col("w_ab") * F.col("w_ca")).alias("product"),
        F.when(alone, F.lit(0)).otherwise(F.col("w_ab") + F.col("w_ca")).alias("sum"),
    ).repartition(edges.buckets, "src", "dst")
    closed = ends.join(edges.read(spark, "pair").select("src", "dst", "w").hint("merge"), ["src", "dst"])
    total = closed.agg(F.coalesce(F.sum(F.col("product") + F.col("sum") * F.col("w")), F.lit(0)).cast("bigint").alias("closings"))
    return total.select("closings", F.expr("closings div 3").alias("triangles"))


def bucketed_messages(spark: SparkSession, edges: BucketedEdges, ranks: DataFrame) -> DataFrame:
    """``(id, received)``: one round of rank messages. Out-degrees and
    messages read the edges by source; only the ranks are moved to them."""
    sides = edges.read(spark, "src")
    out = sides.groupBy("src").agg(F.sum("w").alias("out"))
    moved = ranks.select(F.col("id").alias("src"), "rank").repartition(edges.buckets, "src")
    sent = sides.hint("merge").join(out, "src").hint("merge").join(moved, "src")
    return sent.groupBy(F.col("dst").alias("id")).agg(F.sum(F.col("rank") * F.col("w") / F.col("out")).alias("received"))
