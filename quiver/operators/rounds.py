"""PageRank with every round committed, and restart after the last one.

The folder of a run holds one table per round and one commit per round::

    rounds/round=3/     (id, rank) after round 3
    commits/round=3/    one line: run settings, rows, dangling mass, mass

A round's commit is written after its table. A run that ends in between
(lost driver, full queue) leaves a table without a commit: it is written
again. A later call with the same graph and settings starts after the last
committed round and leaves all earlier tables as they are; another graph or
other settings are refused. More ``iterations`` continue a finished run.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quiver.operators.joins import DEFAULT_BROADCAST_MAX_ROWS
from quiver.operators.ranking import _check, _delivered, _layout, _round, _start
from quiver.session import checkpoint_dir

_COMMIT = "settings string, rows bigint, dangling double, mass double"
_RANKS = "id bigint, rank double"


def _exists(spark: SparkSession, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def commits(spark: SparkSession, folder: str) -> DataFrame:
    """``(settings, rows, dangling, mass, round)`` of the committed rounds."""
    if not _exists(spark, f"{folder}/commits"):
        return spark.createDataFrame([], _COMMIT + ", round int")
    return spark.read.schema(_COMMIT + ", round int").json(f"{folder}/commits")


def _commit(spark: SparkSession, folder: str, it: int, row: tuple) -> None:
    spark.createDataFrame([row], _COMMIT).coalesce(1).write.mode("overwrite").json(f"{folder}/commits/round={it}")


def _last(spark: SparkSession, folder: str, settings: str) -> tuple[int, float]:
    """The last committed round without a gap before it, and its dangling mass."""
    # One row per round.
    done = {r["round"]: r for r in commits(spark, folder).collect()}
    last = 0
    while last + 1 in done:
        last += 1
    if any(r["settings"] != settings for r in done.values()):
        raise ValueError(f"{folder} holds the rounds of another graph or of other settings")
    return last, float(done[last]["dangling"]) if last else 0.0


def pagerank_rounds(
    graph: DataFrame,
    folder: str,
    iterations: int = 10,
    dangling: str = "same",
    dangling_scale: int | None = None,
    initial: DataFrame | None = None,
    split_rows: int = 1_000_000,
    broadcast_max_rows: int = DEFAULT_BROADCAST_MAX_ROWS,
    rows_per_partition: int = 4_000_000,
    absent: str = "add",
) -> DataFrame:
    """``(iteration, id, rank)`` of rounds 1 to ``iterations``, kept below
    ``folder`` (shared storage). Parameters as in
    :func:`quiver.operators.ranking.pagerank`.

    Each round reads the table that the round before has committed, so a
    restart repeats at most one round, and the ranks are those of an
    uninterrupted run.
    """
    _check(dangling, absent, split_rows, rows_per_partition)
    spark = graph.sparkSession
    checkpoint_dir(spark)
    layout = _layout(graph, initial, split_rows, rows_per_partition, broadcast_max_rows, absent)
    start = None if initial is None else initial.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("id", "rank"))).first()
    settings = json.dumps([layout.fingerprint, layout.n, dangling, dangling_scale, absent, start and list(start)])
    last, carried = _last(spark, folder, settings)
    for it in range(last + 1, iterations + 1):
        before = initial if it == 1 else spark.read.schema(_RANKS).parquet(f"{folder}/rounds/round={it - 1}")
        received, d_now, reached = _round(layout, _start(layout, before), it, dangling_scale, broadcast_max_rows, absent)
        spread = d_now if dangling == "same" else carried
        carried = d_now
        rows = Observation(f"pagerank-table-{it}")
        ranks = _delivered(layout, received, spread).where(F.col("part") == 0).select("id", "rank")
        ranks.observe(rows, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(f"{folder}/rounds/round={it}")
        _commit(spark, folder, it, (settings, rows.get["rows"], d_now, reached + spread))
    for frame in (layout.graph, layout.parts):
        frame.unpersist()
    if not iterations:
        return spark.createDataFrame([], "iteration int, id bigint, rank double")
    found = spark.read.schema(_RANKS + ", round int").parquet(f"{folder}/rounds")
    return found.where(F.col("round") <= iterations).select(F.col("round").alias("iteration"), "id", "rank")
