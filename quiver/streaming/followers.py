"""Follower counts kept up to date while edge files keep arriving.

The batch operators read a finished edge directory. Here the same parsing
rules and the same ``follower_count`` run as a Structured Streaming query
over a directory that grows: each micro-batch reads only new files, Spark
keeps the per-user counts in its state store (checkpointed to the shared
folder, so a restarted query resumes), and every batch rewrites the current
table to a parquet folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from quiver.operators.degrees import follower_count
from quiver.sources.edges import parse_lenient, parse_strict, parse_tokenised

_PARSERS = {"strict": parse_strict, "lenient": parse_lenient, "tokenised": parse_tokenised}


def follower_count_stream(
    spark: SparkSession, edge_dir: str, rule: str = "strict", files_per_batch: int | None = None
) -> DataFrame:
    """Streaming ``(user, followers)`` over text edge files in ``edge_dir``."""
    reader = spark.readStream.format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if rule not in _PARSERS:
        raise ValueError(f"rule must be one of {sorted(_PARSERS)}, got {rule!r}")
    return follower_count(_PARSERS[rule](reader.load(edge_dir)))


def start_follower_count(
    spark: SparkSession,
    edge_dir: str,
    output_dir: str,
    rule: str = "strict",
    checkpoint_location: str | None = None,
    available_now: bool = False,
    processing_time: str | None = None,
) -> StreamingQuery:
    """Start the streaming count; each micro-batch overwrites ``output_dir``
    with the full current table (complete output mode). The state lies in
    ``checkpoint_location``, by default beside ``output_dir``, so a restart
    resumes.
    """
    counts = follower_count_stream(spark, edge_dir, rule)
    location = checkpoint_location or f"{output_dir.rstrip('/')}-state"

    def publish(batch: DataFrame, _batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(output_dir)

    writer = (
        counts.writeStream.outputMode("complete")
        .option("checkpointLocation", location)
        .foreachBatch(publish)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
