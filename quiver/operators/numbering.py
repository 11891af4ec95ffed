"""Gapless positions without a single-task window.

Rows are sorted by range partitions, written once, and numbered by the counts
of the partitions: only a row per partition (and group) passes a window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quiver.session import staging_path

_AT, _PART = "_at", "_part"


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written below the shared checkpoint folder and read back."""
    path = staging_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(rows: DataFrame, order: list[str], by: list[str] | None = None, name: str = "idx") -> DataFrame:
    """``rows`` with their place (from 0) in ``order``, or in their group of
    ``by`` (the first columns of ``order``, without nulls).

    Rows equal in ``order`` share a range partition, so ``order`` should tell
    the rows of a group apart.
    """
    by = by or []
    if order[:len(by)] != by:
        raise ValueError("order must start with the columns of by")
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = written(rows.withColumn(_AT, F.monotonically_increasing_id()), "numbered")
    # The upper bits of the id are the partition, the lower ones the place in it.
    rows = rows.withColumn(_PART, F.shiftright(_AT, 33))
    held = rows.groupBy(*by, _PART).agg(F.min(_AT).alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*by).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = held.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).drop("_n")
    placed = rows.join(offsets, [*by, _PART])
    return placed.withColumn(name, F.col("_before") + F.col(_AT) - F.col("_first")).drop(_AT, _PART, "_first", "_before")
