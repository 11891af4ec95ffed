"""Result sinks: delimited key/value text, ``(k,v)`` tuple text, CSV.

Each writer is one distributed write (one file per task); nothing passes
through the driver. ``sort_keys`` sorts rows by the key inside each output
file, like a reducer's key-ordered output, without a global sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quiver.functions.formatting import tuple_text


def _sorted(df: DataFrame, key: str, sort_keys: bool) -> DataFrame:
    return df.sortWithinPartitions(key) if sort_keys else df


def write_delimited(
    df: DataFrame,
    path: str,
    sep: str = "\t",
    sort_keys: bool = False,
    mode: str = "errorifexists",
) -> None:
    """All columns as ``sep``-joined text lines, no header (TAB by default,
    ``sep=","`` for comma output)."""
    _sorted(df, df.columns[0], sort_keys).write.mode(mode).option("sep", sep).option(
        "header", "false"
    ).csv(path)


def write_tuples(
    df: DataFrame,
    key: str,
    value: str,
    path: str,
    sort_keys: bool = False,
    mode: str = "errorifexists",
) -> None:
    """One ``(key,value)`` line per row."""
    lines = _sorted(df, key, sort_keys).select(tuple_text(F.col(key), F.col(value)).alias("value"))
    lines.write.mode(mode).text(path)


def write_csv(df: DataFrame, path: str, header: bool = False, mode: str = "errorifexists") -> None:
    """The DataFrame's own CSV writer."""
    df.write.mode(mode).option("header", str(header).lower()).csv(path)


def write_ordered(df: DataFrame, path: str, key: str, sep: str = "\t", files: int | None = None) -> None:
    """Delimited text in one global order: range-partitioned and sorted files
    whose names ascend with the key. Equal keys share a file."""
    ranged = df.repartitionByRange(files, key) if files else df.repartitionByRange(key)
    ranged.sortWithinPartitions(key).write.option("sep", sep).option("header", "false").csv(path)


def read_ordered(spark: SparkSession, path: str, schema: T.StructType, sep: str = "\t") -> DataFrame:
    """Read back what :func:`write_ordered` wrote, with ``file`` (the number
    in the file's name) and ``place``: the row's number over all files, taken
    from the files' row counts and the order of their lines."""
    rows = spark.read.schema(schema).option("sep", sep).option("header", "false").csv(path)
    number = F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1).cast("int")
    rows = rows.select(
        "*", number.alias("file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_at")
    )
    # One row per block of a file; within a block lines come in order.
    blocks = rows.groupBy("file", "_block").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    earlier = Window.orderBy("file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    met = rows.join(blocks.drop("_n"), ["file", "_block"])
    return met.select(
        *[f.name for f in schema], "file", (F.col("_before") + F.col("_at") - F.col("_first")).alias("place")
    )


def read_delimited(
    spark: SparkSession, path: str, schema: T.StructType, sep: str = "\t", header: bool = False
) -> DataFrame:
    """Read back what :func:`write_delimited` / :func:`write_csv` wrote."""
    return (
        spark.read.schema(schema)
        .option("sep", sep)
        .option("header", str(header).lower())
        .csv(path)
    )


def read_tuples(
    spark: SparkSession, path: str, key: str = "key", value: str = "value",
    key_type: str = "bigint", value_type: str = "bigint",
) -> DataFrame:
    """Parse ``(key,value)`` lines back into two typed columns; lines that do
    not match the pattern are dropped."""
    pattern = r"^\((.*),([^,]*)\)$"
    lines = spark.read.text(path).where(F.col("value").rlike(pattern))
    return lines.select(
        F.regexp_extract("value", pattern, 1).try_cast(key_type).alias(key),
        F.regexp_extract("value", pattern, 2).try_cast(value_type).alias(value),
    )
