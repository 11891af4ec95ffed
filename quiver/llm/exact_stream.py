"""Exact dedup as a stateful stream over a table of files.

The files are read as a stream (``availableNow``: everything present now, in
micro-batches of a bounded number of bytes). A streaming aggregation keeps
one state row per text digest in RocksDB, without expiry:

    digest -> (keeper: largest doc_id with its content locator, group size)

The locator is the file and row in which the keeper's text is stored. State
lives on the executors' disks and is checkpointed to the shared folder, so a
lost executor reloads its part; a later run with the same ``state_dir``
reads only new files. Rows reach the state partially aggregated, one per
task and digest, so a text that makes up a third of all rows is no hot key.

A digest hit is then checked on full bytes: every row of a group with more
than one member is compared with the text at the keeper's locator. Rows that
differ (a digest collision) are regrouped by their text.

Defined cases: a null text counts as empty; rows repeated with the same
``doc_id`` are copies like any others, one of them is kept (the locator
breaks the tie); a null ``doc_id`` ranks lowest; an empty table gives an
empty result; other columns are neither read nor returned, whatever their
names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quiver.llm.common import staged
from quiver.session import staging_path

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # A store per state partition: without this, each reserves megabytes of
    # disk for its logs however little it holds.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
}

# The prefilter before the byte check marks one of this many slots per hit
# digest: a bound on what is broadcast, whatever the number of hits.
HIT_SLOTS = 1 << 20

_STATE = "digest binary, keep_id bigint, keep_file string, keep_row bigint, n bigint"


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _located(df: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return df.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.row_index").alias("row"),
        digest(text).alias("digest"),
        text.alias("text"),
    )


def _as_glob(path: str) -> str:
    """The same path as a pattern: a file stream takes a plain path for a
    folder, a pattern also for a single file."""
    path = path.rstrip("/")
    return f"{path[:-1]}[{path[-1]}]"


def digest_state(
    spark: SparkSession,
    path: str,
    digest: Callable[[Column], Column] = sha256,
    state_dir: str | None = None,
    bytes_per_batch: int = 64 << 30,
) -> DataFrame:
    """Run the stream over ``path`` and return its state, one row per digest:
    ``(digest, keep_id, keep_file, keep_row, n)``."""
    state_dir = state_dir or staging_path(spark, "dedup-state")
    before = {k: spark.conf.get(k, None) for k in STATE_SETTINGS}
    for k, v in STATE_SETTINGS.items():
        spark.conf.set(k, v)
    try:
        files = (
            spark.readStream.schema(spark.read.parquet(path).schema)
            .option("maxBytesPerTrigger", str(bytes_per_batch))
            .parquet(_as_glob(path))
        )
        grouped = _located(files, digest).groupBy("digest").agg(
            F.max(F.struct("doc_id", "file", "row")).alias("keeper"),
            F.count(F.lit(1)).alias("n"),
        )
        query = (
            grouped.writeStream.format("noop").outputMode("update")
            .option("checkpointLocation", state_dir)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        batches = query.lastProgress is not None and query.lastProgress["stateOperators"]
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    if not batches:
        return spark.createDataFrame([], _STATE)
    stored = spark.read.format("statestore").load(state_dir)
    keeper, n = (F.col("value").getField(name) for name in stored.schema["value"].dataType.names)
    return stored.select(
        F.col("key.digest").alias("digest"),
        keeper["doc_id"].alias("keep_id"),
        keeper["file"].alias("keep_file"),
        keeper["row"].alias("keep_row"),
        n.alias("n"),
    )


def _slot(digest: Column) -> Column:
    return F.pmod(F.xxhash64(digest), F.lit(HIT_SLOTS)).cast("int")


def _collisions(docs: DataFrame, state: DataFrame, rows_per_salt: int) -> DataFrame:
    """``(file, row, doc_id, digest, text)`` of hits whose bytes differ from the keeper's."""
    hits = state.where(F.col("n") > 1)
    # At most HIT_SLOTS rows, so the broadcast is bounded; it only spares
    # rows of unrepeated texts the shuffle, the join below decides.
    slots = F.broadcast(hits.select(_slot(F.col("digest")).alias("slot")).distinct())
    suspects = docs.withColumn("slot", _slot(F.col("digest"))).join(slots, "slot", "left_semi")
    met = suspects.drop("slot").join(
        hits.select("digest", "keep_file", "keep_row", F.ceil(F.col("n") / rows_per_salt).cast("int").alias("salts")),
        "digest",
    )
    is_keeper = (F.col("file") == F.col("keep_file")) & (F.col("row") == F.col("keep_row"))
    # A hit meets the keeper's bytes under one of ``salts`` sub-keys, so a
    # large group of copies is compared in many tasks.
    salted = met.where(~is_keeper).select(
        "file", "row", "doc_id", "digest", "text",
        F.pmod(F.xxhash64("file", "row"), F.col("salts")).cast("int").alias("salt"),
    )
    stored = met.where(is_keeper).select(
        "digest", F.col("text").alias("stored"),
        F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"),
    )
    return salted.join(stored, ["digest", "salt"]).where(F.col("text") != F.col("stored")).drop("salt", "stored")


def stream_dedup(
    spark: SparkSession,
    path: str,
    digest: Callable[[Column], Column] = sha256,
    state_dir: str | None = None,
    bytes_per_batch: int = 64 << 30,
    rows_per_salt: int = 512,
) -> DataFrame:
    """One row per document of the Parquet table at ``path``:
    ``(doc_id, keep_id, group_size, kept, digest, file, row)``; of equal texts
    the row with the largest ``doc_id`` is kept. See the module docstring."""
    state = staged(digest_state(spark, path, digest, state_dir, bytes_per_batch), "dedup-groups")
    docs = _located(spark.read.parquet(path), digest)
    wrong = staged(_collisions(docs, state, rows_per_salt), "dedup-collisions")
    rows = docs.select("doc_id", "file", "row", "digest")
    # Both sides are plain shuffles, so AQE splits a digest with many rows.
    if wrong.isEmpty():
        found = rows.join(state, "digest", "left")
    else:
        fewer = wrong.groupBy("digest").agg(F.count(F.lit(1)).alias("less"))
        exact = wrong.groupBy("digest", "text").agg(
            F.max(F.struct("doc_id", "file", "row")).alias("k"), F.count(F.lit(1)).alias("size")
        )
        apart = wrong.join(exact, ["digest", "text"]).select(
            "file", "row", "k", F.col("size").alias("size")
        )
        met = rows.join(state, "digest", "left").join(fewer, "digest", "left").join(apart, ["file", "row"], "left")
        apart_here = F.col("size").isNotNull()
        found = met.select(
            "doc_id", "file", "row", "digest",
            F.when(apart_here, F.col("k.doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
            F.when(apart_here, F.col("k.file")).otherwise(F.col("keep_file")).alias("keep_file"),
            F.when(apart_here, F.col("k.row")).otherwise(F.col("keep_row")).alias("keep_row"),
            F.coalesce(F.col("size"), F.col("n") - F.coalesce(F.col("less"), F.lit(0))).alias("n"),
        )
    return found.select(
        "doc_id", "keep_id", F.col("n").alias("group_size"),
        ((F.col("file") == F.col("keep_file")) & (F.col("row") == F.col("keep_row"))).alias("kept"),
        "digest", "file", "row",
    )
