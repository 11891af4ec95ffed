"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quiver.session import staging_path

# Fixed value: a word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back: the
    lineage ends there, and a lost executor costs no recomputation."""
    path = staging_path(df.sparkSession, label)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.staged_at = path
    return out


def unstaged(*frames: DataFrame) -> None:
    """Delete tables of :func:`staged` that nothing reads any more."""
    for df in frames:
        context = df.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(df.staged_at)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def text_key() -> Column:
    """128 bits that stand for a row's text (null counts as empty): rows of
    equal texts share it, so a verdict on a text reaches them all."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return F.struct(F.xxhash64(text).alias("a"), F.xxhash64(F.lit(1), text).alias("b"))


# Words of 64 bits in the filter of bit_filter: a bound on what is broadcast.
FILTER_WORDS = 1 << 20


def _slot(hashed: Column) -> Column:
    return F.pmod(hashed, F.lit(64 * FILTER_WORDS))


def bit_filter(keys: DataFrame, hashed: Column) -> DataFrame:
    """A bit for the slot of each key's 64-bit hash, as at most
    ``FILTER_WORDS`` rows ``(_word, _bits)`` whatever the number of keys."""
    slots = keys.select(_slot(hashed).alias("s"))
    return slots.groupBy(F.expr("s div 64").alias("_word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(s % 64 AS int))")).alias("_bits")
    )


def with_hit(df: DataFrame, hashed: Column, bits: DataFrame) -> DataFrame:
    """``df`` with ``_hit``: may the row's key be among the keys of ``bits``?
    Never false for a key that is."""
    slotted = df.withColumn("_slot", _slot(hashed)).withColumn("_word", F.expr("_slot div 64"))
    met = slotted.join(F.broadcast(bits), "_word", "left")
    hit = F.expr("coalesce(shiftright(_bits, cast(_slot % 64 AS int)) & 1L, 0L) = 1L")
    return met.withColumn("_hit", hit).drop("_slot", "_word", "_bits")


def drop_rows_with(df: DataFrame, keys: DataFrame, key: Column) -> DataFrame:
    """``df`` without the rows whose ``key`` (a struct with a hash ``a``) is
    among ``keys`` (one struct column), whatever the number of keys.

    A broadcast bit filter of bounded size lets most other rows pass without
    a shuffle; only the rest meets the keys themselves in an anti join.
    """
    name = keys.columns[0]
    keys = staged(keys.distinct(), "drop-keys")
    bits = bit_filter(keys, F.col(name)["a"])
    marked = with_hit(df.withColumn(name, key), F.col(name)["a"], bits)
    clear = marked.where("NOT _hit")
    doubtful = marked.where("_hit").join(keys, name, "left_anti")
    return clear.select(*df.columns).unionByName(doubtful.select(*df.columns))


def slices(*columns: pa.Array, limit: int = 4 << 20) -> Iterator[tuple[int, int]]:
    """``(begin, rows)`` of consecutive slices of about ``limit`` bytes of
    the text columns (a longer row is a slice of its own), so that what is
    derived from a batch stays small however many texts it holds."""
    ends = np.cumsum(sum(np.asarray(pc.fill_null(pc.binary_length(texts), 0), dtype=np.int64) for texts in columns))
    begin = 0
    while begin < len(ends):
        base = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield begin, end - begin
        begin = end


def words_of(texts: pa.Array, lower: bool = True) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Tokenise a batch: ``(vocabulary, codes, starts)``.

    ``vocabulary`` holds the distinct words of the batch, ``codes`` one index
    into it per word in text order, and ``codes[starts[i]:starts[i + 1]]``
    are the words of row ``i`` (none for a null text). Per-word work is then
    done once per distinct word instead of once per occurrence.
    """
    if texts.offset:
        # ascii_lower misreads the offsets of a sliced array: copy the slice.
        texts = texts.take(pa.array(np.arange(len(texts))))
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts) if lower else texts)
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    flat = lists.flatten()
    starts = np.asarray(lists.offsets, dtype=np.int64)
    starts = starts - starts[0]
    encoded = flat.dictionary_encode()
    codes = np.asarray(encoded.indices, dtype=np.int32)
    # Leading or trailing white space yields empty pieces; they are no words.
    empty = pc.index(encoded.dictionary, pa.scalar("", encoded.dictionary.type)).as_py()
    if empty >= 0:
        real = codes != empty
        counted = np.concatenate([[0], np.cumsum(real)])
        starts = counted[starts]
        codes = codes[real]
    return encoded.dictionary, codes, starts


def segment_ids(starts: np.ndarray) -> np.ndarray:
    """Row number of each word, from the ``starts`` of :func:`words_of`."""
    return np.repeat(np.arange(len(starts) - 1), np.diff(starts))


def share_mark(rows: int, wanted: int) -> int:
    """The 63-bit hash below which about ``wanted`` of ``rows`` rows lie. It
    is above 0 for any number of rows that a table can have."""
    return (1 << 63) - 1 if rows <= wanted else max(1, (wanted << 63) // rows)


def drawn(rows: DataFrame, by: str, sizes: dict, wanted: int, seed: int) -> DataFrame:
    """About ``wanted`` rows of each of the classes ``sizes`` (class ->
    number of rows; few, the caller bounds them), chosen by a hash of
    ``doc_id`` (kept as ``_mark``), whatever the size of the input."""
    mark = F.shiftrightunsigned(F.xxhash64(F.col("doc_id"), F.lit(seed)), 1)
    keep = F.lit(False)
    for value, n in sorted(sizes.items()):
        keep = keep | ((F.col(by) == F.lit(value)) & (mark <= F.lit(share_mark(n, wanted))))
    return rows.withColumn("_mark", mark).where(keep)


def within_bytes(batches: Iterator[pa.RecordBatch], by: str, limit: int) -> pa.Table:
    """The rows of ``batches`` whose class (column ``by``) has had fewer than
    ``limit`` bytes of text before them: whole texts only, at least one of
    each class."""
    seen: dict = {}
    parts, schema = [], None
    for batch in batches:
        schema = batch.schema
        keep = []
        for value, size in zip(batch.column(by).to_pylist(), pc.binary_length(batch.column("text")).to_pylist()):
            keep.append(seen.get(value, 0) < limit)
            if keep[-1]:
                seen[value] = seen.get(value, 0) + (size or 0)
        # A copy, so that the batch itself can go.
        parts.append(batch.take(pa.array(np.flatnonzero(keep), pa.int64())))
    return pa.Table.from_batches(parts, schema=schema).combine_chunks() if parts else pa.table({by: [], "text": []})


@lru_cache(maxsize=1)
def _trim():
    try:
        return ctypes.CDLL("libc.so.6").malloc_trim
    except (OSError, AttributeError):
        return lambda _: 0


def released() -> None:
    """Give memory that a worker no longer uses back to the system: workers
    are reused, and what one stage has left would add to the next one's."""
    pa.default_memory_pool().release_unused()
    _trim()(0)
