"""MinHash near-duplicates with sequential Bayesian verification.

1. *Signatures.* Each document becomes its set of ``width``-word shingles
   (64-bit hashes), a 128-bit key of that set, ``BANDS x ROWS`` minhashes and
   one key per band. Documents of equal sets form one class; only a class's
   first row goes on, so copies never meet each other.
2. *Candidates.* Classes that share a band key share a bucket. First, every
   member is paired with the bucket's smallest member only. Verified pairs
   give components; a bucket whose members all fell into one component is
   done. In what is left, the members outside the bucket's largest component
   are compared with all others, in blocks of about ``BLOCK`` rows and
   ``BLOCK_SHINGLES`` shingles that are dealt to tasks and hold the rows'
   texts; survivors are confirmed there and only links leave a block. So a
   large group of near copies costs a star per band, not all of its pairs, and
   no bucket is capped.
3. *Verification.* A pair's minhashes are compared ``BATCH`` at a time; with a
   uniform prior, it is pruned as soon as the posterior probability of a
   similarity of ``threshold`` or more falls below ``miss``. Survivors are
   confirmed on the full shingle sets of both texts, which are read only now.
4. *Groups* are the connected components of the confirmed links.

Signatures are written once and read where they are needed; grouping moves
ids alone. Written tables are deleted after their last use.

A similar pair is missed by all bands with probability (1 - t^ROWS)^BANDS:
5e-6 at t = 0.8, 1e-8 at 0.85. Set equality and shingle equality are by 128
and 64-bit hashes.

Defined cases: a text of fewer than ``width`` words is one shingle (its whole
sequence); a null or empty text has no shingle and is linked with nothing;
rows are told apart by themselves, not by ``doc_id``: rows that share an id, or
have none, are grouped by their texts; a group is named by its smallest id
(null if it has none), and exactly one of its rows is kept, one with that id;
an empty table gives no rows; other columns are neither read nor returned.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quiver.llm.common import (
    bit_filter, drop_rows_with, released, slices, staged, text_key, unstaged, with_hit, words_of,
)
from quiver.llm.components import components

BANDS, ROWS = 40, 6
HASHES = BANDS * ROWS
BATCH = 40
BLOCK, BLOCK_SHINGLES = 256, 1 << 19

_ODD = np.uint64(0x9E3779B97F4A7C15)
_SIGNATURES = "doc_id bigint, ka bigint, kb bigint, n int, set_key binary, bands array<bigint>, minhashes binary"
_PAIRS = "a bigint, b bigint"


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: spreads every input bit over the word."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)


def _constants() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20)
    a = rng.integers(0, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return a, rng.integers(0, 1 << 63, HASHES, dtype=np.uint64)


def shingle_sets(texts: pa.Array, width: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    vocabulary, codes, starts = words_of(texts)
    hashed = np.fromiter(
        (xxhash.xxh3_64_intdigest(w) for w in vocabulary.to_pylist()), dtype=np.uint64, count=len(vocabulary)
    )
    words = hashed[codes]
    if len(words) == 0:
        return [words] * (len(starts) - 1)
    shingles = words
    with np.errstate(over="ignore"):
        for k in range(1, width):
            following = np.zeros_like(words)
            following[:len(words) - k] = words[k:]
            shingles = _mix(shingles * _ODD + following + np.uint64(k))
    out = []
    for s, e in zip(starts[:-1], starts[1:]):
        if e - s >= width:
            out.append(np.unique(shingles[s:e - width + 1]))
        elif e > s:
            out.append(np.array([xxhash.xxh3_64_intdigest(words[s:e].tobytes())], dtype=np.uint64))
        else:
            out.append(words[:0])
    return out


def _minhashes(sets: list[np.ndarray]) -> np.ndarray:
    """One row of ``HASHES`` minhashes per non-empty set."""
    a, b = _constants()
    out = np.empty((len(sets), HASHES), dtype=np.uint64)
    at = 0
    while at < len(sets):
        # Sets are stacked up to a size that stays in the processor's cache.
        end, size = at, 0
        while end < len(sets) and (end == at or size + len(sets[end]) <= 1 << 15):
            size += len(sets[end])
            end += 1
        stacked = np.concatenate(sets[at:end])
        begins = np.concatenate([[0], np.cumsum([len(s) for s in sets[at:end]])[:-1]])
        with np.errstate(over="ignore"):
            for k in range(HASHES):
                out[at:end, k] = np.minimum.reduceat(stacked * a[k] + b[k], begins)
        at = end
    return out


def _combine(parts: np.ndarray, tag: np.ndarray) -> np.ndarray:
    """One 64-bit key from the last axis of ``parts``."""
    with np.errstate(over="ignore"):
        key = np.broadcast_to(tag, parts.shape[:-1]).astype(np.uint64)
        for k in range(parts.shape[-1]):
            key = _mix(key * _ODD + parts[..., k])
    return key


def _signer(width: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = (whole.slice(*part) for whole in batches for part in slices(whole.column("text")))
        for batch in parts:
            sets = shingle_sets(batch.column("text"), width)
            full = [i for i, s in enumerate(sets) if len(s)]
            minhashes = _minhashes([sets[i] for i in full])
            bands = _combine(
                minhashes.reshape(len(full), BANDS, ROWS), np.arange(BANDS, dtype=np.uint64)
            ).view(np.int64)
            # 8 bits of each minhash are kept for the comparison of pairs: of
            # the unequal ones 1 in 256 looks equal, so fewer pairs are pruned.
            short = (_mix(minhashes) >> np.uint64(56)).astype(np.uint8)
            row = {i: k for k, i in enumerate(full)}
            yield pa.RecordBatch.from_arrays([
                *(batch.column(c) for c in ("doc_id", "ka", "kb")),
                pa.array([len(s) for s in sets], pa.int32()),
                pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                pa.array([bands[row[i]] if i in row else None for i in range(len(sets))], pa.list_(pa.int64())),
                pa.array([short[row[i]].tobytes() if i in row else None for i in range(len(sets))], pa.binary()),
            ], names=["doc_id", "ka", "kb", "n", "set_key", "bands", "minhashes"])
            released()
    return sign


def fewest_matches(threshold: float, miss: float) -> list[tuple[int, int]]:
    """``(n, m)`` per batch: after ``n`` compared minhashes, a pair with fewer
    than ``m`` equal ones is similar with probability below ``miss``.

    With a uniform prior the posterior is Beta(m + 1, n - m + 1), and
    P(similarity >= t) = P(Binomial(n + 1, t) <= m).
    """
    out = []
    for n in range(BATCH, HASHES + 1, BATCH):
        total = 0.0
        for m in range(n + 1):
            total += comb(n + 1, m) * threshold ** m * (1 - threshold) ** (n + 1 - m)
            if total >= miss:
                out.append((n, m))
                break
    return out


def _matrix(column) -> np.ndarray:
    values = column.to_pylist()
    return np.frombuffer(b"".join(values), np.uint8).reshape(len(values), HASHES)


def _survivors(left: np.ndarray, right: np.ndarray, i: np.ndarray, j: np.ndarray, limits) -> np.ndarray:
    """Which of the pairs ``(left[i], right[j])`` pass every batch."""
    alive = np.arange(len(i))
    matches = np.zeros(len(i), np.int64)
    done = 0
    for n, least in limits:
        matches[alive] += (left[i[alive], done:n] == right[j[alive], done:n]).sum(axis=1)
        alive = alive[matches[alive] >= least]
        done = n
    return alive


def _bayes(limits: list[tuple[int, int]]):
    def prune(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                at = np.arange(batch.num_rows)
                alive = _survivors(_matrix(batch.column("ma")), _matrix(batch.column("mb")), at, at, limits)
                yield batch.select(["a", "b"]).take(pa.array(alive))
    return prune


def _similar(left: list[np.ndarray], right: list[np.ndarray], i: np.ndarray, j: np.ndarray, percent: int) -> np.ndarray:
    """Which of the pairs ``(left[i], right[j])`` have 100 * intersection >=
    percent * union; ``i`` ascending."""
    keep = np.zeros(len(i), bool)
    for x in np.unique(i):
        at = np.flatnonzero(i == x)
        for k in at:
            own, other = left[x], right[j[k]]
            place = np.minimum(np.searchsorted(own, other), len(own) - 1)
            both = int((own[place] == other).sum())
            keep[k] = 100 * both >= percent * (len(own) + len(other) - both)
    return keep


def _sets_of(texts: pa.ChunkedArray, at: np.ndarray, width: int) -> dict[int, np.ndarray]:
    """Shingle sets of the rows ``at``, a slice of their texts at a time."""
    chosen = texts.combine_chunks().take(pa.array(at))
    sets: list[np.ndarray] = []
    for part in slices(chosen):
        sets += shingle_sets(chosen.slice(*part), width)
    return dict(zip(at.tolist(), sets))


def _block(limits: list[tuple[int, int]], width: int, percent: int):
    """Links between a block of a bucket's outsiders and a block of its members."""
    def compare(rows: pa.Table) -> pa.Table:
        key = np.int64(rows.column("key")[0].as_py())
        outside, inside = (rows.filter(rows.column(c)) for c in ("outside", "inside"))
        a, b = (np.asarray(t.column("id")) for t in (outside, inside))
        ca, cb = (np.asarray(t.column("component")) for t in (outside, inside))
        na, nb = (np.asarray(t.column("n"), dtype=np.int64) for t in (outside, inside))
        apart = ca[:, None] != cb[None, :]
        sized = 100 * np.minimum(na[:, None], nb[None, :]) >= percent * np.maximum(na[:, None], nb[None, :])
        i, j = np.nonzero(apart & sized)
        if len(i):
            # A pair that shares several bands is compared under the first of them.
            bands = [np.asarray(t.column("bands").combine_chunks().flatten()).reshape(-1, BANDS) for t in (outside, inside)]
            first = (bands[0][i] == bands[1][j]).argmax(axis=1)
            mine = bands[0][i, first] == key
            i, j = i[mine], j[mine]
        if len(i):
            alive = _survivors(_matrix(outside.column("minhashes")), _matrix(inside.column("minhashes")), i, j, limits)
            i, j = i[alive], j[alive]
        if len(i):
            left, right = (_sets_of(t.column("text"), np.unique(at), width) for t, at in ((outside, i), (inside, j)))
            keep = _similar(left, right, i, j, percent)
            i, j = i[keep], j[keep]
        x, y = a[i], b[j]
        return pa.table({"a": np.minimum(x, y), "b": np.maximum(x, y)})
    return compare


def _exact(width: int, percent: int):
    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = (whole.slice(*part) for whole in batches for part in slices(whole.column("ta"), whole.column("tb")))
        for batch in parts:
            left = shingle_sets(batch.column("ta"), width)
            right = shingle_sets(batch.column("tb"), width)
            keep = []
            for i, (x, y) in enumerate(zip(left, right)):
                both = len(np.intersect1d(x, y, assume_unique=True))
                if both and 100 * both >= percent * (len(x) + len(y) - both):
                    keep.append(i)
            yield batch.select(["a", "b"]).take(pa.array(keep, pa.int64()))
            released()
    return confirm


def _of(ids: DataFrame, rows: DataFrame, column: str) -> DataFrame:
    """The ``rows`` whose ``column`` may be among ``ids``: a broadcast filter
    of bounded size keeps most others out of the shuffle of the join that
    follows."""
    bits = bit_filter(ids, F.xxhash64(ids.columns[0]))
    return with_hit(rows, F.xxhash64(column), bits).where("_hit").drop("_hit")


def _likely(pairs: DataFrame, signed: DataFrame, limits) -> DataFrame:
    """``pairs (a, b)`` that the sequential comparison does not prune."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("id"))
    sides = _of(wanted, signed.select("id", "minhashes"), "id")
    met = pairs.join(sides.toDF("a", "ma"), "a").join(sides.toDF("b", "mb"), "b")
    return met.select("a", "b", "ma", "mb").mapInArrow(_bayes(limits), _PAIRS)


def _texts_of(ids: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """``(id, text)`` of the classes ``ids``."""
    keys = staged(ids.distinct().join(classes.select("id", "ka", "kb"), "id"), "near-text-keys")
    # Copies of a text are one row before they are joined.
    texts = _of(keys.select("ka"), docs.select("ka", "kb", "text"), "ka").groupBy("ka", "kb").agg(F.first("text").alias("text"))
    return keys.join(texts, ["ka", "kb"]).select("id", "text")


def _confirmed(likely: DataFrame, classes: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """``likely`` pairs whose full shingle sets are similar."""
    likely = staged(likely, "near-likely")
    texts = _texts_of(likely.select(F.explode(F.array("a", "b")).alias("id")), classes, docs)
    met = likely.join(texts.toDF("a", "ta"), "a").join(texts.toDF("b", "tb"), "b")
    links = staged(met.select("a", "b", "ta", "tb").mapInArrow(_exact(width, percent), _PAIRS), "near-links")
    unstaged(likely)
    return links


def _across(
    members: DataFrame, signed: DataFrame, classes: DataFrame, docs: DataFrame, limits, width: int, percent: int
) -> DataFrame:
    """Links between different components of a bucket; ``members``:
    ``(key, id, n, component)``.

    Outsiders (all but the bucket's largest component) meet all members,
    block by block; a row is in a cell once, whether it is there as an
    outsider, as a member or as both.
    """
    per = members.groupBy("key", "component").agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("shingles"))

    def blocks(rows, shingles):
        return F.ceil(F.greatest(rows / BLOCK, shingles / BLOCK_SHINGLES)).cast("int")

    found = per.groupBy("key").agg(
        F.sum("k").alias("size"), F.sum("shingles").alias("shingles"), F.count(F.lit(1)).alias("parts"),
        F.max(F.struct("k", "component", "shingles")).alias("most"),
    ).where("parts > 1")
    open_ = staged(found.select(
        "key", F.col("most.component").alias("main"), blocks(F.col("size"), F.col("shingles")).alias("m_blocks"),
        blocks(F.col("size") - F.col("most.k"), F.col("shingles") - F.col("most.shingles")).alias("o_blocks"),
    ), "near-open")
    rows = staged(_of(open_.select("key"), members, "key").join(open_, "key"), "near-open-rows")
    own_m = F.pmod(F.xxhash64("id"), F.col("m_blocks")).cast("int")
    own_o = F.when(F.col("component") != F.col("main"), F.pmod(F.xxhash64("id"), F.col("o_blocks")).cast("int"))
    as_member = F.transform(F.sequence(F.lit(0), F.col("o_blocks") - 1), lambda o: F.struct(o.alias("ob"), F.col("mb").alias("mb")))
    as_outsider = F.when(F.col("ob").isNotNull(), F.transform(
        F.sequence(F.lit(0), F.col("m_blocks") - 1), lambda m: F.struct(F.col("ob").alias("ob"), m.alias("mb"))
    )).otherwise(F.array().cast("array<struct<ob:int,mb:int>>"))
    details = _of(rows.select("id"), signed.select("id", "bands", "minhashes"), "id").join(
        _texts_of(rows.select("id"), classes, docs), "id"
    )
    dealt = rows.join(details, "id").withColumn("mb", own_m).withColumn("ob", own_o).select(
        "key", "id", "n", "component", "bands", "minhashes", "text", F.col("mb").alias("own_m"), F.col("ob").alias("own_o"),
        F.explode(F.array_union(as_member, as_outsider)).alias("cell"),
    ).select(
        "key", "cell.*", "id", "n", "component", (F.col("cell.mb") == F.col("own_m")).alias("inside"),
        F.coalesce(F.col("cell.ob") == F.col("own_o"), F.lit(False)).alias("outside"), "bands", "minhashes", "text",
    )
    links = dealt.groupBy("key", "ob", "mb").applyInArrow(_block(limits, width, percent), _PAIRS)
    links = staged(links.distinct(), "near-across")
    unstaged(open_, rows)
    return links


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, miss: float = 1e-6, keyed: bool = False) -> DataFrame:
    """One row per document: ``(doc_id, n_shingles, component_id, kept)``.

    Links join documents whose sets have 100 * intersection >= percent *
    union; ``component_id`` is the smallest ``doc_id`` of the group.
    ``keyed`` adds ``text_key`` (see :func:`quiver.llm.common.text_key`), which
    tells rows apart whose ids are equal or null.
    """
    docs = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), text_key()["a"].alias("ka"), text_key()["b"].alias("kb"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    signed = docs.select("doc_id", "ka", "kb", "text").mapInArrow(_signer(width), _SIGNATURES)
    signed = staged(signed.withColumn("id", F.monotonically_increasing_id()), "near-signed")
    # A class of equal sets is named by its first row: smallest doc_id, null last.
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "id", "ka", "kb", "n"))
    classes = staged(
        signed.where("n > 0").groupBy("set_key").agg(first.alias("c"), F.count(F.lit(1)).alias("rows"))
        .select("set_key", "c.doc_id", "c.id", "c.ka", "c.kb", "c.n", "rows"), "near-classes"
    )
    more = classes.where("rows > 1").select("set_key", F.col("id").alias("first"))
    others = signed.where("n > 0").select("set_key", "id").join(more, "set_key").where("id <> first")
    one = drop_rows_with(
        signed.where("n > 0").select("id", "n", "bands", "minhashes"),
        others.select(F.struct(F.xxhash64("id").alias("a"), F.col("id").alias("b")).alias("_other")),
        F.struct(F.xxhash64("id").alias("a"), F.col("id").alias("b")),
    )
    banded = one.select(F.explode("bands").alias("key"), "id", "n")
    buckets = staged(
        banded.groupBy("key").agg(
            F.min("id").alias("first"), F.max("id").alias("last"), F.count(F.lit(1)).alias("size")
        ).where("size > 1"), "near-buckets",
    )
    twos = buckets.where("size = 2").select(F.col("first").alias("a"), F.col("last").alias("b"))
    more = buckets.where("size > 2")
    crowded = staged(_of(more.select("key"), banded, "key").join(more.select("key", "first"), "key"), "near-crowded")
    stars = crowded.where("id <> first").select(F.col("first").alias("a"), F.col("id").alias("b"))
    limits = fewest_matches(percent / 100, miss)
    pairs = staged(twos.unionByName(stars).distinct(), "near-pairs")
    links = _confirmed(_likely(pairs, signed, limits), classes, docs, width, percent)
    grouped = components(links)
    unstaged(buckets, pairs, links)

    labelled = staged(crowded.join(grouped.select(F.col("node").alias("id"), "component"), "id", "left").select(
        "key", "id", "n", F.coalesce("component", "id").alias("component")
    ), "near-labelled")
    unstaged(crowded)
    rest = _across(labelled, signed, classes, docs, limits, width, percent)
    names = grouped.select("node", "component")
    joined = staged(
        rest.join(names.toDF("a", "ca"), "a", "left").join(names.toDF("b", "cb"), "b", "left")
        .select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")), "near-rest-links",
    )
    merged = components(joined)
    unstaged(labelled, rest, joined)

    # Each class with its component, then the component's first row.
    named = classes.join(grouped.toDF("id", "c1"), "id", "left").withColumn("c1", F.coalesce("c1", "id"))
    named = named.join(merged.toDF("c1", "c2"), "c1", "left").withColumn("component", F.coalesce("c2", "c1"))
    named = staged(named.select("set_key", "component", "doc_id", "id"), "near-named")
    tops = named.groupBy("component").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "id")).alias("top")
    ).select("component", F.col("top.doc_id").alias("component_id"), F.col("top.id").alias("top"))
    verdicts = named.select("set_key", "component").join(tops, "component").drop("component")
    rows = staged(signed.select("doc_id", "ka", "kb", "n", "set_key", "id"), "near-rows")
    unstaged(signed)
    full = rows.where("n > 0").join(verdicts, "set_key").withColumn("kept", F.col("id") == F.col("top"))
    empty = rows.where("n = 0").withColumn("component_id", F.col("doc_id")).withColumn("kept", F.lit(True))
    columns = [
        "doc_id", F.col("n").cast("bigint").alias("n_shingles"), "component_id", "kept",
        *([F.struct(F.col("ka").alias("a"), F.col("kb").alias("b")).alias("text_key")] if keyed else []),
    ]
    return full.select(*columns).unionByName(empty.select(*columns))
