"""Ranked lexical search, reversed: documents stream through an index of items.

The items (queries) are few next to the documents, so they are indexed instead
of them. An inverted index over the items' terms is broadcast; each document's
term counts run through it once and yield its scores for all items that share
a term with it. Each task keeps a heap of the ``k`` best documents per item;
the tasks' heaps are merged in two rounds.

1. *Counting.* Every whole text is cut into terms; the counts of the terms
   that some item holds are written (a row per document, with its length).
   Document frequencies, ``N`` and ``L`` are sums over that table.
2. *Scoring.* The written counts run through the postings.
3. *Merging.* At most ``k`` rows per item and task, first per item and part,
   then per item.

Items are taken in blocks of at most ``BLOCK_CHARS`` characters (a longer
item is a block of its own), which bounds what is collected and broadcast;
more items mean more blocks, each against all documents.

Scores are whole numbers: a term weighs ``w = floor(1000 ln((2N + 2) / (2 df +
1)))``, and a document with ``tf`` occurrences among ``n`` terms gains ``w *
((10^9 tf) div (1000 tf + 8 m))`` with ``m = 10 + (90 n N) div L``.

Defined cases: null or empty texts have no terms and are not ranked; an item
without terms, or whose terms no document holds, has no rows; equal scores go
by ascending id, null ids last; repeated documents rank one by one, repeated
items are ranked each; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quiver.llm.common import slices, staged, words_of

#: Characters of the items that are indexed at a time.
BLOCK_CHARS = 4 << 20
#: Cells (documents x items) and postings handled at a time.
CELLS = 1 << 21
#: Parts in which the heaps of an item are first merged.
MERGED_IN = 64

# Bytes that separate terms, and the two cases of ASCII letters.
SEPARATORS = bytes([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
_UPPER, _LOWER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"
_BYTES = bytes.maketrans(SEPARATORS + _UPPER, b" " * len(SEPARATORS) + _LOWER)

_COUNTED = "doc_id bigint, n bigint, terms array<int>, counts array<int>"
_HEAP = "slot int, item_id bigint, doc_id bigint, score bigint"


def terms_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """``(vocabulary, codes, starts)`` of the terms of a batch of texts, as
    :func:`quiver.llm.common.words_of` gives them for words."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    texts = texts.take(pa.array(np.arange(len(texts))))
    _, offsets, data = texts.buffers()
    if data is None or not len(texts):
        return words_of(texts, lower=False)
    # Separators and capitals are single bytes: no other character holds them.
    spaced = pa.py_buffer(data.to_pybytes().translate(_BYTES))
    return words_of(pa.LargeStringArray.from_buffers(len(texts), offsets, spaced), lower=False)


def _per_row(codes: np.ndarray, starts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct ``(row, code)`` pairs and how often each occurs; codes below 0 are left out."""
    rows = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    known = codes >= 0
    keys, counts = np.unique(rows[known] * size + codes[known], return_counts=True)
    return keys // size, keys % size, counts


class Index:
    """Inverted index over the terms of a block of items."""

    def __init__(self, texts: list[str | None]):
        vocabulary, codes, starts = terms_of(pa.array(texts, pa.string()))
        self.terms = vocabulary.cast(pa.string())
        items, terms, _ = _per_row(codes, starts, max(1, len(self.terms)))
        order = np.argsort(terms, kind="stable")
        #: The items of term t: ``items[starts[t]:starts[t + 1]]``.
        self.items = items[order]
        self.starts = np.concatenate([[0], np.cumsum(np.bincount(terms, minlength=len(self.terms)))])


def _counter(shared):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = shared.value
        for whole in batches:
            for begin, size in slices(whole.column("text")):
                batch = whole.slice(begin, size)
                vocabulary, codes, starts = terms_of(batch.column("text"))
                number = pc.fill_null(pc.index_in(vocabulary.cast(pa.string()), value_set=terms), -1)
                rows, found, counts = _per_row(np.asarray(number)[codes], starts, max(1, len(terms)))
                at = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=batch.num_rows))])
                offsets = pa.array(at, pa.int32())
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id"), pa.array(np.diff(starts), pa.int64()),
                    pa.ListArray.from_arrays(offsets, pa.array(found, pa.int32())),
                    pa.ListArray.from_arrays(offsets, pa.array(counts, pa.int32())),
                ], names=["doc_id", "n", "terms", "counts"])
    return count


class Heaps:
    """The ``k`` best documents of each item: by score, then by id, null last."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.least = np.ones(items, np.int64)
        self.item = np.empty(0, np.int64)
        self.score, self.doc = self.item.copy(), self.item.copy()
        self.null = np.empty(0, bool)

    def offer(self, docs: np.ndarray, null: np.ndarray, scores: np.ndarray) -> None:
        """``scores``: a row per document, a column per item."""
        row, item = np.nonzero(scores >= self.least)
        if not len(row):
            return
        item = np.concatenate([self.item, item])
        score = np.concatenate([self.score, scores[row, item[len(self.item):]]])
        doc, null = np.concatenate([self.doc, docs[row]]), np.concatenate([self.null, null[row]])
        order = np.lexsort((doc, null, -score, item))
        item = item[order]
        place = np.arange(len(item)) - np.searchsorted(item, item)
        best = place < self.k
        order = order[best]
        self.item, self.score, self.doc, self.null = item[best], score[order], doc[order], null[order]
        full = place[best] == self.k - 1
        self.least[self.item[full]] = self.score[full]


def _ranker(shared, k: int):
    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, items, starts, weights, n_docs, n_terms = shared.value
        heaps = Heaps(len(names), k)
        for whole in batches:
            rows = max(1, CELLS // max(1, len(names)))
            for begin in range(0, whole.num_rows, rows):
                batch = whole.slice(begin, rows)
                ids = batch.column("doc_id")
                docs, null = np.asarray(pc.fill_null(ids, 0)), np.asarray(pc.is_null(ids))
                m = 10 + 90 * np.asarray(batch.column("n")) * n_docs // max(1, n_terms)
                scores = np.zeros((batch.num_rows, len(names)), np.int64)
                term = np.asarray(batch.column("terms").flatten(), np.int64)
                tf = np.asarray(batch.column("counts").flatten(), np.int64)
                row = np.repeat(np.arange(batch.num_rows), np.asarray(pc.list_value_length(batch.column("terms"))))
                gain = weights[term] * (1_000_000_000 * tf // (1000 * tf + 8 * m[row]))
                held = starts[term + 1] - starts[term]
                done = np.concatenate([[0], np.cumsum(held)])
                at = 0
                while at < len(term):
                    end = max(at + 1, int(np.searchsorted(done, done[at] + CELLS, side="right")) - 1)
                    size = held[at:end]
                    posting = np.arange(done[end] - done[at]) + np.repeat(starts[term[at:end]] - done[at:end] + done[at], size)
                    np.add.at(scores, (np.repeat(row[at:end], size), items[posting]), np.repeat(gain[at:end], size))
                    at = end
                heaps.offer(docs, null, scores)
        yield pa.RecordBatch.from_arrays([
            pa.array(heaps.item, pa.int32()), pa.array([names[i] for i in heaps.item], pa.int64()),
            pa.array(heaps.doc, pa.int64(), mask=heaps.null), pa.array(heaps.score, pa.int64()),
        ], names=["slot", "item_id", "doc_id", "score"])
    return rank


def _blocks(items: DataFrame, limit: int) -> Iterator[list]:
    """The items in blocks of at most ``limit`` characters, each collected."""
    sized = staged(items.withColumn("chars", F.coalesce(F.length("text"), F.lit(0))), "search-items")
    total = sized.agg(F.sum("chars")).first()[0] or 0
    number = max(1, -(-2 * total // limit))
    while True:
        part = F.pmod(F.xxhash64("item_id", "text"), F.lit(number))
        heavy = sized.groupBy(part).agg(F.sum("chars").alias("c"), F.countDistinct("item_id", "text").alias("n"))
        if heavy.where((F.col("c") > limit) & (F.col("n") > 1)).isEmpty():
            break
        number *= 2
    for k in range(number):
        rows = sized.where(part == k).select("item_id", "text").collect()
        if rows:
            yield sorted(rows, key=lambda r: (r["item_id"] is None, r["item_id"] or 0, r["text"] or ""))


def _merged(heaps: DataFrame, k: int) -> DataFrame:
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    part = F.pmod(F.xxhash64("doc_id"), F.lit(MERGED_IN))
    some = heaps.withColumn("rank", F.row_number().over(Window.partitionBy("slot", part).orderBy(*order)))
    some = some.where(F.col("rank") <= k).drop("rank")
    best = some.withColumn("rank", F.row_number().over(Window.partitionBy("slot").orderBy(*order)))
    return best.where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = 10, limit: int = BLOCK_CHARS) -> DataFrame:
    """The ``k`` best ``docs (doc_id, text)`` of each of ``items (item_id,
    text)``: ``(item_id, rank, doc_id, score)``, scores above 0 only."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    items = items.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text"))
    out = spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    found = []
    for rows in _blocks(items, limit):
        index = Index([r["text"] for r in rows])
        terms = spark.sparkContext.broadcast(index.terms)
        counted = staged(docs.mapInArrow(_counter(terms), _COUNTED), "search-counts")
        n_docs, n_terms = counted.where("n > 0").agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        df = np.zeros(len(index.terms), np.int64)
        # At most one row per term of the index.
        for r in counted.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
            df[r["term"]] = r["count"]
        weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(x) + 1))) for x in df], np.int64)
        names = [r["item_id"] for r in rows]
        shared = spark.sparkContext.broadcast((names, index.items, index.starts, weights, n_docs, n_terms))
        heaps = counted.where("size(terms) > 0").mapInArrow(_ranker(shared, k), _HEAP)
        found.append(staged(_merged(heaps, k), "search-found"))
        terms.destroy()
        shared.destroy()
    for block in found:
        out = out.unionByName(block)
    return out
