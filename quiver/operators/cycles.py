"""Cycles on three users, found by intersecting sorted neighbour lists.

Under an order of the users (see :mod:`quiver.operators.triangles`) a cycle
``a -> b -> c -> a`` is found once, at its lowest-ranked user ``a``. The list
of a's higher-ranked out-neighbours goes once to every higher-ranked
in-neighbour ``c`` of ``a``, and is intersected there with the in-neighbours
of ``c``. So a wedge ``c -> a -> b`` is an id in a list, never a row of a
table, and only the cycles that close become rows.

No list is longer than about ``LIST_LENGTH`` ids: a longer one is cut by a hash
of its ids. The lists that meet at a hub ``c`` are spread over sub-keys by a
hash of ``a``; the in-neighbours of ``c`` are copied once per sub-key.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Ids in a list, and ids that are looked up at a time.
LIST_LENGTH, LOOKED_UP = 1024, 1 << 20

_CYCLE = "a bigint, b bigint, c bigint, w_ab bigint, w_bc bigint, w_ca bigint"


def list_parts(degree: Column, length: int = LIST_LENGTH) -> Column:
    """Lists that the neighbours of a user with ``degree`` edges are cut into."""
    return F.greatest(F.lit(1), F.ceil(degree / length)).cast("int")


def neighbour_lists(edges: DataFrame, owner: str, item: str, parts: Column, *kept: str) -> DataFrame:
    """``(owner, part, ids, ws)`` and the columns ``kept``, which follow from
    the owner: sorted neighbours and the weights of their edges. ``ws`` is
    NULL if all weights are 1."""
    listed = edges.groupBy(owner, F.pmod(F.xxhash64(item), parts).cast("int").alias("part"), *kept).agg(
        F.array_sort(F.collect_list(F.struct(F.col(item).cast("bigint").alias("id"), "w"))).alias("list")
    )
    weighted = F.exists("list.w", lambda w: w != 1)
    return listed.select(owner, "part", *kept, F.col("list.id").alias("ids"), F.when(weighted, F.col("list.w")).alias("ws"))


def _flat(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All ids of the lists, their weights, and the row of each."""
    ids, ws = (rows.column(c).combine_chunks() for c in ("ids", "ws"))
    lengths = np.asarray(ids.value_lengths(), dtype=np.int64)
    weights = np.ones(int(lengths.sum()), np.int64)
    weights[np.repeat(~ws.is_null().to_numpy(zero_copy_only=False), lengths)] = np.asarray(ws.flatten())
    return np.asarray(ids.flatten(), dtype=np.int64), weights, np.repeat(np.arange(len(lengths)), lengths)


def _found(lists: pa.Table, of_list: np.ndarray, wedges: pa.Table, of_wedge: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Cycles of the wedges whose ids are in the closing lists of their key."""
    known, known_w, row = _flat(lists)
    if not len(known) or not wedges.num_rows:
        return
    # A number orders by key, then by id.
    every = np.unique(known)
    codes = of_list[row] * len(every) + np.searchsorted(every, known)
    order = np.argsort(codes)
    codes, known_w = codes[order], known_w[order]
    done = np.concatenate([[0], np.cumsum(np.asarray(wedges.column("ids").combine_chunks().value_lengths(), dtype=np.int64))])
    begin = 0
    while begin < wedges.num_rows:
        end = max(begin + 1, int(np.searchsorted(done, done[begin] + LOOKED_UP, side="right")) - 1)
        part = wedges.slice(begin, end - begin).combine_chunks()
        ids, weights, row = _flat(part)
        rank = np.minimum(np.searchsorted(every, ids), len(every) - 1)
        wanted = of_wedge[begin:end][row] * len(every) + rank
        place = np.minimum(np.searchsorted(codes, wanted), len(codes) - 1)
        hit = np.flatnonzero((every[rank] == ids) & (codes[place] == wanted))
        if len(hit):
            own = part.select(["a", "c", "w_ca"]).take(pa.array(row[hit])).combine_chunks()
            columns = {"a": own.column("a"), "b": ids[hit], "c": own.column("c"), "w_ab": weights[hit], "w_bc": known_w[place[hit]],
                       "w_ca": own.column("w_ca")}
            yield from pa.table(columns).to_batches()
        begin = end


def _closed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cycles of rows ordered by key, the closing lists of a key first."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch])
        if held is not None:
            rows = pa.concat_tables([held, rows])
        rows = rows.combine_chunks()
        c, salt = (np.asarray(rows.column(name)) for name in ("c", "salt"))
        key = np.cumsum(np.concatenate([[False], (c[1:] != c[:-1]) | (salt[1:] != salt[:-1])]))
        closing = rows.column("a").is_null().to_numpy()
        lists, wedges = rows.filter(pa.array(closing)), rows.filter(pa.array(~closing))
        yield from _found(lists, key[closing], wedges, key[~closing])
        # The next batch may go on with the last key.
        held = rows.filter(pa.array(closing & (key == key[-1])))


def closed_wedges(wedges: DataFrame, closing: DataFrame) -> DataFrame:
    """``(a, b, c, w_ab, w_bc, w_ca)``, one row per cycle.

    ``wedges (c, salt, a, w_ca, ids, ws)``: an edge ``c -> a`` with a list of
    out-neighbours ``b`` of ``a``. ``closing (c, salt, ids, ws)``: in-neighbours
    ``b`` of ``c``, in any number of lists that share no id.
    """
    none = F.lit(None).cast("bigint")
    columns = [F.col("c").cast("bigint").alias("c"), F.col("salt").cast("int").alias("salt")]
    rows = closing.select(*columns, none.alias("a"), none.alias("w_ca"), "ids", "ws").unionByName(
        wedges.select(*columns, F.col("a").cast("bigint").alias("a"), "w_ca", "ids", "ws")
    )
    # The closing lists have no `a`: NULL comes first.
    placed = rows.repartition("c", "salt").sortWithinPartitions("c", "salt", "a")
    return placed.mapInArrow(_closed, _CYCLE)
