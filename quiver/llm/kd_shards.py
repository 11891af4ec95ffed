"""Shards of near-equal bytes from a k-d tree over document metadata.

Every distinct text is one weighted point; its coordinates are metadata of
the text (bytes, code points, lines, mean line length), so equal texts fall
into one leaf. The tree starts with all points and splits each node at the weighted
median of its widest dimension (extent relative to the root's), until a leaf
holds one shard's bytes. A node that still stands for an odd number of
shards is split at that share instead of the half.

Medians are found on Spark: a histogram per node (``BINS`` bins between the
node's bounds), then again inside the bin that holds the median, until that
bin is lighter than ``TOLERANCE`` of a shard; points with the same coordinate
are told apart by their text hash. Per pass the driver receives one row per
node; the tree itself has one split per shard, and documents find their leaf
by broadcast joins with that bounded table, without a shuffle.

A group of equal texts heavier than ``HEAVY`` of a shard (at most
``shards / HEAVY`` of them) would make medians coarse: such groups are put
first, each on the then lightest shard, and the tree splits all other points
so that the totals come out equal. Only a group larger than a whole shard is
itself divided, by a hash of ``doc_id``.

Slots are gapless per shard: rows are hashed to buckets, buckets counted,
and a row's slot is its bucket's offset plus its place in the bucket, so no
task holds a whole shard.

Defined cases: a null text has size 1 (as an empty one) and forms a group of
its own; repeated rows are separate rows with separate slots; an empty table
gives no rows; input columns named like an output column are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quiver.llm.common import staged

OUTPUT = ("size", "text_crc32", "shard", "slot")
COORDS = ("_kd_bytes", "_kd_chars", "_kd_lines", "_kd_line_chars")
BINS = 1 << 14
TOLERANCE = 0.001
HEAVY = 0.01
TIE_MAX = (1 << 62) - 1
MAX_SHARDS = 65536
MAX_BUCKETS = 65536
ROWS_PER_BUCKET = 500


def _measured(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = (F.length(text) - F.length(F.translate(text, "\n", ""))).cast("bigint")
    docs = docs.drop(*OUTPUT)
    return docs.withColumns({
        "size": F.octet_length(text).cast("bigint") + 1,
        "text_crc32": F.crc32(text.cast("binary")),
        "_kd_bytes": F.octet_length(text).cast("bigint"),
        "_kd_chars": F.length(text).cast("bigint"),
        "_kd_lines": lines,
        "_kd_line_chars": F.floor(F.length(text) / (lines + 1)),
        # 62 bits, so that interval arithmetic stays within a BIGINT.
        "_kd_tie": F.shiftrightunsigned(F.xxhash64("text"), 2),
    })


def _small(spark, rows: list[tuple], schema: str) -> DataFrame:
    return F.broadcast(spark.createDataFrame(rows, schema).coalesce(1))


def _coordinate(dim: Column) -> Column:
    """The coordinate that a row's ``dim`` names (the last one is the tie)."""
    return F.element_at(F.array(*COORDS, "_kd_tie"), dim + 1)


def _descend(df: DataFrame, levels: list[list[tuple]]) -> DataFrame:
    """Add ``_kd_node``: where each row ends after the splits of ``levels``."""
    df = df.withColumn("_kd_node", F.lit(1).cast("bigint"))
    for splits in levels:
        table = _small(df.sparkSession, splits, "_kd_node bigint, _kd_dim int, _kd_at bigint, _kd_at_tie bigint")
        x = _coordinate(F.col("_kd_dim"))
        right = (x > F.col("_kd_at")) | ((x == F.col("_kd_at")) & (F.col("_kd_tie") > F.col("_kd_at_tie")))
        df = df.join(table, "_kd_node", "left").withColumn(
            "_kd_node",
            F.when(F.col("_kd_dim").isNull(), F.col("_kd_node"))
            .otherwise(F.col("_kd_node") * 2 + right.cast("bigint")),
        ).drop("_kd_dim", "_kd_at", "_kd_at_tie")
    return df


class _Search:
    """Weighted-quantile search of one node: the current interval, and what
    must lie left of the split inside it."""

    def __init__(self, node: int, dim: int, lo: int, hi: int, want: float):
        self.node, self.dim, self.lo, self.hi, self.want = node, dim, lo, hi, want
        self.exact: int | None = None  # the coordinate, once the tie is searched
        self.split: tuple | None = None

    @property
    def step(self) -> int:
        return max(1, -(-(self.hi - self.lo + 1) // BINS))

    def narrow(self, bin_: int, before: float, weight: float, tolerance: float) -> None:
        lo = self.lo + bin_ * self.step
        hi = min(self.hi, lo + self.step - 1)
        self.want -= before
        if self.step == 1 and self.exact is None and weight > tolerance:
            self.exact, self.lo, self.hi = lo, 0, TIE_MAX
        elif weight > tolerance and self.step > 1:
            self.lo, self.hi = lo, hi
        else:
            end = hi if self.want >= weight / 2 else lo - 1
            at = (end, TIE_MAX) if self.exact is None else (self.exact, end)
            self.split = (self.node, self.dim, *at)


def _split_level(points: DataFrame, open_: list[_Search], tolerance: float) -> list[tuple]:
    """Splits of the nodes of one level."""
    spark = points.sparkSession
    here = points.join(_small(spark, [(s.node, s.dim) for s in open_], "_kd_node bigint, _kd_dim int"), "_kd_node")
    here = here.withColumn("_kd_x", _coordinate(F.col("_kd_dim")))
    done: list[_Search] = []
    schema = "_kd_node bigint, lo bigint, hi bigint, step bigint, want double, exact bigint"
    while open_:
        state = _small(spark, [(s.node, s.lo, s.hi, s.step, float(s.want), s.exact) for s in open_], schema)
        met = here.join(state, "_kd_node").where(F.col("exact").isNull() | (F.col("_kd_x") == F.col("exact")))
        y = F.when(F.col("exact").isNull(), F.col("_kd_x")).otherwise(F.col("_kd_tie"))
        binned = met.where((y >= F.col("lo")) & (y <= F.col("hi"))).groupBy(
            "_kd_node", "want", F.floor((y - F.col("lo")) / F.col("step")).cast("int").alias("bin")
        ).agg(F.sum("_kd_weight").alias("w"))
        upto = Window.partitionBy("_kd_node").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
        running = binned.withColumn("cum", F.sum("w").over(upto))
        # The bin that holds the quantile; the last one if rounding leaves none.
        found = running.groupBy("_kd_node").agg(
            F.min(F.when(F.col("cum") >= F.col("want"), F.struct("bin", "cum", "w"))).alias("hit"),
            F.max(F.struct("bin", "cum", "w")).alias("last"),
        ).select("_kd_node", F.coalesce("hit", "last").alias("b")).select("_kd_node", "b.*").collect()
        by_node = {r["_kd_node"]: r for r in found}
        for s in open_:
            r = by_node[s.node]
            s.narrow(r["bin"], float(r["cum"] - r["w"]), float(r["w"]), tolerance)
        done += [s for s in open_ if s.split]
        open_ = [s for s in open_ if not s.split]
    return [s.split for s in done]


def _place_heavy(heavy: list, target: float, shards: int) -> tuple[list[tuple], list[float]]:
    """Heavy groups, largest first, on the then lightest shard. Returns
    ``(tie, piece, pieces, shard)`` rows and the bytes placed per shard."""
    load = [0.0] * shards
    rows = []
    pieces = []
    for tie, weight in heavy:
        n = 1 if weight <= target else int(-(-weight // (target / 8)))
        pieces += [(weight / n, tie, i, n) for i in range(n)]
    for weight, tie, i, n in sorted(pieces, key=lambda p: (-p[0], p[1], p[2])):
        shard = min(range(shards), key=lambda s: (load[s], s))
        load[shard] += weight
        rows.append((tie, i, n, shard))
    return rows, load


def _room(load: list[float], light: float) -> list[float]:
    """Bytes of light points per shard that level the totals."""
    order = sorted(load)
    level = 0.0
    for k in range(1, len(order) + 1):
        level = (light + sum(order[:k])) / k
        if k == len(order) or level <= order[k]:
            break
    return [max(0.0, level - x) for x in load]


def _grow(light: DataFrame, room: list[float], tolerance: float) -> tuple[list[list[tuple]], dict]:
    """The tree over the ``light`` points whose leaves take the bytes of
    ``room``: the splits ``(node, dimension, coordinate, tie)`` of each level,
    and the shards ``(from, to)`` that each last node stands for."""
    ranges = {1: (0, len(room))}  # node -> its shards
    levels: list[list[tuple]] = []
    scale: list[int] = []  # extents of the root
    while any(b - a > 1 for a, b in ranges.values()):
        at = _descend(light, levels)
        found = at.groupBy("_kd_node").agg(
            F.sum("_kd_weight").alias("w"), *[F.struct(F.min(c), F.max(c)).alias(c) for c in COORDS]
        ).collect()
        seen = {r["_kd_node"]: r for r in found}
        searches = []
        below = {}
        for node, (a, b) in ranges.items():
            if b - a == 1:
                below[node] = (a, b)
                continue
            mid = (a + b) // 2
            if node not in seen:  # no light points here: the leaf stays empty
                below[node] = (a, a + 1)
                continue
            r = seen[node]
            bounds = [tuple(r[c]) for c in COORDS]
            scale = scale or [max(1, hi - lo) for lo, hi in bounds]
            widest = max(range(len(COORDS)), key=lambda i: ((bounds[i][1] - bounds[i][0]) / scale[i], -i))
            share = sum(room[a:mid]) / (sum(room[a:b]) or 1.0)
            searches.append(_Search(node, widest, *bounds[widest], share * float(r["w"])))
            below[2 * node], below[2 * node + 1] = (a, mid), (mid, b)
        if searches:
            levels.append(_split_level(at, searches, tolerance))
        ranges = below
    return levels, ranges


def kd_shards(docs: DataFrame, shards: int | None = None, target_bytes: int | None = None) -> DataFrame:
    """``docs`` plus ``size``, ``text_crc32``, ``shard`` and ``slot``.

    Give ``shards`` or ``target_bytes`` (then as many shards as that takes).
    """
    spark = docs.sparkSession
    measured = _measured(docs)
    points = staged(
        measured.groupBy(*COORDS, "_kd_tie").agg(
            F.sum("size").alias("_kd_weight"), F.count(F.lit(1)).alias("_kd_rows")
        ), "kd-points",
    )
    total, n_rows = points.agg(F.sum("_kd_weight"), F.sum("_kd_rows")).first()
    total, n_rows = int(total or 0), int(n_rows or 0)
    if shards is None:
        shards = max(1, -(-total // int(target_bytes)))
    if not 1 <= shards <= MAX_SHARDS:
        raise ValueError(f"between 1 and {MAX_SHARDS} shards are supported, got {shards}")
    target = total / shards
    # Fewer than shards / HEAVY groups can be that heavy.
    by_weight = points.groupBy("_kd_tie").agg(F.sum("_kd_weight").alias("w")).where(F.col("w") > HEAVY * target)
    heavy = [(r["_kd_tie"], float(r["w"])) for r in by_weight.collect()]
    placed, load = _place_heavy(heavy, target, shards)
    light = points
    if heavy:
        light = points.join(_small(spark, [(t,) for t, _ in heavy], "_kd_tie bigint"), "_kd_tie", "left_anti")
    room = _room(load, total - sum(w for _, w in heavy))

    levels, ranges = _grow(light, room, TOLERANCE * target)
    leaf_of = {node: a for node, (a, _) in ranges.items()}

    rows = _descend(measured, levels).join(
        _small(spark, list(leaf_of.items()), "_kd_node bigint, _kd_leaf int"), "_kd_node", "left"
    )
    if placed:
        many = {t: n for t, _, n, _ in placed}
        rows = rows.join(_small(spark, list(many.items()), "_kd_tie bigint, _kd_n int"), "_kd_tie", "left")
        rows = rows.withColumn("_kd_piece", F.pmod(F.xxhash64("doc_id"), F.col("_kd_n")).cast("int"))
        rows = rows.join(
            _small(spark, [(t, i, s) for t, i, _, s in placed], "_kd_tie bigint, _kd_piece int, _kd_heavy int"),
            ["_kd_tie", "_kd_piece"], "left",
        )
    else:
        rows = rows.withColumn("_kd_heavy", F.lit(None).cast("int"))
    rows = rows.withColumn("shard", F.coalesce("_kd_heavy", "_kd_leaf"))
    out = _slotted(rows, max(1, min(MAX_BUCKETS, n_rows // ROWS_PER_BUCKET)))
    return out.select(*[c for c in docs.drop(*OUTPUT).columns], *OUTPUT)


def _slotted(rows: DataFrame, buckets: int) -> DataFrame:
    """Add ``slot``: 0, 1, 2, ... within each shard."""
    rows = rows.withColumn("_kd_bucket", F.pmod(F.xxhash64("doc_id", "_kd_tie"), F.lit(buckets)).cast("int"))
    counts = rows.groupBy("shard", "_kd_bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("_kd_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "shard", "_kd_bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_kd_offset")
    )
    place = Window.partitionBy("shard", "_kd_bucket").orderBy("doc_id", "_kd_tie")
    # At most shards x MAX_BUCKETS narrow rows, joined on the window's own
    # partitioning: no further exchange of the rows.
    return rows.withColumn("_kd_place", F.row_number().over(place)).join(
        offsets, ["shard", "_kd_bucket"]
    ).withColumn("slot", F.col("_kd_offset") + F.col("_kd_place") - 1)
