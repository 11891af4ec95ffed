"""Mix sources to target weights with a multivariate-hypergeometric splitting tree.

1. Every document is measured (``size``, in words by default) and hashed to
   one of its source's blocks; block sizes are summed on Spark. The number
   of blocks over all sources is bounded (``MAX_BLOCKS`` plus one a source).
2. Targets: a share of the total size is dealt out by weight; a source is
   capped at ``max_repeats`` times its own size and the excess is dealt anew
   among the others.
3. Draws: a source passes over its blocks in a new permutation each time,
   whole passes first; the last pass ends at the target. The block in which
   it ends is drawn in part: its documents in permuted order while they fit,
   then the one document that comes nearest to the rest.
4. The exact numbers of blocks drawn from each source are dealt to the
   output shards by a binary tree: at each node the left half receives a
   multivariate-hypergeometric sample of the node's blocks (drawn without
   replacement, so the leaves' quotas add up to the sources' exactly), and
   the rest goes right. A shard takes the next quota of blocks of each
   source's permutation, so shards are disjoint.
5. Documents follow their blocks by a broadcast join with the bounded block
   table; ``position`` orders a shard's rows at random (shuffle locally:
   sort within the shard).

The sources are few next to the documents: one row of each is planned on the
driver and broadcast, and more than ``MAX_SOURCES`` of them are an error.

All randomness comes from hashes and one seeded generator: reruns agree.

Defined cases: a null or empty text has size 0 and is drawn like any other
document of its block; a null source is a source of its own, ordered last; a
source without words gets target 0; repeated rows are separate documents of
the same block; an empty table gives no rows; input columns named like an
output column are replaced.
"""

from __future__ import annotations

import random
from collections import Counter
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quiver.llm.common import WORD, staged

MAX_BLOCKS = 32768
MAX_SOURCES = 100_000
# Documents per block at least, so that the block drawn in part can end near
# its target.
MIN_BLOCK_ROWS = 64
OUTPUT = ("size", "source_size", "target", "draws", "draw", "shard", "position")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def fill_targets(sizes: list[int], weights: list[float], share: float, max_repeats: float) -> list[float]:
    """Water-filling: ``share`` of the total by weight, no source above
    ``max_repeats`` times its size, the excess dealt anew until none is above."""
    targets = [0.0] * len(sizes)
    free = [i for i in range(len(sizes)) if weights[i] > 0]
    left = share * sum(sizes)
    while free:
        unit = left / sum(weights[i] for i in free)
        over = [i for i in free if unit * weights[i] > max_repeats * sizes[i]]
        if not over:
            for i in free:
                targets[i] = unit * weights[i]
            break
        for i in over:
            targets[i] = float(max_repeats * sizes[i])
            left -= targets[i]
        free = [i for i in free if i not in set(over)]
    return targets


def split_quotas(rng: random.Random, counts: list[int], shards: int) -> list[list[int]]:
    """Deal ``counts`` blocks per source to ``shards`` leaves of a binary tree."""
    if shards == 1:
        return [counts]
    if not sum(counts):
        return [counts] * shards
    half = shards // 2
    drawn = Counter(rng.sample(range(len(counts)), sum(counts) * half // shards, counts=counts))
    left = [drawn[i] for i in range(len(counts))]
    right = [c - x for c, x in zip(counts, left)]
    return split_quotas(rng, left, half) + split_quotas(rng, right, shards - half)


@dataclass
class _Source:
    name: str | None
    size: int
    target: float
    # (pass, block, in part) in drawing order
    draws: list[tuple[int, int, bool]] = field(default_factory=list)
    rest: float = 0.0  # size still to take from the block drawn in part


def _draw_blocks(sources: dict, blocks: list, seed: int) -> None:
    """Fill ``draws`` of every source from its block sizes."""
    per: dict = {}
    for name, block, size in blocks:
        per.setdefault(name, []).append((block, size))
    for name, s in sources.items():
        left, turn = s.target, 0
        while left > 0 and s.size > 0:
            order = sorted(per[name])
            random.Random(f"{seed}/{name}/{turn}").shuffle(order)
            for block, size in order:
                if left <= 0:
                    break
                if size > left:
                    s.draws.append((turn, block, True))
                    s.rest, left = left, 0.0
                    break
                s.draws.append((turn, block, False))
                left -= size
            turn += 1


def plan_mix(
    docs: DataFrame,
    weight_cycle: tuple[float, ...] = (1.0,),
    share: float = 1.0,
    max_repeats: float = 2.0,
    shards: int = 8,
    seed: int = 17,
    size: Column | None = None,
) -> DataFrame:
    """``docs`` plus ``size``, ``source_size``, ``target`` and ``draws``: an
    array of ``(draw, shard)``, one entry for each time the mix draws the row.

    ``weight_cycle``: weights of the sources by code-point order, repeating.
    ``share``: size of the mix, as a part of the total size of ``docs``.
    """
    spark = docs.sparkSession
    base = docs.drop(*OUTPUT)
    size = word_count(F.col("text")) if size is None else size
    sized = base.withColumn("size", size)
    measured = staged(sized.select("source", "doc_id", "size"), "mix-sizes")
    totals = measured.groupBy("source").agg(
        F.sum("size").alias("size"), F.count(F.lit(1)).alias("rows")
    ).limit(MAX_SOURCES + 1).collect()
    if len(totals) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    totals.sort(key=lambda r: (r["source"] is None, (r["source"] or "").encode("utf-8")))
    sizes = [int(r["size"]) for r in totals]
    weights = [weight_cycle[i % len(weight_cycle)] for i in range(len(sizes))]
    targets = fill_targets(sizes, weights, share, max_repeats)
    sources = {r["source"]: _Source(r["source"], z, t) for r, z, t in zip(totals, sizes, targets)}

    grand = max(1, sum(sizes))
    about = [
        (s.name, s.size, s.target, max(1, min(MAX_BLOCKS * s.size // grand, r["rows"] // MIN_BLOCK_ROWS)))
        for s, r in zip(sources.values(), totals)
    ]
    sources_df = F.broadcast(spark.createDataFrame(
        about, "source string, source_size bigint, target double, _mix_blocks bigint"
    ).withColumnRenamed("source", "_mix_source"))

    def blocked(df: DataFrame) -> DataFrame:
        met = df.join(sources_df, df["source"].eqNullSafe(F.col("_mix_source")), "left").drop("_mix_source")
        return met.withColumn("_mix_block", F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.col("_mix_blocks")))

    sums = blocked(measured).groupBy("source", "_mix_block").agg(F.sum("size").alias("size"))
    blocks = [(r["source"], int(r["_mix_block"]), int(r["size"])) for r in sums.collect()]
    _draw_blocks(sources, blocks, seed)

    rng = random.Random(seed)
    listed = list(sources.values())
    quotas = split_quotas(rng, [len(s.draws) for s in listed], shards)
    rows = []
    for i, s in enumerate(listed):
        taken = 0
        for shard, quota in enumerate(quotas):
            for turn, block, part in s.draws[taken:taken + quota[i]]:
                rows.append((s.name, block, turn, shard, part))
            taken += quota[i]
    # Bounded: a row per block and pass, at most max_repeats passes and a part.
    plan = F.broadcast(spark.createDataFrame(
        rows, "source string, block bigint, draw int, shard int, part boolean"
    ).groupBy("source", "block").agg(F.collect_list(F.struct("draw", "shard", "part")).alias("_mix_draws"))
        .withColumnsRenamed({"source": "_plan_source", "block": "_plan_block"}))

    def planned(df: DataFrame) -> DataFrame:
        met = blocked(df)
        return met.join(
            plan, met["source"].eqNullSafe(F.col("_plan_source")) & (met["_mix_block"] == F.col("_plan_block")), "left"
        ).drop("_plan_source", "_plan_block")

    # A row per source: where its block drawn in part ends.
    ends = F.broadcast(staged(_last_documents(planned(measured), listed, seed), "mix-ends"))
    met = planned(sized).join(ends, F.col("source").eqNullSafe(F.col("_end_source")), "left")
    taken = F.coalesce(_permuted(seed) <= F.col("_end_mark"), F.lit(False)) | (
        F.coalesce("_end_nearest", F.lit(False)) & F.col("doc_id").eqNullSafe(F.col("_end_id"))
    )
    drawn = F.filter(F.coalesce("_mix_draws", F.array()), lambda d: ~d["part"] | taken)
    return met.select(
        *base.columns, "size", "source_size", "target",
        F.transform(drawn, lambda d: F.struct(d["draw"].alias("draw"), d["shard"].alias("shard"))).alias("draws"),
    )


def mix(docs: DataFrame, seed: int = 17, **options) -> DataFrame:
    """``docs`` repeated as often as the mix draws them, plus ``size``,
    ``source_size``, ``target``, ``draw`` (pass number), ``shard`` and
    ``position``; options as for :func:`plan_mix`."""
    planned = plan_mix(docs, seed=seed, **options).withColumn("_mix_d", F.explode("draws"))
    return planned.select(
        *planned.drop("draws", "_mix_d").columns,
        F.col("_mix_d.draw").alias("draw"), F.col("_mix_d.shard").alias("shard"),
        F.xxhash64("doc_id", "_mix_d.draw", F.lit(seed + 1)).alias("position"),
    )


def _permuted(seed: int) -> Column:
    """Order in which the documents of a block drawn in part are taken."""
    return F.xxhash64("doc_id", F.lit(seed + 2))


def _last_documents(planned: DataFrame, sources: list[_Source], seed: int) -> DataFrame:
    """Where each source's block drawn in part ends, a row per source:
    ``_end_mark`` of the last document that fits in permuted order and, if
    ``_end_nearest``, the document ``_end_id`` that is taken after it.

    One block a source, a 1 / blocks share of it. Documents are taken in
    permuted order while they fit; the one nearest to what is left may
    follow if that brings the source nearer to its target.
    """
    spark = planned.sparkSession
    rest = F.broadcast(spark.createDataFrame(
        [(s.name, float(s.rest)) for s in sources if s.rest > 0], "_rest_source string, _rest double"
    ))
    part = planned.where(F.exists(F.coalesce("_mix_draws", F.array()), lambda d: d["part"]))
    part = part.groupBy("source", "doc_id").agg(F.sum("size").alias("size")).withColumn("mark", _permuted(seed))
    part = part.join(rest, part["source"].eqNullSafe(F.col("_rest_source")))
    order = Window.partitionBy("source").orderBy("mark").rangeBetween(Window.unboundedPreceding, 0)
    part = part.withColumn("cum", F.sum("size").over(order))
    fits = F.col("cum") <= F.col("_rest")
    per = part.groupBy("source").agg(
        F.max(F.when(fits, F.col("mark"))).alias("mark"),
        (F.first("_rest") - F.coalesce(F.max(F.when(fits, F.col("cum"))), F.lit(0))).alias("gap"),
    )
    over = part.where(~fits).select("source", "doc_id", "size").join(
        per.select(F.col("source").alias("_gap_source"), "gap"), F.col("source").eqNullSafe(F.col("_gap_source"))
    )
    nearest = over.groupBy("source", "gap").agg(
        F.min(F.struct(F.abs(F.col("size") - F.col("gap")).alias("off"), "doc_id")).alias("best")
    ).where(F.col("best.off") < F.col("gap")).select(
        F.col("source").alias("_near_source"), F.col("best.doc_id").alias("_end_id"), F.lit(True).alias("_end_nearest")
    )
    return per.join(nearest, F.col("source").eqNullSafe(F.col("_near_source")), "left").select(
        F.col("source").alias("_end_source"), F.col("mark").alias("_end_mark"), "_end_id", "_end_nearest"
    )
