"""Benchmark decontamination by spaced-seed hashing.

A mask such as ``11010111`` hashes the tokens at its 1-positions and ignores
the others, so a seed survives a substituted token under a 0. Every position
of every training document is hashed under each mask and joined with the
benchmark's hashes; around each hit, document and item are laid over each
other without gaps and compared token by token. A document is contaminated
by an item if some window of ``window`` tokens (the whole item, if shorter)
that holds the seed agrees in at least ``similarity`` of its tokens.

Tokens are runs of letters, marks and digits, lower-cased; of scripts written
without spaces, single characters with their marks.

The masks of an item depend on its length (see ``MASKS``). At the default
window and similarity every overlap that the rule accepts holds a seed, down
to items of a single token; other values have no such guarantee. Masks that
no item needs are not run over the documents.

The benchmark's seeds are broadcast only while they number at most
``max_broadcast``; beyond that, document seeds are first thinned by a bounded
table of hash slots and then meet the benchmark in a shuffle join. Texts are
never shuffled: a hit carries only the tokens around its seed.

Defined cases: null and empty texts have no seeds and are clean; benchmark
items of equal tokens count as one, under their smallest id; items without a
token are left out; an item of fewer than 5 tokens must occur verbatim, so a
one-word item is found wherever its word is; repeated rows are judged alike; an empty documents or benchmark
table gives no hits; of the input's other columns none is read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quiver.llm.common import drop_rows_with, staged, text_key

# Fixed value: blocks of Thai, Lao, Myanmar, Khmer, kana and Han.
UNSPACED = (
    r"\u0E00-\u0EFF\u1000-\u109F\u1780-\u17FF\u3005-\u3007\u3040-\u30FF\u31F0-\u31FF\u3400-\u4DBF\u4E00-\u9FFF"
    r"\uF900-\uFAFF\uFF66-\uFF9F\x{20000}-\x{3FFFF}"
)
TOKEN = rf"[\p{{L}}\p{{M}}\p{{N}}&&[^{UNSPACED}]]+|[{UNSPACED}&&[\p{{L}}\p{{M}}\p{{N}}]]\p{{M}}*"

# Masks by the least number of tokens (of an item, at most of the window) they
# are for. Enumerated: none of the substitution patterns that leave 0.8 of the
# tokens equal misses every mask, at any length up to 20.
MASKS = {
    1: ("1",), 2: ("11",), 3: ("111",), 4: ("1111",),
    5: ("111", "10011"),
    8: ("111101", "11000111"),
    10: ("11101001", "100011011", "1100111"),
    14: ("101010000011", "101100100001", "111011"),
}
LONGEST = max(len(m) for masks in MASKS.values() for m in masks)
SLOTS = 1 << 21


def token_hashes(text: Column) -> Column:
    words = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(TOKEN), F.lit(0))
    return F.transform(words, lambda w: F.xxhash64(w))


def _mask_hashes(tokens: Column, least: int, number: int) -> Column:
    """Hashes of mask ``number`` of ``MASKS[least]`` at each position where it fits."""
    mask = MASKS[least][number]
    ones = [i for i, c in enumerate(mask) if c == "1"]
    last = F.size(tokens) - len(mask)
    hashes = F.transform(
        F.sequence(F.lit(0), last),
        lambda i: F.xxhash64(F.lit(least), F.lit(number), *[F.get(tokens, i + k) for k in ones]),
    )
    return F.when(last >= 0, hashes).otherwise(F.array().cast("array<bigint>"))


def _seeds(df: DataFrame, keep: list[str], used: list[int]) -> DataFrame:
    """``keep`` + ``(tokens, hash, pos)``: a row for each mask of the lengths
    ``used`` and position."""
    masks = [(least, i) for least in used for i in range(len(MASKS[least]))]
    listed = df.withColumn("seeds", F.concat(*[_mask_hashes(F.col("tokens"), *m) for m in masks]))
    # The outer form, as the inner one makes Spark infer a filter on the array,
    # which computes all hashes a second time.
    rows = listed.select(*keep, "tokens", F.posexplode_outer("seeds").alias("at", "hash")).where("hash IS NOT NULL")
    n = F.size("tokens")
    pos, before = F.col("at"), F.lit(0)
    for least, i in masks[:-1]:
        before = before + F.greatest(n - len(MASKS[least][i]) + 1, F.lit(0))
        pos = F.when(F.col("at") >= before, F.col("at") - before).otherwise(pos)
    return rows.select(*keep, "tokens", "hash", pos.alias("pos"))


def _least(length: Column) -> Column:
    """The key of ``MASKS`` for items of ``length`` tokens."""
    out = F.lit(min(MASKS))
    for least in sorted(MASKS)[1:]:
        out = F.when(length >= least, F.lit(least)).otherwise(out)
    return out


def _slot(h: Column) -> Column:
    return F.pmod(h, F.lit(SLOTS)).cast("int")


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    keys: list[str],
    window: int = 20,
    similarity: float = 0.8,
    max_broadcast: int = 2_000_000,
) -> DataFrame:
    """``keys`` + ``(item_id, seeds, doc_start, item_start, matched, compared)``:
    one row per contaminated document and item, with its best window."""
    items = benchmark.select(F.col("item_id"), token_hashes(F.col("text")).alias("tokens")).where(
        F.size("tokens") > 0
    ).groupBy("tokens").agg(F.min("item_id").alias("item_id"))
    least = _least(F.least(F.size("tokens"), F.lit(window)))
    items = staged(items.select("item_id", "tokens", least.alias("least")), "benchmark-items")
    # At most one row per key of MASKS; an empty benchmark takes any masks.
    used = sorted(r.least for r in items.select("least").distinct().collect()) or [max(MASKS)]
    bench = [_seeds(items.where(F.col("least") == k), ["item_id"], [k]) for k in used]
    items = items.drop("least")
    bench = staged(
        reduce(DataFrame.unionByName, bench).select("hash", "item_id", F.col("pos").alias("item_pos")), "benchmark-seeds"
    )
    small = bench.count() <= max_broadcast

    seeds = _seeds(docs.select(*keys, token_hashes(F.col("text")).alias("tokens")), keys, used)
    # Tokens around the seed: all that a window of `window` tokens can reach.
    around = F.greatest(F.col("pos") - window, F.lit(0))
    seeds = seeds.select(
        *keys, "hash", "pos", around.alias("lo"), F.slice("tokens", around + 1, 2 * window + LONGEST).alias("near")
    )
    if small:
        hits = seeds.join(F.broadcast(bench), "hash").join(F.broadcast(items), "item_id")
    else:
        slots = F.broadcast(bench.select(_slot(F.col("hash")).alias("slot")).distinct())
        thin = seeds.withColumn("slot", _slot(F.col("hash"))).join(slots, "slot", "left_semi").drop("slot")
        hits = thin.join(bench.join(items, "item_id"), "hash")

    # Overlay: doc position p meets item position p - shift.
    hits = hits.withColumn("shift", F.col("pos") - F.col("item_pos")).withColumn("length", F.least(F.size("tokens"), F.lit(window)))
    begin = F.greatest(F.col("lo"), F.col("shift"), F.col("pos") - F.col("length") + 1)
    end = F.least(
        F.col("lo") + F.size("near"), F.col("shift") + F.size("tokens"),
        F.col("pos") + F.col("length"),
    )
    hits = hits.withColumn("begin", begin).withColumn("end", end).where(F.col("end") - F.col("begin") >= F.col("length"))
    equal = F.transform(
        F.sequence(F.col("begin"), F.col("end") - 1),
        lambda p: (F.get("near", p - F.col("lo")) == F.get("tokens", p - F.col("shift"))).cast("int"),
    )
    hits = hits.withColumn("equal", equal).where(
        F.aggregate("equal", F.lit(0), lambda a, x: a + x) >= F.ceil(similarity * F.col("length"))
    )
    running = F.aggregate(
        "equal", F.array(F.lit(0)), lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x))
    )
    windows = F.transform(
        F.sequence(F.lit(0), F.col("end") - F.col("begin") - F.col("length")),
        lambda s: F.struct(
            (F.get("running", s + F.col("length")) - F.get("running", s)).alias("matched"),
            (-s).alias("back"),
        ),
    )
    best = hits.withColumn("running", running).withColumn("best", F.array_max(windows))
    start = F.col("begin") - F.col("best.back")
    top = F.max(F.struct(
        F.col("best.matched").alias("matched"), (-start).alias("s"), F.col("length").alias("compared"),
        (start - F.col("shift")).alias("item_start"),
    ))
    # The verdict follows the aggregate: a filter before it would be pushed
    # into the windows' lambda.
    return best.groupBy(*keys, "item_id").agg(F.count(F.lit(1)).alias("seeds"), top.alias("t")).where(
        F.col("t.matched") >= F.ceil(similarity * F.col("t.compared"))
    ).select(*keys, "item_id", "seeds", (-F.col("t.s")).alias("doc_start"), "t.item_start", "t.matched", "t.compared")


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the contaminated rows, all columns kept."""
    keyed = docs.select(text_key().alias("_text_key"), "text")
    found = leaks(keyed, benchmark, ["_text_key"], **options)
    return drop_rows_with(docs, found.select("_text_key"), text_key())
