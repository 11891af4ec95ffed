"""Join strategy selection.

``auto``       no hint: AQE picks broadcast / shuffled-hash / sort-merge from
               runtime sizes and splits skewed partitions.
``shuffle``    sort-merge join hint on the build side.
``broadcast``  replicate the smaller side to every task, but only behind a
               proven size bound (an exact or a bounded row count); beyond the bound the join falls back to ``shuffle``.
"""

from __future__ import annotations

import logging
import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STRATEGIES = ("auto", "shuffle", "broadcast")

# Largest side (rows) quiver replicates. A broadcast edge row (three BIGINTs
# and a flag) takes about 40 bytes as a hashed relation, so the default keeps
# each broadcast relation near 200 MB; a triangle plan broadcasts up to four.
DEFAULT_BROADCAST_MAX_ROWS = 5_000_000

log = logging.getLogger(__name__)


def check_strategy(strategy: str) -> str:
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy must be one of {STRATEGIES}, got {strategy!r}")
    return strategy


def rows_at_most(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` has at most ``max_rows`` rows.

    Each task stops after ``max_rows + 1`` rows of its partition (a local
    limit), so on a scan or a checkpointed table the check reads no more
    than the broadcast itself would.
    """
    return df.limit(max_rows + 1).count() <= max_rows


@dataclass(frozen=True)
class JoinPlan:
    """How the table side of a join is to be read."""

    strategy: str

    def side(self, df: DataFrame) -> DataFrame:
        if self.strategy == "broadcast":
            return F.broadcast(df)
        if self.strategy == "shuffle":
            return df.hint("merge")
        return df


def resolve_strategy(
    strategy: str,
    table: DataFrame,
    max_rows: int = DEFAULT_BROADCAST_MAX_ROWS,
    known_rows: int | None = None,
) -> JoinPlan:
    """Turn a requested strategy into a safe one.

    ``broadcast`` is kept only if ``known_rows`` (an exact count already
    taken, e.g. observed while the table was written) or a bounded count of
    ``table`` proves the side fits; otherwise ``shuffle`` is used.
    """
    check_strategy(strategy)
    if strategy != "broadcast":
        return JoinPlan(strategy)
    if known_rows is not None:
        if known_rows <= max_rows:
            return JoinPlan("broadcast")
    elif rows_at_most(table, max_rows):
        return JoinPlan("broadcast")
    log.warning("broadcast side exceeds %d rows; using a shuffle join", max_rows)
    return JoinPlan("shuffle")


def salted_join(rows: DataFrame, table: DataFrame, key: str, spread: str, hot: DataFrame) -> DataFrame:
    """``rows JOIN table USING (key)`` where ``table`` has one row per key,
    with hot keys split across tasks.

    ``hot`` lists the keys that hold many ``rows`` as ``(key, salts)``; it
    must be small (the caller proves a bound), because it is broadcast. A
    hot key's rows are spread over ``salts`` sub-keys by a hash of
    ``spread`` (deterministic, so a retried task routes every row the same
    way), and its ``table`` row is replicated once per sub-key. Every other
    key keeps sub-key 0. Each row still meets exactly its own key's table
    row, so the result equals the plain join.
    """
    marks = F.broadcast(hot.select(key, F.col("salts").cast("int").alias("salts")))
    salted_rows = rows.join(marks, key, "left").select(
        *[F.col(c) for c in rows.columns],
        F.when(F.col("salts").isNull(), F.lit(0))
        .otherwise(F.pmod(F.xxhash64(spread), F.col("salts")).cast("int"))
        .alias("_salt"),
    )
    replicated = table.join(marks, key, "left").select(
        *[F.col(c) for c in table.columns],
        F.explode(F.sequence(F.lit(0), F.coalesce(F.col("salts"), F.lit(1)) - 1)).alias("_salt"),
    )
    return salted_rows.join(replicated, [key, "_salt"]).drop("_salt")


def hot_products(per_key: DataFrame, key: str, target: int, max_keys: int) -> DataFrame | None:
    """Keys of a many-to-many join that make more than ``target`` rows, as
    ``(key, left_parts, right_parts)``; None if there is none.

    ``per_key``: ``(key, n_left, n_right)``, the rows of each key on either
    side. At most ``total / target`` keys can exceed the target; it rises
    until that is at most ``max_keys``, so the list may be broadcast.
    """
    product = F.col("n_left").cast("double") * F.col("n_right")
    total, most = per_key.agg(F.sum(product), F.max(product)).first()
    target = max(target, math.ceil((total or 0) / max(1, max_keys)))
    if not most or most <= target:
        return None
    side = math.isqrt(target)
    return per_key.where(product > target).select(
        key,
        F.ceil(F.col("n_left") / side).cast("int").alias("left_parts"),
        F.ceil(F.col("n_right") / side).cast("int").alias("right_parts"),
    )


def grid_join(
    left: DataFrame, right: DataFrame, key: str, left_spread: str | tuple[str, ...], right_spread: str | tuple[str, ...],
    hot: DataFrame, plan: JoinPlan,
) -> DataFrame:
    """``left JOIN right USING (key)`` with the keys of ``hot`` (see
    :func:`hot_products`) cut into a grid of cells.

    A hot key's left rows fall into ``left_parts`` by a hash of
    ``left_spread`` and are copied to every right part, and the other way
    round, so each pair of rows meets in one cell. With sides of
    ``sqrt(target)`` rows the copies stay few next to the join's output,
    whichever side is the larger one. Rows equal in key and spread column(s)
    share a part.
    """
    marks = F.broadcast(hot)
    grid = [key, "_left_parts", "_right_parts"]
    # A cell is small in bytes: with a count of its own, AQE does not merge
    # the shuffle's partitions again.
    partitions = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def cells(rows: DataFrame, spread: str | tuple[str, ...], own: str, other: str) -> DataFrame:
        one, spread = F.lit(1), (spread,) if isinstance(spread, str) else spread
        return rows.join(marks, key, "left").select(
            *rows.columns,
            F.pmod(F.xxhash64(*spread), F.coalesce(own, one)).cast("int").alias(f"_{own}"),
            F.explode(F.sequence(F.lit(0), F.coalesce(other, one) - 1)).alias(f"_{other}"),
        ).repartition(partitions, *grid)

    first = cells(left, left_spread, "left_parts", "right_parts")
    second = cells(right, right_spread, "right_parts", "left_parts")
    return first.join(plan.side(second), grid).drop("_left_parts", "_right_parts")
