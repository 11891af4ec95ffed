"""Duplicate-edge semantics of the directed-triangle counts.

Every count works on pre-aggregated edges ``(src, dst, w)`` where ``w`` is the
number of times the edge occurs. A directed 3-cycle ``a -> b -> c -> a`` is
seen from each of its three rotations; a mode fixes which edge weights a
rotation multiplies:

=========== ============================= ====================================
mode        one rotation (a, b, c)         meaning
=========== ============================= ====================================
bag         w(ab) * w(bc) * w(ca)          every edge occurrence counts
path_bag    w(ab) * w(bc)                  paths are a bag, the closing edge a set
probe_bag   w(ab)                          the probing edge is a bag, the rest sets
set         1                              de-duplicated edges
=========== ============================= ====================================
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MODES = ("bag", "path_bag", "probe_bag", "set")


def check_mode(mode: str) -> str:
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, got {mode!r}")
    return mode


def rotation_sum(mode: str, w1: Column, w2: Column, w3: Column) -> Column:
    """Sum of the mode's weight over the three rotations of one cycle whose
    edges (in cycle order) weigh ``w1, w2, w3``. Used when a cycle is
    enumerated once instead of three times.
    """
    check_mode(mode)
    w1, w2, w3 = (c.cast("bigint") for c in (w1, w2, w3))
    if mode == "bag":
        return F.lit(3) * w1 * w2 * w3
    if mode == "path_bag":
        return w1 * w2 + w2 * w3 + w3 * w1
    if mode == "probe_bag":
        return w1 + w2 + w3
    return F.lit(3).cast("bigint")


def loop_weight(mode: str, w: Column) -> Column:
    """Weight of the one-node cycle ``a -> a -> a -> a`` (a self-loop), which
    has a single rotation.
    """
    check_mode(mode)
    w = w.cast("bigint")
    if mode == "bag":
        return w * w * w
    if mode == "path_bag":
        return w * w
    if mode == "probe_bag":
        return w
    return F.lit(1).cast("bigint")
