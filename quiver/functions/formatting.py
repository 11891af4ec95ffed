"""Text renderings of result rows, and numeric truncation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def tuple_text(key: Column, value: Column) -> Column:
    """``(key,value)``: the text form of a key/value pair."""
    return F.format_string("(%s,%s)", key.cast("string"), value.cast("string"))


def truncate_units(x: Column, scale: int) -> Column:
    """Whole ``1/scale`` units in a non-negative double, as BIGINT
    (``floor(x * scale)``)."""
    return F.floor(x * F.lit(float(scale))).cast("bigint")
