"""Column expressions that parse edge text lines.

All of them stay JVM-side (``split``, ``regexp_replace``, higher-order
``filter``), so they run inside whole-stage codegen with no Python in the
scan path.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: an id is an optionally signed run of decimal digits, the same
# token set that a 32/64-bit integer parser accepts (no blanks, no decimals).
ID_PATTERN = r"^[+-]?[0-9]+$"


def to_id(token: Column) -> Column:
    """Token -> BIGINT, or NULL when it is not an integer (or overflows)."""
    return F.when(token.rlike(ID_PATTERN), token.try_cast("bigint"))


def split_fields(line: Column, sep: str = ",") -> Column:
    """Split like a JVM ``String.split``: trailing empty fields are removed.

    ``'9,'`` gives one field and ``'1,2,,'`` two, which decides whether a line
    passes the strict two-field rule. Spark's own ``split`` keeps trailing
    empties, so they are trimmed from the line first.
    """
    quoted = re.escape(sep)
    return F.split(F.regexp_replace(line, f"(?:{quoted})+$", ""), quoted)


def tokens(line: Column, sep: str = ",") -> Column:
    """Non-empty tokens between separators (empty tokens are skipped)."""
    return F.filter(F.split(line, re.escape(sep)), lambda t: t != F.lit(""))


def odd_position_tokens(line: Column, sep: str = ",") -> Column:
    """Tokens 2, 4, 6, ... of a line: the followee of each (follower, followee)
    pair when one line lists several pairs. A trailing unpaired token is dropped.
    """
    return F.filter(tokens(line, sep), lambda t, i: i % 2 == 1)
