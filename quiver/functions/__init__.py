"""Column-level helpers: parsing rules, triangle weights, text formats."""

from quiver.functions.formatting import truncate_units, tuple_text
from quiver.functions.parsing import (
    ID_PATTERN,
    odd_position_tokens,
    split_fields,
    to_id,
    tokens,
)
from quiver.functions.weights import MODES, check_mode, loop_weight, rotation_sum

__all__ = [
    "ID_PATTERN",
    "MODES",
    "check_mode",
    "loop_weight",
    "odd_position_tokens",
    "rotation_sum",
    "split_fields",
    "to_id",
    "tokens",
    "truncate_units",
    "tuple_text",
]
