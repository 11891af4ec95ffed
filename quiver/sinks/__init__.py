"""Result sinks and their read-back readers."""

from quiver.sinks.text import (
    read_delimited,
    read_ordered,
    read_tuples,
    write_csv,
    write_delimited,
    write_ordered,
    write_tuples,
)

__all__ = [
    "read_delimited", "read_ordered", "read_tuples", "write_csv", "write_delimited", "write_ordered", "write_tuples",
]
