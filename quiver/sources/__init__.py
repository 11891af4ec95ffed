"""Edge and graph sources."""

from quiver.sources.edges import (
    EDGE_SCHEMA,
    RULES,
    edge_view,
    line_report,
    parse_lenient,
    parse_strict,
    parse_tokenised,
    placed_lines,
    read_edges,
    read_edges_csv,
    read_edges_permissive,
    read_lines,
)
from quiver.sources.graphs import (
    edges_to_graph,
    kchain_graph,
    kchain_initial_ranks,
    node_table_graph,
    read_node_table,
)

__all__ = [
    "EDGE_SCHEMA",
    "RULES",
    "edge_view",
    "edges_to_graph",
    "kchain_graph",
    "kchain_initial_ranks",
    "line_report",
    "node_table_graph",
    "parse_lenient",
    "parse_strict",
    "parse_tokenised",
    "read_edges",
    "placed_lines",
    "read_edges_csv",
    "read_edges_permissive",
    "read_lines",
    "read_node_table",
]
