"""Graph operators over ``(follower, followee)`` edge DataFrames."""

from quiver.operators.adjacency import adjacency_blocks
from quiver.operators.bucketed import BucketedEdges, bucketed_closings, bucketed_messages, bucketed_paths, write_bucketed
from quiver.operators.closures import edge_closures
from quiver.operators.degrees import (
    follower_count,
    follower_count_grouped,
    in_neighbours,
    two_path_per_user,
    two_path_total,
)
from quiver.operators.edges import (
    cap_edges,
    distinct_edges,
    drop_loops,
    edge_multiplicity,
    line_multiplicity,
    weighted_edges,
)
from quiver.operators.ids import decode_ids, encode_edges, id_dictionary
from quiver.operators.joins import STRATEGIES, resolve_strategy
from quiver.operators.ranking import PageRankResult, pagerank, ranks_by_id, top_k
from quiver.operators.paths import closed_paths, two_paths, two_paths_nested
from quiver.operators.rounds import pagerank_rounds
from quiver.operators.triangles import triangle_count

__all__ = [
    "BucketedEdges",
    "STRATEGIES",
    "PageRankResult",
    "adjacency_blocks",
    "bucketed_closings",
    "bucketed_messages",
    "bucketed_paths",
    "cap_edges",
    "closed_paths",
    "decode_ids",
    "distinct_edges",
    "drop_loops",
    "edge_closures",
    "edge_multiplicity",
    "encode_edges",
    "follower_count",
    "follower_count_grouped",
    "id_dictionary",
    "in_neighbours",
    "line_multiplicity",
    "pagerank",
    "pagerank_rounds",
    "ranks_by_id",
    "resolve_strategy",
    "top_k",
    "triangle_count",
    "two_path_per_user",
    "two_path_total",
    "two_paths",
    "two_paths_nested",
    "weighted_edges",
    "write_bucketed",
]
