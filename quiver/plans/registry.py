"""Registered queries: ``name -> fn(spark, sf_dir) -> DataFrame``.

Every query reads the test tables through :func:`quiver.sources.edge_view`
(directly, or after rendering them to the text layout a reader parses) and
runs over the whole graph, except the two that show the id cap.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quiver import operators as ops
from quiver import sinks
from quiver.plans.staging import stage_edge_text, stage_files_with_bad_lines, stage_node_table, stage_text_ids
from quiver.session import staging_path
from quiver.sources import (
    edge_view,
    edges_to_graph,
    line_report,
    node_table_graph,
    read_edges,
    read_edges_permissive,
    read_lines,
    read_node_table,
)

# Id cap of the two queries whose feature is the cap (endpoints must be
# strictly below it). No other query drops ids.
EXAMPLE_CAP = 1000

# Neighbours in a block of the adjacency query; shorter than the operator's
# default, so that lists of the test tables take several blocks.
ADJACENCY_LENGTH = 16

# PageRank rounds, top-k size, truncation of dangling mass
# (1e-4 units) in the lagged variant.
PAGERANK_ITERATIONS = 10
PAGERANK_TOP_K = 100
LAGGED_DANGLING_SCALE = 10000

# Doubles are rounded in query output so that engines summing in a different
# order compare equal.
RANK_DIGITS = 12

Query = Callable[[SparkSession, str], DataFrame]


def _edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edge_view(spark, sf_dir)


# -- sources ---------------------------------------------------------------

def edges_strict(spark, sf_dir):
    return read_edges(spark, stage_edge_text(spark, sf_dir), "strict")


def edges_lenient(spark, sf_dir):
    return read_edges(spark, stage_edge_text(spark, sf_dir), "lenient")


def edges_tokenised(spark, sf_dir):
    return read_edges(spark, stage_edge_text(spark, sf_dir), "tokenised")


def edges_csv(spark, sf_dir):
    return read_edges(spark, stage_edge_text(spark, sf_dir), "csv")


def edges_dropped(spark, sf_dir):
    """Lines that the strict rule keeps and drops, observed while they are read."""
    return line_report(spark, stage_edge_text(spark, sf_dir), "strict")


def edges_until_bad(spark, sf_dir):
    """Edges before the first bad line of each of several files."""
    return read_edges(spark, stage_files_with_bad_lines(spark, _edges(spark, sf_dir)), "strict", bad="stop")


# -- row operators ---------------------------------------------------------

def edges_capped(spark, sf_dir):
    return ops.cap_edges(_edges(spark, sf_dir), EXAMPLE_CAP)


def edges_distinct(spark, sf_dir):
    return ops.distinct_edges(_edges(spark, sf_dir))


def edge_multiplicity(spark, sf_dir):
    return ops.edge_multiplicity(_edges(spark, sf_dir))


def line_multiplicity(spark, sf_dir):
    return ops.line_multiplicity(read_lines(spark, stage_edge_text(spark, sf_dir)))


# -- aggregates ------------------------------------------------------------

def follower_count(spark, sf_dir):
    return ops.follower_count(_edges(spark, sf_dir))


def follower_count_text_ids(spark, sf_dir):
    """Follower count where ids are text as it stands."""
    path = stage_text_ids(spark, _edges(spark, sf_dir))
    return ops.follower_count(read_edges(spark, path, "tokenised", ids="text"))


def follower_count_csv(spark, sf_dir):
    """Follower count of a CSV whose bad or missing ids are a group, NULL."""
    return ops.follower_count(read_edges_permissive(spark, stage_edge_text(spark, sf_dir)))


def follower_count_grouped(spark, sf_dir):
    return ops.follower_count_grouped(_edges(spark, sf_dir))


def in_neighbours(spark, sf_dir):
    return ops.in_neighbours(_edges(spark, sf_dir))


def adjacency_blocks(spark, sf_dir):
    """In-neighbour lists in sorted blocks; a block's neighbours as text."""
    blocks = ops.adjacency_blocks(_edges(spark, sf_dir), "in", ADJACENCY_LENGTH)
    listed = F.concat_ws(",", F.col("neighbours").cast("array<string>"))
    return blocks.select("user", "block", "first", "last", "n", listed.alias("neighbours"))


# -- text ids --------------------------------------------------------------

def _text_edges(spark, sf_dir):
    """Edges with text ids, read by the lenient rule."""
    return read_edges(spark, stage_text_ids(spark, _edges(spark, sf_dir)), "lenient", ids="text")


def id_dictionary(spark, sf_dir):
    """A dense number for every text id."""
    return ops.id_dictionary(_text_edges(spark, sf_dir)).select("token", "id")


def edges_encoded(spark, sf_dir):
    """Edges with text ids, encoded by their dictionary."""
    edges = _text_edges(spark, sf_dir)
    return ops.encode_edges(edges, ops.id_dictionary(edges))


def two_path_per_user(spark, sf_dir):
    return ops.two_path_per_user(_edges(spark, sf_dir))


def two_path_total(spark, sf_dir):
    return ops.two_path_total(_edges(spark, sf_dir))


def two_path_total_capped(spark, sf_dir):
    return ops.two_path_total(_edges(spark, sf_dir), EXAMPLE_CAP)


# -- joins -----------------------------------------------------------------

def two_paths(spark, sf_dir):
    return ops.two_paths(_edges(spark, sf_dir))


def two_paths_nested(spark, sf_dir):
    return ops.two_paths_nested(_edges(spark, sf_dir))


def closed_paths(spark, sf_dir):
    """Two-paths that some edge closes; each path as often as it occurs."""
    return ops.closed_paths(_edges(spark, sf_dir))


def edge_closures(spark, sf_dir):
    """How many users close each distinct edge to a directed triangle."""
    return ops.edge_closures(_edges(spark, sf_dir)).select("follower", "followee", "closures")


def triangle_bag(spark, sf_dir):
    """Bag semantics (every edge occurrence counts), sort-merge (shuffle) joins."""
    return ops.triangle_count(_edges(spark, sf_dir), "bag", strategy="shuffle")


def triangle_bag_broadcast(spark, sf_dir):
    """Bag semantics; the edge table is broadcast once its row count is proven
    to fit, otherwise the joins shuffle."""
    return ops.triangle_count(
        _edges(spark, sf_dir), "bag", strategy="broadcast"
    )


def triangle_path_bag(spark, sf_dir):
    """Paths counted as a bag, closing edges as a set; sort-merge (shuffle) joins."""
    return ops.triangle_count(_edges(spark, sf_dir), "path_bag", strategy="shuffle")


def triangle_path_bag_bucketed(spark, sf_dir):
    """The same count over edges laid out in buckets."""
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return ops.bucketed_closings(spark, ops.write_bucketed(_edges(spark, sf_dir), buckets))


def triangle_probe_bag(spark, sf_dir):
    """Probing edges counted as a bag, the two table edges as sets; broadcast
    joins behind the size check."""
    return ops.triangle_count(
        _edges(spark, sf_dir), "probe_bag", strategy="broadcast"
    )


def triangle_set(spark, sf_dir):
    """De-duplicated edges; the join strategy is left to AQE."""
    return ops.triangle_count(_edges(spark, sf_dir), "set")


# -- PageRank --------------------------------------------------------------

def _rounded(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.round(column, RANK_DIGITS))


def _pagerank_same(spark, sf_dir):
    return ops.pagerank(edges_to_graph(_edges(spark, sf_dir)), PAGERANK_ITERATIONS)


def _pagerank_lagged(spark, sf_dir):
    return ops.pagerank(
        edges_to_graph(_edges(spark, sf_dir)), PAGERANK_ITERATIONS,
        dangling="lagged", dangling_scale=LAGGED_DANGLING_SCALE,
    )


def pagerank(spark, sf_dir):
    return ops.ranks_by_id(_rounded(_pagerank_same(spark, sf_dir).ranks, "rank"))


def pagerank_top_k(spark, sf_dir):
    # Chosen by the unrounded ranks; only the rows returned are rounded.
    top = ops.top_k(_pagerank_same(spark, sf_dir).ranks, PAGERANK_TOP_K)
    return _rounded(top, "rank")


def pagerank_mass(spark, sf_dir):
    return _rounded(_pagerank_same(spark, sf_dir).mass, "mass")


def pagerank_dangling(spark, sf_dir):
    return _rounded(_pagerank_same(spark, sf_dir).dangling, "dangling")


def pagerank_lagged(spark, sf_dir):
    return ops.ranks_by_id(_rounded(_pagerank_lagged(spark, sf_dir).ranks, "rank"))


def pagerank_lagged_exact(spark, sf_dir):
    """Lagged dangling mass without truncation."""
    result = ops.pagerank(edges_to_graph(_edges(spark, sf_dir)), PAGERANK_ITERATIONS, dangling="lagged")
    return ops.ranks_by_id(_rounded(result.ranks, "rank"))


def pagerank_lagged_mass(spark, sf_dir):
    return _rounded(_pagerank_lagged(spark, sf_dir).mass, "mass")


def pagerank_rounds(spark, sf_dir):
    """Ranks after every round of the lagged variant, each committed as a table of its own."""
    out = ops.pagerank_rounds(
        edges_to_graph(_edges(spark, sf_dir)), staging_path(spark, "pagerank-rounds"), PAGERANK_ITERATIONS,
        dangling="lagged", dangling_scale=LAGGED_DANGLING_SCALE,
    )
    return _rounded(out, "rank")


def pagerank_from_table(spark, sf_dir):
    """Lagged PageRank over a node table (``id, neighbour, rank`` lines): the
    nodes are those with a line, 0 is the sink, the table gives the start ranks."""
    path = stage_node_table(spark, _edges(spark, sf_dir))
    graph, start = node_table_graph(read_node_table(spark, path, sink_id=0))
    result = ops.pagerank(
        graph, PAGERANK_ITERATIONS, dangling="lagged",
        dangling_scale=LAGGED_DANGLING_SCALE, initial=start, absent="drop",
    )
    return ops.ranks_by_id(_rounded(result.ranks, "rank"))


# -- sinks (write, then read back) ----------------------------------------

_USER_COUNT = T.StructType(
    [T.StructField("user", T.LongType()), T.StructField("followers", T.LongType())]
)
_USER_PATHS = T.StructType(
    [T.StructField("user", T.LongType()), T.StructField("paths", T.LongType())]
)
_EDGE_COUNT = T.StructType(
    [
        T.StructField("follower", T.LongType()),
        T.StructField("followee", T.LongType()),
        T.StructField("n", T.LongType()),
    ]
)


def sink_tab(spark, sf_dir):
    path = staging_path(spark, "sink-tab")
    per_user = ops.two_path_per_user(_edges(spark, sf_dir)).select("user", "paths")
    sinks.write_delimited(per_user, path, sep="\t", sort_keys=True)
    return sinks.read_delimited(spark, path, _USER_PATHS, sep="\t")


def sink_comma(spark, sf_dir):
    path = staging_path(spark, "sink-comma")
    sinks.write_delimited(ops.follower_count(_edges(spark, sf_dir)), path, sep=",", sort_keys=True)
    return sinks.read_delimited(spark, path, _USER_COUNT, sep=",")


def sink_tuple(spark, sf_dir):
    path = staging_path(spark, "sink-tuple")
    sinks.write_tuples(ops.follower_count(_edges(spark, sf_dir)), "user", "followers", path)
    return sinks.read_tuples(spark, path, "user", "followers")


def sink_csv(spark, sf_dir):
    path = staging_path(spark, "sink-csv")
    sinks.write_csv(ops.edge_multiplicity(_edges(spark, sf_dir)), path)
    return sinks.read_delimited(spark, path, _EDGE_COUNT, sep=",")


def sink_ordered(spark, sf_dir):
    """Written in one global order, read back with each row's place over all files."""
    path = staging_path(spark, "sink-ordered")
    sinks.write_ordered(ops.follower_count(_edges(spark, sf_dir)), path, "user")
    return sinks.read_ordered(spark, path, _USER_COUNT).drop("file")


QUERIES: dict[str, Query] = {
    fn.__name__: fn
    for fn in [
        edges_strict, edges_lenient, edges_tokenised, edges_csv, edges_dropped, edges_until_bad,
        edges_capped, edges_distinct, edge_multiplicity, line_multiplicity,
        follower_count, follower_count_text_ids, follower_count_csv, follower_count_grouped, in_neighbours,
        adjacency_blocks, id_dictionary, edges_encoded,
        two_path_per_user, two_path_total, two_path_total_capped,
        two_paths, two_paths_nested, closed_paths, edge_closures,
        triangle_bag, triangle_bag_broadcast, triangle_path_bag, triangle_path_bag_bucketed, triangle_probe_bag, triangle_set,
        pagerank, pagerank_top_k, pagerank_mass, pagerank_dangling,
        pagerank_lagged, pagerank_lagged_exact, pagerank_lagged_mass, pagerank_rounds, pagerank_from_table,
        sink_tab, sink_comma, sink_tuple, sink_csv, sink_ordered,
    ]
}
