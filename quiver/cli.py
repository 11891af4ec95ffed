"""Command-line jobs (``spark-submit --py-files quiver.zip quiver/cli.py ...``
or ``python -m quiver ...``).

One sub-command per batch program of the reference, with the same inputs
and outputs:

    followers      IN OUT [--rule tokenised|strict|lenient|csv] [--sep ,]
    line-counts    IN OUT                    count identical raw lines
    two-paths      IN OUT [--max-id N]       user TAB in*out, total printed
    triangles      IN [--mode bag|path_bag|probe_bag|set] [--max-id N]
                   [--strategy auto|shuffle|broadcast] [--no-loops]
    kchain         K OUT                     node table id TAB neighbour TAB 1/K^2
    pagerank       K OUT [--variant same|lagged] [--iterations 10] [--top K]
    pagerank-table IN OUT [--variant lagged|same] [--sink-id 0]

Results are written by Spark tasks; only scalars (totals, counts, top-k
rows) are printed by the driver.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quiver import operators as ops
from quiver import sinks
from quiver.session import build_session
from quiver.sources import (
    kchain_graph,
    kchain_initial_ranks,
    node_table_graph,
    read_edges,
    read_lines,
    read_node_table,
)

# Lagged PageRank truncates dangling mass to 1e-4 units.
LAGGED_SCALE = 10000


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="quiver")
    sub = p.add_subparsers(dest="command", required=True)

    s = sub.add_parser("followers", help="follower count per user")
    s.add_argument("input"), s.add_argument("output")
    s.add_argument("--rule", default="tokenised", choices=["tokenised", "strict", "lenient", "csv"])
    s.add_argument("--sep", default=",")

    s = sub.add_parser("line-counts", help="count identical raw lines")
    s.add_argument("input"), s.add_argument("output")

    s = sub.add_parser("two-paths", help="two-paths through each user")
    s.add_argument("input"), s.add_argument("output")
    s.add_argument("--max-id", type=int, default=None)

    s = sub.add_parser("triangles", help="directed triangle count")
    s.add_argument("input")
    s.add_argument("--mode", default="bag", choices=["bag", "path_bag", "probe_bag", "set"])
    s.add_argument("--max-id", type=int, default=None)
    s.add_argument("--strategy", default="auto", choices=["auto", "shuffle", "broadcast"])
    s.add_argument("--order", default="degree", choices=["degree", "id"])
    s.add_argument("--no-loops", action="store_true")
    s.add_argument("--rule", default="strict", choices=["strict", "lenient", "csv"])

    s = sub.add_parser("kchain", help="write a K-chain node table")
    s.add_argument("k", type=int), s.add_argument("output")

    s = sub.add_parser("pagerank", help="PageRank over a generated K-chain graph")
    s.add_argument("k", type=int), s.add_argument("output")
    s.add_argument("--variant", default="same", choices=["same", "lagged"])
    s.add_argument("--iterations", type=int, default=10)
    s.add_argument("--top", type=int, default=None, help="top-k size (default K)")

    s = sub.add_parser("pagerank-table", help="PageRank over a node table")
    s.add_argument("input"), s.add_argument("output")
    s.add_argument("--variant", default="lagged", choices=["same", "lagged"])
    s.add_argument("--iterations", type=int, default=10)
    s.add_argument("--sink-id", type=int, default=0)
    return p


def _pagerank(graph: DataFrame, variant: str, iterations: int, initial: DataFrame | None):
    scale = LAGGED_SCALE if variant == "lagged" else None
    # Given start ranks are the node list: messages to other ids are lost.
    absent = "add" if initial is None else "drop"
    return ops.pagerank(
        graph, iterations, dangling=variant, dangling_scale=scale, initial=initial, absent=absent
    )


def _with_sink_row(result, sink_id: int) -> DataFrame:
    """Ranks plus the sink pseudo-node's row (the last round's dangling mass)."""
    last = result.dangling.orderBy(F.col("iteration").desc()).limit(1)
    sink = last.select(F.lit(sink_id).cast("bigint").alias("id"), F.col("dangling").alias("rank"))
    return result.ranks.unionByName(sink)


def run(argv: list[str], spark: SparkSession | None = None) -> int:
    args = _parser().parse_args(argv)
    spark = spark or build_session(app_name=f"quiver-{args.command}")

    if args.command == "followers":
        counts = ops.follower_count(read_edges(spark, args.input, args.rule, args.sep))
        sinks.write_delimited(counts, args.output, sep=",", sort_keys=True)
    elif args.command == "line-counts":
        counts = ops.line_multiplicity(read_lines(spark, args.input))
        sinks.write_tuples(counts, "line", "n", args.output)
    elif args.command == "two-paths":
        edges = read_edges(spark, args.input, "strict")
        per_user = ops.two_path_per_user(edges, args.max_id).select("user", "paths")
        sinks.write_delimited(per_user, args.output, sep="\t", sort_keys=True)
        total = spark.read.schema("user bigint, paths bigint").option("sep", "\t").csv(args.output)
        print(f"PATH2_COUNT = {total.agg(F.sum('paths')).first()[0] or 0}")
    elif args.command == "triangles":
        edges = read_edges(spark, args.input, args.rule)
        row = ops.triangle_count(
            edges, args.mode, args.max_id, allow_loops=not args.no_loops,
            strategy=args.strategy, order=args.order,
        ).first()
        print(f"CLOSINGS = {row.closings}")
        print(f"TRIANGLE_COUNT = {row.triangles}")
    elif args.command == "kchain":
        start = F.lit(repr(1.0 / (args.k * args.k)))
        lines = kchain_graph(spark, args.k).select(
            F.concat_ws("\t", F.col("src").cast("string"),
                        F.coalesce(F.col("dst"), F.lit(0)).cast("string"), start).alias("value")
        )
        lines.write.text(args.output)
    elif args.command == "pagerank":
        graph = kchain_graph(spark, args.k)
        result = _pagerank(graph, args.variant, args.iterations, kchain_initial_ranks(spark, args.k))
        for r in ops.top_k(result.ranks, args.top or args.k).collect():
            print(f"({r.id},{r.rank!r})")
        for r in result.mass.orderBy("iteration").collect():
            print(f"PageRank sum for iteration {r.iteration}: {r.mass!r}")
        out = _with_sink_row(result, 0) if args.variant == "same" else result.ranks
        sinks.write_tuples(out, "id", "rank", args.output)
    elif args.command == "pagerank-table":
        graph, start = node_table_graph(read_node_table(spark, args.input, sink_id=args.sink_id))
        result = _pagerank(graph, args.variant, args.iterations, start)
        for r in result.dangling.orderBy("iteration").collect():
            print(f"PageRank loss, iteration {r.iteration}: {r.dangling!r}")
        sinks.write_delimited(result.ranks, args.output, sep="\t", sort_keys=True)
    return 0


def main() -> None:
    sys.exit(run(sys.argv[1:]))


if __name__ == "__main__":
    main()
