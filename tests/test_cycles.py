"""Cycles by intersected neighbour lists: long lists, hubs, keys over batches."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from quiver import operators as ops
from quiver.operators.joins import JoinPlan
from quiver.operators.triangles import oriented_edges, simple_cycles
from quiver.plans import plan_text


def pairs_of(n=30):
    return [(a, b) for a in range(n) for b in range(n) if (a * 7 + b * 3) % 5 < 2] + [(0, k) for k in range(n)] + [(1, 2)] * 3


@pytest.mark.parametrize("order", ["degree", "id"])
@pytest.mark.parametrize("length,hot", [(1024, None), (3, 4)])
def test_each_cycle_is_found_once_whatever_the_lists(spark, edges_of, order, length, hot):
    pairs = pairs_of()
    oriented, _, _ = oriented_edges(edges_of(pairs).repartition(5), order=order)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        found = simple_cycles(oriented, order, JoinPlan("auto"), hot, length=length).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    known = Counter(pairs)
    turns = Counter()
    for r in found:
        assert (r.w_ab, r.w_bc, r.w_ca) == (known[r.a, r.b], known[r.b, r.c], known[r.c, r.a])
        turns.update([(r.a, r.b, r.c), (r.b, r.c, r.a), (r.c, r.a, r.b)])
    users = range(30)
    want = [(a, b, c) for a in users for b in users for c in users if len({a, b, c}) == 3 and (a, b) in known and (b, c) in known and (c, a) in known]
    assert turns == Counter(want)


def test_wedges_are_no_rows_of_a_shuffle(edges_of):
    # User 0 to 99 all lead to the hubs of one side, which lead to no one back.
    edges = edges_of([(a, 100 + k) for a in range(40) for k in range(40)] + [(200 + k, a) for a in range(40) for k in range(40)])
    for df in (ops.triangle_count(edges, "bag", strategy="shuffle"), ops.closed_paths(edges, strategy="shuffle"), ops.edge_closures(edges)):
        assert "MapInArrow" in plan_text(df)
    assert ops.closed_paths(edges).count() == 0 and ops.edge_closures(edges).where("closures > 0").count() == 0


def test_bucketed_wedges_are_made_at_the_lowest_user_alone(spark, edges_of):
    # A hub of 300 in- and 300 out-edges makes 90,000 paths, and no wedge.
    edges = edges_of([(a, 0) for a in range(1, 301)] + [(0, a) for a in range(301, 601)] + [(301, 1), (5, 5), (5, 0), (0, 5)])
    layout = ops.write_bucketed(edges, 4)
    try:
        assert layout.read(spark, "src").where(F.col("up") & (F.col("src") == 0)).count() == 0
        assert ops.bucketed_closings(spark, layout).collect() == ops.triangle_count(edges, "path_bag").collect()
    finally:
        layout.drop(spark)
