"""Hot keys: a hub holding a large share of all edges must not land in one task."""

import math
from contextlib import contextmanager

from pyspark.sql import functions as F

from quiver import operators as ops
from quiver.operators.ranking import _layout
from quiver.operators.triangles import _oriented
from quiver.operators.joins import JoinPlan, grid_join, hot_products, salted_join
from quiver.operators.edges import weighted_edges
from quiver.plans import plan_text


@contextmanager
def conf(spark, **settings):
    old = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def hub_graph(spark, fan=400, background=1500):
    """User 0 follows ``fan`` users and is followed by ``fan`` users; plus a
    background of ordinary edges. The hub holds about a third of all rows."""
    hub_in = spark.range(1, fan + 1).select(F.col("id").alias("follower"), F.lit(0).cast("bigint").alias("followee"))
    hub_out = spark.range(1, fan + 1).select(F.lit(0).cast("bigint").alias("follower"), F.col("id").alias("followee"))
    ordinary = spark.range(1, background).select(
        F.col("id").alias("follower"), ((F.col("id") * 7) % background).alias("followee")
    )
    return hub_in.unionByName(hub_out).unionByName(ordinary)


def test_two_path_join_splits_the_hub(spark):
    edges = hub_graph(spark)
    with conf(
        spark,
        **{
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4KB",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
            "spark.sql.autoBroadcastJoinThreshold": "-1",
        },
    ):
        df = ops.two_paths(edges)
        rows = df.collect()
        text = plan_text(df)
    assert "SortMergeJoin(skew=true)" in text
    expected = ops.two_path_total(edges).first().paths
    assert len(rows) == expected
    assert sum(1 for r in rows if r.mid == 0) == 400 * 400


def test_pagerank_layout_spreads_a_hub_source(spark):
    # Hub 1 has 400 out-edges; with split_rows=50 it becomes 8 parts.
    graph = spark.range(2, 402).select(F.lit(1).cast("bigint").alias("src"), F.col("id").alias("dst"))
    graph = graph.unionByName(spark.range(2, 402).select(F.col("id").alias("src"), F.lit(1).cast("bigint").alias("dst")))
    layout = _layout(graph, None, split_rows=50, rows_per_partition=100)
    hub_rows = layout.graph.where("src = 1")
    per_partition = hub_rows.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert hub_rows.select("part").distinct().count() == 8
    assert len(per_partition) > 1 and max(r["count"] for r in per_partition) < 400
    assert layout.parts.where("id = 1").count() == 8
    layout.graph.unpersist()
    layout.parts.unpersist()


def test_degree_order_bounds_wedge_fan_out(spark):
    edges = hub_graph(spark)
    weighted = weighted_edges(edges)
    simple_edges = weighted.where("src != dst").count()
    oriented = _oriented(weighted, "degree", JoinPlan("auto"))
    up_out = oriented.where("up").groupBy("src").count()
    down_in = oriented.where("not up").groupBy("dst").count()
    bound = math.sqrt(2 * simple_edges)
    assert up_out.agg(F.max("count")).first()[0] <= bound
    assert down_in.agg(F.max("count")).first()[0] <= bound
    # The hub itself is the highest-ranked user: no wedge is centred on it.
    assert oriented.where("up and src = 0").count() == 0
    assert oriented.where("not up and dst = 0").count() == 0


def test_follower_count_pre_aggregates_before_the_shuffle(spark):
    text = plan_text(ops.follower_count(hub_graph(spark)))
    exchange = text.index("Exchange")
    assert "HashAggregate" in text[:exchange] or text.count("HashAggregate") >= 2
    assert "partial_count" in text


def test_salted_join_spreads_a_hub_and_keeps_the_result(spark):
    # Hub 0 has 2900 out-edges; one degree row per user on the other side.
    edges = hub_graph(spark).unionByName(
        spark.range(1, 2501).select(F.lit(0).cast("bigint").alias("follower"), F.col("id").alias("followee"))
    )
    simple = weighted_edges(edges).where("src != dst")
    degree = simple.groupBy("src").agg(F.count(F.lit(1)).alias("deg"))
    hot = degree.where("deg > 200").select("src", F.ceil(F.col("deg") / 200).alias("salts"))
    with conf(
        spark,
        **{
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
        },
    ):
        salted = salted_join(simple, degree, "src", "dst", hot)
        hub_partitions = salted.where("src = 0").select(F.spark_partition_id().alias("p")).distinct().count()
        got = sorted(tuple(r) for r in salted.select("src", "dst", "w", "deg").collect())
    plain = sorted(tuple(r) for r in simple.join(degree, "src").select("src", "dst", "w", "deg").collect())
    assert got == plain
    assert hub_partitions > 1


def test_triangle_counts_do_not_depend_on_hub_splitting(spark, view_small):
    edges = hub_graph(spark, fan=60, background=300).unionByName(view_small)
    for mode in ("bag", "path_bag", "probe_bag", "set"):
        whole = ops.triangle_count(edges, mode).first()
        split = ops.triangle_count(edges, mode, hot_rows=5).first()
        assert tuple(whole) == tuple(split)


def test_wedge_join_hot_centre_is_split_by_aqe(spark):
    # Under the id order, hub 0 is the lowest-ranked user of every cycle
    # through it, so all its wedges share one join key.
    edges = hub_graph(spark, fan=300, background=600)
    with conf(
        spark,
        **{
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2KB",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB",
            "spark.sql.autoBroadcastJoinThreshold": "-1",
        },
    ):
        df = ops.triangle_count(edges, "bag", order="id", strategy="shuffle")
        closings = df.collect()[0].closings
        text = plan_text(df)
    assert "SortMergeJoin(skew=true)" in text
    assert closings == ops.triangle_count(edges, "bag").first().closings



def test_closing_join_spreads_a_hub_pair(spark):
    # Users 1..n each follow hub 100000 and are followed by hub 100001, and
    # 100000 follows 100001: every wedge closes on the same hub pair.
    n = 1500
    a = spark.range(1, n + 1)
    edges = (
        a.select(F.col("id").alias("follower"), F.lit(100000).cast("bigint").alias("followee"))
        .unionByName(a.select(F.lit(100001).cast("bigint").alias("follower"), F.col("id").alias("followee")))
        .unionByName(spark.createDataFrame([(100000, 100001)], "follower bigint, followee bigint"))
    )
    for hot in (100, 1_000_000):
        row = ops.triangle_count(edges, "bag", strategy="shuffle", hot_rows=hot).first()
        assert (row.closings, row.triangles) == (3 * n, n)
    # Both hubs have degree n + 1, so the pair gets ceil((n + 1) / 100) sub-keys.
    from quiver.operators.triangles import _pair_salts

    salts = spark.range(1).select(_pair_salts(F.lit(n + 1), F.lit(n + 1), 100).alias("s")).first().s
    assert salts == 16


def test_hub_mid_is_split_by_its_output(spark):
    with conf(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        edges = hub_graph(spark)
        paths = ops.two_paths(edges, target_paths=10_000)
        hub = paths.where("mid = 0").groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert sum(r["count"] for r in hub) == 400 * 400
    assert len(hub) >= 3 and max(r["count"] for r in hub) < 100_000
    assert paths.exceptAll(ops.two_paths(edges)).count() == 0


def test_hub_mid_is_split_under_default_settings(spark):
    with conf(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        paths = ops.two_paths(hub_graph(spark, fan=2500))
        hub = paths.where("mid = 0").groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert sum(r["count"] for r in hub) == 2500 * 2500
    assert len(hub) > 1 and max(r["count"] for r in hub) <= 0.8 * 2500 * 2500


def test_grid_join_copies_little_and_keeps_the_result(spark):
    # One key with 30 left and 9,000 right rows, and repeated rows.
    left = spark.range(30).select(F.lit(1).alias("k"), (F.col("id") % 20).alias("x"))
    right = spark.range(9000).select(F.lit(1).alias("k"), F.col("id").alias("y"))
    left, right = left.union(left.select(F.lit(2), "x")), right.union(right.limit(5).select(F.lit(2), "y"))
    per_key = left.groupBy("k").agg(F.count("x").alias("n_left")).join(right.groupBy("k").agg(F.count("y").alias("n_right")), "k")
    hot = hot_products(per_key, "k", 10_000, 100)
    assert [tuple(r) for r in hot.collect()] == [(1, 1, 90)]
    with conf(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        out = grid_join(left, right, "k", "x", "y", hot, JoinPlan("auto"))
        assert out.exceptAll(left.join(right, "k")).count() == 0 and out.count() == 30 * 9005
    assert hot_products(per_key, "k", 1_000_000, 100) is None
    assert hot_products(per_key, "k", 1, 1) is None  # the target rises beyond every key
    assert hot_products(per_key.limit(0), "k", 1, 1) is None


def test_hot_wedge_centres_are_split(spark, view_small):
    edges = hub_graph(spark, fan=100, background=300).unionByName(view_small)
    for order in ("degree", "id"):
        plain = ops.triangle_count(edges, "bag", order=order, strategy="shuffle").first()
        split = ops.triangle_count(edges, "bag", order=order, strategy="shuffle", target_wedges=9)
        assert split.first() == plain and "_left_parts" in plan_text(split)


def test_triangle_branches_read_their_own_columns(spark, view_small):
    text = plan_text(ops.triangle_count(view_small, "bag", strategy="shuffle"))
    assert "PartitionFilters: [isnotnull(up" in text
    schemas = [line for line in text.splitlines() if "ReadSchema" in line]
    assert schemas and all(line.count(":") <= 6 for line in schemas)


def test_negative_ids_do_not_pass_for_a_small_table(spark):
    edges = spark.range(0, 2000).select((-F.col("id")).alias("follower"), (-(F.col("id") * 7) % 500).alias("followee"))
    df = ops.triangle_count(edges, "bag", max_id=10, strategy="broadcast", broadcast_max_rows=100)
    assert "BroadcastHashJoin" not in plan_text(df) or df.first() is not None
    assert "SortMergeJoin" in plan_text(df)


def test_salting_stays_on_beyond_the_broadcast_bound(spark):
    edges = hub_graph(spark)
    plain = ops.triangle_count(edges, "bag").collect()
    assert ops.triangle_count(edges, "bag", hot_rows=2, broadcast_max_rows=50).collect() == plain
