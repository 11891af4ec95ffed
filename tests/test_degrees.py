"""Follower counts, multiplicities and two-path counts."""

from collections import Counter

from pyspark.sql import functions as F

from quiver import operators as ops

HAND = [(1, 2), (2, 3), (3, 1), (3, 1)]


def _by_user(df, column):
    return {r.user: r[column] for r in df.collect()}


def test_follower_count_hand_graph(edges_of):
    got = _by_user(ops.follower_count(edges_of(HAND)), "followers")
    assert got == {1: 2, 2: 1, 3: 1}


def test_grouped_variant_equals_direct(edges_of, view_small):
    for edges in (edges_of(HAND), view_small):
        direct = _by_user(ops.follower_count(edges), "followers")
        grouped = _by_user(ops.follower_count_grouped(edges, salt_buckets=4), "followers")
        assert direct == grouped


def test_follower_count_fixture_numbers(view_small):
    counts = ops.follower_count(view_small)
    assert counts.count() == 200
    assert counts.agg(F.max("followers")).first()[0] == 48


def test_multiplicity(edges_of, view_small):
    got = {(r.follower, r.followee): r.n for r in ops.edge_multiplicity(edges_of(HAND)).collect()}
    assert got == {(1, 2): 1, (2, 3): 1, (3, 1): 2}
    hist = Counter(r.n for r in ops.edge_multiplicity(view_small).collect())
    assert hist == Counter({1: 4813, 2: 524, 3: 41, 4: 4})


def test_line_multiplicity_keeps_raw_text(spark):
    lines = spark.createDataFrame([("1,2",), ("1,2,",), ("1,2",)], "value string")
    got = {r.line: r.n for r in ops.line_multiplicity(lines).collect()}
    assert got == {"1,2": 2, "1,2,": 1}


def test_distinct_and_cap(edges_of):
    edges = edges_of(HAND + [(5, 1)])
    assert ops.distinct_edges(edges).count() == 4
    assert {tuple(r) for r in ops.cap_edges(edges, 3).collect()} == {(1, 2)}
    assert ops.cap_edges(edges, None).count() == 5


def test_in_neighbours(edges_of):
    rows = {r.user: (r.n_in, r.n_in_distinct) for r in ops.in_neighbours(edges_of(HAND)).collect()}
    assert rows == {1: (2, 1), 2: (1, 1), 3: (1, 1)}


def test_two_paths_per_user_hand_graph(edges_of):
    rows = {r.user: (r.n_in, r.n_out, r.paths) for r in ops.two_path_per_user(edges_of(HAND)).collect()}
    assert rows == {1: (2, 1, 2), 2: (1, 1, 1), 3: (1, 2, 2)}
    assert ops.two_path_total(edges_of(HAND)).first().paths == 5


def test_two_paths_per_user_emits_zero_rows(edges_of):
    rows = {r.user: r.paths for r in ops.two_path_per_user(edges_of([(1, 2)])).collect()}
    assert rows == {1: 0, 2: 0}


def test_two_path_fixture_numbers(view_small):
    per_user = ops.two_path_per_user(view_small)
    assert per_user.where("paths = 0").count() == 50
    assert ops.two_path_total(view_small).first().paths == 180_901


def test_capped_total_equals_materialised_join(view_small):
    total = ops.two_path_total(view_small, max_id=100).first().paths
    assert total == 40_672
    assert ops.two_paths(view_small, max_id=100).count() == total
    capped = ops.cap_edges(view_small, 100)
    assert capped.count() == 2014 and capped.distinct().count() == 1793


def test_two_paths_rows_and_nested_form(edges_of):
    edges = edges_of(HAND)
    flat = Counter(tuple(r) for r in ops.two_paths(edges).collect())
    assert flat == Counter({(1, 2, 3): 1, (2, 3, 1): 2, (3, 1, 2): 2})
    nested = ops.two_paths_nested(edges)
    assert nested.columns == ["first", "second"]
    pairs = Counter(
        (r.first.follower, r.first.followee, r.second.followee) for r in nested.collect()
    )
    assert pairs == flat


def test_two_paths_broadcast_equals_shuffle(edges_of, view_small):
    a = ops.two_paths(view_small, 100, strategy="broadcast").count()
    b = ops.two_paths(view_small, 100, strategy="shuffle").count()
    assert a == b == 40_672
