"""Dense ids, adjacency blocks, closures per edge, closed paths, repeated edges."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from quiver import operators as ops
from quiver.operators.closures import edge_closures
from quiver.operators.numbering import numbered
from quiver.sources import edges_to_graph, parse_lenient, parse_strict, read_edges


def _random_edges(seed, n=400, users=40, hub=7):
    rng = random.Random(seed)
    pairs = [(rng.randrange(users), rng.randrange(users)) for _ in range(n)]
    return pairs + [(rng.randrange(users), hub) for _ in range(n // 3)] + [(hub, rng.randrange(users)) for _ in range(n // 3)]


def test_numbering_is_gapless_in_groups(spark):
    rows = spark.range(1000).selectExpr("id % 3 AS g", "(id * 7919) % 1000 AS v").repartition(7)
    got = numbered(rows, ["g", "v"], ["g"]).collect()
    per = defaultdict(list)
    for r in got:
        per[r.g].append((r.v, r.idx))
    for pairs in per.values():
        assert [i for _, i in sorted(pairs)] == list(range(len(pairs)))
    assert numbered(rows.limit(0), ["v"]).collect() == []
    with pytest.raises(ValueError):
        numbered(rows, ["v"], ["g"])


def test_text_ids_of_every_reader(spark):
    lines = spark.createDataFrame([(x,) for x in ["a,b", "a,b,c", "7,007", "x", ",b", "a,", "é,a,,"]], "value string")
    assert Counter(map(tuple, parse_strict(lines, ids="text").collect())) == Counter([("a", "b"), ("7", "007"), ("é", "a")])
    assert Counter(map(tuple, parse_lenient(lines, ids="text").collect())) == Counter(
        [("a", "b"), ("a", "b"), ("7", "007"), ("é", "a")])
    with pytest.raises(ValueError):
        read_edges(spark, "/nowhere", "csv", ids="text")


@pytest.mark.parametrize("hot_rows", [1_000_000, 5])
def test_encoded_edges_give_the_same_graph(spark, edges_of, hot_rows):
    pairs = _random_edges(1)
    text = spark.createDataFrame([(f"u{a}é", f"u{b}é") for a, b in pairs], "follower string, followee string").repartition(5)
    book = ops.id_dictionary(text)
    names = {r.token: r.id for r in book.collect()}
    assert [names[t] for t in sorted(names)] == list(range(len(names)))
    encoded = ops.encode_edges(text, book, hot_rows)
    assert Counter(map(tuple, encoded.collect())) == Counter((names[f"u{a}é"], names[f"u{b}é"]) for a, b in pairs)
    plain = edges_of(pairs)
    assert ops.triangle_count(encoded, "bag").collect() == ops.triangle_count(plain, "bag").collect()
    ranks = ops.decode_ids(ops.pagerank(edges_to_graph(encoded), 3).ranks, book)
    want = {f"u{r.id}é": r.rank for r in ops.pagerank(edges_to_graph(plain), 3).ranks.collect()}
    assert {r.id: pytest.approx(r.rank) for r in ranks.collect()} == want


def test_null_tokens_have_no_id(spark):
    text = spark.createDataFrame([("a", None), (None, "b"), ("b", "a")], "follower string, followee string")
    book = ops.id_dictionary(text)
    assert [(r.token, r.id) for r in book.orderBy("id").collect()] == [("a", 0), ("b", 1)]
    assert [tuple(r) for r in ops.encode_edges(text, book).collect()] == [(1, 0)]


@pytest.mark.parametrize("length", [1, 3, 1000])
def test_adjacency_blocks(edges_of, length):
    pairs = _random_edges(2)
    lists = defaultdict(list)
    for r in ops.adjacency_blocks(edges_of(pairs).repartition(6), "out", length).orderBy("user", "block").collect():
        assert r.n == len(r.neighbours) <= length and (r.first, r.last) == (r.neighbours[0], r.neighbours[-1])
        assert r.block == len(lists[r.user]) // length
        lists[r.user] += r.neighbours
    want = defaultdict(set)
    for a, b in pairs:
        want[a].add(b)
    assert lists == {u: sorted(v) for u, v in want.items()}


@pytest.mark.parametrize("options", [{}, {"length": 2}, {"length": 3, "cell_ids": 16}])
def test_edge_closures_equal_brute_force(edges_of, options):
    pairs = _random_edges(3)
    edges = edges_of(pairs).repartition(4)
    known, times = set(pairs), Counter(pairs)
    users = {u for p in pairs for u in p}
    got = {(r.follower, r.followee): (r.w, r.closures) for r in edge_closures(edges, **options).collect()}
    assert got == {(x, y): (times[x, y], sum((c, x) in known and (y, c) in known for c in users)) for x, y in known}
    assert sum(w * n for w, n in got.values()) == ops.triangle_count(edges, "probe_bag").first().closings
    assert edge_closures(edges.limit(0), **options).collect() == []


@pytest.mark.parametrize("filter_words", [0, 1, 1 << 20])
@pytest.mark.parametrize("target", [4_000_000, 50])
def test_closed_paths(edges_of, filter_words, target):
    pairs = _random_edges(4, n=120, users=25)
    known = set(pairs)
    want = Counter((a, b, d) for a, b in pairs for c, d in pairs if b == c and (d, a) in known)
    got = ops.closed_paths(edges_of(pairs), target_paths=target, filter_words=filter_words)
    assert Counter(map(tuple, got.collect())) == want
    assert sum(want.values()) == ops.triangle_count(edges_of(pairs), "path_bag").first().closings


def test_copies_of_one_edge_are_spread(spark):
    copies = spark.range(20000).selectExpr("1L AS follower", "2L AS followee")
    fan = spark.range(300).selectExpr("2L AS follower", "id + 10 AS followee")
    paths = ops.two_paths(copies.unionByName(fan), target_paths=100_000)
    per_task = [r["count"] for r in paths.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(per_task) == 6_000_000 and max(per_task) < 3_000_000 and len(per_task) > 3
    nested = ops.two_paths_nested(copies.limit(5).unionByName(fan.limit(2)))
    assert nested.count() == 10 and nested.first().first.followee == 2
