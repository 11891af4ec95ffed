"""PageRank: K-chain closed form, pinned values, lagged variant, node tables."""

import pytest

from quiver.operators import pagerank, top_k
from quiver.operators.ranking import _layout
from quiver.plans.inspect import plan_text
from quiver.sources import edges_to_graph, kchain_graph, kchain_initial_ranks, node_table_graph, read_node_table


def closed_form(k, T):
    """Same-iteration ranks after T <= k rounds on a K-chain."""

    def c(t):
        return (1.0 / k**2) * (1 + 1.0 / k) ** t

    ranks = {}
    for i in range(1, k * k + 1):
        d = (i - 1) % k + 1
        ranks[i] = c(T) - (c(T - d) if d <= T else 0.0)
    return ranks, k * c(T - 1)


def _ranks(result):
    return {r.id: r.rank for r in result.ranks.collect()}


def _last(df, column):
    return df.orderBy("iteration").collect()[-1][column]


@pytest.mark.parametrize("k", [10, 30])
def test_kchain_closed_form(spark, k):
    result = pagerank(kchain_graph(spark, k), iterations=10)
    ranks = _ranks(result)
    expected, sink = closed_form(k, 10)
    assert result.nodes == k * k
    assert max(abs(ranks[i] - expected[i]) for i in expected) < 1e-15
    assert abs(_last(result.dangling, "dangling") - sink) < 1e-15
    assert abs(sum(ranks.values()) - 1.0) < 1e-12


def test_kchain_k100_pinned(spark):
    # The recorded output of the reference run (k=100, 10 rounds).
    result = pagerank(kchain_graph(spark, 100), iterations=10)
    ranks = _ranks(result)
    assert abs(_last(result.dangling, "dangling") - 0.010936852726843612) < 1e-16
    assert abs(ranks[1] - 1.0936852726843613e-6) < 1e-18
    assert abs(ranks[2] - 2.1765419783124415e-6) < 1e-18
    assert abs(ranks[10] - 1.0462212541120453e-5) < 1e-17
    deep = [ranks[i] for i in ranks if (i - 1) % 100 + 1 > 10]
    assert len(deep) == 9000
    assert max(abs(r - 1.1046221254112046e-4) for r in deep) < 1e-16
    masses = [r.mass for r in result.mass.orderBy("iteration").collect()]
    assert len(masses) == 10 and all(abs(m - 1.0) < 1e-12 for m in masses)
    top = top_k(result.ranks, 3).collect()
    assert [r.id for r in top] == [11, 12, 13]


def test_k10_pinned(spark):
    ranks = _ranks(pagerank(kchain_graph(spark, 10), iterations=10))
    assert abs(ranks[1] - 0.0023579476910) < 1e-12
    assert abs(ranks[2] - 0.0045015365010) < 1e-12
    assert abs(ranks[10] - 0.0159374246010) < 1e-12


@pytest.mark.parametrize(
    "k,scale,mass",
    [(10, 10000, 0.7955), (10, None, 0.79695), (100, 10000, 0.9864)],
)
def test_lagged_mass(spark, k, scale, mass):
    result = pagerank(kchain_graph(spark, k), iterations=10, dangling="lagged", dangling_scale=scale)
    assert abs(_last(result.mass, "mass") - mass) < 1e-9


def test_lagged_exact_mass_k100(spark):
    result = pagerank(kchain_graph(spark, 100), iterations=10, dangling="lagged")
    assert abs(_last(result.mass, "mass") - 0.9891787995) < 1e-9


def test_single_node_keeps_rank(spark):
    result = pagerank(kchain_graph(spark, 1), iterations=3)
    assert _ranks(result) == {1: 1.0}


def test_node_table_input_in_reference_layout(spark, tmp_path):
    # id <TAB> neighbour <TAB> rank, neighbour 0 = sink; k = 10.
    k = 10
    lines = []
    for i in range(1, k * k + 1):
        lines.append(f"{i}\t{0 if i % k == 0 else i + 1}\t{1.0 / (k * k)}")
    (tmp_path / "graph.txt").write_text("\n".join(lines) + "\n")
    graph, start = node_table_graph(read_node_table(spark, str(tmp_path), sink_id=0))
    result = pagerank(graph, iterations=10, dangling="lagged", dangling_scale=10000, initial=start)
    assert abs(_last(result.mass, "mass") - 0.7955) < 1e-9


def test_initial_ranks_and_out_degree_split(spark):
    graph = spark.createDataFrame([(1, 2), (1, 3), (2, 1), (3, 1)], "src bigint, dst bigint")
    start = spark.createDataFrame([(1, 1.0), (2, 0.0), (3, 0.0)], "id bigint, rank double")
    ranks = _ranks(pagerank(graph, iterations=1, initial=start))
    assert ranks == {1: 0.0, 2: 0.5, 3: 0.5}


def test_hub_split_gives_same_ranks(spark):
    graph = kchain_graph(spark, 6).unionByName(
        spark.range(2, 37).selectExpr("1 as src", "id as dst")
    )
    whole = _ranks(pagerank(graph, iterations=5))
    split = _ranks(pagerank(graph, iterations=5, split_rows=4))
    assert whole.keys() == split.keys()
    assert max(abs(whole[i] - split[i]) for i in whole) < 1e-15


def test_layout_moves_the_edges_once(spark):
    # No join of the edges with their out-degrees, and one shuffle by source.
    layout = _layout(kchain_graph(spark, 6), None, split_rows=100, rows_per_partition=10)
    text = plan_text(layout.graph)
    assert "Join" not in text
    assert {r.of: r.out_rows for r in layout.parts.selectExpr("id AS of", "out_rows").collect()} == dict.fromkeys(range(1, 37), 1)
    assert layout.graph.count() == 36 and layout.n == layout.part_rows == 36
    layout.graph.unpersist()
    layout.parts.unpersist()


def test_repeated_edges_hubs_and_sinks_share_by_rows(spark):
    rows = [(1, 2), (1, 2), (1, 3), (1, None), (2, 1), (2, None), (2, None), (4, 1)]
    graph = spark.createDataFrame(rows, "src bigint, dst bigint")
    start = spark.createDataFrame([(1, 0.44), (2, 0.36), (3, 0.25), (4, 0.1)], "id bigint, rank double")
    for split_rows in (2, 100):
        result = pagerank(graph, iterations=1, initial=start, dangling="lagged", dangling_scale=10, split_rows=split_rows)
        assert _ranks(result) == pytest.approx({1: 0.22, 2: 0.22, 3: 0.11, 4: 0.0})
        # Whole tenths into the sink: 1 of user 1, 2 of user 2 in one message, 2 of user 3.
        assert _last(result.dangling, "dangling") == pytest.approx(0.5)


def test_kchain_initial_ranks(spark):
    rows = kchain_initial_ranks(spark, 3).collect()
    assert len(rows) == 9 and all(abs(r.rank - 1 / 9) < 1e-18 for r in rows)


def test_bad_dangling_mode(spark):
    with pytest.raises(ValueError):
        pagerank(kchain_graph(spark, 2), dangling="later")


def test_empty_graph_has_no_ranks(spark):
    result = pagerank(spark.createDataFrame([], "src bigint, dst bigint"), iterations=2)
    assert result.ranks.count() == 0 and result.nodes == 0
    assert [r.mass for r in result.mass.collect()] == [0.0, 0.0]


def test_null_source_is_no_node(spark):
    graph = spark.createDataFrame([(1, 2), (2, 1), (None, 1)], "src bigint, dst bigint")
    result = pagerank(graph, iterations=2)
    assert result.nodes == 2
    assert {r.id for r in result.ranks.collect()} == {1, 2}


def test_absent_nodes_are_dropped_or_added(spark, tmp_path):
    (tmp_path / "t.txt").write_text("1\t2\t0.5\n2\t3\t0.5\n")
    graph, start = node_table_graph(read_node_table(spark, str(tmp_path)))
    dropped = pagerank(graph, iterations=1, initial=start, absent="drop")
    assert dropped.nodes == 2 and _ranks(dropped) == {1: 0.0, 2: 0.5}
    assert _last(dropped.mass, "mass") == 0.5
    assert set(_ranks(pagerank(graph, iterations=1, initial=start))) == {1, 2, 3}


def test_unknown_absent_policy(spark):
    with pytest.raises(ValueError):
        pagerank(kchain_graph(spark, 2), absent="keep")


def _files(folder):
    return {str(p): p.stat().st_mtime_ns for p in sorted(folder.rglob("*")) if p.is_file()}


@pytest.mark.parametrize("options", [{}, {"dangling": "lagged", "dangling_scale": 1000}])
def test_rounds_restart_after_the_last_commit(spark, edges_of, tmp_path, monkeypatch, options):
    import quiver.operators.rounds as module

    graph = edges_to_graph(edges_of([(a, (a * 7 + k) % 30) for a in range(20) for k in range(3)]))
    folder = tmp_path / "run"
    commit, stopped = module._commit, []

    def stop_in_round_5(spark, where, it, row):
        if it == 5 and not stopped:
            stopped.append(it)
            raise RuntimeError("the driver is lost")
        commit(spark, where, it, row)

    monkeypatch.setattr(module, "_commit", stop_in_round_5)
    with pytest.raises(RuntimeError):
        module.pagerank_rounds(graph, str(folder), 10, **options)
    kept = {p: t for p, t in _files(folder).items() if "round=5" not in p}
    assert len({p.split("round=")[1][0] for p in kept}) == 4
    rows = module.pagerank_rounds(graph, str(folder), 10, **options).collect()
    assert {p: t for p, t in _files(folder).items() if p in kept} == kept
    for t in (1, 4, 5, 10):
        want = {r.id: r.rank for r in pagerank(graph, t, **options).ranks.collect()}
        assert {r.id: r.rank for r in rows if r.iteration == t} == pytest.approx(want)
    # A finished run is read, not repeated; more rounds continue it.
    before = _files(folder)
    assert module.pagerank_rounds(graph, str(folder), 3, **options).count() == 3 * 30
    assert _files(folder) == before
    assert module.pagerank_rounds(graph, str(folder), 11, **options).where("iteration = 11").count() == 30
    stats = module.commits(spark, str(folder)).orderBy("round").collect()
    assert [r.rows for r in stats] == [30] * 11
    with pytest.raises(ValueError):
        module.pagerank_rounds(edges_to_graph(edges_of([(1, 2)])), str(folder), 10, **options)
