"""Edge readers under the malformed-line rules, node tables, K-chain source."""

from collections import Counter

import pytest

from quiver.plans.staging import MALFORMED_LINES
from quiver.sources import kchain_graph, line_report, node_table_graph, read_edges, read_node_table


@pytest.fixture(scope="module")
def malformed_dir(tmp_path_factory):
    path = tmp_path_factory.mktemp("malformed") / "edges.txt"
    path.write_text("\n".join(MALFORMED_LINES) + "\n")
    return str(path.parent)


def _pairs(df):
    return Counter(tuple(r) for r in df.collect())


def test_strict_keeps_exactly_two_fields(spark, malformed_dir):
    got = _pairs(read_edges(spark, malformed_dir, "strict"))
    assert got == Counter({(1, 2): 2, (3, 1): 2})


def test_lenient_takes_first_two_fields(spark, malformed_dir):
    got = _pairs(read_edges(spark, malformed_dir, "lenient"))
    assert got == Counter({(1, 2): 3, (3, 1): 2, (6, 7): 1})


def test_csv_reader_matches_lenient(spark, malformed_dir):
    csv = _pairs(read_edges(spark, malformed_dir, "csv"))
    assert csv == _pairs(read_edges(spark, malformed_dir, "lenient"))
    # Projection of one column must not resurrect a row with a bad cell.
    followees = Counter(r[0] for r in read_edges(spark, malformed_dir, "csv").select("followee").collect())
    assert followees == Counter({2: 3, 1: 2, 7: 1})


def test_tokenised_walks_pairs(spark, malformed_dir):
    df = read_edges(spark, malformed_dir, "tokenised")
    assert df.columns == ["followee"]
    got = Counter(r[0] for r in df.collect())
    assert got == Counter({2: 3, 1: 2, 4: 2, 7: 1})


def test_rejects_non_integer_ids(spark, tmp_path):
    (tmp_path / "e.txt").write_text("1,2\n 3,4\n5,6.0\n99999999999999999999,1\n-7,8\n+9,1\n")
    got = _pairs(read_edges(spark, str(tmp_path), "strict"))
    assert got == Counter({(1, 2): 1, (-7, 8): 1, (9, 1): 1})


def test_other_separator(spark, tmp_path):
    (tmp_path / "e.tsv").write_text("1\t2\n3\t4\t\t\n")
    got = _pairs(read_edges(spark, str(tmp_path), "strict", sep="\t"))
    assert got == Counter({(1, 2): 1, (3, 4): 1})


def test_unknown_rule(spark, malformed_dir):
    with pytest.raises(ValueError):
        read_edges(spark, malformed_dir, "fuzzy")


def test_kchain_graph_shape(spark):
    rows = {r.src: r.dst for r in kchain_graph(spark, 3).collect()}
    assert rows == {1: 2, 2: 3, 3: None, 4: 5, 5: 6, 6: None, 7: 8, 8: 9, 9: None}


def test_node_table_sink_and_ranks(spark, tmp_path):
    (tmp_path / "g.txt").write_text("1\t2\t0.25\n2\t0\t0.25\n3\t\t0.5\nbad\t1\t0.1\n4\t1\tx\n")
    nodes = read_node_table(spark, str(tmp_path), sink_id=0)
    graph, ranks = node_table_graph(nodes)
    assert {(r.src, r.dst) for r in graph.collect()} == {(1, 2), (2, None), (3, None)}
    assert {r.id: r.rank for r in ranks.collect()} == {1: 0.25, 2: 0.25, 3: 0.5}


def test_edge_view_counts(view_small):
    # Pinned in FIXTURES.md for sf0.001.
    assert view_small.count() == 6000
    assert view_small.distinct().count() == 5382
    assert view_small.where("follower = followee").count() == 31


def test_unparsable_neighbour_is_no_sink(spark, tmp_path):
    (tmp_path / "t.txt").write_text("1\tabc\t0.5\n2\t\t0.5\n3\t0\t0.5\n4\t1\t0.5\n")
    rows = {(r.id, r.neighbour) for r in read_node_table(spark, str(tmp_path)).collect()}
    assert rows == {(2, None), (3, None), (4, 1)}


def test_text_ids_are_kept_as_written(spark, tmp_path):
    (tmp_path / "t.txt").write_text("a,bob\nb,bob\nc,7\nd,007\n")
    found = read_edges(spark, str(tmp_path), "tokenised", ids="text")
    assert sorted(r.followee for r in found.collect()) == ["007", "7", "bob", "bob"]
    with pytest.raises(ValueError):
        read_edges(spark, str(tmp_path), "strict", ids="text")


def test_line_report_counts_dropped_lines(spark, tmp_path):
    (tmp_path / "t.txt").write_text("1,2\nx,4\n6,7,8\n")
    assert tuple(line_report(spark, str(tmp_path), "strict").first()) == (3, 1, 2)
    assert tuple(line_report(spark, str(tmp_path), "lenient").first()) == (3, 2, 1)
