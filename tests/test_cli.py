"""Command-line jobs, run in-process against the test session."""

from collections import Counter

from quiver.cli import run


def _lines(spark, path):
    return sorted(r.value for r in spark.read.text(path).collect())


def _edges_file(tmp_path, lines):
    d = tmp_path / "in"
    d.mkdir()
    (d / "edges.txt").write_text("\n".join(lines) + "\n")
    return str(d)


def test_followers(spark, tmp_path):
    src = _edges_file(tmp_path, ["1,2", "2,3", "3,1", "3,1", "x,4"])
    out = str(tmp_path / "out")
    assert run(["followers", src, out], spark) == 0
    assert _lines(spark, out) == ["1,2", "2,1", "3,1", "4,1"]


def test_line_counts(spark, tmp_path):
    src = _edges_file(tmp_path, ["1,2", "1,2", "1,2,"])
    out = str(tmp_path / "out")
    run(["line-counts", src, out], spark)
    assert _lines(spark, out) == ["(1,2,,1)", "(1,2,2)"]


def test_two_paths(spark, tmp_path, capsys):
    src = _edges_file(tmp_path, ["1,2", "2,3", "3,1", "3,1"])
    out = str(tmp_path / "out")
    run(["two-paths", src, out], spark)
    assert _lines(spark, out) == ["1\t2", "2\t1", "3\t2"]
    assert "PATH2_COUNT = 5" in capsys.readouterr().out


def test_triangles(spark, tmp_path, capsys):
    src = _edges_file(tmp_path, ["1,2", "2,3", "3,1", "3,1"])
    run(["triangles", src, "--mode", "bag"], spark)
    run(["triangles", src, "--mode", "set", "--strategy", "broadcast"], spark)
    out = capsys.readouterr().out
    assert "TRIANGLE_COUNT = 2" in out and "TRIANGLE_COUNT = 1" in out


def test_kchain_then_pagerank_table(spark, tmp_path, capsys):
    table = str(tmp_path / "graph")
    run(["kchain", "10", table], spark)
    lines = _lines(spark, table)
    assert len(lines) == 100 and "10\t0\t0.01" in lines and "1\t2\t0.01" in lines
    out = str(tmp_path / "ranks")
    run(["pagerank-table", table, out], spark)
    ranks = spark.read.schema("id bigint, rank double").option("sep", "\t").csv(out)
    assert ranks.count() == 100
    assert abs(sum(r.rank for r in ranks.collect()) - 0.7955) < 1e-9


def test_pagerank_writes_tuples_with_sink_row(spark, tmp_path, capsys):
    out = str(tmp_path / "pr")
    run(["pagerank", "10", out, "--top", "3"], spark)
    rows = [r.value for r in spark.read.text(out).collect()]
    assert len(rows) == 101
    sink = [r for r in rows if r.startswith("(0,")]
    assert len(sink) == 1 and abs(float(sink[0][3:-1]) - 0.2357947691) < 1e-9
    printed = capsys.readouterr().out
    assert printed.count("PageRank sum for iteration") == 10
    assert Counter(line.startswith("(") for line in printed.splitlines())[True] == 3
