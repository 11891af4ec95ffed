"""Bad-line policies, NULL groups, ordered sink, bucketed layouts."""

from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quiver import operators as ops
from quiver import sinks
from quiver.sources import edges_to_graph, read_edges, read_edges_permissive

PAIRS = [(a, (a * 5 + k) % 23) for a in range(23) for k in range(4)] + [(1, 1), (2, 1), (2, 1)]


def _write(folder, **files):
    for name, lines in files.items():
        (folder / f"{name}.txt").write_text("".join(line + "\n" for line in lines))
    return str(folder)


def _rows(df):
    return Counter(map(tuple, df.collect()))


def test_rows_before_the_first_bad_line_of_each_file(spark, tmp_path):
    path = _write(
        tmp_path, a=["1,2", "3,4", "oops", "5,6"], b=["7,8"], c=["9,", "1,1"], d=[], e=["1,2,3", "4,5", "x,1", "6,7"],
    )
    assert _rows(read_edges(spark, path, "strict", bad="stop")) == Counter([(1, 2), (3, 4), (7, 8)])
    assert _rows(read_edges(spark, path, "lenient", bad="stop")) == Counter([(1, 2), (3, 4), (7, 8), (1, 2), (4, 5)])
    assert _rows(read_edges(spark, path, "lenient", ids="text", bad="stop")) == Counter(
        [("1", "2"), ("3", "4"), ("7", "8"), ("1", "2"), ("4", "5"), ("x", "1"), ("6", "7")])


def test_first_bad_line_of_a_file_read_in_many_blocks(spark, tmp_path):
    lines = [f"{i},{i + 1}" for i in range(3000)]
    lines[1700], lines[2900] = "bad", "worse"
    path = _write(tmp_path, one=lines)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
    try:
        df = read_edges(spark, path, "strict", bad="stop")
        assert df.count() == 1700 and df.agg(F.max("follower")).first()[0] == 1699
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_a_failing_reader_names_file_and_line(spark, tmp_path):
    path = _write(tmp_path, good=["1,2"], broken=["1,2", "3,x", "4,5"])
    with pytest.raises(Exception, match=r"bad edge line in .*broken\.txt.*3,x"):
        read_edges(spark, path, "strict", bad="fail").select("follower").collect()
    (tmp_path / "broken.txt").unlink()
    assert _rows(read_edges(spark, path, "strict", bad="fail")) == Counter([(1, 2)])
    for options in ({"bad": "ignore"}, {"rule": "csv", "bad": "stop"}, {"rule": "tokenised", "bad": "fail"}):
        with pytest.raises(ValueError):
            read_edges(spark, path, **options)


def test_null_group_and_corrupt_records(spark, tmp_path):
    path = _write(tmp_path, a=["1,2", "x,2", "3", "4,y", "5,2,9", "", "6,"])
    rows = read_edges_permissive(spark, path)
    assert {(r.follower, r.followee) for r in rows.collect()} == {(1, 2), (None, 2), (3, None), (4, None), (5, 2), (6, None)}
    assert {r.corrupt for r in rows.where("corrupt IS NOT NULL").collect()} >= {"x,2", "4,y"}
    assert _rows(ops.follower_count(rows)) == Counter([(2, 3), (None, 3)])
    # Pruning the columns does not change what is malformed.
    assert rows.select("followee").where("followee IS NULL").count() == 3


def test_ordered_files(spark, tmp_path):
    rows = spark.range(2000).select(((F.col("id") * 7919) % 400).alias("user"), F.lit(1).cast("bigint").alias("followers"))
    schema = T.StructType([T.StructField("user", T.LongType()), T.StructField("followers", T.LongType())])
    path = str(tmp_path / "ordered")
    sinks.write_ordered(rows.repartition(7), path, "user", files=9)
    got = sinks.read_ordered(spark, path, schema).orderBy("place").collect()
    assert [r.place for r in got] == list(range(2000))
    assert [r.user for r in got] == sorted(r.user for r in got)
    assert [r.file for r in got] == sorted(r.file for r in got) and len({r.file for r in got}) > 3
    # Equal keys on a range border share a file.
    per_user = {}
    for r in got:
        per_user.setdefault(r.user, set()).add(r.file)
    assert all(len(files) == 1 for files in per_user.values())
    names = sorted(p.name for p in (tmp_path / "ordered").glob("part-*"))
    first = [int((tmp_path / "ordered" / n).read_text().split("\t")[0]) for n in names]
    assert first == sorted(first)


def test_bucketed_layouts_join_without_moving_the_edges(spark, edges_of):
    edges = edges_of(PAIRS)
    layout = ops.write_bucketed(edges, 4)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        paths = ops.bucketed_paths(spark, layout)
        plan = paths._jdf.queryExecution().toString()
        assert "Exchange" not in plan and plan.count("Bucketed: true") >= 2
        weights = Counter(PAIRS)
        want = Counter({(a, b, d): weights[a, b] * weights[c, d] for a, b in weights for c, d in weights if b == c})
        assert Counter({(r.src, r.mid, r.dst): r.copies for r in paths.collect()}) == want
        closings = ops.bucketed_closings(spark, layout)
        # Of the closing join only the ends of the paths are moved.
        plan = closings._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Bucketed: true") == 3
        assert closings.collect() == ops.triangle_count(edges, "path_bag").collect()
        ranks = spark.range(23).selectExpr("id", "1D / 23 AS rank")
        sent = ops.bucketed_messages(spark, layout, ranks)
        # Only the ranks and the messages are moved, not the edges.
        assert str(sent._jdf.queryExecution().executedPlan()).count("Exchange") == 2
        got = {r.id: r.received for r in sent.collect()}
        one = ops.pagerank(edges_to_graph(edges), 1)
        spread = one.dangling.first().dangling / one.nodes
        assert {r.id: r.rank - spread for r in one.ranks.collect()} == {k: pytest.approx(got.get(k, 0.0)) for k in range(23)}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        layout.drop(spark)
