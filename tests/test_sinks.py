"""Sinks: write, read back, compare; plus plan inspection helpers."""

from collections import Counter

from pyspark.sql import functions as F
from pyspark.sql import types as T

from quiver import operators as ops
from quiver import sinks
from quiver.plans import counted, plan_text

SCHEMA = T.StructType([T.StructField("user", T.LongType()), T.StructField("followers", T.LongType())])


def _rows(df):
    return Counter(tuple(r) for r in df.collect())


def test_tab_and_comma_round_trip(view_small, tmp_path, spark):
    counts = ops.follower_count(view_small)
    for sep, name in (("\t", "tab"), (",", "comma")):
        path = str(tmp_path / name)
        sinks.write_delimited(counts, path, sep=sep, sort_keys=True)
        assert _rows(sinks.read_delimited(spark, path, SCHEMA, sep=sep)) == _rows(counts)


def test_tab_output_is_key_value_text(edges_of, tmp_path, spark):
    path = str(tmp_path / "kv")
    sinks.write_delimited(ops.follower_count(edges_of([(1, 2), (3, 2)])), path, sep="\t")
    lines = [r.value for r in spark.read.text(path).collect()]
    assert lines == ["2\t2"]


def test_tuple_round_trip(view_small, tmp_path, spark):
    counts = ops.follower_count(view_small)
    path = str(tmp_path / "tuples")
    sinks.write_tuples(counts, "user", "followers", path, sort_keys=True)
    first = spark.read.text(path).first().value
    assert first.startswith("(") and first.endswith(")")
    back = sinks.read_tuples(spark, path, "user", "followers")
    assert _rows(back) == _rows(counts)


def test_csv_round_trip_with_header(view_small, tmp_path, spark):
    mult = ops.edge_multiplicity(view_small)
    path = str(tmp_path / "csv")
    sinks.write_csv(mult, path, header=True)
    schema = T.StructType([T.StructField(c, T.LongType()) for c in ("follower", "followee", "n")])
    assert _rows(sinks.read_delimited(spark, path, schema, sep=",", header=True)) == _rows(mult)


def test_plan_text_shows_pushdown_and_partial_aggregation(spark):
    from quiver.sources import edge_view

    edges = ops.cap_edges(edge_view(spark, "/root/testdata/sf0.001"), 100)
    text = plan_text(ops.follower_count(edges))
    assert "PushedFilters" in text and "LessThan(l_partkey,100)" in text
    assert text.count("HashAggregate") >= 2  # partial + final
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint>" in text


def test_observed_counter(view_small, tmp_path):
    df, obs = counted(view_small, "edges", rows=F.count(F.lit(1)), loops=F.sum(F.expr("int(follower = followee)")))
    df.write.format("noop").mode("overwrite").save()
    assert obs.get == {"rows": 6000, "loops": 31}


def test_sorted_sinks_order_keys_in_every_file(spark, tmp_path):
    counts = spark.range(1000).selectExpr("(id * 7919) % 1000 AS user", "id AS n").repartition(4)
    sinks.write_delimited(counts, str(tmp_path / "tab"), sort_keys=True)
    sinks.write_tuples(counts, "user", "n", str(tmp_path / "tuple"), sort_keys=True)
    for kind, first in (("tab", lambda x: x.split("\t")[0]), ("tuple", lambda x: x[1:].split(",")[0])):
        files = [f.read_text().splitlines() for f in (tmp_path / kind).glob("part-*")]
        assert len(files) == 4 and sum(map(len, files)) == 1000
        for lines in files:
            keys = [int(first(x)) for x in lines]
            assert keys == sorted(keys)
