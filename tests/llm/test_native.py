"""Exact dedup, mixing, sharding, decontamination: results and odd inputs."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from quiver.llm.exact_stream import stream_dedup
from quiver.llm.kd_shards import kd_shards
from quiver.llm.licenses import scan
from quiver.llm.mixing import fill_targets, mix, plan_mix, split_quotas
from quiver.llm.queries import ORACLE_SQL, QUERIES
from quiver.llm.spaced_seeds import decontaminate, leaks
from oracle_compare import compare, duckdb_connection

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_oracle(spark, name):
    out = compare(spark, duckdb_connection(SF), name, QUERIES[name], ORACLE_SQL[name], SF)
    assert out.ok, out.detail


def _written(df, tmp_path, name):
    path = str(tmp_path / name)
    df.write.parquet(path)
    return path


def test_dedup_odd_rows_and_forced_collisions(spark, odd, none, tmp_path):
    path = _written(odd.coalesce(1), tmp_path, "odd")
    def same(text):
        return F.lit(bytearray(b"one digest for all"))

    for digest in (None, same):
        out = stream_dedup(spark, path, **({"digest": digest} if digest else {})).collect()
        assert len(out) == 8 and sum(r.kept for r in out) == 5
        by = defaultdict(list)
        for r in out:
            by[r.doc_id].append(r)
        assert by[1][0].keep_id == 2 and by[1][0].group_size == 2 and by[2][0].kept
        assert by[3][0].keep_id == 4 and by[3][0].group_size == 3
        assert sum(r.kept for r in by[4]) == 1
    assert stream_dedup(spark, _written(none, tmp_path, "none")).count() == 0


def test_targets_fill_like_water():
    assert fill_targets([10, 10, 10], [3, 1, 2], 1.5, 2) == [20.0, pytest.approx(25 / 3), pytest.approx(50 / 3)]
    assert fill_targets([0, 5], [1, 1], 1.5, 2) == [0.0, 7.5]
    assert fill_targets([], [], 1.5, 2) == []


def test_splitting_tree_keeps_quotas_exact():
    leaves = split_quotas(random.Random(1), [7, 0, 30], 8)
    assert [sum(x) for x in zip(*leaves)] == [7, 0, 30]
    assert max(map(sum, leaves)) - min(map(sum, leaves)) <= 2


def test_mix_meets_targets_and_reruns_agree(spark, odd, none):
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"), F.element_at(F.array(F.lit("a"), F.lit("b"), F.lit(None)), (F.col("id") % 3 + 1).cast("int")).alias("source"),
        F.repeat(F.lit("w "), (F.col("id") % 50).cast("int")).alias("text"),
    )
    options = {"weight_cycle": (3.0, 1.0, 2.0), "share": 1.5}
    out = plan_mix(docs, **options)
    rows = out.groupBy("source").agg(F.max("target").alias("t"), F.sum(F.size("draws") * F.col("size")).alias("got"), F.max(F.size("draws")).alias("most")).collect()
    assert all(abs(r.got - r.t) <= 0.01 * r.t and r.most <= 2 for r in rows)
    drawn = mix(docs, **options)
    assert drawn.exceptAll(mix(docs, **options)).count() == 0
    assert drawn.groupBy("doc_id", "draw").count().where("count > 1").count() == 0
    assert plan_mix(odd, **options).count() == 8 and plan_mix(none, **options).count() == 0


def test_shards_are_even_gapless_and_keep_copies_together(spark, odd, none):
    docs = spark.range(4000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 10 == 0, F.lit("a copied text")).otherwise(F.concat(F.lit("x"), F.repeat(F.col("id").cast("string"), (F.col("id") % 40).cast("int")))).alias("text"),
    )
    out = kd_shards(docs, 8)
    per = out.groupBy("shard").agg(F.sum("size").alias("b"), F.count("*").alias("n"), F.max("slot").alias("m"), F.countDistinct("slot").alias("d")).collect()
    assert len(per) == 8 and all(r.n == r.m + 1 == r.d for r in per)
    assert max(r.b for r in per) <= 1.03 * min(r.b for r in per)
    assert out.where("text = 'a copied text'").select("shard").distinct().count() == 1
    some = kd_shards(odd, 2)
    assert some.count() == 8 and some.columns[-4:] == ["size", "text_crc32", "shard", "slot"]
    assert kd_shards(none, 8).count() == 0
    assert kd_shards(docs, target_bytes=20_000).select("shard").distinct().count() > 2


def test_tree_splits_at_weighted_medians_of_the_widest_dimension(spark):
    import quiver.llm.kd_shards as module

    rng = random.Random(5)
    rows = [(i, "\n".join("w" * rng.randint(1, 60) for _ in range(rng.randint(1, 12)))) for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    points = module._measured(docs).groupBy(*module.COORDS, "_kd_tie").agg(F.sum("size").alias("_kd_weight")).cache()
    data = [tuple(r) for r in points.select(*module.COORDS, "_kd_tie", "_kd_weight").collect()]
    total = sum(p[-1] for p in data)
    tolerance = module.TOLERANCE * total / 8
    levels, ranges = module._grow(points, [total / 8] * 8, tolerance)
    assert sorted(ranges.values()) == [(k, k + 1) for k in range(8)]
    spans = [max(p[d] for p in data) - min(p[d] for p in data) for d in range(4)]
    nodes = {1: data}
    for level in levels:
        for node, dim, at, tie in level:
            inside = nodes.pop(node)
            extents = [(max(p[d] for p in inside) - min(p[d] for p in inside)) / spans[d] for d in range(4)]
            # A metadata dimension, and the widest; the hash only splits ties.
            assert dim < 4 and extents[dim] == max(extents)
            left = [p for p in inside if (p[dim], p[4]) <= (at, tie)]
            half = sum(p[-1] for p in inside) / 2
            assert abs(sum(p[-1] for p in left) - half) <= tolerance + max(p[-1] for p in inside)
            nodes[2 * node], nodes[2 * node + 1] = left, [p for p in inside if (p[dim], p[4]) > (at, tie)]
    # The median is the exact one up to the tolerance, tied coordinates included.
    assert len(nodes) == 8 and sum(map(len, nodes.values())) == len(data)


def test_a_group_heavier_than_a_shard_is_divided(spark):
    docs = spark.range(2000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") < 1200, F.lit("one and the same text")).otherwise(F.concat(F.lit("text "), F.repeat(F.col("id").cast("string"), 4))).alias("text"),
    )
    per = kd_shards(docs, 8).groupBy("shard").agg(F.sum("size").alias("b"), F.count("*").alias("n"), F.max("slot").alias("m")).collect()
    assert len(per) == 8 and all(r.n == r.m + 1 for r in per)
    assert max(r.b for r in per) <= 1.1 * min(r.b for r in per)


def test_mix_columns_equal_brute_force(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "source", "text").collect()
    import re

    size = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in rows}
    per = defaultdict(int)
    for r in rows:
        per[r.source] += size[r.doc_id]
    names = sorted(per, key=lambda s: (s is None, (s or "").encode()))
    targets = dict(zip(names, fill_targets([per[s] for s in names], [(3, 1, 2)[i % 3] for i in range(len(names))], 1.5, 2)))
    source, got = {r.doc_id: r.source for r in rows}, defaultdict(int)
    out = QUERIES["op2_hypergeometric_mix"](spark, "/root/testdata/sf0.01").collect()
    assert len(out) == len(rows)
    for r in out:
        s = source[r.doc_id]
        assert (r.size, r.source_size) == (size[r.doc_id], per[s]) and r.target == pytest.approx(targets[s])
        assert r.taken <= 2 * r.size
        got[s] += r.taken
    assert all(abs(got[s] - targets[s]) <= 0.01 * targets[s] + 1 for s in names)


def test_mix_of_one_source_per_row(spark, monkeypatch):
    import quiver.llm.mixing as module

    docs = spark.range(400).selectExpr("id AS doc_id", "concat('s', id) AS source", "repeat('w ', cast(id % 9 AS int)) AS text")
    out = plan_mix(docs, weight_cycle=(3.0, 1.0, 2.0), share=1.5).collect()
    assert len(out) == 400 and all(r.size * len(r.draws) <= 2 * r.size for r in out)
    assert all(abs(r.size * len(r.draws) - r.target) <= r.size / 2 + 1e-9 for r in out)
    monkeypatch.setattr(module, "MAX_SOURCES", 399)
    with pytest.raises(ValueError):
        plan_mix(docs)


def test_leaks_match_brute_force_and_tolerate_substitutions(spark, odd, none):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    items = [(i, " ".join(rng.choices(words, k=rng.randint(14, 50)))) for i in range(20)]
    docs, truth = [], set()
    for d in range(200):
        own = rng.choices(words, k=rng.randint(0, 300))
        if d % 4 == 0:
            i, text = items[d % 20]
            leak = text.split()
            for k in range(0, len(leak), 8):  # one word in eight is changed
                leak[k] = "other"
            own[len(own) // 2:len(own) // 2] = leak
            truth.add((d, i))
        docs.append((d, " ".join(own).title()))
    docs_df = spark.createDataFrame(docs, "doc_id bigint, text string")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    found = {(r.doc_id, r.item_id) for r in leaks(docs_df, bench, ["doc_id"]).collect()}
    assert found == truth
    beyond = {(r.doc_id, r.item_id) for r in leaks(docs_df, bench, ["doc_id"], max_broadcast=10).collect()}
    assert beyond == truth
    clean = {r.doc_id for r in decontaminate(docs_df, bench).collect()}
    assert clean == {d for d, _ in docs} - {d for d, _ in truth}
    assert decontaminate(odd, bench).count() == 8 and decontaminate(none, bench).count() == 0
    assert decontaminate(odd, bench.limit(0)).columns == odd.columns


def test_license_digests(spark, odd, none):
    text = "Copyright (c) 2001 Some One\nReleased under the  MIT Licence!"
    docs = spark.createDataFrame([(1, text), (2, "a song released under the MIT License."), (3, None)], "doc_id bigint, text string")
    assert {r.doc_id: r.license for r in scan(docs).collect()} == {1: "MIT notice", 2: None, 3: None}
    assert scan(odd).count() == 8 and scan(none).count() == 0
