"""Training samples: bounded at every size, never empty, long texts learnt."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quiver.llm import langid, toxicity
from quiver.llm.common import drawn, share_mark, table, within_bytes
from quiver.llm.queries import learnt_for_toxicity, op6_text_cnn

SF = "/root/testdata/sf0.1"


@pytest.mark.parametrize("rows", [10 ** 3, 4 * 10 ** 8, 5 * 10 ** 8, 2 * 10 ** 10, 10 ** 15])
def test_sample_shares_never_vanish(spark, rows):
    mark = share_mark(rows, 500)
    assert abs(mark / 2 ** 63 * rows / 500 - 1) < 0.01 if rows > 500 else mark == 2 ** 63 - 1
    # A table of 200,000 rows, taken as a class of `rows`: its share of the sample.
    ids = spark.range(200_000).selectExpr("id AS doc_id", "'x' AS lang")
    got = drawn(ids, "lang", {"x": min(rows, 2 * 10 ** 6)}, 500, seed=1).count()
    want = 500 * 200_000 / min(max(rows, 1), 2 * 10 ** 6) if rows > 200_000 else 100_000
    assert 0.5 * want < got < 1.6 * want


def test_bytes_are_bounded_by_whole_texts():
    batch = pa.RecordBatch.from_pydict({
        "lang": ["a"] * 5 + ["b"], "text": ["x" * 40, None, "y" * 40, "z" * 40, "w", "v" * 1000],
    })
    kept = within_bytes(iter([batch, batch]), "lang", 100)
    assert kept.column("text").to_pylist() == ["x" * 40, None, "y" * 40, "z" * 40, "v" * 1000]
    assert within_bytes(iter([]), "lang", 100).num_rows == 0


def test_long_texts_are_learnt(spark):
    rows = [(i, ("bad awful " if i % 2 else "fine nice ") * 4000, "en" if i % 2 else "fr", i % 2) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, toxic int")
    model = toxicity.fit(docs.drop("toxic"), docs.select("doc_id", "toxic"))
    scores = docs.select("toxic", toxicity.scorer(spark, model)(F.col("text")).alias("s")).collect()
    assert model and all((r.s >= toxicity.CUT) == bool(r.toxic) for r in scores)
    identify = langid.identifier(spark, langid.fit(docs))
    assert all(r.f.lang == r.lang for r in docs.select("lang", identify(F.col("text")).alias("f")).collect())


def test_too_many_languages_are_an_error(spark):
    docs = spark.range(langid.MAX_LANGS + 1).selectExpr("id AS doc_id", "'word' AS text", "concat('l', id) AS lang")
    with pytest.raises(ValueError):
        langid.fit(docs)


def test_recall_of_the_toxic_class(spark):
    found = op6_text_cnn(spark, SF).where("held_out").join(
        table(spark, SF, "labels").where(~learnt_for_toxicity()).select("doc_id", "toxic").distinct(), "doc_id"
    ).groupBy("toxic", "predicted").count().collect()
    n = {(r.toxic, r.predicted): r["count"] for r in found}
    assert n[1, 1] >= 0.9 * (n[1, 1] + n.get((1, 0), 0))
    assert n.get((0, 1), 0) <= 0.02 * (n[0, 0] + n.get((0, 1), 0))
