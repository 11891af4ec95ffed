"""Toxicity learns from every labelled row, however training is cut into chunks and shards."""

from pyspark.sql import functions as F

from quiver.llm import toxicity


def test_every_row_is_learnt(spark, monkeypatch):
    # Chunks of a text, shards of about 40 rows, a tree of two levels.
    for name, value in (("TRAIN_BYTES", 1), ("SHARD_ROWS", 40), ("FAN_IN", 3)):
        monkeypatch.setattr(toxicity, name, value)
    rows = [(i, f"{'bad' if i % 2 else 'fine'}{i % 20} {'vile' if i % 2 else 'nice'}{i % 14} word", "en", i % 2) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, toxic int")
    model = toxicity.fit(docs.drop("toxic"), docs.select("doc_id", "toxic"))
    found = docs.select("toxic", (toxicity.scorer(spark, model)(F.col("text")) >= toxicity.CUT).cast("int").alias("p"))
    assert found.where("toxic = p").count() >= 390


def test_threshold_from_counts():
    steps = {int(k * toxicity.STEPS): [10, 0] if k < 1 else [0, 10] for k in (-3, -1, 2, 4)}
    cut = toxicity._best_cut(steps)
    assert toxicity._sigmoid(-1) < cut < toxicity._sigmoid(2)
    counts = [{"guess": g, "toxic": t, "step": s, "n": n} for g in (0, 1) for s, both in steps.items() for t, n in enumerate(both) if n]
    assert all(abs(c - cut) < 1e-12 for c in toxicity._cuts(counts, 3))
