"""Corpus pipeline: toxicity, near duplicates, decontamination, mix, shards.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows that its
predecessor kept; all but the last return the columns of ``docs``.

Defined cases: rows with a null or empty text pass the filters; columns that
an operator also names are carried through unharmed; an empty table stays
empty. See the operators' docstrings for the rest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quiver.llm import mixing, toxicity
from quiver.llm.common import drop_rows_with, staged, table, text_key, unstaged
from quiver.llm.kd_shards import kd_shards
from quiver.llm.mixing import mix
from quiver.llm.near_dup import near_duplicates
from quiver.llm.queries import MIX, SHARDS, learnt_for_toxicity
from quiver.llm.spaced_seeds import decontaminate


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the classifier scores below its threshold."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), learnt_for_toxicity())
    score = toxicity.scorer(spark, model)
    return docs.where(score(F.col("text")) < toxicity.CUT)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates (five-word shingles, 0.8)."""
    found = staged(near_duplicates(docs, width=5, percent=80, keyed=True), "near-verdicts")

    def key(doc_id, text):
        # Rows are known by id and text: ids may be null or repeat.
        name = F.coalesce(doc_id.cast("string"), F.lit(""))
        return F.struct(F.xxhash64(name, text["a"], text["b"]).alias("a"), name.alias("id"), text.alias("text"))

    known, own = key(F.col("doc_id"), F.col("text_key")), key(F.col("doc_id"), text_key())
    counted = staged(
        found.groupBy(known.alias("_near_key")).agg(F.count(F.lit(1)).alias("n"), F.max("kept").alias("kept"), F.min("kept").alias("all")),
        "near-keys",
    )
    rest = drop_rows_with(docs, counted.where("NOT kept").select("_near_key"), own)
    # Rows equal in id and text, of which some go: one stays.
    repeated = staged(counted.where("kept AND NOT all").select("_near_key"), "near-repeated")
    if repeated.isEmpty():
        return rest
    once = drop_rows_with(rest, repeated, own)
    again = rest.withColumn("_near_key", own).join(repeated, "_near_key", "left_semi").dropDuplicates(["_near_key"])
    return once.unionByName(again.select(*docs.columns))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without a passage of ``benchmark``."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as the mix of sources draws them."""
    taken = {c: f"_doc_{i}" for i, c in enumerate(docs.columns) if c.lower() in mixing.OUTPUT}
    drawn = mix(docs.withColumnsRenamed(taken), **MIX, shards=SHARDS)
    return drawn.withColumnsRenamed({name: f"_mix_{name}" for name in mixing.OUTPUT}).withColumnsRenamed(
        {alias: c for c, alias in taken.items()}
    ).select(*docs.columns)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows with their shard and slot."""
    return kd_shards(docs, SHARDS)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", shard),
]

# The classifier and the minhash groups cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for at, (name, stage) in enumerate(STAGES[:-1]):
        before, docs = docs, staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if at:
            unstaged(before)
    return STAGES[-1][1](spark, docs, sf_dir)
