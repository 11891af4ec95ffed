import pytest

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def odd(spark, tmp_path):
    """Documents with nulls, empty, very long, repeated and equal texts, and
    extra columns named like operators' outputs."""
    rows = [
        (1, None, None, None, None), (2, "", "en", "a", 0), (3, "the cat sat on the mat today", "en", "a", 28),
        (4, "the cat sat on the mat today", "de", "b", 28), (4, "the cat sat on the mat today", "de", "b", 28),
        (5, "word " * 30000, "en", "a", 150000), (None, "no id here at all", "fr", "c", 17),
        (6, "Ünïcode wörds — ok", "de", "b", 18),
    ]
    df = spark.createDataFrame(rows, COLUMNS)
    return df.selectExpr("*", "1 AS size", "'x' AS shard", "2 AS slot", "'y' AS target", "0 AS kept", "5 AS n")


@pytest.fixture
def none(odd):
    return odd.limit(0)
