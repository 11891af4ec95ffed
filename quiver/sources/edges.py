"""Edge sources: text / CSV readers and the edge view over the test tables.

An edge is ``follower -> followee`` (column 0 follows column 1). Readers
return ``(follower BIGINT, followee BIGINT)``, a bag: duplicate lines stay.
Lines that do not give two integer ids are dropped; the four rules differ in
what counts as "two ids":

``strict``     exactly two fields after a JVM-style split (trailing empty
               fields removed first): ``1,2,,`` is kept, ``9,`` and ``6,7,8``
               are dropped.
``lenient``    the first two fields; extra fields are ignored (``6,7,8`` ->
               ``(6,7)``).
``csv``        Spark's CSV reader with an explicit two-``LONG`` schema
               (PERMISSIVE: missing or bad cells become NULL and are dropped,
               extra cells are ignored); same rows as ``lenient``.
``tokenised``  non-empty tokens read as consecutive (follower, followee)
               pairs; yields one ``followee`` column (``1,2,3,4`` -> 2, 4) and
               never looks at the follower token.

With ``ids="text"`` the token itself is the id (``bob``, ``007`` and ``7``
differ; an empty token is no id); :func:`quiver.operators.ids.encode_edges`
makes such edges numeric.

:func:`line_report` counts the lines that a rule keeps and drops. What else to
do with a bad line is the ``bad`` option of :func:`read_edges` (``strict`` and
``lenient``): ``drop`` it, ``fail`` with its file and place, or ``stop``, which
keeps the rows before the first bad line of each file.
:func:`read_edges_permissive` keeps the rows of a CSV whose ids are NULL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quiver.functions.parsing import odd_position_tokens, split_fields, to_id

EDGE_SCHEMA = T.StructType(
    [
        T.StructField("follower", T.LongType(), False),
        T.StructField("followee", T.LongType(), False),
    ]
)

IDS = ("numeric", "text")
RULES = ("strict", "lenient", "csv", "tokenised")
BAD = ("drop", "fail", "stop")


def parse_strict(lines: DataFrame, sep: str = ",", ids: str = "numeric") -> DataFrame:
    """Lines with exactly two ids."""
    parts = split_fields(F.col("value"), sep)
    return _two_ids(lines.select(parts.alias("p")).where(F.size("p") == 2), ids)


def parse_lenient(lines: DataFrame, sep: str = ",", ids: str = "numeric") -> DataFrame:
    """The first two fields of lines that have at least two."""
    parts = split_fields(F.col("value"), sep)
    return _two_ids(lines.select(parts.alias("p")).where(F.size("p") >= 2), ids)


def parse_tokenised(lines: DataFrame, sep: str = ",", ids: str = "numeric") -> DataFrame:
    """Followee of every (follower, followee) token pair, as ``followee``."""
    followee = F.explode(odd_position_tokens(F.col("value"), sep))
    if ids == "text":
        return lines.select(followee.alias("followee"))
    return (
        lines.select(followee.alias("t"))
        .select(to_id(F.col("t")).alias("followee"))
        .where(F.col("followee").isNotNull())
    )


def _two_ids(parts: DataFrame, ids: str = "numeric") -> DataFrame:
    def read(token):
        return F.when(token != "", token) if ids == "text" else to_id(token)

    return (
        parts.select(
            read(F.col("p")[0]).alias("follower"),
            read(F.col("p")[1]).alias("followee"),
        )
        .where(F.col("follower").isNotNull() & F.col("followee").isNotNull())
    )


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Raw text lines, one column ``value``."""
    return spark.read.text(path)


def read_edges_csv(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """CSV with an explicit schema; rows with a NULL id are dropped.

    Both ids are referenced by the NULL filter, so CSV column pruning cannot
    keep a row whose other cell is malformed.
    """
    return (
        spark.read.schema(EDGE_SCHEMA)
        .option("sep", sep)
        .option("mode", "PERMISSIVE")
        .csv(path)
        .where(F.col("follower").isNotNull() & F.col("followee").isNotNull())
    )


def read_edges_permissive(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """CSV with an explicit schema, no row dropped: ``(follower, followee,
    corrupt)``. A missing or bad cell is NULL; ``corrupt`` is the whole line if
    a cell did not parse or the number of cells was wrong, else NULL.

    The three columns are read together, so the reader parses every cell
    whatever is selected later (it would prune the columns otherwise).
    """
    schema = T.StructType([
        T.StructField("follower", T.LongType()), T.StructField("followee", T.LongType()),
        T.StructField("corrupt", T.StringType()),
    ])
    rows = (
        spark.read.schema(schema).option("sep", sep).option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "corrupt")
        .option("spark.sql.csv.parser.columnPruning.enabled", "false").option("columnPruning", "false").csv(path)
    )
    whole = rows.select(F.struct("follower", "followee", "corrupt").alias("row"))
    return whole.where(F.col("row").isNotNull()).select("row.*")


def placed_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(value, file, block, at)``: every line with its file, the start of the
    block it was read in, and its order in that block. Within a file, lines
    are ordered by ``(block, at)``."""
    lines = spark.read.text(path)
    return lines.select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
    )


def _ids_of(lines: DataFrame, rule: str, sep: str, ids: str) -> DataFrame:
    """``lines`` with ``follower`` and ``followee``, both NULL on a bad line."""
    fields = split_fields(F.col("value"), sep)
    fits = F.size(fields) == 2 if rule == "strict" else F.size(fields) >= 2
    first, second = (
        F.when(F.get(fields, F.lit(k)) != "", F.get(fields, F.lit(k))) if ids == "text" else to_id(F.get(fields, F.lit(k)))
        for k in (0, 1)
    )
    good = F.coalesce(fits & first.isNotNull() & second.isNotNull(), F.lit(False))
    return lines.withColumns({"follower": F.when(good, first), "followee": F.when(good, second)})


def _fail_on_bad(spark: SparkSession, path: str, rule: str, sep: str, ids: str) -> DataFrame:
    """The edges of ``path``; the first bad line that a task meets ends the job."""
    rows = _ids_of(placed_lines(spark, path), rule, sep, ids)
    message = F.concat(
        F.lit("bad edge line in "), F.col("file"), F.lit(", block at byte "), F.col("block").cast("string"),
        F.lit(", line "), (F.col("at").bitwiseAND(F.lit((1 << 33) - 1)) + 1).cast("string"), F.lit(" of its task: "),
        F.col("value"),
    )
    # Both ids carry the check, so that neither can be pruned past it.
    checked = [
        F.when(F.col("follower").isNull(), F.raise_error(message).cast(kind)).otherwise(F.col(c)).alias(c)
        for c, kind in rows.select("follower", "followee").dtypes
    ]
    return rows.select(*checked)


def _until_bad(spark: SparkSession, path: str, rule: str, sep: str, ids: str) -> DataFrame:
    """The edges before the first bad line of each file: one row per file
    with a bad line is found first, then lines are compared with its place."""
    rows = _ids_of(placed_lines(spark, path), rule, sep, ids)
    first = rows.where(F.col("follower").isNull()).groupBy("file").agg(F.min(F.struct("block", "at")).alias("bad"))
    before = rows.where(F.col("follower").isNotNull()).join(first, "file", "left").where(
        F.col("bad").isNull() | (F.struct("block", "at") < F.col("bad"))
    )
    return before.select("follower", "followee")


def line_report(spark: SparkSession, path: str, rule: str = "strict", sep: str = ",") -> DataFrame:
    """``(lines, kept, dropped)`` of an edge directory under a rule that reads
    one edge a line (``strict`` or ``lenient``): observed in one pass."""
    parsers = {"strict": parse_strict, "lenient": parse_lenient}
    if rule not in parsers:
        raise ValueError(f"rule must be one of {tuple(parsers)}, got {rule!r}")
    seen, held = Observation("lines"), Observation("kept")
    lines = read_lines(spark, path).observe(seen, F.count(F.lit(1)).alias("n"))
    parsers[rule](lines, sep).observe(held, F.count(F.lit(1)).alias("n")).write.format("noop").mode("overwrite").save()
    n, kept = seen.get["n"], held.get["n"]
    return spark.createDataFrame([(n, kept, n - kept)], "lines bigint, kept bigint, dropped bigint")


def read_edges(
    spark: SparkSession, path: str, rule: str = "strict", sep: str = ",", ids: str = "numeric", bad: str = "drop"
) -> DataFrame:
    """Read an edge directory under one of :data:`RULES`; ``ids="text"`` is
    not for ``csv``, whose schema is numeric."""
    if ids not in IDS or (ids == "text" and rule == "csv"):
        raise ValueError(f"ids must be one of {IDS}, text not with rule='csv'; got {ids!r}, {rule!r}")
    if bad not in BAD or (bad != "drop" and rule not in ("strict", "lenient")):
        raise ValueError(f"bad must be one of {BAD}, other than drop only with strict or lenient; got {bad!r}, {rule!r}")
    if bad != "drop":
        return (_fail_on_bad if bad == "fail" else _until_bad)(spark, path, rule, sep, ids)
    if rule == "csv":
        return read_edges_csv(spark, path, sep)
    lines = read_lines(spark, path)
    if rule == "strict":
        return parse_strict(lines, sep, ids)
    if rule == "lenient":
        return parse_lenient(lines, sep, ids)
    if rule == "tokenised":
        return parse_tokenised(lines, sep, ids)
    raise ValueError(f"rule must be one of {RULES}, got {rule!r}")


def edge_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The follower graph over the test tables: each line item is an edge
    from the ordering customer to the part, ``o_custkey -> l_partkey``.

    One shared id space, a bag with duplicates, self-loops, sinks and cycles.
    Only the four key columns are read (pruned at the parquet scan).
    """
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_orderkey", "l_partkey")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_custkey")
    return (
        lineitem.join(orders, lineitem.l_orderkey == orders.o_orderkey, "inner")
        .select(F.col("o_custkey").alias("follower"), F.col("l_partkey").alias("followee"))
        .where(F.col("follower").isNotNull() & F.col("followee").isNotNull())
    )
