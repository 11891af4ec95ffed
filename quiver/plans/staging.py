"""Stand-in inputs for the reader queries, rendered from the test tables.

The test data is parquet; the edge readers and the node-table reader parse
text. These helpers write the edge view out in the text layout those readers
expect (into the shared checkpoint folder) and return the folder. They only
render rows; all parsing is left to the readers under test.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quiver.session import staging_path
from quiver.sources import edge_view

# The malformed-line fixture appended to every rendered edge
# file (one entry per line; "" is an empty line). Kept rows per reader:
#   strict     (1,2) (3,1) (3,1) (1,2)
#   lenient    (1,2) (3,1) (3,1) (6,7) (1,2) (1,2)   -- csv gives the same
#   tokenised  2 1 1 4 7 2 4 2
MALFORMED_LINES = ["1,2", "3,1", "3,1", "x,4", "5", "6,7,8", "", "9,", ",9", "1,2,3,4", "1,2,,"]


def edge_lines(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """``follower,followee`` text lines plus the fixed malformed lines."""
    rendered = edges.select(F.concat_ws(",", "follower", "followee").alias("value"))
    extra = spark.createDataFrame([(line,) for line in MALFORMED_LINES], "value string")
    return rendered.unionByName(extra)


# (application, input folder, state of its tables) -> its rendered edge lines
_edge_text: dict[tuple, str] = {}


def _table_state(spark: SparkSession, path: str) -> tuple[int, int]:
    """Bytes and time of change: another table at the same path differs."""
    context = spark.sparkContext
    where = context._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(context._jsc.hadoopConfiguration())
    return fs.getContentSummary(where).getLength(), fs.getFileStatus(where).getModificationTime()


def stage_edge_text(spark: SparkSession, sf_dir: str) -> str:
    """The edge view as text: one copy per application and input, shared by
    the reader queries and deleted when the application ends. A table that
    was replaced in the meantime is rendered anew."""
    states = [_table_state(spark, f"{sf_dir}/{name}.parquet") for name in ("lineitem", "orders")]
    key = (spark.sparkContext.applicationId, sf_dir, *states)
    if key not in _edge_text:
        path = staging_path(spark, "edges-text")
        edge_lines(spark, edge_view(spark, sf_dir)).write.text(path)
        _edge_text[key] = path
    return _edge_text[key]


def stage_text_ids(spark: SparkSession, edges: DataFrame) -> str:
    """Edge lines whose followee is a text id: ``p<id>`` where the id is a
    multiple of 3, padded to ten digits where it is odd, else the id."""
    followee = F.col("followee").cast("string")
    named = (
        F.when(F.col("followee") % 3 == 0, F.concat(F.lit("p"), followee))
        .when(F.col("followee") % 2 == 1, F.lpad(followee, 10, "0"))
        .otherwise(followee)
    )
    path = staging_path(spark, "edges-text-ids")
    edges.select(F.concat_ws(",", "follower", named).alias("value")).write.text(path)
    return path


def stage_files_with_bad_lines(spark: SparkSession, edges: DataFrame) -> str:
    """Edge lines in one file per remainder of the follower modulo
    ``BAD_FILES``, sorted by edge. In files whose number is no multiple of 4, a
    bad line follows the edges with a follower divisible by 7 and a followee
    divisible by 11."""
    file = F.pmod("follower", F.lit(BAD_FILES))
    lines = edges.select(file.alias("file"), "follower", "followee", F.lit(0).alias("bad"), F.concat_ws(",", "follower", "followee").alias("value"))
    bad = lines.where("file % 4 <> 0 AND follower % 7 = 0 AND followee % 11 = 0").distinct()
    bad = bad.withColumn("bad", F.lit(1)).withColumn("value", F.lit("no edge"))
    path = staging_path(spark, "edges-bad-lines")
    lines.unionByName(bad).repartition("file").sortWithinPartitions("file", "follower", "followee", "bad").select(
        "file", "value"
    ).write.partitionBy("file").text(path)
    return path


# Files of the rendering with bad lines.
BAD_FILES = 32

# Node lines appended to every rendered node table. Node -5 has
# an absent neighbour and the sink; the others do not parse and are dropped.
EXTRA_NODE_LINES = ["-5\t-99\t0.25", "-5\t0\t0.25", "-6\tabc\t0.5", "x\t1\t0.5", "-7\t1"]


def stage_node_table(spark: SparkSession, edges: DataFrame) -> str:
    """Node lines ``id <TAB> neighbour <TAB> rank``: one per edge, plus one
    with the sink 0 as neighbour for each user without an out-edge. Ids are
    shifted by one, so that no user is the sink; the start rank is
    ``(1 + id % 3) / 1024``. The fixed extra lines follow."""
    shifted = edges.select((F.col("follower") + 1).alias("id"), (F.col("followee") + 1).alias("to"))
    users = shifted.select(F.explode(F.array(
        F.struct("id", F.lit(1).alias("out")), F.struct(F.col("to").alias("id"), F.lit(0).alias("out"))
    )).alias("u")).select("u.*")
    without_out = users.groupBy("id").agg(F.max("out").alias("out")).where("out = 0")
    start = ((F.col("id") % 3 + 1) / F.lit(1024.0)).cast("string")
    lines = shifted.unionByName(without_out.select("id", F.lit(0).cast("bigint").alias("to"))).select(
        F.concat_ws("\t", "id", "to", start).alias("value")
    )
    extra = spark.createDataFrame([(line,) for line in EXTRA_NODE_LINES], "value string")
    path = staging_path(spark, "node-table")
    lines.unionByName(extra).write.text(path)
    return path
