"""Session construction and the shared folder used for staging and checkpoints."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every quiver job relies on. AQE re-plans joins from runtime sizes,
# coalesces small shuffle partitions and splits skewed join partitions (a hot
# follower / followee id), so no static hint is needed for the common case.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Delete checkpoint files of rounds that are no longer referenced.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(
    master: str | None = None,
    app_name: str = "quiver",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with quiver's defaults.

    On a cluster pass ``master=None`` and let spark-submit decide; size
    ``shuffle_partitions`` so one shuffle partition stays ~128-256 MB at the
    target data size.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    The folder is taken from the session (``spark.checkpoint.dir`` or a
    directory already set on the context). Only a local-mode session without
    one (tests, a laptop) gets a fresh folder of its own; on a cluster a
    missing setting is an error, because a machine-local folder would not be
    visible to other executors.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not _is_local(spark):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a shared folder "
                "(HDFS, S3, ...) visible to every executor"
            )
        configured = tempfile.mkdtemp(prefix="quiver-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def staging_path(spark: SparkSession, label: str) -> str:
    """A new, unique folder below the shared checkpoint folder, deleted when
    the application ends."""
    base = checkpoint_dir(spark).rstrip("/")
    path = f"{base}/quiver-staging/{label}-{uuid.uuid4().hex}"
    sc = spark.sparkContext
    hadoop_path = sc._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(sc._jsc.hadoopConfiguration())
    # Hadoop only marks a path that exists.
    fs.mkdirs(hadoop_path)
    fs.deleteOnExit(hadoop_path)
    return f"{path}/data"


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme so a path can be used by plain Python tools."""
    if path.startswith("file:"):
        path = path[len("file:"):]
        while path.startswith("//"):
            path = path[1:]
    return os.path.abspath(path)
