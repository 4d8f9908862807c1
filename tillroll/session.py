"""SparkSession construction and shared-folder helpers."""

from __future__ import annotations

import atexit
import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every tillroll job relies on.  AQE re-plans joins from runtime
# sizes, coalesces small shuffle partitions and splits skewed join partitions.
#
# Partition sizing on a cluster (not set here; it belongs to the cluster):
# set spark.sql.shuffle.partitions to about input bytes / 128 MB (at least a
# few times the total cores) and let AQE coalesce toward
# spark.sql.adaptive.advisoryPartitionSizeInBytes; keep
# spark.sql.files.maxPartitionBytes at 128-512 MB so scan tasks fit in
# executor memory.  Ordered scans and the load adapt to these settings.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_ROOTS: set[str] = set()


def build_session(master: str | None = None, app: str = "tillroll",
                  shuffle_partitions: int | None = None,
                  extra_conf: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the tillroll defaults.

    ``master`` and ``shuffle_partitions`` are only for local runs; on a
    cluster leave them unset and let the cluster configuration decide.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting points at shared storage and is only read
    here; without it a clear error says so.  A session whose driver and
    executors are one process (master ``local[...]``) gets a private folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("spark.checkpoint.dir is not set: written tables need a folder that the driver "
                               "and all executors share")
        configured = tempfile.mkdtemp(prefix="tillroll-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_root(spark: SparkSession) -> str:
    """This application's folder for written tables, removed when the driver ends."""
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tillroll-{spark.sparkContext.applicationId}"
    if root not in _ROOTS:
        _ROOTS.add(root)
        atexit.register(remove_scratch, spark, root)
    return root


def remove_scratch(spark: SparkSession, root: str) -> None:
    """Delete the folder ``root``; a session that was stopped already leaves it to the cluster's own cleaning."""
    if spark.sparkContext._jsc is None:
        return
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a written table inside the shared checkpoint folder."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def stable_path(spark: SparkSession, name: str) -> str:
    """The path of a table that is written again under the same name and then replaced."""
    return f"{scratch_root(spark)}/{name}"


@contextmanager
def shuffle_files_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a finished write are not needed again; Spark removes them."""
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def write_table(df: DataFrame, path: str, mode: str = "error", by: list[str] | None = None) -> None:
    """Write ``df`` as a parquet table of ours: zstd, and its shuffle files go when it is written."""
    writer = df.write.mode(mode).option("compression", "zstd")
    with shuffle_files_removed(df.sparkSession):
        (writer.partitionBy(*by) if by else writer).parquet(path)


def local_path(uri: str) -> str:
    """Strip a ``file:`` scheme (for tests that inspect written files)."""
    if uri.startswith("file:"):
        uri = uri[len("file:"):]
        while uri.startswith("//"):
            uri = uri[1:]
    return os.path.normpath(uri)
