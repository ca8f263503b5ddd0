"""Session construction and staged tables.

On a cluster the checkpoint folder is the shared one named by
``spark.checkpoint.dir``; it is only filled in here when nothing is
configured and the master is local (tests, benches).
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Settings every job of this library is tuned for.  Shuffle partition count
# is left to the caller (cluster size); AQE coalesces small partitions and
# splits skewed join partitions at run time.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "landroll", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The reliable checkpoint folder of this session.

    Uses the folder already set on the context or ``spark.checkpoint.dir``.
    Only a local master without either gets a fresh temporary folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        configured = tempfile.mkdtemp(prefix="landroll-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def stage(df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared staging folder and read it back.

    Used at phase boundaries (identity, entity, parcel tables).  Unlike an
    RDD checkpoint, the staged table keeps column pruning, filter pushdown
    and file-size statistics for the joins that read it, and its plan is a
    leaf, so later phases do not re-plan the whole upstream lineage.
    ``folder`` defaults to a run folder under the session's checkpoint dir.
    """
    spark = df.sparkSession
    path = stage_path(spark, name, folder)
    df.write.mode("error").parquet(path)
    return spark.read.parquet(path)


# The staging folder of the job that runs in this context (thread).
_STAGING_FOLDER: ContextVar[str | None] = ContextVar("staging_folder", default=None)


def stage_path(spark: SparkSession, name: str, folder: str | None = None) -> str:
    """A fresh, unique path for a staged table.

    Inside :func:`staging_area` the path is under that run's folder,
    otherwise under ``<checkpoint dir>/stage``.
    """
    base = folder or _STAGING_FOLDER.get() or f"{checkpoint_dir(spark).rstrip('/')}/stage"
    return f"{base}/{name}-{uuid.uuid4().hex}"


@contextmanager
def staging_area(spark: SparkSession, name: str) -> Iterator[str]:
    """Stage every table of the enclosed job under one folder of its own; jobs of other threads are not affected."""
    folder = stage_path(spark, name)
    token = _STAGING_FOLDER.set(folder)
    try:
        yield folder
    finally:
        _STAGING_FOLDER.reset(token)


@contextmanager
def phase(spark: SparkSession, name: str) -> Iterator[None]:
    """Label the Spark jobs of the enclosed block (visible in event logs and job lists)."""
    sc = spark.sparkContext
    previous = sc.getLocalProperty("spark.job.description")
    sc.setJobDescription(f"landroll: {name}")
    try:
        yield
    finally:
        sc.setJobDescription(previous)


def _fs_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def drop_path(spark: SparkSession, path: str) -> bool:
    """Delete a folder recursively through the cluster's Hadoop filesystem API."""
    fs, hpath = _fs_path(spark, path)
    return bool(fs.delete(hpath, True))


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hpath = _fs_path(spark, path)
    return bool(fs.exists(hpath))


def make_folder(spark: SparkSession, path: str) -> None:
    """Create a folder; one that exists stays as it is."""
    fs, hpath = _fs_path(spark, path)
    fs.mkdirs(hpath)
