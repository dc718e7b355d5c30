"""Session helpers: a configured session for tests/bench and the shared
checkpoint folder taken from the cluster's own settings."""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # a listing of day partitions is a few tasks, not one a folder
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "32",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "ordersmith",
                  extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the deployment and is read, never replaced; a
    cluster without it is an error, since executors would not see each other's
    files. Only a ``local`` session gets a folder of its own.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder that all executors of {master} share")
        d = tempfile.mkdtemp(prefix="ordersmith-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder (for staged writes)."""
    return "/".join([checkpoint_dir(spark).rstrip("/"), *parts])


@contextlib.contextmanager
def freed_shuffles(spark: SparkSession):
    """Each write in this block removes its own shuffle files as it ends; else they lie there until the driver's garbage
    is collected. Not for iterators, which read on after the block."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def staged(df: DataFrame, path: str | None = None) -> DataFrame:
    """``df`` written once, to ``path`` or a fresh folder under the shared checkpoint folder, and read back from there
    by the columns that are asked for. The files stay; those of the shuffles that made them don't."""
    path = path or shared_path(df.sparkSession, "ordersmith-staged", uuid.uuid4().hex)
    with freed_shuffles(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _file_system(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether the path itself exists; any error of the store is raised."""
    fs, p = _file_system(spark, path)
    return bool(fs.exists(p))


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder that this session has written."""
    fs, p = _file_system(spark, path)
    fs.delete(p, True)


def move_partitions(spark: SparkSession, folder: str, path: str) -> None:
    """Put the partition folders (``column=value``) of ``folder`` in the place of those under ``path``, as Spark's own
    commit of a dynamic overwrite does; both are on one file system."""
    fs, p = _file_system(spark, folder)
    for d in fs.listStatus(p):
        name = d.getPath().getName()
        if "=" in name:
            to = spark._jvm.org.apache.hadoop.fs.Path(path, name)
            fs.delete(to, True)
            if not fs.rename(d.getPath(), to):
                raise OSError(f"{d.getPath()} could not be moved to {to}")
    fs.delete(p, True)


def path_size(spark: SparkSession, path: str) -> int:
    """Bytes of all files under a path."""
    fs, p = _file_system(spark, path)
    return int(fs.getContentSummary(p).getLength())
