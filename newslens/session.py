"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(app: str = "newslens", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are written for.

    Shuffle width is left to adaptive execution: it coalesces small partitions and
    splits skewed join partitions at run time, so nothing here is tied to one size.
    Stream state lives in RocksDB, outside the heap, and is saved as changes.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
        .config("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
        # Extraction composes some thousand columns; without call sites that is quick.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the cluster.

    Only a session without ``spark.checkpoint.dir`` (a local test) gets a temporary
    folder, and that folder is then kept in the session so that later calls agree.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder:
        # "local-cluster" has executors of their own, which share no temporary folder.
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = spark.conf.get("newslens.scratch", None)
        if not folder:
            folder = tempfile.mkdtemp(prefix="newslens-")
            spark.conf.set("newslens.scratch", folder)
    return folder.rstrip("/")


def new_table_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/newslens/{name}-{uuid.uuid4().hex}"


def drop_table(spark: SparkSession, path: str) -> None:
    """Delete a table that was written to ``new_table_path`` and is no longer read."""
    if "/newslens/" not in path:
        raise ValueError(f"not a table of this package: {path}")
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
