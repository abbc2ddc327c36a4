"""Intermediate tables in the folder that all machines of the cluster share."""

from __future__ import annotations

import tempfile
import threading
import uuid
import weakref
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: For the time of the job that writes a table: its shuffle files are of no more use when it ends, so Spark removes them; and an
#: Arrow batch, which the JVM, Python and what Python makes of it hold at once, has fewer bytes than Spark's default.
_WHILE_WRITING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.execution.arrow.maxBytesPerBatch": "16m"}
_DEFAULTS = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "false", "spark.sql.execution.arrow.maxBytesPerBatch": "67108864b"}
_paths: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()
_lock = threading.Lock()
_writers: weakref.WeakKeyDictionary[SparkSession, int] = weakref.WeakKeyDictionary()


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. Where none is set, a temporary one on a single machine; several machines must name one."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        checkpoint = spark.sparkContext._jsc.sc().getCheckpointDir()
        found = checkpoint.get() if checkpoint.isDefined() else None
    if not found:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="pairloom-"))
        found = spark.sparkContext._jsc.sc().getCheckpointDir().get()
    return found


@contextmanager
def _while_writing(spark: SparkSession) -> Iterator[None]:
    """The settings above, where the session has Spark's defaults; the last of several writers puts these back."""
    with _lock:
        _writers[spark] = _writers.get(spark, 0) + 1
        for key, value in _WHILE_WRITING.items():
            if spark.conf.get(key) == _DEFAULTS[key]:
                spark.conf.set(key, value)
    try:
        yield
    finally:
        with _lock:
            _writers[spark] -= 1
            for key, value in _WHILE_WRITING.items():
                if not _writers[spark] and spark.conf.get(key) == value:
                    spark.conf.unset(key)


def _filesystem(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def stash(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write `df` as Parquet below the shared folder and read it back: the lineage ends there, and any executor can be lost.

    partition_by: a column each of whose values gets files of its own. The files go by discard(), or when the driver's JVM ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/pairloom/{name}-{uuid.uuid4().hex}"
    writer = df.write.option("compression", "zstd")
    with _while_writing(spark):
        (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    where, files = _filesystem(spark, path)
    files.deleteOnExit(where)
    found = spark.read.schema(df.schema).parquet(path)
    _paths[found] = path
    return found


def discard(*tables: DataFrame) -> None:
    """Delete tables that stash() returned. Nothing that reads them may run afterwards."""
    for table in tables:
        path = _paths.pop(table, None)
        if path:
            where, files = _filesystem(table.sparkSession, path)
            files.delete(where, True)
