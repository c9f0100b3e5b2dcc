"""Intermediate tables in the folder that the cluster shares.

A staged table cuts the lineage, survives the loss of executors, and gives
Catalyst the true file size, so that its broadcast decision for the table rests
on a measured number.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

_local_roots: dict[str, str] = {}
CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def scratch_root(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``; a temporary one only for local masters."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
    if context.applicationId not in _local_roots:
        _local_roots[context.applicationId] = tempfile.mkdtemp(prefix="gleaner-", dir="/tmp")
    return _local_roots[context.applicationId]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path that no other call uses."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str, codec: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back; the exchanges of the write go when it has ended.

    ``codec`` is that of the files, by default Spark's; texts and lists of terms take a third less disk with ``zstd``.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    before = spark.conf.get(CLEAN, None)
    spark.conf.set(CLEAN, "true")
    try:
        (df.write if codec is None else df.write.option("compression", codec)).parquet(path)
    finally:
        spark.conf.unset(CLEAN) if before is None else spark.conf.set(CLEAN, before)
    table = spark.read.schema(df.schema).parquet(path)
    table.staged_at = path
    return table


def stage_all(frames: Iterable[DataFrame], schema: StructType | str, label: str, codec: str | None = None) -> DataFrame:
    """:func:`stage` for the rows of many frames, which are written one after another; without a frame the table is empty."""
    spark, path = SparkSession.active(), None
    for df in frames:
        path = path or scratch_path(spark, label)
        (df.write if codec is None else df.write.option("compression", codec)).mode("append").parquet(path)
    if path is None:
        return stage(spark.createDataFrame([], schema), label)
    table = spark.read.schema(schema).parquet(path)
    table.staged_at = path
    return table


@contextmanager
def settings(spark: SparkSession, **values: str) -> Iterator[None]:
    """Session settings for a while, dots in their names written as ``__``."""
    named = {key.replace("__", "."): value for key, value in values.items()}
    before = {key: spark.conf.get(key, None) for key in named}
    for key, value in named.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def release(*tables: DataFrame) -> None:
    """Delete staged tables once everything made of them is staged itself.

    A table that some unfinished frame still reads must stay: Spark goes back
    to it when an executor is lost. What else the finished jobs left on disk
    is dropped with them.
    """
    for table in tables:
        spark = table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table.staged_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        forget(spark)


def forget(spark: SparkSession) -> None:
    """Let go of the exchanges of finished jobs: they are removed once the driver holds nothing of them any more."""
    spark._jvm.System.gc()
