"""Intermediate tables that cut lineage and survive the loss of executors."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
FOLDERS = 16  # files that a task of a partitioned write may hold open


@contextmanager
def _held(spark: SparkSession, setting: str, value: str) -> Iterator[None]:
    before = spark.conf.get(setting, None)
    spark.conf.set(setting, value)
    try:
        yield
    finally:
        spark.conf.unset(setting) if before is None else spark.conf.set(setting, before)


@contextmanager
def side_by_side(spark: SparkSession) -> Iterator[None]:
    """Partitioned writes keep the files of up to ``FOLDERS`` folders open in a task, and sort only rows of further ones.

    Otherwise a task sorts all of its rows by folder, and spills them.
    """
    with _held(spark, _WRITERS, str(FOLDERS)):
        yield


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Writes that end in the block delete the files of their shuffles.

    Otherwise these lie on the disks until the driver's JVM happens to collect its garbage, those of all steps at once.
    """
    with _held(spark, _CLEANUP, "true"):
        yield


def shared_folder(spark: SparkSession) -> str:
    """The folder all machines of the cluster can reach.

    It is the session's ``spark.checkpoint.dir``, or what the context was given in
    its place. Only a local session, where driver and executors are one process,
    may fall back to a temporary folder.
    """
    context = spark.sparkContext
    folder = spark.conf.get(_SETTING, None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError(f"set {_SETTING} to a folder that every executor can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="starmart-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


class Staging:
    """Writes frames below one folder of its own and hands back readers."""

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = f"{root or shared_folder(spark)}/starmart-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        """A new folder, whatever else has the same name."""
        return f"{self.root}/{name}-{uuid.uuid4().hex[:8]}"

    def keep(self, df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
        """Run ``df`` once; later reads see exactly these rows, column by column."""
        return self.keep_at(df, self.path(name), compression)

    def keep_at(self, df: DataFrame, path: str, compression: str | None = None) -> DataFrame:
        df.write.parquet(path, compression=compression)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, path: str | None = None) -> None:
        """Delete one folder from ``path()``, or all of them, once nothing reads from there."""
        jvm = self.spark.sparkContext._jvm
        folder = jvm.org.apache.hadoop.fs.Path(path or self.root)
        folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
