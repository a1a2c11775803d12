"""Parquet folders whose rows lie in buckets of one key, so that a join by this key leaves them where they are.

Spark knows buckets from its catalog only. So a folder is declared there under a passing name while a frame is made or
written; the entry is external and dropped at once, and the frame goes on knowing the files and their buckets.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, types as T


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


@contextmanager
def _declared(spark: SparkSession, path: str, schema: T.StructType, key: str, buckets: int) -> Iterator[str]:
    """The name under which ``path`` is a table of the current database for as long as the block runs."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    location = files.makeQualified(folder).toString().replace("\\", "\\\\").replace("'", "\\'")
    columns = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in schema)
    name, by = f"clustered_{uuid.uuid4().hex}", _quoted(key)
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS LOCATION '{location}'"
    )
    try:
        yield name
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def write_clustered(df: DataFrame, path: str, key: str, buckets: int, refresh: bool = True) -> None:
    """Store ``df`` with one sorted file per bucket of ``key``.

    The rows are shuffled once, by the hash that the buckets have, so no task writes small files for all of them. Keys
    should be unique or nearly so: a bucket is one task's work.
    """
    placed = df.repartition(buckets, df[_quoted(key)]).sortWithinPartitions(_quoted(key))
    with _declared(df.sparkSession, path, df.schema, key, buckets) as name:
        placed.write.insertInto(name, overwrite=refresh)


def read_clustered(spark: SparkSession, path: str, key: str, buckets: int, schema: T.StructType | None = None) -> DataFrame:
    """What ``write_clustered`` has stored, as a table that Spark knows to be dealt out by ``key``."""
    held = schema or spark.read.parquet(path).schema
    with _declared(spark, path, held, key, buckets) as name:
        return spark.table(name)
