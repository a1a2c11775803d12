"""Named tables in a folder of Parquet or in a database over JDBC.

Both stores have the same four methods, so a job does not know which it uses.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce
from typing import TypeVar

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from starmart.contracts import DIMENSION_KEYS, TABLE_KEYS, project_to
from starmart.sources.clustered import read_clustered, write_clustered

R = TypeVar("R")


def at_once(work: Mapping[str, Callable[[], R]], jobs: int = 6) -> dict[str, R]:
    """Run independent jobs side by side, so that the last tasks of one do not idle the rest."""
    with ThreadPoolExecutor(max_workers=jobs) as pool:
        return dict(zip(work, pool.map(lambda run: run(), work.values())))


def _observed(df: DataFrame) -> tuple[DataFrame, Observation]:
    """The frame with a row count that its own write fills in."""
    rows = Observation()
    return df.observe(rows, F.count(F.lit(1)).alias("rows")), rows


@dataclass(frozen=True)
class ParquetStore:
    """One folder per table below ``root``.

    With ``buckets`` dimensions are stored in so many buckets of their key, and joins by it need not shuffle them. That
    takes effect if there are no fewer than ``spark.sql.shuffle.partitions``, and enough that a bucket fits a task.
    """

    spark: SparkSession
    root: str
    buckets: int = 0

    def clustered(self, table: str) -> bool:
        return self.buckets > 0 and table in DIMENSION_KEYS

    def read(self, table: str, schema: T.StructType | None = None) -> DataFrame:
        if self.clustered(table):
            return read_clustered(self.spark, f"{self.root}/{table}", DIMENSION_KEYS[table], self.buckets, schema)
        reader = self.spark.read.schema(schema) if schema else self.spark.read
        return reader.parquet(f"{self.root}/{table}")

    def write(self, df: DataFrame, table: str, schema: T.StructType, refresh: bool = True) -> int:
        """Store the contract columns and return the number of rows written.

        ``refresh`` replaces the table, otherwise rows are added. Rows are sorted
        by the table's key inside each file, which serves scans by key
        without a shuffle of the whole table.
        """
        pinned = project_to(df, schema)
        if self.clustered(table):
            counted, rows = _observed(pinned)
            write_clustered(counted, f"{self.root}/{table}", DIMENSION_KEYS[table], self.buckets, refresh)
            return rows.get["rows"]
        keys = [k for k in TABLE_KEYS.get(table, ()) if k in schema.names]
        counted, rows = _observed(pinned.sortWithinPartitions(*keys) if keys else pinned)
        counted.write.mode("overwrite" if refresh else "append").parquet(f"{self.root}/{table}")
        return rows.get["rows"]

    def replace(self, draft: ParquetStore, tables: Sequence[str]) -> None:
        """Move ``tables`` of ``draft``, on the same file system, in place of those here.

        Nothing is copied. If a move fails, those before it are undone. Tables that were
        here are set aside until all have moved; a driver that dies meanwhile leaves them in ``_old-...``.
        """
        jvm, aside = self.spark.sparkContext._jvm, f"{self.root}/_old-{uuid.uuid4().hex}"
        place = jvm.org.apache.hadoop.fs.Path
        files = place(self.root).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        absent = [t for t in tables if not files.exists(place(f"{draft.root}/{t}"))]
        if absent:
            raise FileNotFoundError(f"the draft lacks tables: {', '.join(absent)}")
        files.mkdirs(place(aside))
        moved: list[tuple[str, str]] = []

        def move(old: str, new: str) -> None:
            if not files.rename(place(old), place(new)):
                raise OSError(f"cannot move {old} to {new}")
            moved.append((old, new))

        try:
            for t in tables:
                if files.exists(place(f"{self.root}/{t}")):
                    move(f"{self.root}/{t}", f"{aside}/{t}")
                move(f"{draft.root}/{t}", f"{self.root}/{t}")
        except Exception:
            for old, new in reversed(moved):
                files.rename(place(new), place(old))
            files.delete(place(aside), False)  # empty again, or else it stays
            raise
        files.delete(place(aside), True)

    def count(self, table: str) -> DataFrame:
        return self.read(table).agg(F.count(F.lit(1)).alias("row_count"))


@dataclass(frozen=True)
class JdbcStore:
    """Tables of one database. ``properties`` holds user, password and driver.

    ``column_types`` spells a column of a contract in the database's words. With it a missing table is created before
    it is written, with the types, nullability, key and references that the contracts declare, which Spark's own writer
    cannot all say. ``create_options`` ends that statement, by table.
    """

    spark: SparkSession
    url: str
    properties: Mapping[str, str]
    schema_name: str | None = None
    write_options: Mapping[str, str] = field(default_factory=dict)
    create_options: Mapping[str, str] = field(default_factory=dict)
    column_types: Callable[[str, T.StructField], str] | None = None

    def qualified(self, table: str) -> str:
        return f"{self.schema_name}.{table}" if self.schema_name else table

    def read(
        self,
        table: str,
        schema: T.StructType | None = None,
        split: tuple[str, int, int, int] | None = None,
    ) -> DataFrame:
        """A table scan. ``split`` is (column, lower, upper, parts) for a parallel scan;
        the bounds only place the cuts, rows outside them are read as well."""
        reader = self.spark.read
        if split is None:
            rows = reader.jdbc(self.url, self.qualified(table), properties=dict(self.properties))
        else:
            column, lower, upper, parts = split
            rows = reader.jdbc(
                self.url, self.qualified(table), column, lower, upper, parts, properties=dict(self.properties)
            )
        return project_to(rows, schema) if schema else rows

    def query(self, sql: str) -> DataFrame:
        """The result of a query that the database itself runs."""
        return self.spark.read.jdbc(self.url, f"({sql}) t", properties=dict(self.properties))

    def key_split(self, table: str, key: str, parts: int) -> tuple[str, int, int, int]:
        """Cuts for a parallel scan over a numeric key, from one row the database computes."""
        row = self.query(f"SELECT MIN({key}) AS low, MAX({key}) AS high FROM {self.qualified(table)}").first()
        return key, int(row[0] or 0), int(row[1] or 0) + 1, parts

    def options(self, table: str, refresh: bool) -> dict[str, str]:
        """Writer options. A refresh empties the table and keeps its definition."""
        chosen = {**self.properties, **self.write_options}
        if refresh:
            chosen["truncate"] = "true"
        if table in self.create_options:
            chosen["createTableOptions"] = self.create_options[table]
        return chosen

    def create_statement(self, table: str, schema: T.StructType) -> str:
        """The statement that creates ``table`` with the columns of its contract, if there is none."""
        columns = ", ".join(f"{f.name} {self.column_types(table, f)}" for f in schema.fields)
        end = self.create_options.get(table, "")
        return f"CREATE TABLE IF NOT EXISTS {self.qualified(table)} ({columns}){end and ' ' + end}"

    def send(self, statement: str) -> None:
        """Let the database run a statement, on a connection of the driver's that Spark's session can load."""
        jvm = self.spark.sparkContext._jvm
        settings = jvm.java.util.Properties()
        for name, value in self.properties.items():
            settings.setProperty(name, value)
        loader = jvm.java.lang.Thread.currentThread().getContextClassLoader()
        driver = loader.loadClass(self.properties["driver"]).getDeclaredConstructor().newInstance()
        connection = driver.connect(self.url, settings)
        try:
            connection.createStatement().execute(statement)
        finally:
            connection.close()

    def write(self, df: DataFrame, table: str, schema: T.StructType, refresh: bool = True) -> int:
        if self.column_types:
            self.send(self.create_statement(table, schema))
        counted, rows = _observed(project_to(df, schema))
        mode = "overwrite" if refresh else "append"
        counted.write.mode(mode).jdbc(self.url, self.qualified(table), properties=self.options(table, refresh))
        return rows.get["rows"]

    def count(self, table: str) -> DataFrame:
        return self.query(f"SELECT COUNT(*) AS row_count FROM {self.qualified(table)}")


def count_tables(store: ParquetStore | JdbcStore, tables: Sequence[str]) -> DataFrame:
    """(``table_name``, ``row_count``) of stored tables, as one frame."""
    return union_counts((t, store.count(t)) for t in tables)


def union_counts(counts: Iterable[tuple[str, DataFrame]]) -> DataFrame:
    named = [
        df.select(F.lit(name).alias("table_name"), F.col("row_count").cast("bigint").alias("row_count"))
        for name, df in counts
    ]
    return reduce(DataFrame.unionByName, named)
