"""A folder of Parquet tables in which every load is published as a whole.

Below the root, ``loads`` has one folder per load with the tables that it wrote, and ``versions`` one small numbered
file per version, which says in which folders each table lies. A load writes its folder
first; the file that names it appears last and makes all of its tables visible in one step. Nothing is moved or
overwritten, so this works where moving is copying, and whoever reads a version is not disturbed by later loads.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from starmart.contracts import DIMENSION_KEYS
from starmart.sources.clustered import read_clustered
from starmart.sources.tables import ParquetStore

KEPT = 3  # versions that stay readable


class Conflict(RuntimeError):
    """Tables that a load was made from have changed meanwhile."""


@dataclass(frozen=True)
class Snapshot:
    """The tables of one version. Number 0 is the empty store."""

    spark: SparkSession
    root: str
    number: int = 0
    tables: Mapping[str, Sequence[str]] = field(default_factory=dict)  # folders below the root
    buckets: Mapping[str, int] = field(default_factory=dict)  # of tables that are stored in buckets of their key

    def read(self, table: str, schema: T.StructType | None = None) -> DataFrame:
        if table not in self.tables:
            raise FileNotFoundError(f"version {self.number} of {self.root} has no table {table}")
        folders = [f"{self.root}/{folder}" for folder in self.tables[table]]
        if table in self.buckets and len(folders) == 1:
            return read_clustered(self.spark, folders[0], DIMENSION_KEYS[table], self.buckets[table], schema)
        reader = self.spark.read.schema(schema) if schema else self.spark.read
        return reader.parquet(*folders)

    def count(self, table: str) -> DataFrame:
        return self.read(table).agg(F.count(F.lit(1)).alias("row_count"))


@dataclass(frozen=True)
class VersionedStore:
    """Tables of which readers see the newest complete version.

    ``read`` and ``count`` look the version up each time; who needs several tables of one version takes a ``snapshot``. The
    ``kept`` newest versions stay, so a reader may lag behind by as many loads. ``buckets`` is for the loads made
    from here, see ``ParquetStore``; a version says of each table how it is stored.
    """

    spark: SparkSession
    root: str
    kept: int = KEPT
    buckets: int = 0

    # --- files ---

    def _place(self, path: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{path}")

    def _files(self):
        return self._place("versions").getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _numbers(self) -> list[int]:
        """Of all files of versions, whole or not, newest first."""
        files, folder = self._files(), self._place("versions")
        names = [s.getPath().getName() for s in files.listStatus(folder)] if files.exists(folder) else []
        return sorted((int(n.removesuffix(".json")) for n in names if n.removesuffix(".json").isdigit()), reverse=True)

    def _version(self, number: int) -> Snapshot | None:
        """A version, or None if its file is not whole: its load has died, or has not ended."""
        stream = self._files().open(self._place(f"versions/{number:012}.json"))
        try:
            text = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        try:
            held = json.loads(text)
            return Snapshot(self.spark, self.root, number, held["tables"], held.get("buckets", {}))
        except (ValueError, KeyError, TypeError):
            return None

    def _versions(self) -> list[Snapshot]:
        return [v for v in map(self._version, self._numbers()) if v is not None]

    # --- reading ---

    def snapshot(self) -> Snapshot:
        """The newest version that is whole."""
        for number in self._numbers():
            version = self._version(number)
            if version is not None:
                return version
        return Snapshot(self.spark, self.root)

    def read(self, table: str, schema: T.StructType | None = None) -> DataFrame:
        return self.snapshot().read(table, schema)

    def count(self, table: str) -> DataFrame:
        return self.snapshot().count(table)

    # --- loads ---

    def draft(self) -> ParquetStore:
        """A new folder for the tables of a load, which no reader sees before ``publish``."""
        return ParquetStore(self.spark, f"{self.root}/loads/{uuid.uuid4().hex}", self.buckets)

    def discard(self, draft: ParquetStore) -> None:
        """Delete the folder of a load that will not be published."""
        self._files().delete(self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(draft.root), True)

    def publish(self, draft: ParquetStore, tables: Sequence[str], made_from: Snapshot | None = None, add: bool = False) -> Snapshot:
        """Make ``tables`` of ``draft`` the newest version, together with all other tables as they are.

        ``made_from`` is the version that the load has read. If a table of it that is not replaced here has another content by now,
        nothing is published: a ``Conflict``. ``add`` adds the rows to those there are instead of replacing them.
        A driver that dies before the last step leaves the version before as the newest.
        """
        jvm, files, folder = self.spark.sparkContext._jvm, self._files(), draft.root.removeprefix(f"{self.root}/")
        absent = [t for t in tables if not files.exists(jvm.org.apache.hadoop.fs.Path(f"{draft.root}/{t}"))]
        if absent:
            raise FileNotFoundError(f"the draft lacks tables: {', '.join(absent)}")
        while True:
            latest = self.snapshot()
            old = {t: v for t, v in (made_from.tables if made_from else {}).items() if t not in tables}
            changed = sorted(t for t, v in old.items() if list(latest.tables.get(t, ())) != list(v))
            if changed:
                raise Conflict(f"not published, changed since version {made_from.number}: {', '.join(changed)}")
            new = {t: [*(latest.tables.get(t, ()) if add else ()), f"{folder}/{t}"] for t in tables}
            number = max([0, *self._numbers()]) + 1
            buckets = {t: n for t, n in latest.buckets.items() if t not in tables}
            buckets |= {t: draft.buckets for t in tables if draft.clustered(t)}
            if self._name(number, {**latest.tables, **new}, buckets):
                self._forget()
                return Snapshot(self.spark, self.root, number, {**latest.tables, **new}, buckets)

    def _name(self, number: int, tables: Mapping[str, Sequence[str]], buckets: Mapping[str, int]) -> bool:
        """Write the file of a version, or nothing if another load has taken the number."""
        place, files = self._place(f"versions/{number:012}.json"), self._files()
        if files.exists(place):
            return False
        try:
            stream = files.create(place, False)
        except Exception as taken:
            if files.exists(place) and "exist" in str(taken).lower():
                return False
            raise
        try:
            stream.write(bytearray(json.dumps({"tables": tables, "buckets": buckets}), "utf-8"))
        finally:
            stream.close()
        return True

    def _forget(self) -> None:
        """Delete versions beyond ``kept``, and the folders that only they name."""
        versions, files = self._versions(), self._files()
        needed = {f for v in versions[: self.kept] for folders in v.tables.values() for f in folders}
        for version in versions[self.kept :]:
            files.delete(self._place(f"versions/{version.number:012}.json"), False)
            for folder in {f for folders in version.tables.values() for f in folders} - needed:
                files.delete(self._place(folder), True)

    def clear_dead_loads(self, older_than_seconds: float) -> list[str]:
        """Delete the folders of loads that no version names and in which nothing has begun for that long; their names.

        They are left by drivers that died. The time has to be longer than any load takes.
        """
        files, top, cleared = self._files(), self._place("loads"), []
        named = {"/".join(f.split("/")[:2]) for v in self._versions() for folders in v.tables.values() for f in folders}
        for status in files.listStatus(top) if files.exists(top) else []:
            load, limit = f"loads/{status.getPath().getName()}", 1000 * (time.time() - older_than_seconds)
            if load not in named and status.getModificationTime() < limit:
                files.delete(status.getPath(), True)
                cleared.append(load)
        return cleared

    def write(self, df: DataFrame, table: str, schema: T.StructType, refresh: bool = True) -> int:
        """Store one table and publish it by itself; the number of rows written. Without ``refresh`` rows are added."""
        draft = self.draft()
        try:
            rows = draft.write(df, table, schema)
            self.publish(draft, [table], add=not refresh)
        except BaseException:
            self.discard(draft)
            raise
        return rows
