"""Typed parquet tables under one root, replaced as a whole by writing a new version."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eavcube.operators.relational import append_rows
from eavcube.schemas import KEYS, SCHEMAS
from eavcube.sources.files import children, delete
from eavcube.sources.keyed import KeyedTable

# Between the name of a table and the key of a bucketed copy.
_BUCKETS = ".by-"


class TableStore:
    """Tables as `root/<name>/version=<n>`; readers take the newest complete version.

    A new version may be computed from the one it replaces, since nothing is overwritten. Tables that take keyed writes
    are stored in parts instead (`keyed`) and read the same way.
    """

    def __init__(self, spark: SparkSession, root: str, read_only: bool = False, pins: dict[str, int] | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.read_only = read_only
        self.pins = pins or {}

    def pinned(self, versions: dict[str, int]) -> TableStore:
        """The same tables, read as of the given versions."""
        return TableStore(self.spark, self.root, True, versions)

    def keyed(self, name: str, by: list[str] | None = None, parts: int = 64) -> KeyedTable:
        """The table in hash parts of its logical key, made from the stored version if there is one."""
        table = KeyedTable(self.spark, f"{self.root}/{name}", KEYS[name], by, parts)
        if not table.exists():
            if self.read_only:
                raise PermissionError(f"{self.root} is read-only")
            version = self._latest(name)
            rows = None if version is None else self.read(name)
            table.create(SCHEMAS[name] if rows is None else rows.schema, rows)
        return table

    def read(self, name: str) -> DataFrame:
        if self._in_parts(name):
            return KeyedTable(self.spark, f"{self.root}/{name}", KEYS[name]).read()
        version = self.pins.get(name) or self._latest(name)
        if version is None:
            raise KeyError(f"no table {name} under {self.root}")
        reader = self.spark.read.schema(SCHEMAS[name]) if name in SCHEMAS else self.spark.read
        return reader.parquet(self._path(name, version))

    def exists(self, name: str) -> bool:
        return self._in_parts(name) or self._latest(name) is not None

    def replace(self, name: str, df: DataFrame, partition_by: str | None = None) -> DataFrame:
        """Create or replace the table with the rows of a frame and return what was written.

        With `partition_by`, filters on that column skip files. The rebalance hint gathers each value into
        few files and splits values that are too large for one task.
        """
        if self.read_only:
            raise PermissionError(f"{self.root} is read-only")
        if self._in_parts(name):
            raise ValueError(f"{name} takes keyed writes only")
        version = (self._latest(name) or 0) + 1
        rows = df.hint("rebalance", partition_by) if partition_by else df
        writer = rows.write.mode("overwrite")
        writer = writer.partitionBy(partition_by) if partition_by else writer
        writer.parquet(self._path(name, version))
        return self.read(name)

    def replace_bucketed(self, name: str, df: DataFrame, key: str, buckets: int) -> DataFrame:
        """Store a copy of a table in buckets of a key, sorted by it, and return it.

        Two tables with equal buckets of the key they are joined on meet without a shuffle, and so do groups that have the
        key among theirs. The key and the number of buckets are part of the folder's name, so they always fit the files.
        """
        if self.read_only:
            raise PermissionError(f"{self.root} is read-only")
        stored = f"{name}{_BUCKETS}{key}-{buckets}"
        version = (self._latest(stored) or 0) + 1
        table = self._bucket_table(stored, version)
        # Dealt as the buckets are, so that each is one file.
        dealt = df.repartition(buckets, F.col(key)).write.bucketBy(buckets, key).sortBy(key)
        dealt.format("parquet").option("path", self._path(stored, version)).mode("overwrite").saveAsTable(table)
        return self.spark.table(table)

    def read_bucketed(self, name: str, key: str) -> DataFrame | None:
        """The newest bucketed copy of a table, or None; a new session registers its files again."""
        found = [c for c in children(self.spark, self.root) if c.startswith(f"{name}{_BUCKETS}{key}-")]
        for stored in sorted(found, key=lambda c: int(c.rsplit("-", 1)[1]), reverse=True):
            version = self._latest(stored)
            if version is None:
                continue
            table, path = self._bucket_table(stored, version), self._path(stored, version)
            if not self.spark.catalog.tableExists(table):
                columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.spark.read.parquet(path).schema.fields)
                self.spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) "
                               f"INTO {stored.rsplit('-', 1)[1]} BUCKETS LOCATION '{path}'")
            return self.spark.table(table)
        return None

    def _bucket_table(self, stored: str, version: int) -> str:
        return f"bucketed_{hashlib.md5(self._path(stored, version).encode()).hexdigest()}"

    def append(self, name: str, rows: DataFrame) -> DataFrame:
        return self.replace(name, append_rows(self.read(name), rows))

    def create_if_absent(self, name: str, schema: T.StructType | None = None) -> DataFrame:
        """The stored table, or an empty one with the declared schema."""
        if not self.exists(name):
            self.replace(name, self.spark.createDataFrame([], schema or SCHEMAS[name]))
        return self.read(name)

    def create_all(self) -> dict[str, DataFrame]:
        return {name: self.create_if_absent(name) for name in SCHEMAS}

    def names(self) -> list[str]:
        return [n for n in self._children(self.root) if _BUCKETS not in n and self.exists(n)]

    def describe(self) -> DataFrame:
        """(table, column, type) of every table."""
        rows = [
            (name, f.name, f.dataType.simpleString())
            for name in self.names() for f in self.read(name).schema.fields
        ]
        return self.spark.createDataFrame(rows, "`table` string, `column` string, `type` string")

    def row_counts(self) -> DataFrame:
        """(table, rows) of every table."""
        report = None
        for name in self.names():
            part = self.read(name).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows")
            report = part if report is None else report.unionByName(part)
        return report

    def register_views(self, prefix: str = "") -> list[str]:
        """Make every table a temporary view, so that it can be queried with SQL."""
        views = []
        for name in self.names():
            self.read(name).createOrReplaceTempView(prefix + name)
            views.append(prefix + name)
        return views

    def drop_view(self, name: str) -> bool:
        return self.spark.catalog.dropTempView(name)

    def expire(self, keep: int = 1) -> list[str]:
        """Delete all but the newest `keep` complete versions of every table, for when no reader holds an older one."""
        if self.read_only:
            raise PermissionError(f"{self.root} is read-only")
        gone = []
        for name in self.names():
            if self._in_parts(name):
                gone += KeyedTable(self.spark, f"{self.root}/{name}", KEYS[name]).expire()
                continue
            gone += [self._path(name, version) for version in self.versions(name)[:-keep]]
        for path in gone:
            delete(self.spark, path)
        return gone

    def versions(self, name: str) -> list[int]:
        """Numbers of the complete versions, oldest first."""
        return sorted(
            int(child.split("=")[1]) for child in children(self.spark, f"{self.root}/{name}")
            if child.startswith("version=") and "_SUCCESS" in children(self.spark, f"{self.root}/{name}/{child}")
        )

    def _path(self, name: str, version: int) -> str:
        return f"{self.root}/{name}/version={version:06d}"

    def _latest(self, name: str) -> int | None:
        return max(self.versions(name), default=None)

    def _in_parts(self, name: str) -> bool:
        return name in KEYS and KeyedTable(self.spark, f"{self.root}/{name}", KEYS[name]).exists()

    def _children(self, path: str) -> list[str]:
        return children(self.spark, path)


def copy_tables(source: TableStore, target: TableStore, names: list[str]) -> None:
    """Bring tables of a second, read-only root into the working root."""
    for name in names:
        target.replace(name, source.read(name))
