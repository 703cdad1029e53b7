"""Parquet tables in hash parts of a key, so that a keyed write reads and writes only the parts its keys fall into."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eavcube.operators.ordered import checkpoint
from eavcube.operators.relational import add_column, not_in
from eavcube.operators.skew import same_keys
from eavcube.operators.window import keep_first
from eavcube.sources.files import children, delete

_PART, _WRITE, _SCHEMA = "__part", "__write", "__schema"
_SET, _ADD = "set", "add"


class KeyedTable:
    """A table as `path/parts=<n>/__write=<number>-<kind>/__part=<p>`.

    Nothing is overwritten. A write of kind `set` stands for all rows of the parts it has, one of kind `add` brings
    further rows; a part consists of its newest `set` and the `add`s after it. Writes without Spark's success mark do
    not count, so a reader or a repeated job never sees half of one. `keys` identify a row, `by` (some of them) choose
    the part. The number of parts belongs to the table: choose it so that a part fits a task.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], by: Sequence[str] | None = None, parts: int = 64):
        self.spark, self.keys, self.by = spark, list(keys), list(by or keys)
        stored = [c for c in children(spark, path) if c.startswith("parts=")]
        self.parts = int(stored[0].split("=")[1]) if stored else parts
        self.root = f"{path.rstrip('/')}/parts={self.parts}"

    # Reading

    def exists(self) -> bool:
        return bool(self._numbers(_SCHEMA))

    def create(self, schema: T.StructType, rows: DataFrame | None = None) -> KeyedTable:
        """Declare the columns unless the table exists, with its first rows. It exists once they are written."""
        if not self.exists():
            if rows is not None:
                self._write(rows.select(*[f"`{n}`" for n in schema.names]), _SET)
            self._declare(schema)
        return self

    @property
    def schema(self) -> T.StructType:
        """The columns last declared."""
        numbers = self._numbers(_SCHEMA)
        if not numbers:
            raise KeyError(f"no table under {self.root}")
        return self.spark.read.parquet(f"{self.root}/{_SCHEMA}={numbers[-1]:06d}").schema

    def read(self, parts: Sequence[int] | None = None) -> DataFrame:
        """The rows of all parts or of some; a column added later is NULL in older rows."""
        schema, paths = self.schema, self._paths(parts)
        if not paths:
            return self.spark.createDataFrame([], schema)
        # Rows without the partition columns, which the folders hold.
        return self.spark.read.schema(schema).option("basePath", self.root).parquet(*paths).select(*[f"`{n}`" for n in schema.names])

    def read_for(self, rows: DataFrame) -> DataFrame:
        """The rows of the parts that the keys of a frame fall into."""
        return self.read(self.touched(rows))

    def touched(self, rows: DataFrame) -> list[int]:
        """The parts of a frame's keys; at most as many as the table has."""
        return sorted(r[0] for r in rows.select(self._part(rows)).distinct().collect())

    # Writing

    def append(self, rows: DataFrame) -> KeyedTable:
        """Add rows without looking at what is stored."""
        self._write(self._typed(rows), _ADD)
        return self

    def insert(self, rows: DataFrame, order: Sequence[str] = ()) -> KeyedTable:
        """Add the rows whose key is not stored, the first of each key in `order` (by default that of the other columns).

        NULL equals NULL. Of the stored table only the key columns of the touched parts are read; nothing is rewritten.
        """
        typed = self._typed(rows)
        fresh = checkpoint(keep_first(typed, self.keys, list(order) or [c for c in typed.columns if c not in self.keys]))
        stored = self.read_for(fresh).select(*self.keys)
        self._write(fresh.join(stored, same_keys(fresh, stored, self.keys), "left_anti"), _ADD)
        return self

    def upsert(self, rows: DataFrame, keys: Sequence[str] | None = None) -> KeyedTable:
        """Delete the stored rows whose `keys` (by default those of the table) arrive again, then add all rows.

        The touched parts are read and written anew, the others stay as they are. `keys` must include those of `by`.
        """
        keys = list(keys or self.keys)
        if not set(self.by) <= set(keys):
            raise ValueError(f"keys {keys} do not tell the part, which needs {self.by}")
        fresh = checkpoint(self._typed(rows))
        self._write(not_in(self.read_for(fresh), fresh, keys).unionByName(fresh), _SET)
        return self

    def widen(self, name: str, kind: str | T.DataType) -> KeyedTable:
        """Add a typed column, NULL in the stored rows, unless it exists. No row is read or written."""
        empty = self.spark.createDataFrame([], self.schema)
        wide = add_column(empty, name, kind)
        if wide is not empty:
            self._declare(wide.schema)
        return self

    # Upkeep

    def compact(self, writes: int = 8) -> list[int]:
        """Write the parts that consist of more than `writes` writes as one; returns them."""
        crowded = [p for p, found in self._layout().items() if len(found) > writes]
        if crowded:
            self._write(checkpoint(self.read(crowded)), _SET)
        return crowded

    def expire(self) -> list[str]:
        """Delete the folders that no part needs any more, for when no reader holds an older state."""
        needed = {f"{self._folder(*w)}/{_PART}={p}" for p, found in self._layout().items() for w in found}
        gone = []
        for number, kind in self._writes():
            folder = self._folder(number, kind)
            for part in self._parts_of(folder):
                if f"{folder}/{_PART}={part}" not in needed:
                    delete(self.spark, f"{folder}/{_PART}={part}")
                    gone.append(f"{folder}/{_PART}={part}")
        return gone

    # Helpers

    def _part(self, rows: DataFrame) -> Column:
        # Keys as text, so that a wider number type leads to the same part.
        return F.pmod(F.xxhash64(*[rows[c].cast("string") for c in self.by]), F.lit(self.parts)).cast("int").alias(_PART)

    def _typed(self, rows: DataFrame) -> DataFrame:
        schema = self.schema
        if differ := set(schema.names) ^ set(rows.columns):
            raise ValueError(f"columns differ: {sorted(differ)}")
        return rows.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields])

    def _declare(self, schema: T.StructType) -> None:
        number = max(self._numbers(_SCHEMA), default=0) + 1
        self.spark.createDataFrame([], schema).write.parquet(f"{self.root}/{_SCHEMA}={number:06d}")

    def _write(self, rows: DataFrame, kind: str) -> None:
        number = max((n for n, _ in self._writes(complete=False)), default=0) + 1
        # Gathers a part into few files, and cuts one that is too large for a task.
        placed = rows.select("*", self._part(rows)).hint("rebalance", _PART)
        placed.write.partitionBy(_PART).parquet(self._folder(number, kind))

    def _folder(self, number: int, kind: str) -> str:
        return f"{self.root}/{_WRITE}={number:06d}-{kind}"

    def _numbers(self, prefix: str) -> list[int]:
        return [int(c.split("=")[1]) for c in children(self.spark, self.root)
                if c.startswith(f"{prefix}=") and "_SUCCESS" in children(self.spark, f"{self.root}/{c}")]

    def _writes(self, complete: bool = True) -> list[tuple[int, str]]:
        found = [c.split("=")[1].split("-") for c in children(self.spark, self.root) if c.startswith(f"{_WRITE}=")
                 and (not complete or "_SUCCESS" in children(self.spark, f"{self.root}/{c}"))]
        return [(int(n), kind) for n, kind in found]

    def _parts_of(self, folder: str) -> list[int]:
        return [int(c.split("=")[1]) for c in children(self.spark, folder) if c.startswith(f"{_PART}=")]

    def _layout(self) -> dict[int, list[tuple[int, str]]]:
        """The writes each part consists of."""
        layout: dict[int, list[tuple[int, str]]] = {}
        for number, kind in self._writes():
            for part in self._parts_of(self._folder(number, kind)):
                layout[part] = [(number, kind)] if kind == _SET else [*layout.get(part, []), (number, kind)]
        return layout

    def _paths(self, parts: Sequence[int] | None) -> list[str]:
        return [f"{self._folder(*w)}/{_PART}={p}" for p, found in sorted(self._layout().items())
                if parts is None or p in set(parts) for w in found]
