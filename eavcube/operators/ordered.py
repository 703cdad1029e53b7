"""Positions in a total order without sending the rows, or one large group of them, through one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eavcube.session import shared_folder

CHUNK = "__chunk"
POSITION = "__position"

_INDEX_BITS = 33


def checkpoint(df: DataFrame) -> DataFrame:
    """Write the frame to the shared checkpoint folder and go on from there."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def positioned(df: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    """Add CHUNK (number of the sorted slice) and POSITION (0-based rank in the total order).

    One range-partitioned sort; the checkpoint fixes the slices, so row i of slice p has rank
    `rows before slice p` + i. Only one count per slice reaches the driver. The order should identify
    the rows: rows that tie on all of it cannot be split over slices.
    """
    ordered = checkpoint(df.orderBy(*order)).withColumn("__row", F.monotonically_increasing_id())
    ordered = ordered.withColumn(CHUNK, F.shiftright("__row", _INDEX_BITS).cast("int"))
    before, starts = 0, []
    sizes = ordered.groupBy(CHUNK).agg(F.count(F.lit(1)).alias("rows")).collect()
    for chunk, rows in sorted((r[CHUNK], r["rows"]) for r in sizes):
        starts.append((chunk, before))
        before += rows
    offsets = df.sparkSession.createDataFrame(starts, f"{CHUNK} int, __start bigint")
    index = F.col("__row").bitwiseAND(F.lit((1 << _INDEX_BITS) - 1))
    return (
        ordered.join(F.broadcast(offsets), CHUNK)
        .withColumn(POSITION, F.col("__start") + index)
        .drop("__row", "__start")
    )


def numbered(df: DataFrame, order: Sequence[Column | str], name: str, start: int | Column = 1) -> DataFrame:
    """Add consecutive numbers from `start` along the given order."""
    first = start if isinstance(start, Column) else F.lit(start)
    return positioned(df, order).withColumn(name, (F.col(POSITION) + first).cast("bigint")).drop(CHUNK, POSITION)


def numbered_by(df: DataFrame, bucket: Column, order: Sequence[Column | str], name: str,
                top: DataFrame | None = None) -> DataFrame:
    """Add consecutive numbers along (bucket, order) within one plan: no job runs before the action.

    `bucket` is a function of the row that keeps the order wanted and has a bounded number of values: a prefix of the
    first order column, or a hash where any order will do. Rows are ranked inside their bucket, and a running sum over
    the counts of the buckets gives each its start. `top`, a frame with one value, is the number to continue from.
    The frame is read twice, so it must give the same rows each time.
    """
    counts = df.groupBy(bucket.alias("__bucket")).agg(F.count(F.lit(1)).alias("__n")).withColumn("__later", F.lit(1))
    if top is not None:
        kind = counts.schema["__bucket"].dataType
        above = top.select(F.coalesce(F.col(f"`{top.columns[0]}`").cast("bigint"), F.lit(0)).alias("__n"))
        counts = counts.unionByName(above.select(F.lit(None).cast(kind).alias("__bucket"), "__n", F.lit(0).alias("__later")))
    # One row for each bucket.
    before = Window.partitionBy(F.lit(0)).orderBy("__later", F.asc_nulls_first("__bucket")).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("__start", F.coalesce(F.sum("__n").over(before), F.lit(0))).where("__later = 1").select("__bucket", "__start")
    inside = Window.partitionBy(bucket).orderBy(*order)
    ranked = df.withColumn("__rank", F.row_number().over(inside)).withColumn("__own", bucket)
    return ranked.join(starts, F.col("__own").eqNullSafe(F.col("__bucket"))).select(
        *[f"`{c}`" for c in df.columns], (F.col("__start") + F.col("__rank")).cast("bigint").alias(name))


def small_list(df: DataFrame, column: str, limit: int = 1000) -> list | None:
    """Sorted distinct non-null values of a column, or None when there are more than `limit`."""
    rows = df.select(column).where(F.col(column).isNotNull()).distinct().limit(limit + 1).collect()
    return sorted(r[0] for r in rows) if len(rows) <= limit else None


def bounded_list(df: DataFrame, column: str, limit: int | None = None) -> list:
    """Sorted distinct non-null values that shape a schema; more than a `limit` set by the caller is an error."""
    if limit is None:
        return sorted(r[0] for r in df.select(column).where(F.col(column).isNotNull()).distinct().collect())
    values = small_list(df, column, limit)
    if values is None:
        raise ValueError(f"{column} has more than {limit} distinct values")
    return values
