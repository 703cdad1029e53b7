"""Operators over ordered groups: keep-first, canonical ids, interpolation, quantile labels, scaling."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eavcube.operators.ordered import CHUNK, POSITION, positioned
from eavcube.operators.quantile import quantile_list
from eavcube.operators.skew import HOT_ROWS, hot_keys, skew_join, split_hot

_RANK = "__rank"


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per key, the first in `order`.

    `row_number() <= 1` is limited per key before the shuffle (WindowGroupLimit), so a hot key sends one
    row per task. NULL keys form one group.
    """
    return first_n(df, keys, order, 1)


def first_n(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], n: int) -> DataFrame:
    """The first `n` rows per key in `order`; of the columns given by name, unknown values come last."""
    group = Window.partitionBy(*keys).orderBy(*[F.asc_nulls_last(c) if isinstance(c, str) else c for c in order])
    return df.withColumn(_RANK, F.row_number().over(group)).where(F.col(_RANK) <= n).drop(_RANK)


def repeated_rows(df: DataFrame, keys: Sequence[str], order: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Rows after the first of their key; `order` must be unique within a key and keys not NULL."""
    first = df.groupBy(*keys).agg(F.min(order).alias("__first"))
    return skew_join(df, first, keys, "inner", hot_rows).where(F.col(order) > F.col("__first")).drop("__first")


def canonical_ids(df: DataFrame, id_col: str, content: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """(bad_id, good_id): every id and the lowest id with the same content (NULL equals NULL)."""
    marks = [F.coalesce(F.to_json(F.struct(*content)), F.lit("")).alias("__content")]
    rows = df.select(F.col(id_col).alias("bad_id"), *marks)
    lowest = rows.groupBy("__content").agg(F.min("bad_id").alias("good_id"))
    return skew_join(rows, lowest, ["__content"], "inner", hot_rows).select("bad_id", "good_id")


def interpolate_linear(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Fill NULLs of `value` per group: linear by position between neighbours, nearest value at the ends.

    Groups without any value stay NULL. Ordinary groups take one shuffle, one sort and one pass. Hot
    groups are sorted over the cluster instead and cut into slices; what a slice cannot see is carried
    over from one summary row per slice. `order` must identify the rows of a group.
    """
    keys, order = list(keys), list(order)
    hot = hot_keys(df, keys, hot_rows)
    if hot is None:
        return _interpolate_groups(df, keys, order, value)
    ordinary, large = split_hot(df, keys, hot)
    return _interpolate_groups(ordinary, keys, order, value).unionByName(
        _interpolate_slices(large, keys, order, value)
    )


def _interpolate_groups(df: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    ranked = df.withColumn(POSITION, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return _fill(_neighbours(ranked, keys, order, value), value).drop(POSITION, "__known", "__prev", "__next").select(*df.columns)


def _neighbours(df: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """The known values before and after each row, from one pass over one sort.

    The next known value is a LEAD that skips unknown ones: unlike a frame that ends with the group, it only moves forward.
    """
    group = ", ".join(f"`{k}`" for k in keys)
    row = f"(PARTITION BY {group} ORDER BY {', '.join(f'`{c}`' for c in order)})"
    known = df.withColumn("__known", _known(value))
    return known.select(
        "*", F.last("__known", ignorenulls=True).over(
            Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("__prev"),
        F.expr(f"lead(__known, 1) IGNORE NULLS OVER {row}").alias("__next"))


def _interpolate_slices(df: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    ordered = positioned(df, [*keys, *order])
    known = _known(value)
    part = [CHUNK, *keys]
    local = _neighbours(ordered, part, [POSITION], value)
    # One row per slice and hot group: no more than slices + hot groups, so it is broadcast.
    ends = ordered.groupBy(*part).agg(F.max(known).alias("__last"), F.min(known).alias("__first"))
    earlier = Window.partitionBy(*keys).orderBy(F.asc(CHUNK)).rowsBetween(Window.unboundedPreceding, -1)
    later = Window.partitionBy(*keys).orderBy(F.desc(CHUNK)).rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(
        F.col(CHUNK).alias("__c"),
        *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)],
        F.last("__last", ignorenulls=True).over(earlier).alias("__before"),
        F.last("__first", ignorenulls=True).over(later).alias("__after"),
    )
    same = [F.col(CHUNK) == F.col("__c")] + [
        F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)
    ]
    filled = (
        local.join(F.broadcast(carried), reduce(lambda a, b: a & b, same))
        .withColumn("__prev", F.coalesce("__prev", "__before"))
        .withColumn("__next", F.coalesce("__next", "__after"))
    )
    return _fill(filled, value).select(*df.columns)


def _known(value: str) -> Column:
    """(position, value) where there is a value, NULL elsewhere."""
    pair = F.struct(F.col(POSITION).alias("p"), F.col(value).cast("double").alias("v"))
    return F.when(F.col(value).isNotNull(), pair)


def _fill(df: DataFrame, value: str) -> DataFrame:
    prev, nxt = F.col("__prev"), F.col("__next")
    step = (nxt.v - prev.v) / F.nullif((nxt.p - prev.p).cast("double"), F.lit(0.0))
    line = prev.v + step * (F.col(POSITION) - prev.p)
    return df.withColumn(value, F.coalesce(F.col(value), line, prev.v, nxt.v))


def quantile_labels(
    df: DataFrame,
    value: str,
    labels: Sequence[str],
    out: str,
    drop_duplicates: bool = False,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Equal-frequency bins with right-closed edges; the lowest value belongs to the first bin.

    Repeated edges raise, or are merged with `drop_duplicates` (the labels of the merged bins are then
    the first ones).
    """
    probs = [i / len(labels) for i in range(len(labels) + 1)]
    edges = quantile_list(df, value, probs, hot_rows)
    if edges[0] is None:
        return df.withColumn(out, F.lit(None).cast("string"))
    unique = sorted(set(edges))
    if len(unique) < len(edges) and not drop_duplicates:
        raise ValueError(f"quantile edges of {value} are not unique: {edges}")
    c = F.col(value)
    if len(unique) == 1:
        return df.withColumn(out, F.when(c.isNotNull(), F.lit(labels[0])))
    label = F.when(c.isNull() | F.isnan(c.cast("double")), F.lit(None).cast("string"))
    for upper, text in zip(unique[1:], labels):
        label = label.when(c <= F.lit(upper), F.lit(text))
    return df.withColumn(out, label)


def minmax_scale(df: DataFrame, value: str, out: str) -> DataFrame:
    """(x - min) / (max - min) over all rows; NULL when all values are equal."""
    low, high = df.agg(F.min(value), F.max(value)).first()
    if low is None or low == high:
        return df.withColumn(out, F.lit(None).cast("double"))
    return df.withColumn(out, (F.col(value) - F.lit(low)) / F.lit(high - low))


def above_quantile(df: DataFrame, value: str, prob: float, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Rows whose value exceeds the exact quantile of all values."""
    (edge,) = quantile_list(df, value, [prob], hot_rows)
    return df.where(F.col(value) > F.lit(edge))
