"""Grouped summaries, pivots and correlations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eavcube.operators.quantile import EDGES, quantiles
from eavcube.operators.skew import HOT_ROWS, skew_join


def conditional_average(df: DataFrame, key: str, value: str, measures: Mapping[str, Column]) -> DataFrame:
    """One averaged column per condition, all in one pass over a long table."""
    return df.groupBy(key).agg(*[F.avg(F.when(cond, F.col(value))).alias(n) for n, cond in measures.items()])


def mean_per_variable(df: DataFrame, key: str, variable: str, value: str, out: str = "valor") -> DataFrame:
    return df.groupBy(key, variable).agg(F.avg(value).alias(out))


def pivot_mean(df: DataFrame, key: str, variable: str, value: str, variables: Sequence[str],
               suffix: str = "", drop_empty: bool = False) -> DataFrame:
    """Long to wide: one averaged column per listed variable; `drop_empty` leaves out those without any value.

    The averages are formed per (key, variable) first, so a key with very many rows spreads over its
    variables; the second step sees one row per pair.
    """
    if drop_empty:
        valued = {r[0] for r in df.where(F.col(value).isNotNull()).select(variable).distinct().collect()}
        variables = [v for v in variables if v in valued]
    rows = df.where(F.col(variable).isin(list(variables)))
    pairs = mean_per_variable(rows, key, variable, value, "__mean")
    wide = [F.max(F.when(F.col(variable) == v, F.col("__mean"))).alias(f"{v}{suffix}") for v in variables]
    return pairs.groupBy(key).agg(*wide)


def lag_pivot(df: DataFrame, key: str, variable: str, value: str, lag: str, variables: Sequence[str],
              windows: Mapping[str, tuple[int, int]], base: str) -> DataFrame:
    """Wide means per variable and lag window from a single scan; columns are `<variable>_<window>`.

    Only keys with a value in the `base` window are kept.
    """
    low = min(w[0] for w in windows.values())
    high = max(w[1] for w in windows.values())
    rows = df.where(F.col(variable).isin(list(variables)) & F.col(lag).between(low, high))
    means = [
        F.avg(F.when(F.col(lag).between(*span), F.col(value))).alias(name) for name, span in windows.items()
    ]
    pairs = rows.groupBy(key, variable).agg(*means)
    wide = [
        F.max(F.when(F.col(variable) == v, F.col(name))).alias(f"{v}_{name}")
        for name in windows for v in variables
    ]
    result = pairs.groupBy(key).agg(*wide, F.count(base).alias("__base"))
    return result.where(F.col("__base") > 0).drop("__base")


def group_means(df: DataFrame, key: str, columns: Sequence[str], sort: str | None = None) -> DataFrame:
    """Mean of columns per category without the NULL category, optionally sorted ascending."""
    means = df.where(F.col(key).isNotNull()).groupBy(key).agg(*[F.avg(c).alias(c) for c in columns])
    return means.orderBy(sort) if sort else means


def frequency(df: DataFrame, key: str, out: str = "n") -> DataFrame:
    """Rows per category without the NULL category, most frequent first."""
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias(out))
    return counts.orderBy(F.desc(out), key)


def five_numbers(df: DataFrame, key: str, value: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Minimum, quartiles and maximum per category."""
    names = ["minimum", "q1", "median", "q3", "maximum"]
    edges = quantiles(df, value, [0.0, 0.25, 0.5, 0.75, 1.0], [key], hot_rows)
    return edges.select(key, *[F.col(EDGES)[i].alias(n) for i, n in enumerate(names)])


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def correlation_matrix(df: DataFrame, columns: Sequence[str] | None = None, tile: int = 20) -> DataFrame:
    """Pearson correlation of every pair on the rows where both are known, as (var_a, var_b, r).

    Constant columns give NULL. One pass over the input: up to `tile` columns make one aggregate of all pairs; of more
    columns, whose aggregates would be too many, the Gram matrix of (values, squares, known) has all sums at once.
    """
    columns = list(columns or numeric_columns(df))
    if len(columns) > tile:
        return _gram_correlations(df, columns)
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1:]]
    return _correlate(df, pairs) if pairs else df.sparkSession.createDataFrame([], "var_a string, var_b string, r double")


def _gram_correlations(df: DataFrame, columns: list[str]) -> DataFrame:
    """Correlations from the products of 3 numbers for each of k columns: 9 k^2 sums, added up in a tree over the tasks.

    Values are taken relative to one of the first rows, which keeps the sums of squares from cancelling. NaN counts as
    unknown. A column that is constant where the other is known gives NULL.
    """
    k = len(columns)
    numbers = df.select(*[F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None).cast("double")).alias(f"x{i}") for i, c in enumerate(columns)])
    head = numbers.limit(100).collect()
    start = [next((r[i] for r in head if r[i] is not None), 0.0) for i in range(k)]
    moved = [F.coalesce(F.col(f"x{i}") - F.lit(start[i]), F.lit(0.0)) for i in range(k)]
    known = [F.col(f"x{i}").isNotNull().cast("double") for i in range(k)]
    vectors = numbers.select(array_to_vector(F.array(*moved, *[m * m for m in moved], *known)).alias("v"))
    gram = RowMatrix(MLUtils.convertVectorColumnsFromML(vectors, "v"), numCols=3 * k).computeGramianMatrix().toArray()
    xx, xm, sm, n = gram[:k, :k], gram[:k, 2 * k:], gram[k:2 * k, 2 * k:], gram[2 * k:, 2 * k:]
    spread = n * sm - xm * xm
    # What is left of a constant's squares is rounding.
    spread[spread <= 1e-12 * n * sm] = float("nan")
    r = (n * xx - xm * xm.T) / (spread**0.5 * (spread**0.5).T)
    rows = [(columns[i], columns[j], None if r[i, j] != r[i, j] else float(r[i, j])) for i in range(k) for j in range(i + 1, k)]
    return df.sparkSession.createDataFrame(rows, "var_a string, var_b string, r double")


def correlation_with(df: DataFrame, target: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Correlation of every other column with the target, highest first."""
    columns = [c for c in (columns or numeric_columns(df)) if c != target]
    table = _correlate(df, [(c, target) for c in columns])
    return table.select(F.col("var_a").alias("variable"), "r").orderBy(F.desc_nulls_last("r"), "variable")


def _correlate(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    row = df.agg(*[_pearson(a, b).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])
    entries = [
        F.struct(F.lit(a).alias("var_a"), F.lit(b).alias("var_b"), F.col(f"r{i}").alias("r"))
        for i, (a, b) in enumerate(pairs)
    ]
    return row.select(F.inline(F.array(*entries)))


def _pearson(a: str, b: str) -> Column:
    both = F.col(a).isNotNull() & F.col(b).isNotNull()
    x = F.when(both, F.col(a).cast("double"))
    y = F.when(both, F.col(b).cast("double"))
    spread = F.stddev_samp(x) * F.stddev_samp(y)
    return F.covar_samp(x, y) / F.nullif(spread, F.lit(0.0))


def null_counts(df: DataFrame) -> DataFrame:
    """(column, rows, nulls, pct_nulls) for every column from one pass."""
    counts = [F.count(F.col(c)).alias(f"n{i}") for i, c in enumerate(df.columns)]
    row = df.agg(F.count(F.lit(1)).alias("rows"), *counts)
    entries = [
        F.struct(F.lit(c).alias("column"), (F.col("rows") - F.col(f"n{i}")).alias("nulls"))
        for i, c in enumerate(df.columns)
    ]
    share = F.round(F.coalesce(F.try_divide(F.col("nulls") * 100.0, F.col("rows")), F.lit(0.0)), 2)
    return row.select("rows", F.inline(F.array(*entries))).select(
        "column", "rows", "nulls", share.alias("pct_nulls")
    )


def dense_columns(df: DataFrame, min_share: float = 0.7) -> list[str]:
    """Columns whose share of known values reaches the minimum (one row of counts reaches the driver)."""
    row = df.agg(F.count(F.lit(1)).alias("rows"), *[F.count(F.col(c)).alias(c) for c in df.columns]).first()
    return [c for c in df.columns if row[c] >= min_share * row["rows"]]


def drop_sparse(df: DataFrame, min_share: float = 0.7) -> DataFrame:
    return df.select(*dense_columns(df, min_share))


def distinct_count(df: DataFrame, key: str | None, column: str, out: str = "n_distinct") -> DataFrame:
    grouped = df.groupBy(key) if key else df.groupBy()
    return grouped.agg(F.countDistinct(column).alias(out))


def yearly_health(entities: DataFrame, series: DataFrame, key: str, year: Column,
                  hot_rows: int = HOT_ROWS) -> DataFrame:
    """Distinct entities and their series rows per year.

    Series rows are counted per entity before the join, so no entity is repeated per observation.
    """
    per_entity = series.groupBy(key).agg(F.count(F.lit(1)).alias("__rows"))
    ids = entities.select(key, year.alias("year"))
    joined = skew_join(ids, per_entity, [key], "left", hot_rows)
    return joined.groupBy("year").agg(
        F.countDistinct(key).alias("entities"),
        F.coalesce(F.sum("__rows"), F.lit(0)).alias("series_rows"),
    )
