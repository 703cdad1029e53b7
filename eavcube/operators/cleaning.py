"""Conforming and cleaning operators for registers, catalogues and long series."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eavcube.functions import keys as K
from eavcube.functions import numbers as N
from eavcube.functions.text import normalise_text
from eavcube.operators.ordered import small_list
from eavcube.operators.quantile import quantile_list
from eavcube.operators.relational import insert_if_absent, not_in, remap_ids, with_parent
from eavcube.operators.skew import HOT_ROWS
from eavcube.operators.window import canonical_ids, interpolate_linear, keep_first

REVIEW_LABEL = "MUNICIPIO POR REVISAR"


# Keys and dimensions ---------------------------------------------------------------------------


def repair_keys(df: DataFrame, key: str, prefix: str = K.HOME_PREFIX, width: int = K.PLACE_WIDTH) -> DataFrame:
    return df.withColumn(key, K.repair_short_key(F.col(key), prefix, width))


def swap_keys(df: DataFrame, key: str, prefix: str = K.HOME_PREFIX, width: int = K.PLACE_WIDTH) -> DataFrame:
    return df.withColumn(key, K.swap_inverted_key(F.col(key), prefix, width))


def unify_dimension(dimension: DataFrame, facts: DataFrame, key: str, defaults: Mapping[str, Column],
                    overrides: Mapping[str, Column] | None = None, prefix: str = K.HOME_PREFIX,
                    width: int = K.PLACE_WIDTH) -> DataFrame:
    """A dimension from three sources: valid rows, rows with a repaired key, placeholders for used keys.

    `overrides` replaces columns of the repaired rows, `defaults` gives the other columns of a placeholder.
    """
    valid = dimension.where(F.length(key) == width)
    repaired = repair_keys(dimension.where(F.length(key) < width), key, prefix, width)
    repaired = repaired.withColumns(dict(overrides)) if overrides else repaired
    used = repair_keys(facts.select(key), key, prefix, width).where(F.col(key).isNotNull()).distinct()
    placeholders = used.select(key, *[v.alias(c) for c, v in defaults.items()])
    columns = dimension.columns
    return insert_if_absent([valid, repaired.select(*columns), placeholders.select(*columns)], [key])


def add_swapped_members(dimension: DataFrame, key: str) -> DataFrame:
    """Add the corrected twin of every inverted key unless it exists; the inverted row stays."""
    swapped = swap_keys(dimension.where(K.is_inverted_key(F.col(key))), key)
    return insert_if_absent([dimension, swapped], [key])


def migrate_facts(facts: DataFrame, id_col: str, key: str, order: Sequence[str] = ()) -> DataFrame:
    """Facts with repaired place keys, one row per id (the first in `order`)."""
    return insert_if_absent([repair_keys(facts, key)], [id_col], order)


def deduplicate_catalogue(catalogue: DataFrame, facts: DataFrame, id_col: str, content: Sequence[str],
                          hot_rows: int = HOT_ROWS) -> tuple[DataFrame, DataFrame]:
    """Merge catalogue rows with equal content into the lowest id and point the facts to it."""
    mapping = canonical_ids(catalogue, id_col, content, hot_rows)
    kept = keep_first(catalogue, content, [id_col])
    return kept, remap_ids(facts, mapping.where(F.col("bad_id") != F.col("good_id")), id_col, hot_rows)


def deduplicate_facts(facts: DataFrame, id_col: str, order: str, children: Mapping[str, DataFrame],
                      child_keys: Mapping[str, Sequence[str]]) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Keep the first row per id and the children of the survivors.

    A surviving id keeps its children; each child table is itself reduced to one row per logical key.
    """
    kept = keep_first(facts, [id_col], [order])
    trimmed = {
        name: keep_first(child, child_keys[name], [c for c in child.columns if c not in child_keys[name]])
        for name, child in children.items()
    }
    return kept, trimmed


# Text and coordinates --------------------------------------------------------------------------


def normalise_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: normalise_text(F.col(c)) for c in columns})


def normalise_tables(tables: Mapping[str, DataFrame], columns: Mapping[str, Sequence[str]]) -> dict[str, DataFrame]:
    """Fold the listed text columns of every table."""
    return {n: normalise_columns(t, columns[n]) if n in columns else t for n, t in tables.items()}


def is_mislocated(key: Column, lat: Column, lon: Column, box: Mapping[str, Sequence[float]],
                  prefix: str = K.HOME_PREFIX) -> Column:
    """A foreign key prefix, a home key outside the box, or a zero coordinate."""
    home = key.startswith(prefix)
    wrong = (home & N.outside_box(lat, lon, box)) | ~home | (lat == 0) | (lon == 0)
    return F.coalesce(wrong, F.lit(False))


def purge_mislocated(entities: DataFrame, series: DataFrame, id_col: str, flag: Column, lat: str, lon: str,
                     hot_rows: int = HOT_ROWS) -> tuple[DataFrame, DataFrame]:
    """Blank the coordinates of flagged entities and drop their series; the entities stay."""
    flagged = entities.where(flag).select(id_col)
    return blank_coordinates(entities, flag, lat, lon), not_in(series, flagged, [id_col], hot_rows)


def blank_coordinates(entities: DataFrame, flag: Column, lat: str, lon: str) -> DataFrame:
    """Both coordinates NULL where the flag is true."""
    blank = [F.when(~flag, F.col(c)).alias(c) if c in (lat, lon) else F.col(c) for c in entities.columns]
    return entities.select(*blank)


def clamp_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: N.clamp_negative(F.col(c)) for c in columns})


# Series ----------------------------------------------------------------------------------------


def neutralise_sentinel(df: DataFrame, value: str, sentinel: float = N.SENTINEL) -> DataFrame:
    return df.withColumn(value, N.sentinel_to_null(F.col(value), sentinel))


def dead_variables(df: DataFrame, variable: str, value: str) -> DataFrame:
    """Variables without a single known value."""
    counts = df.groupBy(variable).agg(F.count(value).alias("__known"))
    return counts.where(F.col("__known") == 0).select(variable)


def split_by_values(df: DataFrame, column: str, chosen: DataFrame,
                    hot_rows: int = HOT_ROWS) -> tuple[DataFrame, DataFrame]:
    """Rows whose value is listed in `chosen` and the others (a NULL value is among the others).

    A short list becomes a literal filter that reaches the scan, a long one is joined.
    """
    values = small_list(chosen, column)
    if values is None:
        return with_parent(df, chosen, column, hot_rows=hot_rows), not_in(df, chosen, [column], hot_rows)
    listed = F.coalesce(F.col(column).isin(values), F.lit(False))
    return df.where(listed), df.where(~listed)


def remove_dead_variables(df: DataFrame, variable: str, value: str) -> DataFrame:
    """Series without its dead variables."""
    return split_by_values(df, variable, dead_variables(df, variable, value))[1]


def deduplicate_series(df: DataFrame, keys: Sequence[str], id_col: str) -> DataFrame:
    """Lowest id per (variable, entity, date)."""
    return keep_first(df, keys, [id_col])


def rescuable_variables(df: DataFrame, variable: str, value: str, max_pct: float = 10.0) -> DataFrame:
    """Variables with some but less than `max_pct` percent missing values."""
    counts = df.groupBy(variable).agg(F.count(F.lit(1)).alias("rows"), F.count(value).alias("known"))
    nulls = F.col("rows") - F.col("known")
    wanted = (nulls > 0) & (nulls * 100.0 / F.col("rows") < max_pct)
    return counts.where(wanted).select(variable, "rows", nulls.alias("nulls"))


def interpolate_rescuable(df: DataFrame, variable: str, entity: str, order: Sequence[str], value: str,
                          max_pct: float = 10.0, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Interpolate only the rescuable variables, per (variable, entity), all in one job.

    Other variables pass by without a shuffle. The frame is read three times (counts, chosen, others), so
    it should be a stored table, best partitioned by variable.
    """
    rescuable = rescuable_variables(df, variable, value, max_pct).select(variable)
    chosen, others = split_by_values(df, variable, rescuable, hot_rows)
    return others.unionByName(interpolate_linear(chosen, [variable, entity], order, value, hot_rows))


def remove_orphans(children: Mapping[str, DataFrame], parent: DataFrame, key: str,
                   hot_rows: int = HOT_ROWS) -> dict[str, DataFrame]:
    """Child rows whose parent exists."""
    return {name: with_parent(child, parent, key, hot_rows=hot_rows) for name, child in children.items()}


def remove_unreferenced(dimension: DataFrame, key: str, facts: Sequence[DataFrame]) -> DataFrame:
    """Dimension rows used by at least one of the fact tables."""
    used = None
    for fact in facts:
        ids = fact.select(key).where(F.col(key).isNotNull()).distinct()
        used = ids if used is None else used.unionByName(ids)
    return dimension.join(used.distinct(), key, "left_semi")


def purge_series(df: DataFrame, variable: str, value: str, limit: float = N.SENTINEL) -> DataFrame:
    """The deleting policy: no variable that only holds the code, no row at or below it."""
    spans = df.groupBy(variable).agg(F.min(value).alias("__lo"), F.max(value).alias("__hi"))
    only_code = spans.where((F.col("__lo") == limit) & (F.col("__hi") == limit))
    kept = split_by_values(df, variable, only_code.select(variable))[1]
    return kept.where(F.col(value).isNull() | (F.col(value) > limit))


def purge_dictionary(dictionary: DataFrame, series: DataFrame, variable: str, value: str,
                     limit: float = N.SENTINEL) -> DataFrame:
    """Dictionary rows without the variables that hold nothing but the code or missing values."""
    spans = series.groupBy(variable).agg(F.min(value).alias("__lo"), F.max(value).alias("__hi"))
    code = F.lit(limit)
    # One row per variable.
    dead = spans.where(F.col("__lo").isNull() | ((F.col("__lo") == code) & (F.col("__hi") == code)))
    return not_in(dictionary, dead.select(variable), [variable])


def reset_coordinates(df: DataFrame, lat: str, lon: str, box: Mapping[str, Sequence[float]]) -> DataFrame:
    """Blank both coordinates when either is out of the box or both are zero."""
    a, b = F.col(lat), F.col(lon)
    bad = F.coalesce(N.outside_box(a, b, box) | ((a == 0) & (b == 0)), F.lit(False))
    return df.withColumns({lat: F.when(~bad, a), lon: F.when(~bad, b)})


# Imputation ------------------------------------------------------------------------------------


def impute_mean(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace missing values by the column mean (one row of means reaches the driver)."""
    means = df.agg(*[F.avg(c).alias(c) for c in columns]).first().asDict()
    return _fill(df, means)


def impute_median(df: DataFrame, columns: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Replace missing values by the exact column median."""
    return _fill(df, {c: quantile_list(df, c, [0.5], hot_rows)[0] for c in columns})


def impute_constant(df: DataFrame, columns: Sequence[str], value: float = 0.0) -> DataFrame:
    return _fill(df, {c: value for c in columns})


def _fill(df: DataFrame, values: Mapping[str, float | None]) -> DataFrame:
    known = {c: v for c, v in values.items() if v is not None}
    filled = {c: F.coalesce(F.col(c).cast("double"), F.lit(float(v))) for c, v in known.items()}
    return df.withColumns(filled) if filled else df


def clean_model_table(df: DataFrame, date: str, imputed: str, open_limits: Mapping[str, Sequence[float]],
                      closed_limits: Mapping[str, Sequence[float]]) -> DataFrame:
    """Date cast, mean imputation of one column over all rows, then physical limits."""
    dated = df.withColumn(date, F.col(date).cast("date"))
    return within_limits(impute_mean(dated, [imputed]), open_limits, closed_limits)


def within_limits(df: DataFrame, open_limits: Mapping[str, Sequence[float]],
                  closed_limits: Mapping[str, Sequence[float]]) -> DataFrame:
    """Rows strictly inside the open limits and inside the closed ones; missing values do not qualify."""
    kept = df
    for c, (low, high) in open_limits.items():
        kept = kept.where((F.col(c) > low) & (F.col(c) < high))
    for c, (low, high) in closed_limits.items():
        kept = kept.where(F.col(c).between(low, high))
    return kept
