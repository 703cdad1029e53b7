"""Feature tables for models: lags, windows, ratios, labels and encodings."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import OneHotEncoder, StringIndexer
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eavcube.functions import dates as D
from eavcube.functions import numbers as N
from eavcube.operators.aggregate import correlation_matrix, lag_pivot
from eavcube.operators.ordered import bounded_list
from eavcube.operators.skew import HOT_ROWS, skew_join
from eavcube.operators.window import quantile_labels

# Closed day ranges before the start, propagation weights and tercile labels.
LAG_WINDOWS = {"0d": (0, 0), "3d": (1, 3), "7d": (1, 7), "15d": (1, 15)}
PROPAGATION = {"NDVI": 0.4, "NDMI": -0.3, "NDWI": -0.2}
PROPAGATION_SOIL = ("TSOIL6", 0.1)
TERCILES = ["bajo", "medio", "alto"]


def with_lag(series: DataFrame, entities: DataFrame, key: str, start: str, observed: str, out: str = "lag",
             hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Series with the days from each observation to the start of its entity; later ones are dropped."""
    joined = skew_join(series, entities.select(key, start), [key], "inner", hot_rows)
    lagged = joined.withColumn(out, D.days_before(F.col(start), F.col(observed)))
    return lagged.where(F.col(out) >= 0).drop(start)


def lag_features(series: DataFrame, entities: DataFrame, key: str, start: str, observed: str, variable: str,
                 value: str, variables: Sequence[str], windows: Mapping[str, tuple[int, int]] = LAG_WINDOWS,
                 base: str = "0d", hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Wide lag-window means of entities that have an observation in the base window.

    Over a series and entities stored in equal buckets of the key, with `hot_rows=None`, the series is not shuffled.
    """
    lagged = with_lag(series, entities, key, start, observed, hot_rows=hot_rows)
    return lag_pivot(lagged, key, variable, value, "lag", variables, windows, base)


def wide_table(entities: DataFrame, joins: Sequence[tuple[DataFrame, Sequence[str]]],
               hot_rows: int = HOT_ROWS) -> DataFrame:
    """Left-join feature frames in turn. Columns that clash get the suffix of their position (`_1`, `_2`).

    Hot keys are looked for in `entities`, so no join is computed twice.
    """
    wide = entities
    for i, (frame, on) in enumerate(joins, 1):
        clash = [c for c in frame.columns if c in wide.columns and c not in on]
        renamed = frame.withColumnsRenamed({c: f"{c}_{i}" for c in clash})
        probe = entities if set(on) <= set(entities.columns) else None
        wide = skew_join(wide, renamed, list(on), "left", hot_rows, probe)
    return wide


def with_means_and_trends(df: DataFrame, means: Mapping[str, Sequence[str]],
                          trends: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Row means over columns and differences of two columns."""
    with_means = df.withColumns({name: N.row_mean(columns) for name, columns in means.items()})
    return with_means.withColumns({name: F.col(a) - F.col(b) for name, (a, b) in trends.items()})


def soil_vegetation_features(df: DataFrame, layers: int = 6) -> DataFrame:
    """Soil and vegetation means and trends over the lag-window columns."""
    windows = list(LAG_WINDOWS)
    means = {f"TSOIL_{w}_mean": [f"TSOIL{i}_{w}" for i in range(1, layers + 1)] for w in windows}
    for index in ("NDVI", "NDMI"):
        means[f"{index}_mean"] = [f"{index}_{w}" for w in windows[1:]]
    means["TSOIL_mean"] = means["TSOIL_3d_mean"]
    trends = {f"{index}_trend": (f"{index}_3d", f"{index}_15d") for index in ("NDVI", "NDMI")}
    trends["TSOIL_trend"] = (f"TSOIL{layers}_3d", f"TSOIL{layers}_15d")
    return with_means_and_trends(df, means, trends)


# Ratios; each name has two published formulas.


def fuel_temperature_sum(soil: Column, air: Column) -> Column:
    return soil + air


def fuel_temperature_product(soil: Column, vegetation: Column) -> Column:
    return soil * vegetation


def water_stress(a: Column, moisture: Column) -> Column:
    """Vegetation minus moisture, or soil temperature minus moisture."""
    return a - moisture


def human_pressure_by_location(people: Column, lat: Column, lon: Column) -> Column:
    return people / (F.abs(lat) + F.abs(lon) + F.lit(1.0))


def human_pressure_by_age(adults: Column, total: Column) -> Column:
    return N.safe_ratio(adults, total)


def propagation_index(df: DataFrame, soil_median: float | None, weights: Mapping[str, float] = PROPAGATION,
                      soil: tuple[str, float] = PROPAGATION_SOIL, out: str = "propagation") -> DataFrame:
    """Weighted vegetation indices (missing as 0) plus soil temperature (missing as its median)."""
    column, weight = soil
    filled = F.coalesce(F.col(column).cast("double"), F.lit(soil_median))
    return df.withColumn(out, N.weighted_sum(weights) + filled * F.lit(weight))


def risk_terciles(df: DataFrame, value: str, out: str = "risk", labels: Sequence[str] = TERCILES,
                  drop_duplicates: bool = False, hot_rows: int = HOT_ROWS) -> DataFrame:
    return quantile_labels(df, value, labels, out, drop_duplicates, hot_rows)


def age_groups(df: DataFrame, groups: Mapping[str, Sequence[str]], prefix: str = "r_",
               total: str = "population_total") -> DataFrame:
    """Sums over age bands plus the total of all bands; the bands themselves are dropped."""
    bands = [c for c in df.columns if c.startswith(prefix)]
    sums = {name: N.row_sum(columns) for name, columns in groups.items()}
    return df.withColumns({total: N.row_sum(bands), **sums}).drop(*bands)


def columns_like(df: DataFrame, prefixes: Sequence[str] = (), parts: Sequence[str] = ()) -> list[str]:
    """Column names with any of the prefixes or containing any of the parts."""
    return [c for c in df.columns if any(c.startswith(p) for p in prefixes) or any(p in c for p in parts)]


def one_hot(df: DataFrame, column: str, limit: int = 1000, drop_first: bool = True) -> DataFrame:
    """Boolean columns per level in sorted order; NULL is false everywhere and the column is dropped.

    The levels must be known to fix the schema, so their list reaches the driver and is checked for size; a column of more
    levels makes a vector (`one_hot_vector`).
    """
    levels = bounded_list(df, column, limit)[1 if drop_first else 0:]
    flags = {f"{column}_{v}": F.coalesce(F.col(column) == F.lit(v), F.lit(False)) for v in levels}
    return df.withColumns(flags).drop(column) if flags else df.drop(column)


def one_hot_vector(df: DataFrame, column: str, out: str, drop_first: bool = True) -> DataFrame:
    """One sparse vector per row instead of a column per level, for columns of very many levels.

    Its places are the levels in sorted order, without the first if `drop_first`; NULL and the first have all zeros.
    The column stays. The levels, not the rows, are held by the fitted encoder.
    """
    text = F.col(column).cast("string")
    if drop_first:
        (first,) = df.agg(F.min(text)).first()
        text = F.when(text != F.lit(first), text)
    rows = df.withColumn("__level", text)
    if rows.where("__level is not null").isEmpty():
        return rows.drop("__level").withColumn(out, array_to_vector(F.array().cast("array<double>")))
    # Unknown levels take the last place, which the encoder leaves out.
    index = StringIndexer(inputCol="__level", outputCol="__index", handleInvalid="keep", stringOrderType="alphabetAsc").fit(rows)
    encoder = OneHotEncoder(inputCol="__index", outputCol=out, dropLast=True, handleInvalid="error")
    indexed = index.transform(rows)
    return encoder.fit(indexed).transform(indexed).drop("__level", "__index")


def heat_rows(df: DataFrame, lat: str, lon: str, index: str) -> DataFrame:
    """Rows that can be put on a map."""
    return df.dropna(subset=[lat, lon, index])


def numeric_only(df: DataFrame) -> DataFrame:
    return df.select(*[f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)])


def redundant_columns(df: DataFrame, columns: Sequence[str], threshold: float = 0.9) -> list[str]:
    """Later columns of pairs whose correlation reaches the threshold (one row per pair is read)."""
    table = correlation_matrix(df, columns).collect()
    strong = {(r["var_a"], r["var_b"]) for r in table if r["r"] is not None and abs(r["r"]) >= threshold}
    dropped: list[str] = []
    for i, a in enumerate(columns):
        if a not in dropped:
            dropped += [b for b in columns[i + 1:] if (a, b) in strong and b not in dropped]
    return dropped


def drop_redundant(df: DataFrame, columns: Sequence[str], threshold: float = 0.9) -> DataFrame:
    return df.drop(*redundant_columns(df, columns, threshold))


def model_table(df: DataFrame, columns: Sequence[str], dummies: str | None = None) -> DataFrame:
    """Complete rows of the listed columns, plus the encoded ones; names that do not exist are skipped."""
    wanted = [c for c in columns if c in df.columns]
    wanted += [c for c in (columns_like(df, parts=[dummies]) if dummies else []) if c not in wanted]
    return df.select(*wanted).na.drop()
