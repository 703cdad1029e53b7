"""Audits: null, text and series profiles, references, duplicates and impossible values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eavcube.functions import numbers as N
from eavcube.functions import text as X
from eavcube.functions.dates import ends_before_start
from eavcube.operators.aggregate import null_counts
from eavcube.operators.relational import lookup, with_parent, without_parent
from eavcube.operators.skew import HOT_ROWS
from eavcube.schemas import Reference

# Suggested action per kind of column.
PROTECT, LABEL, KEEP_METRIC, KEEP_TEMPORAL, REVIEW = (
    "protected id", "label missing text", "keep NULL (metric)", "keep NULL (temporal)", "review",
)


def column_class(kind: T.DataType) -> str:
    """Coarse class of a column type: text, numeric, temporal or other."""
    if isinstance(kind, T.StringType):
        return "text"
    if isinstance(kind, T.NumericType):
        return "numeric"
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType, T.DayTimeIntervalType)):
        return "temporal"
    return "other"


def null_profile(df: DataFrame, ids: Sequence[str]) -> DataFrame:
    """Missing values per column and what to do about them."""
    by_class = {"text": LABEL, "numeric": KEEP_METRIC, "temporal": KEEP_TEMPORAL, "other": REVIEW}
    protected = {i.lower() for i in ids}
    actions = {
        f.name: PROTECT if f.name.lower() in protected else by_class[column_class(f.dataType)]
        for f in df.schema.fields
    }
    return null_counts(df).withColumn("action", X.map_labels(F.col("column"), actions))


def series_summary(df: DataFrame, variable: str, value: str) -> DataFrame:
    """Rows, distinct variables and missing values of a whole series table."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.countDistinct(variable).alias("variables"),
        F.count_if(F.col(value).isNull()).alias("nulls"),
    )


def variable_profile(df: DataFrame, variable: str, value: str, sigmas: float = 4.0) -> DataFrame:
    """Count, range, mean, deviation, missing share and mean +- sigmas bounds per variable."""
    stats = df.groupBy(variable).agg(
        F.count(F.lit(1)).alias("rows"),
        F.min(value).alias("min_value"),
        F.max(value).alias("max_value"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"),
        F.count_if(F.col(value).isNull()).alias("nulls"),
    )
    return stats.withColumns({
        "pct_nulls": F.round(F.col("nulls") * 100.0 / F.col("rows"), 2),
        "low_bound": F.col("mean") - F.lit(sigmas) * F.col("std"),
        "high_bound": F.col("mean") + F.lit(sigmas) * F.col("std"),
    })


def text_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Untrimmed, accented and mixed-case values per text column, from one pass."""
    columns = columns or [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    tests = {"untrimmed": X.is_untrimmed, "accented": X.has_accents, "mixed_case": X.is_mixed_case}
    counts = [
        F.count_if(test(F.col(c))).alias(f"{name}{i}")
        for i, c in enumerate(columns) for name, test in tests.items()
    ]
    entries = [
        F.struct(F.lit(c).alias("column"), *[F.col(f"{name}{i}").alias(name) for name in tests])
        for i, c in enumerate(columns)
    ]
    row = df.agg(F.count(F.lit(1)).alias("rows"), *counts)
    return row.select("rows", F.inline(F.array(*entries))).select("column", "rows", *tests)


def reference_audit(tables: Mapping[str, DataFrame], references: Sequence[Reference], samples: int = 3,
                    hot_rows: int = HOT_ROWS) -> DataFrame:
    """Orphan rows per declared reference and the lowest missing ids with their rows (`id:rows`).

    Orphans are counted per missing id first; total and examples both read that one shuffle.
    """
    report = None
    for ref in references:
        orphans = without_parent(tables[ref.child], tables[ref.parent], ref.column, ref.parent_column, hot_rows)
        missing = orphans.groupBy(F.col(ref.column).cast("string").alias("__id")).agg(F.count(F.lit(1)).alias("__n"))
        total = missing.agg(F.coalesce(F.sum("__n"), F.lit(0)).alias("n"))
        lowest = missing.orderBy("__id").limit(samples)
        example = F.concat_ws(":", "__id", F.col("__n").cast("string"))
        part = total.select("n", F.lit(None).cast("string").alias("id")).unionByName(
            lowest.select(F.lit(0).cast("bigint").alias("n"), example.alias("id"))
        )
        part = part.select(F.lit(ref.label).alias("reference"), "n", "id")
        report = part if report is None else report.unionByName(part)
    # At most samples + 1 rows per reference are collected into one array.
    return report.groupBy("reference").agg(
        F.sum("n").alias("orphans"), F.array_join(F.array_sort(F.collect_list("id")), ",").alias("samples")
    )


def duplicate_audit(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Logical keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("repeats")).where(F.col("repeats") > 1)


def count_where(df: DataFrame, name: str, cond: Column) -> DataFrame:
    """(check, failures): rows for which a condition is true."""
    return df.agg(F.count_if(cond).alias("failures")).select(F.lit(name).alias("check"), "failures")


def any_negative(columns: Sequence[str]) -> Column:
    cond = F.col(columns[0]) < 0
    for c in columns[1:]:
        cond = cond | (F.col(c) < 0)
    return cond


def consistency_counts(fires: DataFrame, operations: DataFrame, damage: DataFrame, population: DataFrame, key: str,
                       start: str, end: str, detected: str, arrived: str, lat: str, lon: str,
                       box: Mapping[str, Sequence[float]], parts: Sequence[str], people: str) -> DataFrame:
    """Impossible times, coordinates out of range, negative damage and invalid population."""
    timed = operations.join(fires.select(key, start), key)
    impossible = ends_before_start(F.col(start), F.col(end), F.col(detected), F.col(arrived))
    return (
        count_where(timed, "impossible_times", impossible)
        .unionByName(count_where(fires, "out_of_range", N.outside_box(F.col(lat), F.col(lon), box)))
        .unionByName(count_where(damage, "negative_damage", any_negative(parts)))
        .unionByName(count_where(population, "invalid_population", F.col(people) <= 0))
    )


def chronology_detail(fires: DataFrame, operations: DataFrame, places: DataFrame, key: str, place: str, name: str,
                      start: str, end: str) -> DataFrame:
    """Fires that end before they start, with the name of their place."""
    timed = fires.select(key, place, start).join(operations.select(key, end), key)
    wrong = timed.where(F.col(end) < F.col(start))
    return lookup(wrong, places.select(place, name), [place]).select(key, name, start, end)


def arrivals_before_detection(operations: DataFrame, key: str, detected: str, arrived: str) -> DataFrame:
    return operations.where(F.col(arrived) < F.col(detected)).select(key, detected, arrived)


def impossible_values(df: DataFrame, variable: str, value: str, low: float = N.SENTINEL,
                      high: float = 100.0) -> DataFrame:
    """Variables whose minimum is at or below the code or whose maximum exceeds the limit."""
    spans = df.groupBy(variable).agg(
        F.min(value).alias("minimum"),
        F.max(value).alias("maximum"),
        F.count_if(F.col(value) <= low).alias("coded_nulls"),
    )
    return spans.where((F.col("minimum") <= low) | (F.col("maximum") > high))


def out_of_box(fires: DataFrame, places: DataFrame, place: str, lat: str, lon: str,
               box: Mapping[str, Sequence[float]], keep: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Fires outside the box, with the name columns of their place."""
    wrong = fires.where(N.outside_box(F.col(lat), F.col(lon), box))
    return lookup(wrong, places, [place], hot_rows=hot_rows).select(*keep)


def damage_outliers(damage: DataFrame, fires: DataFrame, places: DataFrame, key: str, place: str, name: str,
                    parts: Sequence[str], limit: float = 10_000.0) -> DataFrame:
    """Damage rows with a negative part or a total of all parts over the limit."""
    total = F.col(parts[0])
    for c in parts[1:]:
        total = total + F.col(c)
    wrong = damage.withColumn("total", total).where(any_negative(parts) | (F.col("total") > limit))
    placed = wrong.join(fires.select(key, place), key)
    return lookup(placed, places.select(place, name), [place]).select(key, name, *parts, "total")


def variables_in_use(dictionary: DataFrame, series: DataFrame, variable: str) -> DataFrame:
    """Dictionary rows whose variable occurs in the series."""
    return with_parent(dictionary, series, variable).orderBy(variable)


def dictionary_check(local: DataFrame, official: DataFrame, key: str, name: str, unit: str) -> DataFrame:
    """Each local variable with the official name and unit and whether it was found."""
    other = official.select(F.upper(key).alias("__key"), F.col(name).alias("__name"), F.col(unit).alias("__unit"))
    found = F.col("__key").isNotNull()
    return local.join(other, F.upper(local[key]) == F.col("__key"), "left").select(
        local[key],
        F.when(found, F.col("__name")).otherwise("not found").alias("official_name"),
        F.when(found, F.col("__unit")).otherwise("N/A").alias("unit"),
        F.when(found, "verified").otherwise("review").alias("status"),
    )


def schema_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table, column, type, class, rows, nulls) of every column, one pass per table."""
    report = None
    for name, df in tables.items():
        types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
        classes = {f.name: column_class(f.dataType) for f in df.schema.fields}
        part = null_counts(df).select(
            F.lit(name).alias("table"), "column", X.map_labels(F.col("column"), types).alias("type"),
            X.map_labels(F.col("column"), classes).alias("class"), "rows", "nulls",
        )
        report = part if report is None else report.unionByName(part)
    return report


def text_samples(df: DataFrame, n: int = 5) -> DataFrame:
    """A short preview of the text columns."""
    return df.select(*[f.name for f in df.schema.fields if column_class(f.dataType) == "text"]).limit(n)
