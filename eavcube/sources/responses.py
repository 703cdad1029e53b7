"""JSON catalogues and service responses as typed rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DESCRIPTORS = "id string, name string, sources array<string>, range map<string,string>"
VERIFIED = "id string, nombre string, fuente string, rango map<string,string>, unidades string"
SERIES = "properties struct<parameter: map<string, map<string, double>>>"
UNITS = (
    "parameters map<string, struct<units: string>>, "
    "header struct<parameter: map<string, struct<units: string>>>"
)
MATRIX = "array<array<string>>"

# Defaults of fields that are missing in the catalogues.
DEFAULT_SOURCE, DEFAULT_UNIT, DEFAULT_NAME, UNKNOWN_UNIT, NO_UNIT = (
    "NASA", "Por definir", "Sin nombre", "N/A", "n/a",
)


def read_json_list(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A JSON array of objects with a fixed schema."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def shape_descriptors(df: DataFrame) -> DataFrame:
    """Descriptors reduced to id, name, first source, range and a unit to be filled in."""
    return df.select(
        "id",
        F.col("name").alias("nombre"),
        F.coalesce(F.get("sources", F.lit(0)), F.lit(DEFAULT_SOURCE)).alias("fuente"),
        F.coalesce("range", F.create_map().cast("map<string,string>")).alias("rango"),
        F.lit(DEFAULT_UNIT).alias("unidades"),
    )


def dictionary_rows(df: DataFrame) -> DataFrame:
    """Verified descriptors as dictionary rows, with defaults for missing names and units."""
    return df.select(
        F.col("id").alias("id_variable"),
        F.lit(DEFAULT_SOURCE).alias("fuente"),
        F.coalesce("nombre", F.lit(DEFAULT_NAME)).alias("nombre_completo"),
        F.coalesce("unidades", F.lit(UNKNOWN_UNIT)).alias("unidad_de_medida"),
    )


def parse_series(df: DataFrame, body: str, keep: Sequence[str], pattern: str = "yyyyMMdd") -> DataFrame:
    """Nested variable -> date -> value responses as rows (kept columns, variable, obs_date, value)."""
    parsed = df.select(*keep, F.from_json(body, SERIES).alias("__r"))
    variables = parsed.select(*keep, F.explode("__r.properties.parameter").alias("variable", "__days"))
    days = variables.select(*keep, "variable", F.explode("__days").alias("__day", "value"))
    return days.select(*keep, "variable", F.try_to_date("__day", pattern).alias("obs_date"), "value")


def unreadable_series(df: DataFrame, body: str) -> DataFrame:
    """Rows whose response `parse_series` cannot read, to be stored or asked for again."""
    return df.where(F.from_json(body, SERIES)["properties"]["parameter"].isNull())


def parse_units(df: DataFrame, body: str) -> DataFrame:
    """(variable, unit) from either place a response may keep its metadata in."""
    parsed = df.select(F.from_json(body, UNITS).alias("__r"))
    first = F.when(F.size("__r.parameters") > 0, F.col("__r.parameters"))
    table = F.coalesce(first, F.col("__r.header.parameter"))
    rows = parsed.select(F.explode(table).alias("variable", "__info"))
    return rows.select("variable", F.coalesce("__info.units", F.lit(NO_UNIT)).alias("unit"))


def parse_matrix(df: DataFrame, body: str, keep: Sequence[str], columns: dict[str, str]) -> DataFrame:
    """Header row plus value rows as one row per value row; `columns` maps names to types.

    The type `epoch_ms` turns milliseconds since the epoch into a date.
    """
    parsed = df.select(*keep, F.from_json(body, MATRIX).alias("__m"))
    rows = parsed.select(
        *keep,
        F.get("__m", F.lit(0)).alias("__header"),
        F.explode(F.slice("__m", F.lit(2), F.greatest(F.size("__m") - 1, F.lit(0)))).alias("__row"),
    )
    named = rows.select(*keep, F.map_from_arrays("__header", "__row").alias("__v"))
    return named.select(*keep, *[_typed(name, kind) for name, kind in columns.items()])


def _typed(name: str, kind: str) -> Column:
    text = F.try_element_at("__v", F.lit(name))
    if kind == "epoch_ms":
        return F.to_date(F.timestamp_millis(text.try_cast("bigint"))).alias(name)
    return text.try_cast(kind).alias(name)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path)
