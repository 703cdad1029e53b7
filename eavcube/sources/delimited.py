"""Delimited text in and out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

BOM = "﻿"


def read_text_columns(spark: SparkSession, path: str, separator: str = ",", multi_line: bool = True) -> DataFrame:
    """Every column as text, header names without byte-order mark and outer whitespace.

    A doubled quote inside a quoted field is a quote. With `multi_line` quoted fields may hold line breaks, and each
    file is read by one task; turn it off for large files without such fields.
    """
    raw = spark.read.option("header", True).option("sep", separator).option("escape", '"').option("multiLine", multi_line).csv(path)
    return raw.toDF(*[c.replace(BOM, "").strip() for c in raw.columns])


def read_typed(spark: SparkSession, path: str, schema: T.StructType | str, separator: str = ",") -> DataFrame:
    """Typed columns by position, without a pass to infer them; values that do not fit become NULL."""
    return spark.read.schema(schema).option("header", True).option("sep", separator).csv(path)


def write_delimited(df: DataFrame, path: str, bom: bool = False, mode: str = "overwrite") -> None:
    """CSV with header; with `bom` every file starts with the UTF-8 signature."""
    out = df.withColumnRenamed(df.columns[0], BOM + df.columns[0]) if bom else df
    out.write.mode(mode).option("header", True).csv(path)
