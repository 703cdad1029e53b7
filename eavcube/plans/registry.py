"""Registry of queries over the driver tables, each next to the SQL that checks it."""

from __future__ import annotations

import inspect
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Schemas read so far: a file footer is opened once per table, as a catalogue would.
_SCHEMAS: dict[str, T.StructType] = {}

# What each adapter stands for, over the raw tables. The Spark twins are in `Tables`.
ADAPTERS = {
    "obs": """SELECT event_id AS obs_id, event_type AS variable, user_id AS entity_id, CAST(ts AS DATE) AS obs_date,
        CASE WHEN event_type = 'signup' OR (event_type = 'click' AND event_id % 17 = 0)
             THEN CAST(-999 AS DOUBLE) ELSE value END AS value FROM events""",
    "entity": """SELECT user_id AS entity_id, max(CAST(ts AS DATE)) AS start_date
        FROM events WHERE event_type = 'error' GROUP BY user_id""",
    "fire": """SELECT o_orderkey AS fire_id, CAST(c_nationkey AS BIGINT) AS place_id, o_custkey AS entity_id,
        o_orderkey % 200 AS cat_id, CAST(o_orderdate AS DATE) AS start_date, o_orderpriority AS fire_type,
        CAST(17.5 AS DOUBLE) + CAST(o_orderkey % 300 AS DOUBLE) / CAST(100 AS DOUBLE) AS lat,
        CAST(-101.5 AS DOUBLE) + CAST(o_orderkey % 400 AS DOUBLE) / CAST(100 AS DOUBLE) AS lon
        FROM orders JOIN customer ON o_custkey = c_custkey""",
    "place": """SELECT CAST(n_nationkey AS BIGINT) AS place_id, n_name AS place,
        r_name AS state FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "damage": """SELECT l_orderkey AS fire_id,
        sum(CASE WHEN l_returnflag = 'A' THEN l_quantity END) AS shrub,
        sum(CASE WHEN l_returnflag = 'N' THEN l_quantity END) AS herb,
        sum(CASE WHEN l_returnflag = 'R' THEN l_quantity END) AS tree
        FROM lineitem GROUP BY l_orderkey""",
    "ops": """SELECT l_orderkey AS fire_id, max(CAST(l_shipdate AS DATE)) AS end_date,
        CAST(date_diff('day', min(CAST(l_shipdate AS DATE)), max(CAST(l_shipdate AS DATE))) AS BIGINT) AS duration_days,
        (l_orderkey * 3701) % 86400 AS detected_s, (l_orderkey * 5303) % 86400 AS arrived_s
        FROM lineitem GROUP BY l_orderkey""",
    "demo": """SELECT CAST(c_nationkey AS BIGINT) AS place_id, c_mktsegment AS segment, count(*) AS pop_total
        FROM customer GROUP BY c_nationkey, c_mktsegment""",
    "cat": "SELECT p_partkey AS id, p_brand AS kind, p_type AS detail FROM part",
    "parent": "SELECT o_orderkey AS fire_id FROM orders WHERE o_orderkey % 50 <> 0",
}


class Tables:
    """The driver tables of one folder and the adapters over them, all lazy."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def raw(self, name: str) -> DataFrame:
        path = f"{self.folder}/{name}.parquet"
        if path not in _SCHEMAS:
            _SCHEMAS[path] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(_SCHEMAS[path]).parquet(path)

    @cached_property
    def obs(self) -> DataFrame:
        kind, number = F.col("event_type"), F.col("event_id")
        lost = (kind == "signup") | ((kind == "click") & (number % 17 == 0))
        return self.raw("events").select(
            number.alias("obs_id"), kind.alias("variable"), F.col("user_id").alias("entity_id"),
            F.to_date("ts").alias("obs_date"), F.when(lost, F.lit(-999.0)).otherwise(F.col("value")).alias("value"),
        )

    @cached_property
    def entity(self) -> DataFrame:
        errors = self.raw("events").where(F.col("event_type") == "error")
        return errors.groupBy(F.col("user_id").alias("entity_id")).agg(F.max(F.to_date("ts")).alias("start_date"))

    @cached_property
    def fire(self) -> DataFrame:
        key = F.col("o_orderkey")
        joined = self.raw("orders").join(self.raw("customer"), F.col("o_custkey") == F.col("c_custkey"))
        return joined.select(
            key.alias("fire_id"), F.col("c_nationkey").cast("bigint").alias("place_id"),
            F.col("o_custkey").alias("entity_id"), (key % 200).alias("cat_id"),
            F.to_date("o_orderdate").alias("start_date"), F.col("o_orderpriority").alias("fire_type"),
            (F.lit(17.5) + (key % 300).cast("double") / F.lit(100.0)).alias("lat"),
            (F.lit(-101.5) + (key % 400).cast("double") / F.lit(100.0)).alias("lon"),
        )

    @cached_property
    def place(self) -> DataFrame:
        joined = self.raw("nation").join(self.raw("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        return joined.select(
            F.col("n_nationkey").cast("bigint").alias("place_id"), F.col("n_name").alias("place"),
            F.col("r_name").alias("state"),
        )

    @cached_property
    def damage(self) -> DataFrame:
        flags = {"shrub": "A", "herb": "N", "tree": "R"}
        sums = [
            F.sum(F.when(F.col("l_returnflag") == flag, F.col("l_quantity"))).alias(name)
            for name, flag in flags.items()
        ]
        return self.raw("lineitem").groupBy(F.col("l_orderkey").alias("fire_id")).agg(*sums)

    @cached_property
    def ops(self) -> DataFrame:
        day = F.to_date("l_shipdate")
        rows = self.raw("lineitem").groupBy(F.col("l_orderkey").alias("fire_id")).agg(
            F.max(day).alias("end_date"), F.min(day).alias("first_date")
        )
        return rows.select(
            "fire_id", "end_date", F.datediff("end_date", "first_date").cast("bigint").alias("duration_days"),
            ((F.col("fire_id") * 3701) % 86400).alias("detected_s"), ((F.col("fire_id") * 5303) % 86400).alias("arrived_s"),
        )

    @cached_property
    def demo(self) -> DataFrame:
        grouped = self.raw("customer").groupBy(
            F.col("c_nationkey").cast("bigint").alias("place_id"), F.col("c_mktsegment").alias("segment")
        )
        return grouped.agg(F.count(F.lit(1)).alias("pop_total"))

    @cached_property
    def cat(self) -> DataFrame:
        return self.raw("part").select(
            F.col("p_partkey").alias("id"), F.col("p_brand").alias("kind"), F.col("p_type").alias("detail")
        )

    @cached_property
    def parent(self) -> DataFrame:
        return self.raw("orders").where(F.col("o_orderkey") % 50 != 0).select(F.col("o_orderkey").alias("fire_id"))


def query(oracle: str | None = None, adapters: str = ""):
    """Register a function of `Tables` under its name.

    `oracle` is the checking SQL; the named adapters are put in front of it as common table expressions,
    and it may start with a comma to add its own.
    """

    def register(build: Callable[[Tables], DataFrame]):
        name = build.__name__
        QUERIES[name] = lambda spark, folder: _plain(build(Tables(spark, folder)))
        if oracle is not None:
            ORACLES[name] = with_adapters(oracle, adapters.split())
        return build

    return register


def with_adapters(sql: str, names: list[str]) -> str:
    body = inspect.cleandoc(sql)
    if not names:
        return body.lstrip(",").strip() if not body.startswith(",") else "WITH " + body[1:].strip()
    heads = ",\n".join(f"{n} AS ({ADAPTERS[n]})" for n in names)
    return f"WITH {heads}{body if body.startswith(',') else chr(10) + body}"


def _plain(df: DataFrame) -> DataFrame:
    """Counts and keys as BIGINT and doubles to six places, so that both engines give equal values."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DoubleType):
            c = F.round(c, 6)
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType)):
            c = c.cast("bigint")
        out.append(c.alias(f.name))
    return df.select(*out)
