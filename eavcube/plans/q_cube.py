"""Cube, dimension, index and drill queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eavcube.operators import cube as C
from eavcube.plans.registry import Tables, query


def dim_time(t: Tables) -> DataFrame:
    return C.time_dimension(t.raw("lineitem").select(F.to_date("l_shipdate").alias("d")), "d")


def fact(t: Tables) -> DataFrame:
    ops = t.ops.select("fire_id", "duration_days")
    built = C.fire_fact(t.fire.select("fire_id", "place_id", "entity_id", "start_date"), ops, t.damage, "fire_id")
    return C.with_severity(C.with_areas(built, "tree", "herb", "shrub"))


def places(t: Tables) -> DataFrame:
    return t.place.select("place_id", "place", "state")


def climate(t: Tables) -> DataFrame:
    """Climate means per event user, taken to the fires of the same customer."""
    per_entity = C.climate_fact(t.obs, "entity_id", "variable", "value", "view", "purchase", "error", "s")
    return t.fire.select("fire_id", "entity_id").join(per_entity, "entity_id").drop("entity_id")


FACT = """
, dim_time AS (
    SELECT DISTINCT CAST(l_shipdate AS DATE) AS d FROM lineitem
), fact0 AS (
    SELECT f.fire_id, f.place_id, f.entity_id, f.start_date, o.duration_days, d.tree, d.herb, d.shrub,
        CASE WHEN d.fire_id IS NOT NULL THEN coalesce(d.tree, 0) + coalesce(d.herb, 0) + coalesce(d.shrub, 0) END
            AS total_area
    FROM fire f LEFT JOIN ops o ON f.fire_id = o.fire_id LEFT JOIN damage d ON f.fire_id = d.fire_id
), fact AS (
    SELECT *, coalesce(total_area, 0) * CAST(0.6 AS DOUBLE) + coalesce(duration_days, 0) * CAST(0.4 AS DOUBLE)
        AS severity FROM fact0
)"""

CLIMATE = """
, climate0 AS (
    SELECT entity_id, avg(CASE WHEN variable = 'view' THEN value END) AS temperature,
        avg(CASE WHEN variable = 'purchase' THEN value END) AS wind,
        avg(CASE WHEN variable = 'error' THEN value END) AS humidity,
        avg(CASE WHEN variable LIKE '%s%' THEN value END) AS radiation
    FROM obs GROUP BY entity_id
), climate AS (
    SELECT f.fire_id, c.temperature, c.wind, c.humidity, c.radiation
    FROM fire f JOIN climate0 c ON f.entity_id = c.entity_id
)"""

FACT_ADAPTERS = "fire ops damage"


@query(FACT + """
SELECT CAST(year(d) AS BIGINT) AS year, count(*) AS fires, round(avg(severity), 6) AS severity,
    round(sum(total_area), 6) AS area
FROM fact JOIN dim_time ON start_date = d GROUP BY year(d)""", FACT_ADAPTERS)
def cube_annual(t: Tables) -> DataFrame:
    return C.annual_summary(fact(t), dim_time(t), "start_date")


@query(FACT + """
SELECT CAST(year(d) AS BIGINT) AS year, CAST(quarter(d) AS BIGINT) AS quarter, CAST(month(d) AS BIGINT) AS month,
    CASE month(d) WHEN 1 THEN 'Enero' WHEN 2 THEN 'Febrero' WHEN 3 THEN 'Marzo' WHEN 4 THEN 'Abril'
        WHEN 5 THEN 'Mayo' WHEN 6 THEN 'Junio' WHEN 7 THEN 'Julio' WHEN 8 THEN 'Agosto'
        WHEN 9 THEN 'Septiembre' WHEN 10 THEN 'Octubre' WHEN 11 THEN 'Noviembre' ELSE 'Diciembre' END AS month_name,
    count(*) AS fires, round(avg(severity), 6) AS severity, round(sum(total_area), 6) AS area
FROM fact JOIN dim_time ON start_date = d GROUP BY 1, 2, 3, 4""", FACT_ADAPTERS)
def cube_time(t: Tables) -> DataFrame:
    return C.time_cube(fact(t), dim_time(t), "start_date")


@query(FACT + """
SELECT CAST(year(d) AS BIGINT) AS year, CAST(month(d) AS BIGINT) AS month, count(*) AS fires
FROM fact JOIN dim_time ON start_date = d GROUP BY 1, 2""", FACT_ADAPTERS)
def cube_time_hierarchy(t: Tables) -> DataFrame:
    return C.time_hierarchy(fact(t), dim_time(t), "start_date")


@query("""
SELECT DISTINCT CAST(l_shipdate AS DATE) AS date, CAST(year(l_shipdate) AS BIGINT) AS year,
    CAST(month(l_shipdate) AS BIGINT) AS month, CAST(quarter(l_shipdate) AS BIGINT) AS quarter,
    CASE month(l_shipdate) WHEN 1 THEN 'Enero' WHEN 2 THEN 'Febrero' WHEN 3 THEN 'Marzo' WHEN 4 THEN 'Abril'
        WHEN 5 THEN 'Mayo' WHEN 6 THEN 'Junio' WHEN 7 THEN 'Julio' WHEN 8 THEN 'Agosto'
        WHEN 9 THEN 'Septiembre' WHEN 10 THEN 'Octubre' WHEN 11 THEN 'Noviembre' ELSE 'Diciembre' END AS month_name,
    CASE WHEN month(l_shipdate) IN (12, 1, 2) THEN 'Invierno' WHEN month(l_shipdate) IN (3, 4, 5) THEN 'Primavera'
        WHEN month(l_shipdate) IN (6, 7, 8) THEN 'Verano' ELSE 'Otoño' END AS season,
    isodow(CAST(l_shipdate AS DATE)) IN (6, 7) AS is_weekend
FROM lineitem""")
def dim_time_enriched(t: Tables) -> DataFrame:
    return dim_time(t)


@query(FACT + """
SELECT p.state, p.place, count(*) AS fires, round(avg(f.severity), 6) AS severity,
    round(sum(coalesce(f.total_area, 0)), 6) AS area
FROM fact f JOIN place p ON f.place_id = p.place_id GROUP BY p.state, p.place""", FACT_ADAPTERS + " place")
def cube_geo(t: Tables) -> DataFrame:
    return C.geographic_cube(fact(t), places(t), "place_id")


@query(FACT + CLIMATE + """
SELECT p.place, count(*) AS fires, round(avg(f.severity), 6) AS severity,
    round(avg(c.temperature), 6) AS temperature
FROM fact f JOIN place p ON f.place_id = p.place_id LEFT JOIN climate c ON f.fire_id = c.fire_id
GROUP BY p.place HAVING count(*) > 100""", FACT_ADAPTERS + " place obs")
def top_risk_places(t: Tables) -> DataFrame:
    return C.critical_places(fact(t), places(t), climate(t), "fire_id", "place_id")


_POPULATION = """
SELECT p.place, count(f.fire_id) AS fires, round(avg(d.pop_total), 6) AS population,
    round(count(f.fire_id) * {scale} / nullif(avg(d.pop_total), 0), 6) AS impact
FROM fire f JOIN place p ON f.place_id = p.place_id LEFT JOIN demo d ON f.place_id = d.place_id
GROUP BY p.place"""


@query(_POPULATION.format(scale="CAST(1 AS DOUBLE)"), "fire place demo")
def place_risk(t: Tables) -> DataFrame:
    return C.population_impact(t.fire, places(t), t.demo, "fire_id", "place_id", "pop_total")


@query(_POPULATION.format(scale="CAST(1000 AS DOUBLE)"), "fire place demo")
def place_impact(t: Tables) -> DataFrame:
    return C.population_impact(t.fire, places(t), t.demo, "fire_id", "place_id", "pop_total", 1000.0)


@query("""
, per AS (SELECT place_id, avg(pop_total) AS a FROM demo GROUP BY place_id)
SELECT p.place, count(f.fire_id) AS fires, round(avg(per.a), 6) AS population,
    round(count(f.fire_id) * CAST(1000 AS DOUBLE) / nullif(avg(per.a), 0), 6) AS impact
FROM fire f JOIN place p ON f.place_id = p.place_id LEFT JOIN per ON f.place_id = per.place_id
GROUP BY p.place""", "fire place demo")
def place_impact_once(t: Tables) -> DataFrame:
    return C.population_impact(
        t.fire, places(t), t.demo, "fire_id", "place_id", "pop_total", 1000.0, pre_aggregate=True
    )


@query(CLIMATE + """
SELECT fire_id, round(temperature, 6) AS temperature, round(wind, 6) AS wind, round(humidity, 6) AS humidity,
    round(radiation, 6) AS radiation FROM climate""", "obs fire")
def climate_fact(t: Tables) -> DataFrame:
    return climate(t)


_BUCKETS = FACT + CLIMATE + """
SELECT round(c.temperature) AS temperature, round(c.wind, 1) AS wind, count(*) AS fires,
    round(avg(f.severity), 6) AS severity
FROM fact f {how} JOIN climate c ON f.fire_id = c.fire_id GROUP BY 1, 2"""


@query(_BUCKETS.format(how="LEFT"), FACT_ADAPTERS + " obs")
def climate_buckets_left(t: Tables) -> DataFrame:
    return C.climate_buckets(fact(t), climate(t), "fire_id", "left")


@query(_BUCKETS.format(how=""), FACT_ADAPTERS + " obs")
def climate_buckets_inner(t: Tables) -> DataFrame:
    return C.climate_buckets(fact(t), climate(t), "fire_id", "inner")


@query(FACT + """
SELECT fire_id, tree AS tree_area, herb AS herb_area, total_area, duration_days, round(severity, 6) AS severity
FROM fact""", FACT_ADAPTERS)
def severity_v1(t: Tables) -> DataFrame:
    return fact(t).select("fire_id", "tree_area", "herb_area", "total_area", "duration_days", "severity")


@query(FACT + """
SELECT fire_id, round(coalesce(CASE WHEN fire_id % 3 = 0 THEN severity END,
    coalesce(total_area, 0) * CAST(0.5 AS DOUBLE) + coalesce(duration_days, 0) * CAST(0.3 AS DOUBLE)
    + coalesce(tree, 0) * CAST(0.2 AS DOUBLE)), 6) AS severity
FROM fact""", FACT_ADAPTERS)
def severity_v2(t: Tables) -> DataFrame:
    partly = fact(t).withColumn("severity", F.when(F.col("fire_id") % 3 == 0, F.col("severity")))
    return C.with_severity(partly, C.SEVERITY_2, only_missing=True).select("fire_id", "severity")


@query(CLIMATE + """
SELECT f.fire_id, round(CASE WHEN c.fire_id IS NOT NULL THEN coalesce(c.temperature, 0) * CAST(0.4 AS DOUBLE)
    + coalesce(c.wind, 0) * CAST(0.3 AS DOUBLE) + coalesce(c.humidity, 0) * CAST(0.3 AS DOUBLE) END, 6) AS risk
FROM fire f LEFT JOIN climate c ON f.fire_id = c.fire_id""", "obs fire")
def climate_risk_v1(t: Tables) -> DataFrame:
    return C.with_climate_risk(t.fire.select("fire_id"), climate(t), "fire_id")


@query(CLIMATE + """
SELECT f.fire_id, round(CASE WHEN f.fire_id % 5 = 0 THEN CAST(1 AS DOUBLE)
    WHEN c.fire_id IS NULL OR (c.temperature IS NULL AND c.wind IS NULL AND c.humidity IS NULL) THEN NULL
    ELSE coalesce(c.temperature, 0) * CAST(0.4 AS DOUBLE) + coalesce(c.wind, 0) * CAST(0.3 AS DOUBLE)
    - coalesce(c.humidity, 0) * CAST(0.2 AS DOUBLE) END, 6) AS risk
FROM fire f LEFT JOIN climate c ON f.fire_id = c.fire_id""", "obs fire")
def climate_risk_v2(t: Tables) -> DataFrame:
    fires = t.fire.select("fire_id").withColumn("risk", F.when(F.col("fire_id") % 5 == 0, F.lit(1.0)))
    return C.with_climate_risk(
        fires, climate(t), "fire_id", C.CLIMATE_RISK_2, null_when_unknown=True, only_missing=True
    )


@query("SELECT id, kind, detail FROM cat", "cat")
def dim_cause(t: Tables) -> DataFrame:
    return t.cat.select("id", "kind", "detail")


@query("""
SELECT p_partkey AS id, p_name AS kind, p_type AS regime, CASE WHEN lower(p_name) LIKE '%widget%' THEN CAST(0.9 AS DOUBLE)
    WHEN lower(p_name) LIKE '%ring%' THEN CAST(0.95 AS DOUBLE) WHEN lower(p_name) LIKE '%bolt%' THEN CAST(0.7 AS DOUBLE)
    ELSE CAST(0.5 AS DOUBLE) END AS vegetation_risk FROM part""")
def dim_vegetation_risk(t: Tables) -> DataFrame:
    parts = t.raw("part").select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("kind"), F.col("p_type").alias("regime")
    )
    return C.vegetation_dimension(parts, "id", "kind", "regime", {"widget": 0.9, "Ring": 0.95, "bolt": 0.7})


@query("SELECT DISTINCT fire_type AS type FROM fire", "fire")
def dim_type(t: Tables) -> DataFrame:
    return C.type_dimension(t.raw("orders").select(F.col("o_orderpriority").alias("fire_type")), "fire_type")


@query("""
, m AS (SELECT s_nationkey % 25 AS key, max(s_suppkey % 7) AS owner FROM supplier GROUP BY 1)
SELECT lpad(CAST(n_nationkey AS VARCHAR), 5, '0') AS key, n_name AS place,
    CASE WHEN r_name IS NOT NULL THEN r_name ELSE substr(lpad(CAST(n_nationkey AS VARCHAR), 5, '0'), 1, 2) END AS state,
    CASE WHEN r_name IS NOT NULL THEN 'region ' || r_name END AS region
FROM nation LEFT JOIN m ON n_nationkey = m.key LEFT JOIN region ON m.owner = r_regionkey""")
def dim_place_states(t: Tables) -> DataFrame:
    key = F.lpad(F.col("n_nationkey").cast("string"), 5, "0").alias("key")
    dimension = C.place_dimension(t.raw("nation").select(key, "n_name"), "key", "n_name")
    members = t.raw("supplier").select(
        F.lpad((F.col("s_nationkey") % 25).cast("string"), 5, "0").alias("key"),
        (F.col("s_suppkey") % 7).cast("int").alias("owner"),
    )
    states = t.raw("region").select(
        F.col("r_regionkey").alias("owner"), F.col("r_name").alias("state"),
        F.concat(F.lit("region "), "r_name").alias("region"),
    )
    return C.with_state_names(dimension, members, states, "key", "owner", "state", "region")


@query(FACT + """
SELECT CAST(month(d) AS BIGINT) AS month, count(*) AS fires FROM fact JOIN dim_time ON start_date = d GROUP BY 1
""", FACT_ADAPTERS)
def drill_monthly(t: Tables) -> DataFrame:
    cube = C.time_hierarchy(fact(t), dim_time(t), "start_date")
    return cube.groupBy("month").agg(F.sum("fires").alias("fires"))


@query(FACT + """
SELECT p.place, count(*) AS fires FROM fact f JOIN place p ON f.place_id = p.place_id
GROUP BY p.place ORDER BY fires DESC, p.place LIMIT 10""", FACT_ADAPTERS + " place")
def drill_top_places(t: Tables) -> DataFrame:
    cube = C.geographic_cube(fact(t), places(t), "place_id").select("place", "fires")
    return C.top_k(cube, "fires", 10, ["place"])


@query("""
, impact AS (
    SELECT p.place, avg(d.pop_total) AS population,
        count(f.fire_id) * CAST(1000 AS DOUBLE) / nullif(avg(d.pop_total), 0) AS impact
    FROM fire f JOIN place p ON f.place_id = p.place_id LEFT JOIN demo d ON f.place_id = d.place_id GROUP BY p.place
)
SELECT place, round(impact, 6) AS impact FROM impact WHERE population > 1.3
ORDER BY round(impact, 6) DESC, place LIMIT 10""", "fire place demo")
def drill_top_impact(t: Tables) -> DataFrame:
    impact = C.population_impact(t.fire, places(t), t.demo, "fire_id", "place_id", "pop_total", 1000.0)
    ranked = impact.withColumn("impact", F.round("impact", 6))
    return C.top_k(ranked, "impact", 10, ["place"], F.col("population") > 1.3).select("place", "impact")
