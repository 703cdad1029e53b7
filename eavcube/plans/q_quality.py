"""Audit queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eavcube.functions import numbers as N
from eavcube.operators import quality as Q
from eavcube.plans.registry import Tables, query
from eavcube.schemas import Reference

HOME_BOX = {"lat": (18.3, 20.3), "lon": (-100.6, -98.5)}
COUNTRY_BOX = {"lat": (18.0, 20.0), "lon": (-101.0, -98.0)}


def _known(t: Tables) -> DataFrame:
    return t.obs.withColumn("value", N.sentinel_to_null(F.col("value")))


@query("""
, orphans AS (
    SELECT 'line.fire_id -> parent.fire_id' AS reference, CAST(l_orderkey AS VARCHAR) AS id FROM lineitem
    WHERE l_orderkey NOT IN (SELECT fire_id FROM parent)
    UNION ALL SELECT 'fire.place_id -> place.place_id', CAST(place_id AS VARCHAR) FROM fire
    WHERE place_id NOT IN (SELECT place_id FROM place)
), samples AS (
    SELECT reference, string_agg(id || ':' || n, ',' ORDER BY id || ':' || n) AS samples FROM (
        SELECT reference, id, count(*) AS n, row_number() OVER (PARTITION BY reference ORDER BY id) AS k
        FROM orphans GROUP BY reference, id)
    WHERE k <= 3 GROUP BY reference
), refs AS (SELECT 'line.fire_id -> parent.fire_id' AS reference UNION ALL SELECT 'fire.place_id -> place.place_id')
SELECT r.reference, count(o.id) AS orphans, coalesce(max(s.samples), '') AS samples
FROM refs r LEFT JOIN orphans o ON r.reference = o.reference LEFT JOIN samples s ON r.reference = s.reference
GROUP BY r.reference""", "parent fire place")
def fk_audit(t: Tables) -> DataFrame:
    lines = t.raw("lineitem").select(F.col("l_orderkey").alias("fire_id"))
    tables = {"line": lines, "parent": t.parent, "fire": t.fire, "place": t.place}
    return Q.reference_audit(tables, [
        Reference("line", "fire_id", "parent", "fire_id"), Reference("fire", "place_id", "place", "place_id"),
    ])


@query("""
SELECT variable, entity_id, obs_date, count(*) AS repeats FROM obs
GROUP BY variable, entity_id, obs_date HAVING count(*) > 1""", "obs")
def duplicate_audit(t: Tables) -> DataFrame:
    return Q.duplicate_audit(t.obs, ["variable", "entity_id", "obs_date"])


@query("""
SELECT 'impossible_times' AS "check", count(*) AS failures FROM ops o JOIN fire f ON o.fire_id = f.fire_id
WHERE o.end_date < f.start_date OR (o.end_date = f.start_date AND o.arrived_s < o.detected_s)
UNION ALL SELECT 'out_of_range', count(*) FROM fire
WHERE lat NOT BETWEEN 18.0::DOUBLE AND 20.0::DOUBLE OR lon NOT BETWEEN -101.0::DOUBLE AND -98.0::DOUBLE
UNION ALL SELECT 'negative_damage', count(*) FROM damage WHERE shrub - 30 < 0 OR herb < 0 OR tree < 0
UNION ALL SELECT 'invalid_population', count(*) FROM demo WHERE pop_total - 9 <= 0""", "ops fire damage demo")
def consistency_counts(t: Tables) -> DataFrame:
    return Q.consistency_counts(
        t.fire, t.ops, t.damage.withColumn("shrub", F.col("shrub") - 30),
        t.demo.withColumn("pop_total", F.col("pop_total") - 9), "fire_id", "start_date", "end_date", "detected_s",
        "arrived_s", "lat", "lon", COUNTRY_BOX, ["shrub", "herb", "tree"], "pop_total",
    )


@query("""
SELECT f.fire_id, p.place, f.start_date, o.end_date FROM fire f JOIN ops o ON f.fire_id = o.fire_id
JOIN place p ON f.place_id = p.place_id WHERE o.end_date < f.start_date""", "fire ops place")
def chronology_detail(t: Tables) -> DataFrame:
    return Q.chronology_detail(t.fire, t.ops, t.place, "fire_id", "place_id", "place", "start_date", "end_date")


@query("SELECT fire_id, detected_s, arrived_s FROM ops WHERE arrived_s < detected_s", "ops")
def early_arrivals(t: Tables) -> DataFrame:
    return Q.arrivals_before_detection(t.ops, "fire_id", "detected_s", "arrived_s")


@query("""
, wide AS (SELECT f.fire_id, f.fire_type, d.shrub, o.end_date FROM fire f LEFT JOIN damage d ON f.fire_id = d.fire_id
    LEFT JOIN ops o ON f.fire_id = o.fire_id)
SELECT 'fire_id' AS "column", count(*) AS rows, count(*) - count(fire_id) AS nulls,
    round((count(*) - count(fire_id)) * 100.0 / count(*), 2)::DOUBLE AS pct_nulls, 'protected id' AS action FROM wide
UNION ALL SELECT 'fire_type', count(*), count(*) - count(fire_type),
    round((count(*) - count(fire_type)) * 100.0 / count(*), 2)::DOUBLE, 'label missing text' FROM wide
UNION ALL SELECT 'shrub', count(*), count(*) - count(shrub),
    round((count(*) - count(shrub)) * 100.0 / count(*), 2)::DOUBLE, 'keep NULL (metric)' FROM wide
UNION ALL SELECT 'end_date', count(*), count(*) - count(end_date),
    round((count(*) - count(end_date)) * 100.0 / count(*), 2)::DOUBLE, 'keep NULL (temporal)' FROM wide""",
       "fire damage ops")
def null_profile(t: Tables) -> DataFrame:
    wide = (
        t.fire.select("fire_id", "fire_type").join(t.damage.select("fire_id", "shrub"), "fire_id", "left")
        .join(t.ops.select("fire_id", "end_date"), "fire_id", "left")
    )
    return Q.null_profile(wide, ["fire_id"])


@query("""
, k AS (SELECT variable, nullif(value, -999) AS value FROM obs)
SELECT variable, count(*) AS rows, min(value) AS min_value, max(value) AS max_value, round(avg(value), 6) AS mean,
    round(stddev_samp(value), 6) AS std, count(*) - count(value) AS nulls,
    round((count(*) - count(value)) * 100.0 / count(*), 2)::DOUBLE AS pct_nulls,
    round(avg(value) - 4 * stddev_samp(value), 6) AS low_bound,
    round(avg(value) + 4 * stddev_samp(value), 6) AS high_bound FROM k GROUP BY variable""", "obs")
def variable_profile(t: Tables) -> DataFrame:
    return Q.variable_profile(_known(t), "variable", "value")


@query("""
, k AS (SELECT variable, nullif(value, -999) AS value FROM obs)
SELECT count(*) AS rows, count(DISTINCT variable) AS variables, count(*) FILTER (WHERE value IS NULL) AS nulls FROM k
""", "obs")
def series_summary(t: Tables) -> DataFrame:
    return Q.series_summary(_known(t), "variable", "value")


@query("""
SELECT variable, min(value) AS minimum, max(value) AS maximum, count(*) FILTER (WHERE value <= -999) AS coded_nulls
FROM obs GROUP BY variable HAVING min(value) <= -999 OR max(value) > 200""", "obs")
def impossible_values(t: Tables) -> DataFrame:
    return Q.impossible_values(t.obs, "variable", "value", high=200.0)


@query("""
SELECT d.fire_id, p.place, d.shrub, d.herb, d.tree, d.shrub + d.herb + d.tree AS total
FROM (SELECT fire_id, shrub - 5 AS shrub, herb, tree FROM damage) d JOIN fire f ON d.fire_id = f.fire_id
JOIN place p ON f.place_id = p.place_id
WHERE d.shrub < 0 OR d.herb < 0 OR d.tree < 0 OR d.shrub + d.herb + d.tree > 150""", "damage fire place")
def damage_outliers(t: Tables) -> DataFrame:
    damage = t.damage.withColumn("shrub", F.col("shrub") - 5)
    parts = ["shrub", "herb", "tree"]
    return Q.damage_outliers(damage, t.fire, t.place, "fire_id", "place_id", "place", parts, 150.0)


@query("""
SELECT p_partkey AS part, p_name AS name FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_tax > 0.07)
""")
def variables_in_use(t: Tables) -> DataFrame:
    parts = t.raw("part").select(F.col("p_partkey").alias("part"), F.col("p_name").alias("name"))
    used = t.raw("lineitem").where(F.col("l_tax") > 0.07).select(F.col("l_partkey").alias("part"))
    return Q.variables_in_use(parts, used, "part")


@query("""
SELECT f.fire_id, p.place, f.lat, f.lon FROM fire f JOIN place p ON f.place_id = p.place_id
WHERE f.lat NOT BETWEEN 18.3::DOUBLE AND 20.3::DOUBLE OR f.lon NOT BETWEEN -100.6::DOUBLE AND -98.5::DOUBLE
""".replace("f.lat, f.lon FROM", "round(f.lat, 6) AS lat, round(f.lon, 6) AS lon FROM"), "fire place")
def out_of_box(t: Tables) -> DataFrame:
    keep = ["fire_id", "place", "lat", "lon"]
    return Q.out_of_box(t.fire, t.place.drop("state"), "place_id", "lat", "lon", HOME_BOX, keep)


@query("""
SELECT lower(c.c_name) AS id, CASE WHEN s.s_name IS NOT NULL THEN s.s_name ELSE 'not found' END AS official_name,
    CASE WHEN s.s_name IS NOT NULL THEN CAST(s.s_nationkey AS VARCHAR) ELSE 'N/A' END AS unit,
    CASE WHEN s.s_name IS NOT NULL THEN 'verified' ELSE 'review' END AS status
FROM customer c LEFT JOIN supplier s ON upper(c.c_name) = replace(upper(s.s_name), 'SUPPLIER', 'CUSTOMER')""")
def dictionary_check(t: Tables) -> DataFrame:
    local = t.raw("customer").select(F.lower("c_name").alias("id"))
    official = t.raw("supplier").select(
        F.regexp_replace(F.upper("s_name"), "SUPPLIER", "CUSTOMER").alias("id"), F.col("s_name").alias("name"),
        F.col("s_nationkey").cast("string").alias("unit"),
    )
    return Q.dictionary_check(local, official, "id", "name", "unit")


@query("""
SELECT 'orders' AS "table", u.c AS "column", u.t AS "type", u.k AS class, (SELECT count(*) FROM orders) AS rows, 0 AS nulls
FROM (VALUES ('o_orderkey', 'bigint', 'numeric'), ('o_custkey', 'bigint', 'numeric'), ('o_orderstatus', 'string', 'text'),
    ('o_totalprice', 'double', 'numeric'), ('o_orderdate', 'timestamp_ntz', 'temporal'),
    ('o_orderpriority', 'string', 'text')) AS u(c, t, k)
UNION ALL SELECT 'damage', u.c, u.t, 'numeric', (SELECT count(*) FROM damage), CASE u.c
    WHEN 'shrub' THEN (SELECT count(*) FROM damage WHERE shrub IS NULL)
    WHEN 'herb' THEN (SELECT count(*) FROM damage WHERE herb IS NULL)
    WHEN 'tree' THEN (SELECT count(*) FROM damage WHERE tree IS NULL) ELSE 0 END
FROM (VALUES ('fire_id', 'bigint'), ('shrub', 'double'), ('herb', 'double'), ('tree', 'double')) AS u(c, t)""", "damage")
def schema_report(t: Tables) -> DataFrame:
    return Q.schema_report({"orders": t.raw("orders"), "damage": t.damage})
