"""Join, set, key and date queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eavcube.functions import dates as D
from eavcube.functions import numbers as N
from eavcube.functions import text as X
from eavcube.operators import aggregate as A
from eavcube.operators import relational as R
from eavcube.operators import window as W
from eavcube.operators.ordered import bounded_list
from eavcube.plans.registry import Tables, query

@query("""
SELECT o.fire_id, o.place_id, o.fire_type FROM fire o
WHERE o.fire_id IN (SELECT fire_id FROM parent) AND o.entity_id NOT IN (SELECT entity_id FROM entity)
    AND o.fire_type IN ('1-URGENT', '2-HIGH') AND o.fire_type NOT LIKE '%LOW' AND o.fire_type LIKE '%H%'
    """, "fire parent entity")
def semi_anti(t: Tables) -> DataFrame:
    kind = F.col("fire_type")
    chosen = t.fire.where(kind.isin("1-URGENT", "2-HIGH") & ~kind.endswith("LOW") & kind.contains("H"))
    known = R.with_parent(chosen, t.parent, "fire_id")
    return R.not_in(known, t.entity, ["entity_id"]).select("fire_id", "place_id", "fire_type")


@query("""
SELECT trim(c.c_mktsegment) AS segment, n.n_name AS place, count(*) AS n
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN supplier s
    ON c.c_nationkey = s.s_nationkey AND c.c_custkey = s.s_suppkey
WHERE trim(c.c_mktsegment) <> 'BUILDING' GROUP BY 1, 2""")
def composite_lookup(t: Tables) -> DataFrame:
    customers = t.raw("customer").where(F.trim("c_mktsegment") != "BUILDING").select(
        F.col("c_nationkey").alias("nation"), F.col("c_custkey").alias("number"), F.trim("c_mktsegment").alias("segment")
    )
    suppliers = t.raw("supplier").select(F.col("s_nationkey").alias("nation"), F.col("s_suppkey").alias("number"))
    nations = t.raw("nation").select(F.col("n_nationkey").alias("nation"), F.col("n_name").alias("place"))
    matched = R.lookup(customers, suppliers, ["nation", "number"])
    return R.lookup(matched, nations, ["nation"]).groupBy("segment", "place").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT variable, count(DISTINCT entity_id) AS entities FROM obs GROUP BY variable", "obs")
def distinct_count(t: Tables) -> DataFrame:
    return A.distinct_count(t.obs, "variable", "entity_id", "entities")


@query("SELECT place_id, max(entity_id) AS highest FROM fire GROUP BY place_id", "fire")
def max_per_key(t: Tables) -> DataFrame:
    return t.fire.groupBy("place_id").agg(F.max("entity_id").alias("highest"))


@query("""
SELECT DISTINCT p_brand AS kind, p_type AS detail FROM part
EXCEPT SELECT p_brand, p_type FROM part WHERE p_brand < 'Brand#15'""")
def catalogue_new_pairs(t: Tables) -> DataFrame:
    pairs = t.cat.select("kind", "detail")
    return R.new_rows(pairs, t.cat.where(F.col("kind") < "Brand#15").select("kind", "detail"))


@query("""
, pairs AS (SELECT DISTINCT kind, detail FROM cat)
SELECT kind, detail, row_number() OVER (ORDER BY kind, detail) + (SELECT max(c_custkey) FROM customer) AS id
FROM pairs""", "cat")
def surrogate_keys(t: Tables) -> DataFrame:
    stored = t.raw("customer").select(F.col("c_custkey").alias("id"))
    return R.surrogate_keys(t.cat.select("kind", "detail").distinct(), "id", ["kind", "detail"], stored)


@query("""
SELECT id, first_value(id) OVER (PARTITION BY kind, detail ORDER BY id) AS canonical FROM cat""", "cat")
def canonical_catalogue_ids(t: Tables) -> DataFrame:
    mapping = W.canonical_ids(t.cat, "id", ["kind", "detail"])
    return mapping.select(F.col("bad_id").alias("id"), F.col("good_id").alias("canonical"))


@query("""
SELECT variable, entity_id, obs_date, obs_id FROM (
    SELECT *, row_number() OVER (PARTITION BY variable, entity_id, obs_date ORDER BY obs_id) AS n FROM obs
) WHERE n > 1""", "obs")
def repeated_observations(t: Tables) -> DataFrame:
    repeated = W.repeated_rows(t.obs, ["variable", "entity_id", "obs_date"], "obs_id")
    return repeated.select("variable", "entity_id", "obs_date", "obs_id")


@query("""
SELECT entity_id FROM fire WHERE place_id = 3
UNION SELECT entity_id FROM obs WHERE value < 0
UNION SELECT entity_id FROM entity WHERE start_date < DATE '2024-01-15'""", "fire obs entity")
def union_of_ids(t: Tables) -> DataFrame:
    sets = [
        t.fire.where(F.col("place_id") == 3), t.obs.where(F.col("value") < 0),
        t.entity.where(F.col("start_date") < F.lit("2024-01-15").cast("date")),
    ]
    return R.union_ids(sets, "entity_id")


@query("""
, first AS (SELECT c_custkey AS id, c_name AS name FROM customer WHERE c_custkey % 3 = 0),
second AS (SELECT c_custkey AS id, 'second ' || c_name AS name FROM customer WHERE c_custkey % 2 = 0)
SELECT * FROM first UNION ALL SELECT * FROM second WHERE id NOT IN (SELECT id FROM first)""")
def insert_if_absent(t: Tables) -> DataFrame:
    rows = t.raw("customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    first = rows.where(F.col("id") % 3 == 0)
    second = rows.where(F.col("id") % 2 == 0).withColumn("name", F.concat(F.lit("second "), "name"))
    return R.insert_if_absent([first, second], ["id"])


@query("""
, incoming AS (SELECT entity_id, variable, obs_date, value * 2 AS value FROM obs WHERE obs_date >= DATE '2024-01-20')
SELECT entity_id, variable, obs_date, value FROM obs o
WHERE NOT EXISTS (SELECT 1 FROM incoming i WHERE i.entity_id = o.entity_id AND i.variable = o.variable)
UNION ALL SELECT entity_id, variable, obs_date, value FROM incoming""", "obs")
def upsert_by_key(t: Tables) -> DataFrame:
    stored = t.obs.select("entity_id", "variable", "obs_date", "value")
    incoming = stored.where(F.col("obs_date") >= F.lit("2024-01-20").cast("date")).withColumn(
        "value", F.col("value") * 2
    )
    return R.upsert_by_key(stored, incoming, ["entity_id", "variable"])


@query("""
SELECT f.fire_id, CASE WHEN e.entity_id IS NOT NULL THEN 'seen ' || f.fire_type ELSE f.fire_type END AS fire_type
FROM fire f LEFT JOIN entity e ON f.entity_id = e.entity_id""", "fire entity")
def update_matched(t: Tables) -> DataFrame:
    seen = t.entity.select("entity_id", F.lit("seen ").alias("mark"))
    fires = t.fire.select("fire_id", "entity_id", "fire_type", F.lit("").alias("mark"))
    marked = R.update_from(fires, seen, ["entity_id"], {"mark": F.col("mark")})
    return marked.select("fire_id", F.concat("mark", "fire_type").alias("fire_type"))


@query("""
SELECT obs_id, CASE WHEN value < 0 THEN NULL ELSE value END AS value FROM obs
WHERE NOT (variable = 'view' AND value > 50)""", "obs")
def update_delete_where(t: Tables) -> DataFrame:
    updated = R.update_where(t.obs.select("obs_id", "variable", "value"), "value", F.col("value") < 0, F.lit(None))
    return R.delete_where(updated, (F.col("variable") == "view") & (F.col("value") > 50)).select("obs_id", "value")


@query("""
SELECT e.entity_id, e.start_date FROM entity e WHERE e.entity_id NOT IN (
    SELECT entity_id FROM obs WHERE value > 60 GROUP BY entity_id HAVING count(DISTINCT variable) >= 4)""", "entity obs")
def pending_entities(t: Tables) -> DataFrame:
    measured = t.obs.where(F.col("value") > 60)
    return R.pending_entities(t.entity, measured, "entity_id", "variable", count=4)


@query("""
, names AS (SELECT variable, CAST((row_number() OVER (ORDER BY variable) - 1) // 2 AS BIGINT) AS bundle
    FROM (SELECT DISTINCT variable FROM obs)),
groups AS (SELECT bundle, string_agg(variable, ',' ORDER BY variable) AS variables, count(*) AS size
    FROM names GROUP BY bundle),
present AS (SELECT o.entity_id, n.bundle, count(DISTINCT o.variable) AS k
    FROM obs o JOIN names n ON o.variable = n.variable WHERE o.value > 100 GROUP BY 1, 2)
SELECT e.entity_id, CAST(e.entity_id AS DOUBLE) / 4 AS lat, g.bundle, g.variables, strftime(e.start_date - INTERVAL 9 DAY, '%Y%m%d') AS window_start,
    strftime(e.start_date, '%Y%m%d') AS window_end
FROM entity e, groups g LEFT JOIN present p ON p.entity_id = e.entity_id AND p.bundle = g.bundle
WHERE coalesce(p.k, 0) < g.size""", "obs entity")
def request_plan(t: Tables) -> DataFrame:
    groups = R.bundles(bounded_list(t.obs, "variable"), 2)
    seen = t.obs.where(F.col("value") > 100)
    places = t.entity.withColumn("lat", F.col("entity_id").cast("double") / 4)
    return R.request_plan(places, seen, "entity_id", "start_date", "variable", groups, 10, ["lat"])


_BANDS = """
, bands AS (
    SELECT user_id AS entity_id, ts, event_id,
        CASE WHEN event_id % 11 = 0 THEN NULL ELSE value / 500 END AS b01,
        CASE WHEN event_id % 13 = 0 THEN NULL ELSE (value + 40) / 500 END AS b02,
        CASE WHEN event_id % 101 = 0 THEN -value ELSE value / 300 END AS b06, (value + 10) / 700 AS b07
    FROM events
), idx AS (
    SELECT entity_id, ts, event_id,
        CASE WHEN b02 >= 0 AND b01 >= 0 THEN (b02 - b01) / nullif(b02 + b01, 0) END AS ndvi,
        CASE WHEN b02 >= 0 AND b06 >= 0 THEN (b02 - b06) / nullif(b02 + b06, 0) END AS ndwi,
        CASE WHEN b02 >= 0 AND b07 >= 0 THEN (b02 - b07) / nullif(b02 + b07, 0) END AS ndmi
    FROM bands
)"""


@query(_BANDS + """
, ranked AS (
    SELECT i.*, row_number() OVER (PARTITION BY i.entity_id ORDER BY i.ts DESC, i.ndvi DESC) AS n
    FROM idx i JOIN entity e ON i.entity_id = e.entity_id
    WHERE i.ndvi IS NOT NULL AND i.ts >= e.start_date - INTERVAL 30 DAY AND i.ts < e.start_date
)
SELECT entity_id, CAST(ts AS DATE) AS obs_date, 'NDVI' AS variable, round(ndvi, 6) AS value FROM ranked WHERE n = 1
UNION ALL SELECT entity_id, CAST(ts AS DATE), 'NDWI', round(ndwi, 6) FROM ranked WHERE n = 1
UNION ALL SELECT entity_id, CAST(ts AS DATE), 'NDMI', round(ndmi, 6) FROM ranked WHERE n = 1""", "entity")
def spectral_latest_clear(t: Tables) -> DataFrame:
    number, value = F.col("event_id"), F.col("value")
    bands = t.raw("events").select(
        F.col("user_id").alias("entity_id"), "ts",
        F.when(number % 11 != 0, value / 500).alias("b01"),
        F.when(number % 13 != 0, (value + 40) / 500).alias("b02"),
        F.when(number % 101 == 0, -value).otherwise(value / 300).alias("b06"),
        ((value + 10) / 700).alias("b07"),
    )
    return R.latest_clear_indices(
        t.entity, bands, "entity_id", "start_date", "ts", {"NDVI": ("b02", "b01"), "NDWI": ("b02", "b06"),
                                                         "NDMI": ("b02", "b07")}, "NDVI", 30
    )


@query("""
SELECT fire_id, CAST(year(start_date) AS BIGINT) AS year, CAST(month(start_date) AS BIGINT) AS month,
    CAST(quarter(start_date) AS BIGINT) AS quarter, strftime(start_date, '%Y%m%d') AS stamp FROM fire""", "fire")
def date_parts(t: Tables) -> DataFrame:
    d = F.col("start_date")
    return t.fire.select(
        "fire_id", F.year(d).alias("year"), F.month(d).alias("month"), F.quarter(d).alias("quarter"),
        F.date_format(d, "yyyyMMdd").alias("stamp"),
    )


@query("""
SELECT o.obs_id, CAST(date_diff('day', o.obs_date, e.start_date) AS BIGINT) AS lag,
    strftime(e.start_date - INTERVAL 9 DAY, '%Y-%m-%d') AS window_start,
    CASE WHEN o.obs_date = e.start_date THEN '0d' WHEN date_diff('day', o.obs_date, e.start_date) BETWEEN 1 AND 3 THEN '3d'
        WHEN date_diff('day', o.obs_date, e.start_date) BETWEEN 4 AND 7 THEN '7d' ELSE 'older' END AS span
FROM obs o JOIN entity e ON o.entity_id = e.entity_id WHERE e.start_date >= o.obs_date""", "obs entity")
def date_windows(t: Tables) -> DataFrame:
    joined = R.lookup(t.obs.select("obs_id", "entity_id", "obs_date"), t.entity, ["entity_id"])
    lag = D.days_before(F.col("start_date"), F.col("obs_date"))
    span = F.when(lag == 0, "0d").when(D.in_lag_window(lag, 1, 3), "3d").when(D.in_lag_window(lag, 4, 7), "7d")
    return joined.where(lag >= 0).select(
        "obs_id", lag.alias("lag"), F.date_format(F.date_sub("start_date", 9), "yyyy-MM-dd").alias("window_start"),
        span.otherwise("older").alias("span"),
    )


@query("SELECT fire_id, isodow(start_date) IN (6, 7) AS weekend FROM fire", "fire")
def weekend(t: Tables) -> DataFrame:
    return t.fire.select("fire_id", D.is_weekend(F.col("start_date")).alias("weekend"))


@query("""
SELECT fire_id, round((fire_id % 60 * 3600 + fire_id % 59 * 60 + fire_id % 58) / CAST(3600 AS DOUBLE), 6) AS hours,
    CAST(fire_id % 24 * 3600 + fire_id % 59 * 60 AS BIGINT) AS clock FROM fire""", "fire")
def duration_hours(t: Tables) -> DataFrame:
    key = F.col("fire_id")
    lasted = F.format_string("%d:%02d:%02d", key % 60, key % 59, key % 58)
    clock = F.format_string("%d:%02d", key % 24, key % 59)
    return t.fire.select(
        "fire_id", D.seconds_to_hours(D.duration_seconds(lasted)).alias("hours"), D.clock_seconds(clock).alias("clock")
    )


@query("""
SELECT fire_id, CASE fire_type WHEN '1-URGENT' THEN 'Crítico' WHEN '2-HIGH' THEN 'Alto' WHEN '3-MEDIUM' THEN 'Medio' END
    AS label, abs(lon) AS distance FROM fire""", "fire")
def map_labels(t: Tables) -> DataFrame:
    labels = {"1-URGENT": "Crítico", "2-HIGH": "Alto", "3-MEDIUM": "Medio"}
    return t.fire.select("fire_id", X.map_labels(F.col("fire_type"), labels).alias("label"), F.abs("lon").alias("distance"))


@query("""
SELECT f.fire_id, o.end_date, f.start_date FROM fire f JOIN ops o ON f.fire_id = o.fire_id
WHERE o.end_date < f.start_date OR (o.end_date = f.start_date AND o.arrived_s < o.detected_s)""", "fire ops")
def chronology_predicate(t: Tables) -> DataFrame:
    joined = t.fire.select("fire_id", "start_date").join(t.ops, "fire_id")
    wrong = D.ends_before_start(F.col("start_date"), F.col("end_date"), F.col("detected_s"), F.col("arrived_s"))
    return joined.where(wrong).select("fire_id", "end_date", "start_date")


@query("""
SELECT obs_id, value FROM obs WHERE value > (SELECT quantile_cont(value, 0.9) FROM obs)""", "obs")
def above_quantile(t: Tables) -> DataFrame:
    return W.above_quantile(t.obs.select("obs_id", "value"), "value", 0.9)


@query("""
SELECT CAST(year(f.start_date) AS BIGINT) AS year, count(DISTINCT f.fire_id) AS entities, count(o.obs_id) AS series_rows
FROM fire f LEFT JOIN obs o ON f.entity_id = o.entity_id GROUP BY 1""", "fire obs")
def yearly_health(t: Tables) -> DataFrame:
    per_entity = t.obs.select("entity_id")
    counts = per_entity.groupBy("entity_id").agg(F.count(F.lit(1)).alias("n"))
    rows = R.lookup(t.fire.select("fire_id", "entity_id", "start_date"), counts, ["entity_id"], "left")
    return rows.groupBy(F.year("start_date").alias("year")).agg(
        F.countDistinct("fire_id").alias("entities"), F.coalesce(F.sum("n"), F.lit(0)).alias("series_rows")
    )


@query("""
SELECT CAST(year(f.start_date) AS BIGINT) AS year, count(DISTINCT f.fire_id) AS entities,
    count(l.l_orderkey) AS series_rows
FROM fire f LEFT JOIN lineitem l ON f.fire_id = l.l_orderkey GROUP BY 1""", "fire")
def yearly_health_children(t: Tables) -> DataFrame:
    lines = t.raw("lineitem").select(F.col("l_orderkey").alias("fire_id"))
    return A.yearly_health(t.fire, lines, "fire_id", F.year("start_date"))


@query("""
SELECT obs_id, variable, value FROM obs ORDER BY md5(CAST(obs_id AS VARCHAR) || ':42') LIMIT 1000""", "obs")
def sample_fixed(t: Tables) -> DataFrame:
    return R.fixed_sample(t.obs, 1000, "obs_id").select("obs_id", "variable", "value")


@query("""
SELECT o.obs_id, coalesce(c.low, o.obs_id) AS mapped FROM obs o LEFT JOIN (
    SELECT id, min(id) OVER (PARTITION BY kind, detail) AS low FROM cat) c ON o.obs_id = c.id""", "obs cat")
def remap_ids(t: Tables) -> DataFrame:
    mapping = W.canonical_ids(t.cat, "id", ["kind", "detail"])
    return R.remap_ids(t.obs.select("obs_id", F.col("obs_id").alias("mapped")), mapping, "mapped")


@query("""
SELECT obs_id, value, CAST(NULL AS DOUBLE) AS corrected FROM obs WHERE value IS NOT NULL
UNION ALL SELECT event_id + 1000000, value, CAST(NULL AS DOUBLE) FROM events WHERE event_type = 'view'""", "obs")
def append_and_widen(t: Tables) -> DataFrame:
    wide = R.add_column(t.obs.select("obs_id", "value"), "corrected", "double")
    extra = t.raw("events").where(F.col("event_type") == "view").select(
        (F.col("event_id") + 1000000).alias("obs_id"), "value", F.lit(None).alias("corrected")
    )
    return R.append_rows(R.add_column(wide, "corrected", "double").where(F.col("value").isNotNull()), extra)


@query("""
SELECT fire_id, start_date, count(*) OVER (PARTITION BY fire_type) AS n FROM fire
ORDER BY start_date DESC, fire_id LIMIT 20""", "fire")
def preview_newest(t: Tables) -> DataFrame:
    counts = t.fire.groupBy("fire_type").agg(F.count(F.lit(1)).alias("n"))
    newest = t.fire.select("fire_id", "fire_type", "start_date").orderBy(F.desc_nulls_last("start_date"), "fire_id").limit(20)
    return R.lookup(newest, counts, ["fire_type"]).select("fire_id", "start_date", "n")


@query("""
SELECT l_orderkey AS fire_id, round(l_quantity / nullif(l_discount, 0), 6) AS ratio, greatest(l_tax, 0) AS tax
FROM lineitem""")
def guarded_ratio(t: Tables) -> DataFrame:
    return t.raw("lineitem").select(
        F.col("l_orderkey").alias("fire_id"), N.safe_ratio(F.col("l_quantity"), F.col("l_discount")).alias("ratio"),
        F.greatest("l_tax", F.lit(0.0)).alias("tax"),
    )
