"""Key repair, text, deduplication, location, series and load queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eavcube.functions import keys as K
from eavcube.functions import numbers as N
from eavcube.functions import text as X
from eavcube.operators import cleaning as CL
from eavcube.operators import quality as Q
from eavcube.operators import window as W
from eavcube.plans import wildfire as WF
from eavcube.plans.registry import Tables, query
from eavcube.schemas import SCHEMAS

# Short, valid and inverted keys from the customer number.
_KEYS = """
, keyed AS (
    SELECT c_custkey AS id, CASE c_custkey % 3 WHEN 0 THEN '15' || lpad(CAST(c_custkey % 125 AS VARCHAR), 3, '0')
        WHEN 1 THEN CAST(c_custkey % 25 + 1 AS VARCHAR) || '15'
        ELSE lpad(CAST(c_custkey % 125 AS VARCHAR), 3, '0') || '15' END AS key, c_name AS name
    FROM customer
), repaired AS (
    SELECT id, name, key AS old, CASE WHEN length(key) < 5
        THEN '15' || lpad(substr(key, 1, length(key) - 2), 3, '0') ELSE key END AS key FROM keyed
)"""


def keyed(t: Tables) -> DataFrame:
    n = F.col("c_custkey")
    tail = F.lpad((n % 125).cast("string"), 3, "0")
    key = F.when(n % 3 == 0, F.concat(F.lit("15"), tail)).when(
        n % 3 == 1, F.concat((n % 25 + 1).cast("string"), F.lit("15"))
    ).otherwise(F.concat(tail, F.lit("15")))
    return t.raw("customer").select(n.alias("id"), key.alias("key"), F.col("c_name").alias("name"))


@query(_KEYS + "\nSELECT id, key FROM repaired")
def key_repair(t: Tables) -> DataFrame:
    return CL.repair_keys(keyed(t), "key").select("id", "key")


@query(_KEYS + """
SELECT id, CASE WHEN key LIKE '%15' AND key NOT LIKE '15%' AND length(key) = 5
    THEN substr(key, 4, 2) || substr(key, 1, 3) ELSE key END AS key FROM keyed""")
def key_swap(t: Tables) -> DataFrame:
    return CL.swap_keys(keyed(t), "key").select("id", "key")


@query(_KEYS + """
, twins AS (
    SELECT substr(key, 4, 2) || substr(key, 1, 3) AS key, min(name) AS name FROM keyed
    WHERE key LIKE '%15' AND key NOT LIKE '15%' AND length(key) = 5 GROUP BY 1
), own AS (SELECT key, min(name) AS name FROM keyed GROUP BY key)
SELECT key, name FROM own UNION ALL SELECT key, name FROM twins WHERE key NOT IN (SELECT key FROM own)""")
def swapped_members(t: Tables) -> DataFrame:
    return CL.add_swapped_members(keyed(t).select("key", "name"), "key")


@query(_KEYS + """
, valid AS (SELECT key, 1 AS owner, min(name) AS name FROM keyed WHERE length(key) = 5 AND id % 2 = 0 GROUP BY key),
short AS (SELECT key, 15 AS owner, min(name) AS name FROM repaired WHERE length(old) < 5 AND id % 2 = 0 GROUP BY key),
step2 AS (SELECT * FROM valid UNION ALL SELECT * FROM short WHERE key NOT IN (SELECT key FROM valid)),
used AS (SELECT DISTINCT key FROM repaired)
SELECT key, CAST(owner AS BIGINT) AS owner, name FROM step2
UNION ALL SELECT key, 15, 'MUNICIPIO POR REVISAR' FROM used WHERE key NOT IN (SELECT key FROM step2)""")
def unify_dimension(t: Tables) -> DataFrame:
    rows = keyed(t)
    dimension = rows.where(F.col("id") % 2 == 0).select("key", F.lit(1).alias("owner"), "name")
    home = F.lit(15)
    return CL.unify_dimension(
        dimension, rows, "key", {"owner": home, "name": F.lit(CL.REVIEW_LABEL)}, {"owner": home}
    )


@query("""
SELECT l_orderkey AS id, CASE WHEN length(CAST(l_partkey AS VARCHAR)) >= 5 THEN CAST(l_partkey AS VARCHAR)
    ELSE lpad(CAST(l_partkey AS VARCHAR), 5, '0') END AS key FROM lineitem""")
def zero_fill(t: Tables) -> DataFrame:
    padded = F.concat(F.lit(" "), F.col("l_partkey").cast("string"))
    return t.raw("lineitem").select(F.col("l_orderkey").alias("id"), K.zero_fill(padded).alias("key"))


# Text ------------------------------------------------------------------------------------------

_TEXT = """
, texts AS (
    SELECT c_custkey AS id, CASE c_custkey % 5 WHEN 0 THEN '  Región ' || c_name WHEN 1 THEN 'ÁÉÍÓÚ Üñ ' || c_name
        WHEN 2 THEN NULL WHEN 3 THEN upper(c_name) ELSE lower(c_mktsegment) || ' ' END AS text FROM customer
)"""


def texts(t: Tables) -> DataFrame:
    n, name = F.col("c_custkey"), F.col("c_name")
    text = (
        F.when(n % 5 == 0, F.concat(F.lit("  Región "), name)).when(n % 5 == 1, F.concat(F.lit("ÁÉÍÓÚ Üñ "), name))
        .when(n % 5 == 3, F.upper(name)).when(n % 5 == 4, F.concat(F.lower("c_mktsegment"), F.lit(" ")))
    )
    return t.raw("customer").select(n.alias("id"), text.alias("text"))


@query(_TEXT + """
SELECT id, coalesce(lower(trim(translate(text, 'áÁéÉíÍóÓúÚüÜñÑ', 'aaeeiioouuuunn'))), 'no especificado') AS text
FROM texts""")
def text_normalise(t: Tables) -> DataFrame:
    return CL.normalise_columns(texts(t), ["text"])


@query(_TEXT + """
SELECT 'text' AS "column", count(*) AS rows, count(*) FILTER (WHERE text <> trim(text)) AS untrimmed,
    count(*) FILTER (WHERE regexp_matches(text, '[áéíóúÁÉÍÓÚüÜñÑ]')) AS accented,
    count(*) FILTER (WHERE text <> upper(text) AND text <> lower(text)) AS mixed_case FROM texts""")
def text_profile(t: Tables) -> DataFrame:
    return Q.text_profile(texts(t))


@query("""
SELECT doc_id, length(regexp_replace(text, '\\s', '', 'g')) AS dense, md5(regexp_replace(text, '\\s', '', 'g')) AS digest
FROM documents""")
def key_whitespace(t: Tables) -> DataFrame:
    dense = X.strip_whitespace(F.col("text"))
    return t.raw("documents").select("doc_id", F.length(dense).alias("dense"), F.md5(dense).alias("digest"))


# Duplicates ------------------------------------------------------------------------------------


@query("""
SELECT f.fire_id, c.low AS id FROM fire f JOIN (
    SELECT id, first_value(id) OVER (PARTITION BY kind, detail ORDER BY id) AS low FROM cat) c ON f.cat_id = c.id
""", "fire cat")
def catalogue_dedup(t: Tables) -> DataFrame:
    fires = t.fire.select("fire_id", F.col("cat_id").alias("id"))
    return CL.deduplicate_catalogue(t.cat, fires, "id", ["kind", "detail"])[1]


@query("""
SELECT min(id) AS id, kind, detail FROM cat GROUP BY kind, detail""", "cat")
def catalogue_kept(t: Tables) -> DataFrame:
    return CL.deduplicate_catalogue(t.cat, t.fire.select(F.col("cat_id").alias("id")), "id", ["kind", "detail"])[0]


@query("""
, facts AS (SELECT fire_id // 3 AS key, fire_id, place_id FROM fire),
kept AS (SELECT key, min(fire_id) AS fire_id, arg_min(place_id, fire_id) AS place_id FROM facts GROUP BY key),
lines AS (SELECT l_orderkey // 3 AS key, l_linenumber AS line, min(l_partkey) AS part FROM lineitem GROUP BY 1, 2)
SELECT k.key, k.fire_id, k.place_id, count(l.part) AS lines, CAST(sum(l.part) AS BIGINT) AS parts
FROM kept k LEFT JOIN lines l ON k.key = l.key GROUP BY 1, 2, 3""", "fire")
def fact_dedup_cascade(t: Tables) -> DataFrame:
    third = lambda c: F.floor(F.col(c) / 3).alias("key")
    facts = t.fire.select(third("fire_id"), "fire_id", "place_id")
    lines = t.raw("lineitem").select(
        third("l_orderkey"), F.col("l_linenumber").alias("line"), F.col("l_partkey").alias("part")
    )
    kept, children = CL.deduplicate_facts(facts, "key", "fire_id", {"lines": lines}, {"lines": ["key", "line"]})
    sizes = children["lines"].groupBy("key").agg(F.count("part").alias("lines"), F.sum("part").alias("parts"))
    return kept.join(sizes, "key", "left").withColumn("lines", F.coalesce("lines", F.lit(0)))


@query("""
SELECT arg_min(obs_id, obs_id) AS obs_id, variable, entity_id, obs_date, arg_min(value, obs_id) AS value FROM obs
GROUP BY variable, entity_id, obs_date""", "obs")
def series_dedup(t: Tables) -> DataFrame:
    return CL.deduplicate_series(t.obs, ["variable", "entity_id", "obs_date"], "obs_id")


# Locations -------------------------------------------------------------------------------------

_LOCATED = """
, located AS (
    SELECT fire_id, CASE WHEN place_id % 4 = 0 THEN '09' ELSE '15' END || lpad(CAST(place_id AS VARCHAR), 3, '0') AS key,
        CASE WHEN fire_id % 41 = 0 THEN 0 ELSE lat END AS lat, CASE WHEN fire_id % 43 = 0 THEN NULL ELSE lon END AS lon
    FROM fire
), bad AS (
    SELECT fire_id FROM located WHERE key LIKE '15%'
        AND (lat NOT BETWEEN 18.35::DOUBLE AND 20.25::DOUBLE OR lon NOT BETWEEN -100.6::DOUBLE AND -98.55::DOUBLE)
    UNION SELECT fire_id FROM located WHERE key NOT LIKE '15%'
    UNION SELECT fire_id FROM located WHERE lat = 0 OR lon = 0
)"""


def located(t: Tables) -> DataFrame:
    prefix = F.when(F.col("place_id") % 4 == 0, "09").otherwise("15")
    return t.fire.select(
        "fire_id", F.concat(prefix, F.lpad(F.col("place_id").cast("string"), 3, "0")).alias("key"),
        F.when(F.col("fire_id") % 41 == 0, F.lit(0.0)).otherwise(F.col("lat")).alias("lat"),
        F.when(F.col("fire_id") % 43 != 0, F.col("lon")).alias("lon"),
    )


def mislocated() -> Column:
    return CL.is_mislocated(F.col("key"), F.col("lat"), F.col("lon"), WF.STATE_BOX)


@query(_LOCATED + "\nSELECT fire_id FROM bad", "fire")
def mislocated_flag(t: Tables) -> DataFrame:
    return located(t).where(mislocated()).select("fire_id")


@query(_LOCATED + """
, kept AS (SELECT l_orderkey AS fire_id, count(*) AS n FROM lineitem
    WHERE l_orderkey NOT IN (SELECT fire_id FROM bad) GROUP BY 1)
SELECT l.fire_id, round(CASE WHEN b.fire_id IS NULL THEN l.lat END, 6) AS lat,
    round(CASE WHEN b.fire_id IS NULL THEN l.lon END, 6) AS lon,
    coalesce(k.n, 0) AS series_rows
FROM located l LEFT JOIN bad b ON l.fire_id = b.fire_id LEFT JOIN kept k ON l.fire_id = k.fire_id""", "fire")
def mislocated_purge(t: Tables) -> DataFrame:
    series = t.raw("lineitem").select(F.col("l_orderkey").alias("fire_id"), "l_partkey")
    fires, kept = CL.purge_mislocated(located(t), series, "fire_id", mislocated(), "lat", "lon")
    sizes = kept.groupBy("fire_id").agg(F.count(F.lit(1)).alias("n"))
    return fires.join(sizes, "fire_id", "left").select(
        "fire_id", "lat", "lon", F.coalesce("n", F.lit(0)).alias("series_rows")
    )


@query("""
SELECT c_custkey AS id, CASE WHEN c_acctbal < 0 THEN 0 ELSE c_acctbal END AS balance,
    CASE WHEN c_custkey % 7 = 0 THEN NULL WHEN c_acctbal - 5000 < 0 THEN 0 ELSE round(c_acctbal - 5000, 6) END AS rest
FROM customer""")
def clamp_negative(t: Tables) -> DataFrame:
    rows = t.raw("customer").select(
        F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("balance"),
        F.when(F.col("c_custkey") % 7 != 0, F.col("c_acctbal") - 5000).alias("rest"),
    )
    return CL.clamp_columns(rows, ["balance", "rest"])


@query("""
, resets AS (SELECT fire_id, lat, lon, lat NOT BETWEEN 18.3::DOUBLE AND 20.3::DOUBLE
    OR lon NOT BETWEEN -100.6::DOUBLE AND -98.5::DOUBLE OR (lat = 0 AND lon = 0) AS bad FROM fire)
SELECT fire_id, round(CASE WHEN NOT bad THEN lat END, 6) AS lat, round(CASE WHEN NOT bad THEN lon END, 6) AS lon
FROM resets""", "fire")
def coordinates_reset(t: Tables) -> DataFrame:
    box = {"lat": (18.3, 20.3), "lon": (-100.6, -98.5)}
    return CL.reset_coordinates(t.fire.select("fire_id", "lat", "lon"), "lat", "lon", box)


# Series ----------------------------------------------------------------------------------------

_CLEAN = """
, known AS (SELECT obs_id, variable, entity_id, obs_date, nullif(value, -999) AS value FROM obs),
alive AS (SELECT * FROM known WHERE variable IN (SELECT variable FROM known GROUP BY variable HAVING count(value) > 0)),
rescue AS (SELECT variable, count(*) AS rows, count(*) - count(value) AS nulls FROM alive GROUP BY variable
    HAVING count(*) - count(value) > 0 AND (count(*) - count(value)) * 100.0 / count(*) < 10)"""


def alive(t: Tables) -> DataFrame:
    return CL.remove_dead_variables(CL.neutralise_sentinel(t.obs, "value"), "variable", "value")


@query(_CLEAN + "\nSELECT obs_id, value FROM known", "obs")
def sentinel_to_null(t: Tables) -> DataFrame:
    return CL.neutralise_sentinel(t.obs, "value").select("obs_id", "value")


@query(_CLEAN + "\nSELECT obs_id, variable, value FROM alive", "obs")
def dead_variables(t: Tables) -> DataFrame:
    return alive(t).select("obs_id", "variable", "value")


@query(_CLEAN + "\nSELECT variable, rows, nulls FROM rescue", "obs")
def rescuable_variables(t: Tables) -> DataFrame:
    return CL.rescuable_variables(alive(t), "variable", "value")


@query(_CLEAN + """
, placed AS (SELECT *, row_number() OVER (PARTITION BY variable, entity_id ORDER BY obs_date, obs_id) AS p FROM alive
    WHERE variable IN (SELECT variable FROM rescue)),
ends AS (
    SELECT *, last_value(CASE WHEN value IS NOT NULL THEN p END IGNORE NULLS) OVER before AS p0,
        last_value(value IGNORE NULLS) OVER before AS v0,
        first_value(CASE WHEN value IS NOT NULL THEN p END IGNORE NULLS) OVER after AS p1,
        first_value(value IGNORE NULLS) OVER after AS v1
    FROM placed
    WINDOW before AS (PARTITION BY variable, entity_id ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
        after AS (PARTITION BY variable, entity_id ORDER BY p ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
)
SELECT obs_id, variable, value FROM alive WHERE variable NOT IN (SELECT variable FROM rescue)
UNION ALL
SELECT obs_id, variable, round(CASE WHEN value IS NOT NULL THEN value WHEN p0 IS NULL THEN v1 WHEN p1 IS NULL THEN v0
    ELSE v0 + (v1 - v0) / (p1 - p0) * (p - p0) END, 6) FROM ends""", "obs")
def interpolate_series(t: Tables) -> DataFrame:
    filled = CL.interpolate_rescuable(alive(t), "variable", "entity_id", ["obs_date", "obs_id"], "value")
    return filled.select("obs_id", "variable", "value")


@query("""
, lines AS (SELECT l_orderkey AS fire_id, l_linenumber AS line FROM lineitem)
SELECT fire_id, line FROM lines WHERE fire_id IN (SELECT fire_id FROM parent)""", "parent")
def orphan_cleanup(t: Tables) -> DataFrame:
    lines = t.raw("lineitem").select(F.col("l_orderkey").alias("fire_id"), F.col("l_linenumber").alias("line"))
    return CL.remove_orphans({"lines": lines}, t.parent, "fire_id")["lines"]


@query("""
SELECT p_partkey AS part, p_name AS name FROM part WHERE p_partkey IN (
    SELECT l_partkey FROM lineitem WHERE l_quantity > 49 UNION SELECT l_suppkey FROM lineitem)""")
def unreferenced_cleanup(t: Tables) -> DataFrame:
    lines = t.raw("lineitem")
    parts = t.raw("part").select(F.col("p_partkey").alias("part"), F.col("p_name").alias("name"))
    return CL.remove_unreferenced(parts, "part", [
        lines.where(F.col("l_quantity") > 49).select(F.col("l_partkey").alias("part")),
        lines.select(F.col("l_suppkey").alias("part")),
    ])


@query("""
SELECT obs_id, variable, value FROM obs WHERE (value > -999 OR value IS NULL) AND variable NOT IN (
    SELECT variable FROM obs GROUP BY variable HAVING min(value) = -999 AND max(value) = -999)""", "obs")
def purge_policy(t: Tables) -> DataFrame:
    return CL.purge_series(t.obs, "variable", "value").select("obs_id", "variable", "value")


@query("""
SELECT variable, n FROM (SELECT variable, count(*) AS n, min(value) AS lo, max(value) AS hi FROM obs GROUP BY 1)
WHERE lo IS NOT NULL AND NOT (lo = -999 AND hi = -999)""", "obs")
def purge_dictionary(t: Tables) -> DataFrame:
    dictionary = t.obs.groupBy("variable").agg(F.count(F.lit(1)).alias("n"))
    return CL.purge_dictionary(dictionary, t.obs, "variable", "value")


# Imputation ------------------------------------------------------------------------------------


@query("""
, k AS (SELECT obs_id, nullif(value, -999) AS value FROM obs)
SELECT obs_id, round(coalesce(value, (SELECT avg(value) FROM k)), 6) AS value FROM k""", "obs")
def impute_mean(t: Tables) -> DataFrame:
    return CL.impute_mean(CL.neutralise_sentinel(t.obs, "value").select("obs_id", "value"), ["value"])


@query("""
, k AS (SELECT obs_id, nullif(value, -999) AS value FROM obs)
SELECT obs_id, round(coalesce(value, (SELECT median(value) FROM k)), 6) AS value FROM k""", "obs")
def impute_median(t: Tables) -> DataFrame:
    return CL.impute_median(CL.neutralise_sentinel(t.obs, "value").select("obs_id", "value"), ["value"])


@query("""
SELECT event_id AS id, CAST(ts AS DATE) AS day, coalesce(CASE WHEN event_id % 9 > 0 THEN value END,
    (SELECT round(avg(CASE WHEN event_id % 9 > 0 THEN value END), 6) FROM events)) AS ndvi, round(value - 20, 6) AS temp
FROM events WHERE value - 20 > -10 AND value - 20 < 50 AND value * 2 BETWEEN 0 AND 100""")
def physical_limits(t: Tables) -> DataFrame:
    rows = t.raw("events").select(
        F.col("event_id").alias("id"), F.col("ts").alias("day"),
        F.when(F.col("event_id") % 9 > 0, F.col("value")).alias("ndvi"), (F.col("value") - 20).alias("temp"),
        (F.col("value") * 2).alias("humidity"),
    )
    cleaned = CL.clean_model_table(rows, "day", "ndvi", {"temp": (-10, 50)}, {"humidity": (0, 100)})
    return cleaned.drop("humidity")


# Loads -----------------------------------------------------------------------------------------

_REGISTER = """
, reg AS (
    SELECT o_orderkey AS k, CASE WHEN o_orderkey % 7 = 0 THEN ' 15-' ELSE '15-' END || CAST(o_orderkey AS VARCHAR) AS clave,
        CASE o_orderkey % 4 WHEN 0 THEN ' México ' WHEN 1 THEN 'Ciudad de México' ELSE 'México' END AS estado,
        CASE WHEN o_orderkey % 3 = 0 THEN strftime(o_orderdate, '%Y-%m-%d') || ' 00:00:00'
            WHEN o_orderkey % 3 = 1 THEN strftime(o_orderdate, '%d/%m/%Y')
            WHEN o_orderkey % 10 = 2 THEN 'sin dato' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS inicio,
        CASE WHEN o_orderkey % 5 = 0 THEN '19,' || lpad(CAST(o_orderkey % 100 AS VARCHAR), 2, '0')
            WHEN o_orderkey % 5 = 1 THEN 'nan' ELSE ' 19.' || lpad(CAST(o_orderkey % 100 AS VARCHAR), 2, '0') END AS latitud,
        '-99.' || lpad(CAST(o_orderkey % 100 AS VARCHAR), 2, '0') AS longitud,
        CASE WHEN o_orderkey % 50 = 0 THEN 'x' ELSE strftime(o_orderdate, '%Y') END AS anio,
        CASE WHEN o_orderkey % 6 = 0 THEN 'n/d' ELSE CAST(o_orderkey % 40 AS VARCHAR) || '.5' END AS arbolado,
        'c' || CAST(o_orderkey % 5 AS VARCHAR) AS causa, 'e' || CAST(o_orderkey % 3 AS VARCHAR) AS causa_especifica,
        'r' || CAST(o_orderkey % 2 AS VARCHAR) AS regimen, 'v' || CAST(o_orderkey % 4 AS VARCHAR) AS vegetacion
    FROM orders
), conformed AS (
    SELECT clave, k, causa, causa_especifica, regimen, vegetacion,
        CAST(coalesce(try_strptime(split_part(inicio, ' ', 1), '%Y-%m-%d'),
            try_strptime(split_part(inicio, ' ', 1), '%d/%m/%Y')) AS DATE) AS inicio,
        CASE WHEN latitud <> 'nan' THEN TRY_CAST(replace(trim(latitud), ',', '.') AS DOUBLE) END AS latitud,
        TRY_CAST(longitud AS DOUBLE) AS longitud, coalesce(TRY_CAST(anio AS BIGINT), 0) AS anio,
        coalesce(TRY_CAST(arbolado AS DOUBLE), 0) AS arbolado
    FROM reg WHERE trim(estado) = 'México'
), kept AS (SELECT * FROM conformed WHERE inicio IS NOT NULL AND latitud IS NOT NULL AND longitud IS NOT NULL)"""


def register(t: Tables) -> DataFrame:
    """The orders written as an all-text register with typical defects."""
    k, day = F.col("o_orderkey"), F.col("o_orderdate")
    cents = F.lpad((k % 100).cast("string"), 2, "0")
    code = lambda letter, n: F.concat(F.lit(letter), (k % n).cast("string"))
    start = (
        F.when(k % 3 == 0, F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit(" 00:00:00")))
        .when(k % 3 == 1, F.date_format(day, "dd/MM/yyyy")).when(k % 10 == 2, "sin dato")
        .otherwise(F.date_format(day, "yyyy-MM-dd"))
    )
    lat = F.when(k % 5 == 0, F.concat(F.lit("19,"), cents)).when(k % 5 == 1, "nan").otherwise(
        F.concat(F.lit(" 19."), cents)
    )
    columns = {
        "Clave del incendio": F.concat(F.when(k % 7 == 0, " 15-").otherwise("15-"), k.cast("string")),
        "Año": F.when(k % 50 == 0, "x").otherwise(F.date_format(day, "yyyy")),
        "CVE_ENT": F.lit("15"), "CVEGEO": F.concat(F.lit("15"), F.lpad((k % 25).cast("string"), 3, "0")),
        "Región": F.lit("Centro"), "Municipio": code("m", 25),
        "Estado": F.when(k % 4 == 0, " México ").when(k % 4 == 1, "Ciudad de México").otherwise("México"),
        "Fecha Inicio": start, "Latitud": lat, "Longitud": F.concat(F.lit("-99."), cents),
        "Arbolado Adulto": F.when(k % 6 == 0, "n/d").otherwise(F.concat((k % 40).cast("string"), F.lit(".5"))),
        "Causa": code("c", 5), "Causa especifica": code("e", 3), "Régimen de fuego": code("r", 2),
        "Tipo Vegetación": code("v", 4), "Tipo de incendio": F.col("o_orderpriority"), "Tamaño": F.lit("0 a 5"),
        **{c: F.lit("1") for c in ("Renuevo", "Arbustivo", "Herbáceo", "Hojarasca", "Total hectáreas")},
    }
    return t.raw("orders").select(*[c.cast("string").alias(n) for n, c in columns.items()])


@query(_REGISTER + """
SELECT clave AS id_clave_inc, inicio AS fecha_inicio, latitud, longitud, anio, arbolado AS arbolado_adulto FROM kept""")
def register_conform(t: Tables) -> DataFrame:
    return WF.conform_register(register(t)).select(
        "id_clave_inc", "fecha_inicio", "latitud", "longitud", "anio", "arbolado_adulto"
    )


@query(_REGISTER + """
SELECT count(*) AS rows, count(*) FILTER (WHERE inicio IS NULL) AS bad_date,
    count(*) FILTER (WHERE latitud IS NULL) AS bad_lat, count(*) FILTER (WHERE longitud IS NULL) AS bad_lon,
    count(*) FILTER (WHERE inicio IS NOT NULL AND latitud IS NOT NULL AND longitud IS NOT NULL) AS kept
FROM conformed WHERE anio = 1997""")
def register_quality(t: Tables) -> DataFrame:
    return WF.register_quality(register(t), "1997")


@query(_REGISTER + """
, causes AS (SELECT causa, causa_especifica, row_number() OVER (ORDER BY causa, causa_especifica) AS id
    FROM (SELECT DISTINCT causa, causa_especifica FROM kept)),
kinds AS (SELECT regimen, vegetacion, row_number() OVER (ORDER BY regimen, vegetacion) AS id
    FROM (SELECT DISTINCT regimen, vegetacion FROM kept))
SELECT k.clave AS id_clave_inc, c.id AS id_causa, v.id AS id_vegetacion, k.inicio AS fecha_inicio
FROM kept k JOIN causes c ON k.causa = c.causa AND k.causa_especifica = c.causa_especifica
    JOIN kinds v ON k.regimen = v.regimen AND k.vegetacion = v.vegetacion""")
def register_split(t: Tables) -> DataFrame:
    empty = {
        n: t.spark.createDataFrame([], SCHEMAS[n])
        for n in ("estado", "municipios", "causa", "vegetacion", "incendios", "danos")
    }
    tables = WF.split_register(WF.conform_register(register(t)), empty)
    return tables["incendios"].select("id_clave_inc", "id_causa", "id_vegetacion", "fecha_inicio")


@query("""
, people AS (
    SELECT lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS id_cvegeo, 1990 + c_custkey % 3 AS anio, c_mktsegment AS sexo,
        min(c_custkey) AS pob_total FROM customer GROUP BY 1, 2, 3
)
SELECT p.id_cvegeo, p.anio, p.sexo, p.pob_total, p.pob_total % 10 AS r_00_04, p.pob_total % 7 AS r_85_mm,
    CASE WHEN n.n_nationkey IS NULL THEN 'MUNICIPIO DESDE CSV POR REVISAR' ELSE n.n_name END AS nombre_municipio
FROM people p LEFT JOIN nation n ON p.id_cvegeo = lpad(CAST(n.n_nationkey AS VARCHAR), 5, '0') AND n.n_nationkey % 2 = 0
""")
def demography_load(t: Tables) -> DataFrame:
    n = F.col("c_custkey")
    bands = {b: (n % 10) if b == "POB_00_04" else (n % 7) for b in WF.POPULATION_BANDS}
    rows = t.raw("customer").select(
        F.concat(F.lit(" "), F.col("c_nationkey").cast("string")).alias("CLAVE"), (n % 3 + 1990).alias("Fecha"),
        F.col("c_mktsegment").alias("SEXO"), n.alias("POB_TOTAL"), *[c.alias(b) for b, c in bands.items()],
    )
    known = t.raw("nation").where(F.col("n_nationkey") % 2 == 0).select(
        K.zero_fill(F.col("n_nationkey")).alias("id_cvegeo"), F.lit(15).alias("id_clave_ent"),
        F.col("n_name").alias("nombre_municipio"),
    )
    places, people = WF.load_demography(rows, known)
    return people.join(places, "id_cvegeo").select(
        "id_cvegeo", "anio", "sexo", "pob_total", "r_00_04", "r_85_mm", "nombre_municipio"
    )


@query("""
SELECT CAST(fire_id AS VARCHAR) AS id_clave_inc, CASE WHEN fire_id % 9 > 0 THEN start_date END AS fecha_termino,
    CASE WHEN fire_id % 25 < 24 THEN fire_id % 25 * 3600 + fire_id % 60 * 60 END AS hora_deteccion_s,
    CASE WHEN fire_id % 2 = 0 THEN fire_id % 90 * 3600 + 600 ELSE fire_id % 5 * 86400 END AS duracion_s,
    CASE WHEN fire_id % 11 > 0 THEN CAST(round(fire_id % 30 + CAST(0.7 AS DOUBLE)) AS BIGINT) END AS duracion_dias
FROM fire WHERE fire_id IN (SELECT fire_id FROM parent)""", "fire parent")
def operations_load(t: Tables) -> DataFrame:
    k = F.col("fire_id")
    text = {
        "Clave del incendio": F.concat(F.lit(" "), k.cast("string"), F.lit(" ")),
        "Fecha Termino": F.when(k % 9 > 0, F.date_format("start_date", "d/M/yyyy")).otherwise("pendiente"),
        "Detección": F.format_string("%02d:%02d", k % 25, k % 60),
        "Llegada": F.lit("99:99"),
        "Duración": F.when(k % 2 == 0, F.format_string("%d:10:00", k % 90)).otherwise(F.format_string("%d days", k % 5)),
        "Duración días": F.when(k % 11 > 0, F.format_string("%d.7", k % 30)).otherwise(""),
    }
    raw = t.fire.select(*[c.alias(n) for n, c in text.items()])
    # Unreadable repetitions with a tab in the key: the row with known values is kept.
    torn = t.fire.where(k % 4 == 0).select(*[
        (F.concat(F.lit("\t"), k.cast("string")) if n == "Clave del incendio" else F.lit("?")).alias(n) for n in text])
    raw = torn.unionByName(raw)
    known = t.parent.select(F.col("fire_id").cast("string").alias("id_clave_inc"))
    return WF.load_operations(raw, known).drop("hora_llegada_s")


@query("""
SELECT fire_id, lat < CAST(18.35 AS DOUBLE) OR lat > CAST(20.25 AS DOUBLE) AS lat_out, round((lat - lon) / (lat + lon), 6) AS nd
FROM fire""", "fire")
def out_of_range_predicate(t: Tables) -> DataFrame:
    lat, lon = F.col("lat"), F.col("lon")
    return t.fire.select("fire_id", N.outside(lat, 18.35, 20.25).alias("lat_out"), N.safe_ratio(lat - lon, lat + lon).alias("nd"))


@query("""
SELECT entity_id, variable, min(obs_id) AS first_id FROM obs GROUP BY 1, 2""", "obs")
def keep_first_row(t: Tables) -> DataFrame:
    kept = W.keep_first(t.obs, ["entity_id", "variable"], ["obs_id"])
    return kept.select("entity_id", "variable", F.col("obs_id").alias("first_id"))
