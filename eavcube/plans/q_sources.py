"""Parsing of JSON responses, dictionary maintenance and incremental ingestion."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eavcube.operators import relational as R
from eavcube.plans import wildfire as WF
from eavcube.plans.registry import Tables, query
from eavcube.session import shared_folder
from eavcube.sources import responses as S
from eavcube.schemas import DAMAGE_PARTS, SCHEMAS
from eavcube.sources.keyed import KeyedTable
from eavcube.sources.tables import TableStore
from eavcube.streaming.incremental import LEDGER, ResponseSink, SeriesLog, image_rows, series_rows, start_ingest, start_taking


def series_bodies(t: Tables) -> DataFrame:
    """One nested response per event user and variable, built from the event table; its size is bounded by the days."""
    daily = t.raw("events").groupBy(
        F.col("user_id").alias("entity_id"), "event_type", F.date_format("ts", "yyyyMMdd").alias("day")
    ).agg(F.max("value").alias("value"))
    days = daily.groupBy("entity_id", "event_type").agg(
        F.map_from_entries(F.collect_list(F.struct("day", "value"))).alias("days")
    )
    variables = days.select("entity_id", F.create_map("event_type", "days").alias("parameter"))
    body = F.to_json(F.struct(F.struct("parameter").alias("properties")))
    return variables.select("entity_id", body.alias("body"))


_SERIES = """
SELECT user_id AS entity_id, event_type AS variable, CAST(ts AS DATE) AS obs_date, max(value) AS value
FROM events GROUP BY 1, 2, 3"""


@query(_SERIES)
def json_series(t: Tables) -> DataFrame:
    return S.parse_series(series_bodies(t), "body", ["entity_id"])


@query("""
SELECT event_id AS entity_id, CAST(ts AS DATE) AS day, value AS ndvi,
    CASE WHEN event_id % 7 = 0 THEN NULL ELSE round(value * 2, 6) END AS ndwi FROM events""")
def json_matrix(t: Tables) -> DataFrame:
    number = F.col("event_id")
    second = F.when(number % 7 == 0, F.lit(None).cast("string")).otherwise((F.col("value") * 2).cast("string"))
    header = F.array(F.lit("id"), F.lit("time"), F.lit("NDVI"), F.lit("NDWI"))
    millis = F.unix_millis(F.col("ts").cast("timestamp")).cast("string")
    row = F.array(number.cast("string"), millis, F.col("value").cast("string"), second)
    bodies = t.raw("events").select(number.alias("entity_id"), F.to_json(F.array(header, row)).alias("body"))
    parsed = S.parse_matrix(
        bodies, "body", ["entity_id"], {"time": "epoch_ms", "NDVI": "double", "NDWI": "double"}
    )
    return parsed.withColumnsRenamed({"time": "day", "NDVI": "ndvi", "NDWI": "ndwi"})


@query("""
SELECT p_name || CAST(p_partkey AS VARCHAR) AS variable, CASE WHEN p_partkey % 5 = 0 THEN 'n/a' ELSE p_type END AS unit
FROM part""")
def json_units(t: Tables) -> DataFrame:
    key = F.concat("p_name", F.col("p_partkey").cast("string"))
    unit = F.when(F.col("p_partkey") % 5 != 0, F.col("p_type"))
    info = F.create_map(key, F.struct(unit.alias("units")))
    empty = F.create_map().cast("map<string,struct<units:string>>")
    first = F.to_json(F.struct(info.alias("parameters")))
    second = F.to_json(F.struct(empty.alias("parameters"), F.struct(info.alias("parameter")).alias("header")))
    body = F.when(F.col("p_partkey") % 2 == 0, first).otherwise(second)
    return S.parse_units(t.raw("part").select(body.alias("body")), "body")


@query("""
SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS nombre, CASE WHEN p_partkey % 3 = 0 THEN 'NASA' ELSE p_brand END AS fuente,
    'Por definir' AS unidades, CASE WHEN p_partkey % 4 = 0 THEN 0 ELSE 1 END AS limits FROM part""")
def descriptor_shape(t: Tables) -> DataFrame:
    key = F.col("p_partkey")
    sources = F.when(key % 3 != 0, F.array("p_brand", "p_type")).when(key % 2 == 0, F.array().cast("array<string>"))
    limits = F.when(key % 4 != 0, F.create_map(F.lit("min"), F.col("p_size").cast("string")))
    text = F.to_json(F.struct(
        key.cast("string").alias("id"), F.col("p_name").alias("name"), sources.alias("sources"), limits.alias("range")
    ))
    rows = t.raw("part").select(F.from_json(text, S.DESCRIPTORS).alias("d")).select("d.*")
    shaped = S.shape_descriptors(rows)
    return shaped.select("id", "nombre", "fuente", "unidades", F.size("rango").alias("limits"))


@query("""
, verified AS (SELECT p_partkey, p_name FROM part WHERE p_size > 5)
SELECT CAST(p.p_partkey AS VARCHAR) AS id_variable, 'NASA' AS fuente, p.p_name AS nombre_completo,
    CASE WHEN p.p_partkey % 2 = 0 THEN p.p_type ELSE 'N/A' END AS unidad_de_medida
FROM part p JOIN verified v ON p.p_partkey = v.p_partkey""")
def dictionary_update(t: Tables) -> DataFrame:
    parts = t.raw("part")
    catalogue = parts.select(
        F.col("p_partkey").cast("string").alias("id"), F.col("p_name").alias("nombre"),
        F.lit(None).cast("string").alias("unidades"),
    )
    rows = S.dictionary_rows(catalogue)
    units = parts.where(F.col("p_partkey") % 2 == 0).select(
        F.col("p_partkey").cast("string").alias("id_variable"), F.col("p_type").alias("unit")
    )
    updated = R.update_from(rows, units, ["id_variable"], {"unidad_de_medida": F.col("unit")})
    verified = parts.where(F.col("p_size") > 5).select(F.col("p_partkey").cast("string").alias("id_variable"))
    return R.with_parent(updated, verified, "id_variable")


@query(_SERIES)
def series_incremental(t: Tables) -> DataFrame:
    """Responses landed as files and taken in by the streaming job, then read back.

    Older responses and unreadable ones for the same keys land first, in the same batch.
    """
    folder = f"{shared_folder(t.spark)}/ingest-{uuid.uuid4()}"
    bodies = series_bodies(t)
    older = bodies.withColumn("body", F.regexp_replace("body", r":(-?[0-9])", ":1$1"))
    torn = bodies.withColumn("body", F.substring("body", 1, 20))
    older.unionByName(torn).write.json(f"{folder}/landing")
    bodies.write.mode("append").json(f"{folder}/landing")
    log = SeriesLog(t.spark, f"{folder}/log")
    start_ingest(t.spark, f"{folder}/landing", log, f"{folder}/state").awaitTermination()
    return log.read().withColumn("entity_id", F.col("entity_id").cast("bigint"))


_SINK = ["record", "variable", "entity", "day", "value"]


def _sink(t: Tables, folder: str, rows_of) -> ResponseSink:
    series = KeyedTable(t.spark, f"{folder}/series", ["variable", "entity", "day"], ["entity"], parts=8)
    series.create(t.spark.createDataFrame([], "record bigint, variable string, entity bigint, day date, value double").schema)
    ledger = KeyedTable(t.spark, f"{folder}/ledger", ["response"], parts=8)
    ledger.create(t.spark.createDataFrame([], LEDGER).schema)
    return ResponseSink(series, ledger, _SINK, rows_of)


@query("""
, daily AS (SELECT user_id AS entity, event_type AS variable, CAST(ts AS DATE) AS day, max(value) AS value FROM events GROUP BY 1, 2, 3)
SELECT entity, variable, day, CASE WHEN entity % 2 = 0 THEN -value ELSE value END AS value, TRUE AS numbered FROM daily
WHERE entity % 2 = 1 OR variable IN ('view', 'click', 'purchase') AND day < DATE '2024-01-20'
UNION ALL SELECT entity, variable, day, value, TRUE FROM daily WHERE entity % 2 = 0 AND variable NOT IN ('view', 'click', 'purchase')""")
def ingest_upsert(t: Tables) -> DataFrame:
    """Responses taken into a keyed series; later ones replace whole (entity, variable) pairs.

    All users land first. Then even users land again for three variables, with other values and fewer days. At last the
    state of the stream is lost, so that all files come a second time, which must change nothing.
    """
    folder = f"{shared_folder(t.spark)}/take-{uuid.uuid4()}"
    sink = _sink(t, folder, series_rows)
    daily = t.raw("events").groupBy(F.col("user_id").alias("entity_id"), "event_type", F.to_date("ts").alias("day")).agg(F.max("value").alias("value"))

    def land(rows: DataFrame) -> None:
        # Bounded by the days of a user.
        days = rows.groupBy("entity_id", "event_type").agg(
            F.map_from_entries(F.collect_list(F.struct(F.date_format("day", "yyyyMMdd").alias("day"), "value"))).alias("days"))
        body = F.to_json(F.struct(F.struct(F.create_map("event_type", "days").alias("parameter")).alias("properties")))
        days.select("entity_id", body.alias("body")).write.mode("append").json(f"{folder}/landing")

    def take(state: str) -> None:
        start_taking(t.spark, f"{folder}/landing", sink, f"{folder}/{state}").awaitTermination()

    land(daily)
    take("state")
    again = (F.col("entity_id") % 2 == 0) & F.col("event_type").isin("view", "click", "purchase") & (F.col("day") < F.lit("2024-01-20").cast("date"))
    land(daily.where(again).withColumn("value", -F.col("value")))
    take("state")
    take("fresh state")
    series = sink.series.read()
    repeated = series.groupBy("record").agg(F.count(F.lit(1)).alias("times"))
    return series.join(repeated, "record", "left").select("entity", "variable", "day", "value", F.coalesce(F.col("times") == 1, F.lit(False)).alias("numbered"))


@query("""
, clear AS (
    SELECT user_id, event_type, CAST(ts AS DATE) AS day, value, row_number() OVER (PARTITION BY user_id ORDER BY CAST(ts AS DATE) DESC, value DESC) AS n
    FROM events WHERE event_type <> 'error' AND value IS NOT NULL)
SELECT user_id AS entity, v.variable, day, round(value + v.shift, 6) AS value FROM clear
JOIN (VALUES ('NDVI', 0.0), ('NDWI', 1.0), ('NDMI', 2.0)) AS v(variable, shift) ON TRUE WHERE n = 1""")
def ingest_images(t: Tables) -> DataFrame:
    """Image responses, one per user with a row per event, taken into a keyed series: the newest clear day of each."""
    folder = f"{shared_folder(t.spark)}/images-{uuid.uuid4()}"
    sink = _sink(t, folder, image_rows(["NDVI", "NDWI", "NDMI"], "NDVI"))
    seen = F.when(F.col("event_type") != "error", F.col("value"))
    row = F.array(F.col("user_id").cast("string"), F.unix_millis(F.to_date("ts").cast("timestamp")).cast("string"),
                  *[(seen + F.lit(shift)).cast("string") for shift in (0.0, 1.0, 2.0)])
    header = F.array(*[F.lit(c) for c in ("id", "time", "NDVI", "NDWI", "NDMI")])
    # Bounded by the events of a user.
    lists = t.raw("events").groupBy(F.col("user_id").alias("entity_id")).agg(F.collect_list(row).alias("rows"))
    lists.select("entity_id", F.to_json(F.concat(F.array(header), "rows")).alias("body")).write.json(f"{folder}/landing")
    start_taking(t.spark, f"{folder}/landing", sink, f"{folder}/state").awaitTermination()
    return sink.series.read().drop("record")


def _stored(t: Tables, rows: DataFrame, keys: list[str], by: list[str] | None = None) -> KeyedTable:
    """A keyed table with the rows as its first write."""
    table = KeyedTable(t.spark, f"{shared_folder(t.spark)}/keyed-{uuid.uuid4()}", keys, by, parts=16)
    return table.create(rows.schema, rows)


@query("""
, both_ AS (SELECT c_custkey AS id, c_name AS name, 1 AS source FROM customer WHERE c_custkey % 3 = 0
    UNION ALL SELECT c_custkey, 'second ' || c_name, 2 FROM customer WHERE c_custkey % 2 = 0
    UNION ALL SELECT c_custkey, 'zz ' || c_name, 2 FROM customer WHERE c_custkey % 4 = 0)
SELECT id, name FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY source, name) AS n FROM both_) WHERE n = 1""")
def store_insert_if_absent(t: Tables) -> DataFrame:
    """Insert-if-absent into a stored table in parts, repeated by a second run."""
    rows = t.raw("customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    table = _stored(t, rows.where(F.col("id") % 3 == 0), ["id"])
    more = rows.where(F.col("id") % 2 == 0).withColumn("name", F.concat(F.lit("second "), "name"))
    more = more.unionByName(rows.where(F.col("id") % 4 == 0).withColumn("name", F.concat(F.lit("zz "), "name")))
    return table.insert(more).insert(more).read()


@query("""
, incoming AS (SELECT entity_id, variable, obs_date, value * 2 AS value FROM obs WHERE obs_date >= DATE '2024-01-20')
SELECT entity_id, variable, obs_date, value FROM obs o
WHERE NOT EXISTS (SELECT 1 FROM incoming i WHERE i.entity_id = o.entity_id AND i.variable = o.variable)
UNION ALL SELECT entity_id, variable, obs_date, value FROM incoming""", "obs")
def store_upsert_by_key(t: Tables) -> DataFrame:
    """Delete-then-insert by (entity, variable) in a stored table in parts by entity, repeated by a second run."""
    rows = t.obs.select("entity_id", "variable", "obs_date", "value")
    table = _stored(t, rows, ["entity_id", "variable"], ["entity_id"])
    incoming = rows.where(F.col("obs_date") >= F.lit("2024-01-20").cast("date")).withColumn("value", F.col("value") * 2)
    table.upsert(incoming).upsert(incoming)
    table.expire()
    return table.read()


@query("""
SELECT obs_id, value, CAST(NULL AS DOUBLE) AS corrected FROM obs
UNION ALL SELECT event_id + 1000000, value, value / 2 FROM events WHERE event_type = 'view'
UNION ALL SELECT event_id + 2000000, value, NULL FROM events WHERE event_type = 'click'""", "obs")
def store_append_and_widen(t: Tables) -> DataFrame:
    """Rows appended to a stored table before and after a column was added to it; the parts are then compacted."""
    table = _stored(t, t.obs.select("obs_id", "value"), ["obs_id"]).widen("corrected", "double").widen("corrected", "double")
    events = t.raw("events")
    for kind, shift, half in (("view", 1_000_000, F.col("value") / 2), ("click", 2_000_000, F.lit(None).cast("double"))):
        table.append(events.where(F.col("event_type") == kind).select((F.col("event_id") + shift).alias("obs_id"), "value", half.alias("corrected")))
    table.compact(writes=2)
    return table.read()


def _register(t: Tables) -> WF.MigrationInputs:
    """A raw register with defects: a fire per customer, the series of the event users, a place per nation."""
    raw = TableStore(t.spark, f"{shared_folder(t.spark)}/raw-{uuid.uuid4()}")
    key, fire = F.col("c_custkey"), F.concat(F.lit("c"), F.col("c_custkey").cast("string"))
    place = F.concat(F.lit("15"), (F.col("c_nationkey") + 100).cast("string"))
    customers, regions, events = t.raw("customer"), t.raw("region"), t.raw("events")

    def put(name: str, *columns) -> None:
        rows = columns[0].select(*[c.cast(f.dataType).alias(f.name) for f, c in zip(SCHEMAS[name].fields, columns[1:])])
        raw.replace(name, rows)

    put("diccionario", events.select("event_type").distinct(), F.concat(F.lit(" "), "event_type"), F.lit("NASA"), F.col("event_type"), F.lit("u"))
    put("estado", regions, F.col("r_regionkey"), F.col("r_name"), F.col("r_name"))
    for name, kinds in (("vegetacion", 4), ("causa", 3)):
        kind = F.concat(F.lit("kind "), (F.col("r_regionkey") % kinds).cast("string"))
        put(name, regions, F.col("r_regionkey"), kind, kind)
    put("municipios", t.raw("nation"), F.concat(F.lit("15"), (F.col("n_nationkey") + 100).cast("string")), F.lit(15), F.col("n_name"))
    # Every seventh fire twice, some in a place that no catalogue has, some without coordinates.
    fires = customers.unionByName(customers.where(key % 7 == 0))
    put("incendios", fires, fire, F.when(key % 100 == 1, F.lit("15999")).otherwise(place), key % 5, key % 5,
        F.when(key % 10 == 3, F.lit(0.0)).otherwise(F.lit(19.5)), F.lit(-99.5), F.lit("2024-02-01"), F.lit("Copa"), F.lit(2024))
    damaged = customers.where(key % 2 == 0)
    damaged = damaged.select(fire.alias("id")).unionByName(damaged.select(fire.alias("id"))).unionByName(
        customers.where(key % 9 == 0).select(F.concat(F.lit("x"), key.cast("string")).alias("id")))
    put("danos", damaged, F.col("id"), *[F.lit(-1.0)] * len(DAMAGE_PARTS), F.lit("0 a 5"))
    raw.replace("operaciones", t.spark.createDataFrame([], SCHEMAS["operaciones"]))
    put("climatologia", events, F.col("event_id"), F.concat("event_type", F.lit(" ")), F.concat(F.lit("c"), F.col("user_id").cast("string")),
        F.to_date("ts"), F.when(F.col("event_type") == "signup", F.lit(-999.0)).otherwise(F.col("value")))
    operations = customers.where(key % 3 == 0).select(*[
        {"id_clave_inc": fire, "fecha_termino": F.lit("02/02/2024")}.get(new, F.lit("1")).alias(old) for old, new in WF.OPERATIONS.items()])
    people = t.raw("nation").select((F.col("n_nationkey") + 15100).alias("CLAVE"), F.explode(F.array(F.lit("Mujeres"), F.lit("Hombres"), F.lit("Hombres"))).alias("SEXO"))
    people = people.unionByName(t.raw("region").where("r_regionkey = 0").select(F.lit(15555).cast(people.schema["CLAVE"].dataType).alias("CLAVE"), F.lit("Mujeres").alias("SEXO")))
    people = people.select("CLAVE", F.lit(2020).alias("Fecha"), "SEXO", F.lit(10).alias("POB_TOTAL"), *[F.lit(1).alias(b) for b in WF.POPULATION_BANDS])
    return WF.MigrationInputs(TableStore(t.spark, raw.root, read_only=True), people, operations)


@query("""
, fires AS (SELECT c_custkey AS id FROM customer),
known AS (SELECT e.* FROM events e JOIN fires ON user_id = id WHERE id % 10 <> 3),
alive AS (SELECT event_type FROM known GROUP BY event_type HAVING count(CASE WHEN event_type <> 'signup' THEN value END) > 0),
n AS (SELECT (SELECT count(DISTINCT event_type) FROM events) AS words, (SELECT count(*) FROM region) AS states,
    (SELECT count(DISTINCT r_regionkey % 4) FROM region) AS kinds, (SELECT count(DISTINCT r_regionkey % 3) FROM region) AS causes,
    (SELECT count(*) FROM nation) + (SELECT least(count(*), 1) FROM fires WHERE id % 100 = 1) AS places,
    (SELECT count(*) FROM fires) AS fires, (SELECT count(*) FROM fires WHERE id % 2 = 0) AS damaged, (SELECT count(*) FROM fires WHERE id % 3 = 0) AS timed,
    (SELECT 2 * count(*) + 1 FROM nation) AS people,
    (SELECT count(*) FROM (SELECT DISTINCT event_type, user_id, CAST(ts AS DATE) AS d FROM known JOIN alive USING (event_type))) AS series)
SELECT phase, "table", CAST(rows AS BIGINT) AS rows FROM n, LATERAL (VALUES
    ('catalogues', 'diccionario', words), ('catalogues', 'estado', states), ('catalogues', 'vegetacion', states), ('catalogues', 'causa', states),
    ('geography', 'municipios', places), ('geography', 'incendios', fires),
    ('keys and duplicates', 'municipios', places), ('keys and duplicates', 'causa', causes), ('keys and duplicates', 'vegetacion', kinds),
    ('keys and duplicates', 'incendios', fires),
    ('children', 'danos', damaged), ('children', 'operaciones', timed), ('children', 'municipios', places + 1), ('children', 'demografia', people),
    ('series', 'climatologia', series), ('interpolation', 'climatologia', series),
    ('text and coordinates', 'diccionario', words), ('text and coordinates', 'estado', states), ('text and coordinates', 'vegetacion', kinds),
    ('text and coordinates', 'causa', causes), ('text and coordinates', 'municipios', places + 1), ('text and coordinates', 'incendios', fires),
    ('text and coordinates', 'demografia', people), ('text and coordinates', 'danos', damaged),
    ('integrity', 'municipios', places + 1)) AS v(phase, "table", rows)""")
def migration_counters(t: Tables) -> DataFrame:
    """Rows of each table after each phase of a migration of a defective register, which is stopped once and goes on."""
    inputs = _register(t)
    work = TableStore(t.spark, f"{shared_folder(t.spark)}/work-{uuid.uuid4()}")
    report = WF.migrate(inputs, work)
    # As if the last two phases had been lost: they are run again from what they started from.
    log = work.read(WF.MigrationLog.TABLE)
    last = F.col("step") >= 7
    work.replace(WF.MigrationLog.TABLE, log.where(~last | (F.col("state") == "begun") & (F.col("step") == 7)))
    resumed = WF.migrate(inputs, work, resume=True)
    return report.intersect(resumed)
