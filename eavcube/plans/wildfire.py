"""The wildfire warehouse: register, demography and operations loads, migration, cube and features.

Every step is a chain of the general operators with the column names of the tables of record.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eavcube.functions import dates as D
from eavcube.functions import keys as K
from eavcube.functions import numbers as N
from eavcube.functions import text as X
from eavcube.operators import cleaning as CL
from eavcube.operators import cube as C
from eavcube.operators import features as FE
from eavcube.operators import ml as M
from eavcube.operators import quality as Q
from eavcube.operators import relational as R
from eavcube.operators.aggregate import pivot_mean, yearly_health
from eavcube.operators.ordered import checkpoint
from eavcube.operators.quantile import quantile_list
from eavcube.operators.skew import HOT_ROWS
from eavcube.operators.window import keep_first
from eavcube.schemas import AGE_BANDS, DAMAGE_PARTS, KEYS, REFERENCES, SCHEMAS, TEXT_COLUMNS
from eavcube.sources.keyed import KeyedTable
from eavcube.sources.tables import TableStore
from eavcube.streaming.incremental import LEDGER, ResponseSink, image_rows, series_rows

# Headers of the register and the columns they become.
REGISTER_TEXT = {
    "Clave del incendio": "id_clave_inc", "CVE_ENT": "id_clave_ent", "CVEGEO": "id_cvegeo", "Región": "region",
    "Estado": "estado", "Municipio": "nombre_municipio", "Causa": "causa", "Causa especifica": "causa_especifica",
    "Régimen de fuego": "regimen_del_fuego", "Tipo Vegetación": "tipo_de_vegetacion",
    "Tipo de incendio": "tipo_de_incendio", "Tamaño": "tamanio",
}
REGISTER_NUMBERS = {
    "Año": "anio", "Arbolado Adulto": "arbolado_adulto", "Renuevo": "renuevo", "Arbustivo": "arbustivo",
    "Herbáceo": "herbaceo", "Hojarasca": "hojarasca", "Total hectáreas": "total_hectareas",
}
OPERATIONS = {
    "Clave del incendio": "id_clave_inc", "Fecha Termino": "fecha_termino", "Detección": "hora_deteccion_s",
    "Llegada": "hora_llegada_s", "Duración": "duracion_s", "Duración días": "duracion_dias",
}
# Population bands of the demography file, in the order of the table's bands.
POPULATION_BANDS = [
    "POB_00_04", "POB_05_09", "POB_010_014", "POB_015_019", "POB_20_24", "POB_25_29", "POB_30_34", "POB_35_39",
    "POB_40_44", "POB_45_49", "POB_50_54", "POB_55_59", "POB_60_64", "POB_65_69", "POB_70_74", "POB_75_79",
    "POB_80_84", "POB_85_mm",
]
# The columns of a fire that the register has itself.
FIRE_COLUMNS = [c for c in SCHEMAS["incendios"].names if c not in ("id_causa", "id_vegetacion")]
HOME_STATE = "México"
HOME_STATE_KEY = 15
# The state's bounding box and the labels of places that were not in a catalogue.
STATE_BOX = {"lat": (18.35, 20.25), "lon": (-100.6, -98.55)}
# The series is filtered by variable far more often than by anything else.
PARTITIONED = {"climatologia": "id_variable"}
FROM_CSV_LABEL = "MUNICIPIO DESDE CSV POR REVISAR"
# How the services are asked, and what the vegetation service answers with.
HISTORY_DAYS, BUNDLE = 10, 15
VEGETATION = ["NDVI", "NDWI", "NDMI"]
SERIES_COLUMNS = ["id_registro", "id_variable", "id_clave_inc", "fecha_de_observacion", "resultado_numerico"]
RESPONSES = "respuestas"


# Loads -----------------------------------------------------------------------------------------


def conform_register(raw: DataFrame, state: str = HOME_STATE) -> DataFrame:
    """Typed rows of one state from the all-text register.

    Rows without start date or coordinates are dropped; other numbers that cannot be read become 0.
    """
    text = {new: F.col(f"`{old}`") for old, new in REGISTER_TEXT.items()}
    numbers = {new: F.coalesce(N.to_number(F.col(f"`{old}`")), F.lit(0.0)) for old, new in REGISTER_NUMBERS.items()}
    home = raw.where(X.trim_whitespace(F.col("Estado")) == state)
    # What rows are dropped by is parsed behind a generator, below which the filter cannot be pushed, so only once.
    required = F.struct(
        D.parse_date(F.col("`Fecha Inicio`")).alias("fecha_inicio"),
        N.to_number(F.col("Latitud")).alias("latitud"),
        N.to_number(F.col("Longitud")).alias("longitud"),
    )
    typed = home.select(
        *[c.alias(n) for n, c in text.items()],
        *[c.alias(n) for n, c in numbers.items()],
        F.inline(F.array(required)),
    )
    return typed.dropna(subset=["fecha_inicio", "latitud", "longitud"]).withColumns({
        "estado": X.trim_whitespace(F.col("estado")),
        "id_clave_ent": F.col("id_clave_ent").try_cast("int"),
        "anio": F.round("anio").cast("int"),
    })


def register_quality(raw: DataFrame, year: str, state: str = HOME_STATE) -> DataFrame:
    """Rows of one year before and after conforming and what was unreadable."""
    rows = raw.where((X.trim_whitespace(F.col("Estado")) == state) & (F.col("`Año`") == year))
    date = D.parse_date(F.col("`Fecha Inicio`"))
    lat, lon = N.to_number(F.col("Latitud")), N.to_number(F.col("Longitud"))
    return rows.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(date.isNull()).alias("bad_date"),
        F.count_if(lat.isNull()).alias("bad_lat"), F.count_if(lon.isNull()).alias("bad_lon"),
        F.count_if(date.isNotNull() & lat.isNotNull() & lon.isNotNull()).alias("kept"),
    )


def split_register(register: DataFrame, stored: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Catalogues, fires and damage from the conformed register, added to what is stored already."""
    out = {}
    for name in ("estado", "municipios"):
        columns = stored[name].columns
        out[name] = R.insert_if_absent([stored[name], register.select(*columns).distinct()], KEYS[name])
    for name, pair in (("causa", ["causa", "causa_especifica"]),
                       ("vegetacion", ["regimen_del_fuego", "tipo_de_vegetacion"])):
        fresh = R.new_rows(register.select(*pair).dropna(), stored[name].select(*pair))
        keyed = R.surrogate_keys(fresh, f"id_{name}", pair, stored[name])
        out[name] = R.append_rows(stored[name], keyed.select(*stored[name].columns))
    # A catalogue has few keys, so the fires of each are spread. Nothing runs while the plan is made.
    fires = R.lookup(register, out["causa"], ["causa", "causa_especifica"], spread_by=FIRE_COLUMNS)
    fires = R.lookup(fires, out["vegetacion"], ["regimen_del_fuego", "tipo_de_vegetacion"], spread_by=FIRE_COLUMNS)
    for name, rows in (("incendios", fires), ("danos", register)):
        out[name] = R.insert_if_absent([stored[name], rows.select(*stored[name].columns)], KEYS[name])
    return out


def load_demography(rows: DataFrame, places: DataFrame,
                    stored: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(places, demography): zero-filled keys, placeholder places, first row per place, year and sex."""
    keyed = rows.withColumn("id_cvegeo", K.zero_fill(F.col("CLAVE")))
    bands = dict(zip(POPULATION_BANDS, AGE_BANDS))
    shaped = keyed.select(
        "id_cvegeo", F.col("Fecha").try_cast("int").alias("anio"), F.col("SEXO").alias("sexo"),
        F.col("POB_TOTAL").try_cast("int").alias("pob_total"),
        *[F.col(a).try_cast("int").alias(b) for a, b in bands.items()],
    )
    missing = shaped.select("id_cvegeo").distinct().select(
        "id_cvegeo", F.lit(HOME_STATE_KEY).alias("id_clave_ent"), F.lit(FROM_CSV_LABEL).alias("nombre_municipio")
    )
    sources = [shaped] if stored is None else [stored, shaped]
    return R.insert_if_absent([places, missing], ["id_cvegeo"]), R.insert_if_absent(sources, KEYS["demografia"])


def load_operations(raw: DataFrame, fires: DataFrame) -> DataFrame:
    """Operations of known fires with tolerant date, time and duration parsing, one row per fire."""
    parse = {
        "id_clave_inc": X.strip_whitespace, "fecha_termino": lambda c: D.parse_date(c, D.DAY_FIRST),
        "hora_deteccion_s": D.clock_seconds, "hora_llegada_s": D.clock_seconds,
        "duracion_s": D.duration_seconds, "duracion_dias": N.to_integer,
    }
    typed = raw.select(*[parse[new](F.col(f"`{old}`")).alias(new) for old, new in OPERATIONS.items()])
    return keep_first(R.with_parent(typed, fires, "id_clave_inc"), ["id_clave_inc"], typed.columns[1:])


# Keyed loads and ingestion ---------------------------------------------------------------------


def load_register(store: TableStore, register: DataFrame) -> None:
    """Add the conformed register to the stored tables by keyed writes: only parts that new keys fall into are read."""
    for name in ("estado", "municipios"):
        store.keyed(name).insert(register.select(*SCHEMAS[name].names).distinct())
    ids = {}
    for name, pair in (("causa", ["causa", "causa_especifica"]),
                       ("vegetacion", ["regimen_del_fuego", "tipo_de_vegetacion"])):
        table = store.keyed(name)
        fresh = R.new_rows(register.select(*pair).dropna(), table.read().select(*pair))
        table.append(checkpoint(R.surrogate_keys(fresh, f"id_{name}", pair, table.read())))
        ids[name] = (table.read(), pair)
    fires = register
    for catalogue, pair in ids.values():
        fires = R.lookup(fires, catalogue, pair, spread_by=FIRE_COLUMNS)
    for name, rows in (("incendios", fires), ("danos", register)):
        store.keyed(name).insert(rows.select(*SCHEMAS[name].names))


def response_sink(store: TableStore, kind: str = "series") -> ResponseSink:
    """Takes landed climate (`series`) or vegetation (`images`) responses into the stored series."""
    series = store.keyed("climatologia", ["id_clave_inc"])
    ledger = KeyedTable(store.spark, f"{store.root}/{RESPONSES}", ["response"])
    ledger.create(store.spark.createDataFrame([], LEDGER).schema)
    rows_of = {"series": series_rows, "images": image_rows(VEGETATION, VEGETATION[0])}[kind]
    return ResponseSink(series, ledger, SERIES_COLUMNS, rows_of)


def open_requests(store: TableStore, variables: Sequence[str]) -> DataFrame:
    """What is still to be asked for, oldest fires first: one row per fire and bundle of variables that is not complete."""
    fires = store.read("incendios").withColumnsRenamed({"latitud": "lat", "longitud": "lon"})
    series = store.read("climatologia")
    pending = R.pending_entities(fires, series, "id_clave_inc", "id_variable", count=len(variables) + len(VEGETATION))
    plan = R.request_plan(pending, series, "id_clave_inc", "fecha_inicio", "id_variable",
                          R.bundles(variables, BUNDLE), HISTORY_DAYS, ["lat", "lon"])
    return plan.orderBy("window_end", "id_clave_inc", "bundle")


# Migration -------------------------------------------------------------------------------------


@dataclass(frozen=True)
class MigrationInputs:
    """The raw tables and the two delimited files, already read as text or typed columns."""

    raw: TableStore
    demography: DataFrame
    operations: DataFrame


class MigrationLog:
    """What each phase of a migration read and wrote, stored as the table `migracion` of the working store.

    A phase is entered with the versions of the tables it starts from. One that was begun and not finished is run again
    from these versions, whatever it had already written.
    """

    TABLE = "migracion"
    SCHEMA = "step int, phase string, state string, `table` string, version bigint, rows bigint"

    def __init__(self, work: TableStore, resume: bool):
        self.work = work
        stored = work.read(self.TABLE).collect() if resume and work.exists(self.TABLE) else []
        self.rows = [tuple(r) for r in stored]

    def finished(self, phase: str) -> bool:
        return any(r[1] == phase and r[2] == "done" for r in self.rows)

    def begin(self, step: int, phase: str) -> TableStore:
        """The working store as the phase finds it."""
        begun = {r[3]: r[4] for r in self.rows if r[1] == phase and r[2] == "begun"}
        if not any(r[1] == phase and r[2] == "begun" for r in self.rows):
            begun = {n: self.work.versions(n)[-1] for n in SCHEMAS if self.work.versions(n)}
            # A phase that starts from nothing has a line too.
            lines = [(step, phase, "begun", n, v, None) for n, v in begun.items()] or [(step, phase, "begun", None, None, None)]
            self._add(lines)
        return self.work.pinned({n: v for n, v in begun.items() if n})

    def finish(self, step: int, phase: str, counts: Mapping[str, int]) -> None:
        self._add([(step, phase, "done", n, self.work.versions(n)[-1], rows) for n, rows in counts.items()])

    def report(self) -> DataFrame:
        """(phase, table, rows) of the finished phases."""
        lines = [(r[1], r[3], r[5]) for r in self.rows if r[2] == "done"]
        return self.work.spark.createDataFrame(lines, "phase string, `table` string, rows bigint")

    def _add(self, lines: list[tuple]) -> None:
        self.rows += lines
        self.work.replace(self.TABLE, self.work.spark.createDataFrame(self.rows, self.SCHEMA).coalesce(1))


def migrate(inputs: MigrationInputs, work: TableStore, box: Mapping[str, Sequence[float]] = STATE_BOX,
            resume: bool = False, tidy: bool = False) -> DataFrame:
    """Clean the raw tables into the working store and return (phase, table, rows) counters.

    Each phase reads the stored tables and writes new versions; a log says which phases are done and what the current one
    started from, so with `resume` a stopped run goes on where it was, with the same result. `tidy` deletes the versions
    that were replaced. The large series is written twice: cleaned, then interpolated. In the end the fires and
    series rows of each year are stored as `salud_anual`.
    """
    phases = [
        ("catalogues", lambda now: _catalogues(inputs.raw)),
        ("geography", lambda now: _geography(inputs.raw)),
        ("keys and duplicates", _keys_and_duplicates),
        ("children", lambda now: _children(inputs, now)),
        ("series", lambda now: {"climatologia": _series(inputs.raw, now, box)}),
        ("interpolation", lambda now: {"climatologia": _interpolated(now.read("climatologia"))}),
        ("text and coordinates", lambda now: _text_and_coordinates(now, box)),
        ("integrity", _integrity),
    ]
    log = MigrationLog(work, resume)
    for step, (phase, run) in enumerate(phases, 1):
        if log.finished(phase):
            continue
        counts = {}
        for name, table in run(log.begin(step, phase)).items():
            typed = table.select(*[F.col(f.name).cast(f.dataType) for f in SCHEMAS[name].fields])
            counts[name] = work.replace(name, typed, PARTITIONED.get(name)).count()
        log.finish(step, phase, counts)
    health = yearly_health(work.read("incendios"), work.read("climatologia"), "id_clave_inc", F.year("fecha_inicio"))
    work.replace("salud_anual", health)
    if tidy:
        work.expire()
    return log.report()


def audit(store: TableStore, report: TableStore, box: Mapping[str, Sequence[float]] = STATE_BOX,
          official: DataFrame | None = None) -> dict[str, DataFrame]:
    """Write the audits of a store.

    Schema, gaps with what to do about them, references, repeated keys, texts; the profile of the series, its impossible
    values and the variables in use; consistency counters with the fires behind them: chronology, arrivals, places
    outside the box, damage. `official` (id_variable, nombre, unidades) adds the check of the dictionary.
    """
    tables = {n: store.read(n) for n in SCHEMAS}
    fires, places, operations, damage = (tables[n] for n in ("incendios", "municipios", "operaciones", "danos"))
    series = tables["climatologia"]
    linked = {r.column for r in REFERENCES}
    place = ("id_cvegeo", "nombre_municipio")

    def together(frames: Mapping[str, DataFrame]) -> DataFrame:
        """One frame with the name of the table each row is about."""
        out = None
        for name, df in frames.items():
            line = df.select(F.lit(name).alias("table"), *df.columns)
            out = line if out is None else out.unionByName(line)
        return out

    repeats = {name: Q.duplicate_audit(tables[name], keys).agg(
        F.count(F.lit(1)).alias("keys"), F.coalesce(F.sum("repeats"), F.lit(0)).alias("rows")) for name, keys in KEYS.items()}
    audits = {
        "audit_schema": Q.schema_report(tables),
        "audit_gaps": together({n: Q.null_profile(df, [*KEYS[n], *(c for c in df.columns if c in linked)]) for n, df in tables.items()}),
        "audit_references": Q.reference_audit(tables, REFERENCES),
        "audit_duplicates": together(repeats),
        "audit_texts": together({n: Q.text_profile(tables[n], columns) for n, columns in TEXT_COLUMNS.items()}),
        "audit_series": Q.variable_profile(series, "id_variable", "resultado_numerico"),
        "audit_impossible": Q.impossible_values(series, "id_variable", "resultado_numerico"),
        "audit_variables": Q.variables_in_use(tables["diccionario"], series, "id_variable"),
        "audit_consistency": Q.consistency_counts(
            fires, operations, damage, tables["demografia"], "id_clave_inc", "fecha_inicio", "fecha_termino", "hora_deteccion_s",
            "hora_llegada_s", "latitud", "longitud", box, DAMAGE_PARTS, "pob_total"),
        "audit_chronology": Q.chronology_detail(fires, operations, places, "id_clave_inc", *place, "fecha_inicio", "fecha_termino"),
        "audit_arrivals": Q.arrivals_before_detection(operations, "id_clave_inc", "hora_deteccion_s", "hora_llegada_s"),
        "audit_places": Q.out_of_box(fires, places, "id_cvegeo", "latitud", "longitud", box, ["id_clave_inc", *place, "latitud", "longitud"]),
        "audit_damage": Q.damage_outliers(damage, fires, places, "id_clave_inc", *place, DAMAGE_PARTS),
    }
    if official is not None:
        audits["audit_dictionary"] = Q.dictionary_check(tables["diccionario"], official, "id_variable", "nombre", "unidades")
    return {name: report.replace(name, df) for name, df in audits.items()}


def _catalogues(raw: TableStore) -> dict[str, DataFrame]:
    dictionary = raw.read("diccionario").withColumn("id_variable", X.strip_whitespace(F.col("id_variable")))
    return {"diccionario": dictionary, **{n: raw.read(n) for n in ("estado", "vegetacion", "causa")}}


def _geography(raw: TableStore) -> dict[str, DataFrame]:
    fires = raw.read("incendios").withColumn("id_clave_inc", X.strip_whitespace(F.col("id_clave_inc")))
    home = F.lit(HOME_STATE_KEY)
    places = CL.unify_dimension(
        raw.read("municipios"), fires, "id_cvegeo",
        {"id_clave_ent": home, "nombre_municipio": F.lit(CL.REVIEW_LABEL)}, {"id_clave_ent": home},
    )
    return {"municipios": places, "incendios": CL.migrate_facts(fires, "id_clave_inc", "id_cvegeo")}


def _keys_and_duplicates(work: TableStore) -> dict[str, DataFrame]:
    places = CL.add_swapped_members(work.read("municipios"), "id_cvegeo")
    fires = CL.swap_keys(work.read("incendios"), "id_cvegeo")
    causes, fires = CL.deduplicate_catalogue(work.read("causa"), fires, "id_causa", ["causa", "causa_especifica"])
    kinds, fires = CL.deduplicate_catalogue(
        work.read("vegetacion"), fires, "id_vegetacion", ["regimen_del_fuego", "tipo_de_vegetacion"]
    )
    return {"municipios": places, "causa": causes, "vegetacion": kinds, "incendios": fires}


def _children(inputs: MigrationInputs, work: TableStore) -> dict[str, DataFrame]:
    fires = work.read("incendios")
    damage = inputs.raw.read("danos").withColumn("id_clave_inc", X.strip_whitespace(F.col("id_clave_inc")))
    places, people = load_demography(inputs.demography, work.read("municipios"))
    order = [c for c in damage.columns if c != "id_clave_inc"]
    return {
        "danos": keep_first(R.with_parent(damage, fires, "id_clave_inc"), ["id_clave_inc"], order),
        "operaciones": load_operations(inputs.operations, fires),
        "municipios": places,
        "demografia": keep_first(CL.swap_keys(people, "id_cvegeo"), KEYS["demografia"], ["pob_total"]),
    }


def _mislocated(box: Mapping[str, Sequence[float]]) -> Column:
    return CL.is_mislocated(F.col("id_cvegeo"), F.col("latitud"), F.col("longitud"), box)


def _series(raw: TableStore, work: TableStore, box: Mapping[str, Sequence[float]]) -> DataFrame:
    """Known and well located fires in one semi-join, then codes, dead variables and duplicates."""
    series = raw.read("climatologia").withColumns({
        c: X.strip_whitespace(F.col(c)) for c in ("id_variable", "id_clave_inc")
    })
    fires = work.read("incendios").where(~_mislocated(box))
    known = CL.neutralise_sentinel(R.with_parent(series, fires, "id_clave_inc"), "resultado_numerico")
    alive = CL.remove_dead_variables(known, "id_variable", "resultado_numerico")
    return CL.deduplicate_series(alive, KEYS["climatologia"], "id_registro")


def _interpolated(series: DataFrame) -> DataFrame:
    return CL.interpolate_rescuable(
        series, "id_variable", "id_clave_inc", ["fecha_de_observacion", "id_registro"], "resultado_numerico"
    )


def _text_and_coordinates(work: TableStore, box: Mapping[str, Sequence[float]]) -> dict[str, DataFrame]:
    tables = CL.normalise_tables({n: work.read(n) for n in TEXT_COLUMNS}, TEXT_COLUMNS)
    return {
        **tables,
        "danos": CL.clamp_columns(tables["danos"], DAMAGE_PARTS),
        "incendios": CL.blank_coordinates(tables["incendios"], _mislocated(box), "latitud", "longitud"),
    }


def _integrity(work: TableStore) -> dict[str, DataFrame]:
    """Child tables that still have orphans, without them, and the places that are used.

    The series was joined to the fires when it was written and no fire has gone since.
    """
    fires = work.read("incendios")
    children = {n: work.read(n) for n in ("danos", "operaciones")}
    torn = {
        n: c for n, c in children.items()
        if not c.where(F.col("id_clave_inc").isNull()).isEmpty()
        or not R.without_parent(c, fires, "id_clave_inc").isEmpty()
    }
    places = CL.remove_unreferenced(work.read("municipios"), "id_cvegeo", [fires, work.read("demografia")])
    return {**CL.remove_orphans(torn, fires, "id_clave_inc"), "municipios": places}


# Cube ------------------------------------------------------------------------------------------


def build_cube(work: TableStore, cube: TableStore) -> dict[str, DataFrame]:
    """Write the dimensions and facts of the star schema under their published column names and return them as stored,
    with the names the views are made of."""

    def put(name: str, df: DataFrame) -> DataFrame:
        names = CUBE_COLUMNS.get(name, {})
        return cube.replace(name, df.withColumnsRenamed(names)).withColumnsRenamed({new: old for old, new in names.items()})

    places = work.read("municipios")
    dim_place = C.with_state_names(
        C.place_dimension(places, "id_cvegeo", "nombre_municipio"), places, work.read("estado"),
        "id_cvegeo", "id_clave_ent", "estado", "region",
    )
    ops = work.read("operaciones").select("id_clave_inc", "duracion_dias")
    fact = C.fire_fact(work.read("incendios"), ops, work.read("danos").drop("tamanio"), "id_clave_inc")
    fact = C.with_areas(fact.withColumnRenamed("duracion_dias", "duration_days"),
                        "arbolado_adulto", "herbaceo", "arbustivo")
    climate = C.climate_fact(work.read("climatologia"), "id_clave_inc", "id_variable", "resultado_numerico")
    stored_climate = put("fact_clima", climate)
    fact = C.with_climate_risk(C.with_severity(fact), stored_climate, "id_clave_inc")
    fact = C.with_climate_risk(fact, stored_climate, "id_clave_inc", C.CLIMATE_RISK_2, True, True)
    tables = {
        "dim_tiempo": C.time_dimension(work.read("climatologia"), "fecha_de_observacion"),
        "dim_ubicacion": dim_place,
        "dim_causa": work.read("causa"),
        "dim_vegetacion": C.vegetation_dimension(
            work.read("vegetacion"), "id_vegetacion", "tipo_de_vegetacion", "regimen_del_fuego"
        ),
        "dim_tipo_incendio": C.type_dimension(work.read("incendios"), "tipo_de_incendio"),
        "fact_incendios": C.with_severity(fact, C.SEVERITY_2, only_missing=True),
    }
    return {"fact_clima": stored_climate, **{n: put(n, df) for n, df in tables.items()}}


# Column names of the published tables of the cube.
CUBE_COLUMNS = {
    "dim_tiempo": {
        "date": "fecha", "year": "anio", "month": "mes", "quarter": "trimestre", "month_name": "nombre_mes",
        "season": "estacion", "is_weekend": "es_fin_semana",
    },
    "dim_ubicacion": {"place": "municipio", "state": "estado"},
    "dim_vegetacion": {"vegetation_risk": "riesgo_vegetacion"},
    "dim_tipo_incendio": {"type": "tipo"},
    "fact_incendios": {
        "duration_days": "duracion_dias", "n_fires": "num_incendios", "total_area": "superficie_total",
        "tree_area": "superficie_arbolado", "herb_area": "superficie_herbacea", "severity": "indice_severidad",
        "risk": "riesgo",
    },
    "fact_clima": {
        "temperature": "temperatura_prom", "wind": "viento_prom", "humidity": "humedad_prom",
        "radiation": "radiacion_prom",
    },
}
# Column names of the published views.
VIEW_COLUMNS = {
    "year": "anio", "quarter": "trimestre", "month": "mes", "month_name": "nombre_mes", "state": "estado",
    "place": "municipio", "fires": "incendios", "severity": "severidad", "area": "superficie",
    "temperature": "temp", "wind": "viento", "population": "poblacion", "impact": "impacto",
}
ANNUAL_COLUMNS = {
    "fires": "total_incendios", "severity": "severidad_promedio", "area": "superficie_total_quemada",
}


def cube_views(tables: Mapping[str, DataFrame], population: DataFrame) -> dict[str, DataFrame]:
    """The published summary views over a built cube, lazy and in their usual order."""
    fact, time, place = tables["fact_incendios"], tables["dim_tiempo"], tables["dim_ubicacion"]
    climate = tables["fact_clima"]
    key, fire, start = "id_cvegeo", "id_clave_inc", "fecha_inicio"
    views = {
        "vw_resumen_anual": (C.annual_summary(fact, time, start), ANNUAL_COLUMNS, [F.asc("anio")]),
        "vw_jerarquia_tiempo": (C.time_hierarchy(fact, time, start), {}, [F.asc("anio"), F.asc("mes")]),
        "vw_cubo_tiempo": (C.time_cube(fact, time, start), {}, [F.asc("anio"), F.asc("mes")]),
        "vw_cubo_geografico": (C.geographic_cube(fact, place, key), {}, [F.desc("incendios")]),
        "vw_clima_impacto": (C.climate_buckets(fact, climate, fire), {}, [F.desc("incendios")]),
        "vw_clima_riesgo": (C.climate_buckets(fact, climate, fire, "inner"), {}, [F.desc("incendios")]),
        "vw_riesgo_poblacional": (
            C.population_impact(fact, place, population, fire, key, "pob_total"),
            {"impact": "incendios_por_habitante"}, [F.desc_nulls_last("incendios_por_habitante")],
        ),
        "vw_impacto_poblacion": (
            C.population_impact(fact, place, population, fire, key, "pob_total", 1000.0), {},
            [F.desc_nulls_last("impacto")],
        ),
        "vw_top_riesgo": (
            C.critical_places(fact, place, climate, fire, key), {"temperature": "temperatura"},
            [F.desc_nulls_last("severidad")],
        ),
    }
    return {
        name: df.withColumnsRenamed({**VIEW_COLUMNS, **names}).orderBy(*order)
        for name, (df, names, order) in views.items()
    }


def published_tables(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The cube tables under their published column names."""
    return {name: df.withColumnsRenamed(CUBE_COLUMNS.get(name, {})) for name, df in tables.items()}


def register_views(tables: Mapping[str, DataFrame], population: DataFrame) -> list[str]:
    """Make the cube tables and views temporary views, so that they can be queried with SQL."""
    frames = {**published_tables(tables), **cube_views(tables, population)}
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
    return list(frames)


# Features --------------------------------------------------------------------------------------


AGE_GROUPS = {
    "pob_joven": AGE_BANDS[:3], "pob_adulta": AGE_BANDS[3:7], "pob_mayor": AGE_BANDS[12:],
}


def lag_model_table(work: TableStore, variables: Sequence[str]) -> DataFrame:
    """Fires with lag-window climate, catalogue, population and damage columns and a tercile label."""
    fires = work.read("incendios")
    # Bucketed copies, if there are any, spare the shuffle of the series.
    copies = [work.read_bucketed(name, "id_clave_inc") for name in ("climatologia", "incendios")]
    series, starts = copies if None not in copies else (work.read("climatologia"), fires)
    lags = FE.lag_features(
        series, starts, "id_clave_inc", "fecha_inicio", "fecha_de_observacion", "id_variable",
        "resultado_numerico", variables, hot_rows=None if None not in copies else HOT_ROWS,
    )
    wide = FE.wide_table(fires, [
        # Frames with one row per fire first; population repeats fires, so it comes last.
        (lags, ["id_clave_inc"]), (work.read("danos"), ["id_clave_inc"]), (work.read("vegetacion"), ["id_vegetacion"]),
        (work.read("causa"), ["id_causa"]), (work.read("demografia"), ["id_cvegeo"]),
    ])
    wide = wide.withColumns({
        "temp_combustible": FE.fuel_temperature_sum(F.col("TSOIL6_0d"), F.col("T2M_0d")),
        "estres_hidrico": FE.water_stress(F.col("NDVI_7d"), F.col("NDMI_7d")),
        "presion_humana": FE.human_pressure_by_location(F.col("pob_total"), F.col("latitud"), F.col("longitud")),
        "mes": F.month("fecha_inicio"), "estacion": D.season_number(F.col("fecha_inicio")),
    })
    # The edges of the terciles and the result read the joins from here.
    wide = checkpoint(FE.soil_vegetation_features(wide))
    trend: Column = F.col("NDVI_trend") - F.col("NDMI_trend") + F.col("TSOIL_trend")
    return FE.risk_terciles(wide.withColumn("__trend", trend), "__trend", "riesgo", drop_duplicates=True).drop("__trend")


def propagation_table(work: TableStore, variables: Sequence[str]) -> DataFrame:
    """Fires with mean climate, the propagation index, age groups and both kinds of labels."""
    means = pivot_mean(work.read("climatologia"), "id_clave_inc", "id_variable", "resultado_numerico", variables)
    fires = checkpoint(work.read("incendios").join(means, "id_clave_inc", "left"))
    (median,) = quantile_list(fires, "TSOIL6", [0.5])
    indexed = FE.propagation_index(fires, median, out="indice_propagacion")
    people = FE.age_groups(work.read("demografia"), AGE_GROUPS, total="poblacion_total").drop("anio")
    wide = FE.wide_table(indexed, [(people, ["id_cvegeo"])]).withColumns({
        "presion_humana": FE.human_pressure_by_age(F.col("pob_adulta"), F.col("poblacion_total")),
        "mes": F.month("fecha_inicio"), "estacion": D.season_number(F.col("fecha_inicio")),
        "temp_combustible": FE.fuel_temperature_product(F.col("TSOIL6"), F.col("NDVI")),
        "estres_hidrico": FE.water_stress(F.col("TSOIL6"), F.col("NDMI")),
    })
    labelled = FE.risk_terciles(checkpoint(wide), "indice_propagacion", "riesgo", drop_duplicates=True)
    return FE.one_hot(labelled, "tipo_de_incendio")


# Model -----------------------------------------------------------------------------------------


MODEL = "modelo"
# The published model columns.
MODEL_FEATURES = [
    "NDVI_mean", "NDMI_mean", "NDVI_trend", "NDMI_trend", "TSOIL_mean", "TSOIL_trend", "pob_total", "presion_humana",
    "mes", "estacion", "id_vegetacion", "id_causa",
]


def train_model(features: TableStore, out: TableStore, trees: int = 150, max_depth: int = 12,
                columns: Sequence[str] = MODEL_FEATURES) -> dict[str, DataFrame]:
    """Fit a forest on the risk label of the stored lag features; store scored test rows, report and importances.

    The split is by the key of the fire, so the rows of one fire are on one side. Rows without a label take no part.
    """
    table = FE.model_table(features.read("lag_features"), ["id_clave_inc", *columns, "riesgo"])
    used = [c for c in columns if c in table.columns]
    label = F.array_position(F.array(*[F.lit(t) for t in FE.TERCILES]), F.col("riesgo"))
    rows = checkpoint(table.withColumn("label", (label - 1).cast("double")).where(F.col("label") >= 0))
    train, test = M.hash_split(rows, "id_clave_inc")
    model = M.fit_forest(train, used, "label", trees, max_depth)
    M.save_model(model, used, f"{out.root}/{MODEL}")
    scored = out.replace("model_scores", M.predict(model, test, used))
    report = M.classification_report(scored, "label", "prediction", [float(i) for i in range(len(FE.TERCILES))])
    return {
        "model_scores": scored,
        "model_report": out.replace("model_report", report),
        "model_importances": out.replace("model_importances", M.importances(model, used, train)),
    }


def score_fires(models: TableStore, features: TableStore, out: TableStore) -> DataFrame:
    """Predict the risk of all fires of a feature table with the stored model; fires that lack a feature get NULL."""
    model, used = M.load_model(f"{models.root}/{MODEL}")
    scored = M.predict(model, features.read("lag_features").select("id_clave_inc", *used), used)
    names = F.array(*[F.lit(t) for t in FE.TERCILES])
    risk = F.get(names, F.col("prediction").cast("int")).alias("riesgo_previsto")
    return out.replace("fire_scores", scored.select("id_clave_inc", risk))
