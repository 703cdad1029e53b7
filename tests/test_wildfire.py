"""The whole plan on a small register that holds every defect."""

from __future__ import annotations

import datetime as dt

import pytest

from eavcube.operators import quality as Q
from eavcube.plans import wildfire as WF
from eavcube.schemas import AGE_BANDS, KEYS, REFERENCES, SCHEMAS
from eavcube.sources.tables import TableStore

DAY = dt.date


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    store = TableStore(spark, str(tmp_path_factory.mktemp("raw")))

    def put(name, data):
        store.replace(name, spark.createDataFrame(data, SCHEMAS[name]))

    codes = ["T2M", "WS2M", "QV2M", "ALLSKY_SFC_SW_DWN", "NDVI", "NDMI", "NDWI", "DEAD"] + [f"TSOIL{i}" for i in range(1, 7)]
    put("diccionario", [(f" {c}\t", "NASA", f"Nombre {c}", None) for c in codes])
    put("estado", [(15, "Centro", "México"), (9, "Centro", "Ciudad de México")])
    put("vegetacion", [(1, "Adaptado", "Bosque de Pino"), (2, "Adaptado", "Bosque de Pino"), (3, "Sensible", "Selva")])
    put("causa", [(1, "Fogata", "Paseantes"), (2, "Fogata", "Paseantes"), (3, "Quema", "Pastizal")])
    put("municipios", [
        ("15102", 15, "Tóluca "), ("1215", 15, "Corto"), ("10315", 15, "Invertido"), ("15999", 15, "Sin uso"),
    ])
    put("incendios", [
        ("15-01", "15102", 2, 2, 19.0, -99.5, DAY(2025, 3, 31), "Superficial", 2025),
        ("15-01", "15102", 2, 2, 19.0, -99.5, DAY(2025, 3, 31), "Superficial", 2025),
        ("15-02", "1215", 1, 1, 25.0, -99.5, DAY(2025, 3, 31), "Copa", 2025),
        ("15-03", "10315", 3, 3, 19.5, -99.0, DAY(2025, 3, 31), None, 2025),
        ("15-04", "15777", 3, 3, 0.0, -99.0, DAY(2025, 3, 30), "Mixto", 2025),
        (" 15-05", "15102", 3, 3, 19.2, -99.2, DAY(2025, 3, 31), "Copa", 2025),
    ])
    put("danos", [
        ("15-01", 1.0, -2.0, 3.0, 4.0, 0.0, "0 a 5"), ("15-02", None, 1.0, None, 2.0, 0.0, "Mayor a 100"),
        ("15-\t03", 0.0, 0.0, 7.0, 8.0, 0.0, "06 a 10"), ("15-99", 1.0, 1.0, 1.0, 1.0, 1.0, "0 a 5"),
    ])
    series, number = [], 0
    for fire in ("15-01", "15-02", "15-03", " 15-05", "15-98"):
        for code in codes:
            for back in range(9):
                number += 1
                value = float(back + len(code))
                if code == "DEAD" or (code == "T2M" and fire == "15-01" and back in (2, 8)):
                    value = -999.0
                if code == "WS2M" and back % 2:
                    value = -999.0
                series.append((number, f"{code} ", fire, DAY(2025, 3, 31) - dt.timedelta(days=back), value))
    series.append((number + 1, "T2M", "15-01", DAY(2025, 3, 31), 1000.0))
    put("climatologia", series)
    return store


@pytest.fixture(scope="module")
def migrated(spark, raw, tmp_path_factory):
    header = "CLAVE int, Fecha int, SEXO string, POB_TOTAL int, " + ", ".join(f"{b} int" for b in WF.POPULATION_BANDS)
    bands = list(range(1, 19))
    people = spark.createDataFrame(
        [(15102, 2020, "Mujeres", 1000, *bands), (15102, 2020, "Mujeres", 2000, *bands), (15102, 2020, "Hombres", 900, *bands),
         (15555, 2020, "Hombres", 0, *bands)],
        header,
    )
    operations = spark.createDataFrame(
        [("15-01 ", "02/04/2025", "12:30", "13:05", "36:10:00", "2"), ("15-03", "garbage", "24:10", "", "3 days", "3.7"),
         ("15-77", "01/01/2025", "", "", "", "1")],
        ", ".join(f"`{c}` string" for c in WF.OPERATIONS),
    )
    work = TableStore(spark, str(tmp_path_factory.mktemp("work")))
    report = WF.migrate(WF.MigrationInputs(raw, people, operations), work)
    return work, report


def test_migration_repairs_and_deduplicates(migrated, rows):
    work, report = migrated
    fires = {r["id_clave_inc"]: r for r in work.read("incendios").collect()}
    assert sorted(fires) == ["15-01", "15-02", "15-03", "15-04", "15-05"]
    assert (fires["15-01"]["id_causa"], fires["15-01"]["id_vegetacion"]) == (1, 1)
    assert [fires[k]["id_cvegeo"] for k in ("15-02", "15-03")] == ["15012", "15103"]
    assert fires["15-03"]["tipo_de_incendio"] == "no especificado"
    # Outside the box and zero coordinates are blanked, the fires stay.
    assert [fires[k]["latitud"] for k in ("15-01", "15-02", "15-04")] == [19.0, None, None]
    assert rows(work.read("causa"), "id_causa") == [(1,), (3,)]
    places = {r["id_cvegeo"]: r["nombre_municipio"] for r in work.read("municipios").collect()}
    assert places == {
        "15102": "toluca", "15012": "corto", "15103": "invertido", "15777": "municipio por revisar",
        "15555": "municipio desde csv por revisar",
    }
    counts = {(r["phase"], r["table"]): r["rows"] for r in report.collect()}
    assert sum(r["entities"] for r in work.read("salud_anual").collect()) == 5
    assert counts[("integrity", "municipios")] == 5 and counts[("geography", "incendios")] == 5


def test_migration_cleans_children_and_series(migrated, rows):
    work, _ = migrated
    damage = {r["id_clave_inc"]: r for r in work.read("danos").collect()}
    assert sorted(damage) == ["15-01", "15-02", "15-03"]
    assert (damage["15-01"]["arbustivo"], damage["15-02"]["hojarasca"]) == (0.0, None)
    ops = {r["id_clave_inc"]: r for r in work.read("operaciones").collect()}
    assert ops["15-01"]["fecha_termino"] == DAY(2025, 4, 2) and ops["15-01"]["duracion_s"] == 130200
    assert (ops["15-03"]["fecha_termino"], ops["15-03"]["hora_deteccion_s"], ops["15-03"]["duracion_dias"]) == (None, None, 4)
    people = work.read("demografia")
    assert people.count() == 3 and people.where("sexo = 'mujeres'").first()["pob_total"] == 1000
    series = work.read("climatologia")
    assert series.where("id_variable = 'DEAD' or id_clave_inc in ('15-02', '15-98')").count() == 0
    assert series.where("resultado_numerico <= -999").count() == 0
    t2m = {r[0]: r[1] for r in series.where("id_variable = 'T2M' and id_clave_inc = '15-01'")
           .select("fecha_de_observacion", "resultado_numerico").collect()}
    # Few gaps: filled. Half of WS2M is missing: left alone.
    assert t2m[DAY(2025, 3, 29)] == 5.0 and t2m[DAY(2025, 3, 23)] == 10.0 and t2m[DAY(2025, 3, 31)] == 3.0
    assert series.where("id_variable = 'WS2M' and resultado_numerico is null").count() > 0


def test_no_orphans_or_duplicates_remain(migrated):
    work, _ = migrated
    tables = {n: work.read(n) for n in SCHEMAS}
    audit = Q.reference_audit(tables, REFERENCES).collect()
    assert len(audit) == len(REFERENCES) and sum(r["orphans"] for r in audit) == 0
    for name, keys in KEYS.items():
        assert Q.duplicate_audit(tables[name], keys).count() == 0


def test_cube_and_views(spark, migrated, tmp_path, rows):
    work, _ = migrated
    tables = WF.build_cube(work, TableStore(spark, str(tmp_path)))
    fact = {r["id_clave_inc"]: r for r in tables["fact_incendios"].collect()}
    assert fact["15-01"]["total_area"] == 7.0 and fact["15-01"]["severity"] == pytest.approx(0.6 * 7 + 0.4 * 2)
    assert fact["15-04"]["total_area"] is None and fact["15-04"]["severity"] == 0.0
    assert fact["15-02"]["risk"] is None and fact["15-01"]["risk"] is not None
    place = {r["id_cvegeo"]: (r["state"], r["region"]) for r in tables["dim_ubicacion"].collect()}
    assert place["15102"] == ("mexico", "centro")
    views = WF.cube_views(tables, work.read("demografia"))
    assert len(views) == 9
    annual = views["vw_resumen_anual"].first().asDict()
    assert (annual["anio"], annual["total_incendios"]) == (2025, 5)
    # Each of the two fires in 15102 meets two population rows.
    impact = {r["municipio"]: r for r in views["vw_impacto_poblacion"].collect()}
    assert impact["toluca"]["incendios"] == 4 and impact["toluca"]["poblacion"] == 950.0
    assert views["vw_cubo_tiempo"].columns == [
        "anio", "trimestre", "mes", "nombre_mes", "incendios", "severidad", "superficie",
    ]
    names = WF.register_views(tables, work.read("demografia"))
    assert spark.sql("SELECT sum(incendios) FROM vw_cubo_geografico").first()[0] == 5
    published = spark.sql("""
        SELECT t.anio, t.trimestre, t.nombre_mes, t.estacion, t.es_fin_semana, u.municipio, u.estado, v.riesgo_vegetacion,
            f.num_incendios, f.superficie_total, f.superficie_arbolado, f.superficie_herbacea, f.indice_severidad, f.riesgo,
            f.duracion_dias, c.temperatura_prom, c.viento_prom, c.humedad_prom, c.radiacion_prom
        FROM fact_incendios f LEFT JOIN dim_tiempo t ON f.fecha_inicio = t.fecha LEFT JOIN dim_ubicacion u USING (id_cvegeo)
        LEFT JOIN dim_vegetacion v USING (id_vegetacion) LEFT JOIN fact_clima c USING (id_clave_inc)
        JOIN dim_tipo_incendio k ON f.tipo_de_incendio = k.tipo""")
    assert published.count() == 5
    for name in names:
        spark.catalog.dropTempView(name)


def test_feature_tables(migrated):
    work, _ = migrated
    codes = ["T2M", "NDVI", "NDMI", "NDWI"] + [f"TSOIL{i}" for i in range(1, 7)]
    table = WF.lag_model_table(work, codes)
    row = table.where("id_clave_inc = '15-03'").first()
    assert row["T2M_0d"] == 3.0 and row["T2M_3d"] == 5.0 and row["TSOIL_mean"] == pytest.approx(8.0)
    assert row["NDVI_trend"] == row["NDVI_3d"] - row["NDVI_15d"] and row["estacion"] == 2
    # The fire in a place with two population rows is doubled, as the join says.
    assert table.where("id_clave_inc = '15-01'").count() == 2
    wide = WF.propagation_table(work, codes)
    first = wide.where("id_clave_inc = '15-01'").first()
    assert first["poblacion_total"] == sum(range(1, 19)) and first["pob_joven"] == 6.0
    assert not set(AGE_BANDS) & set(wide.columns)
    assert [c for c in wide.columns if c.startswith("tipo_de_incendio_")] == [
        "tipo_de_incendio_mixto", "tipo_de_incendio_no especificado", "tipo_de_incendio_superficial",
    ]


def test_training_on_stored_features(spark, tmp_path):
    """The label depends on one feature: the forest finds it, and every test row has a score."""
    from eavcube.plans import jobs

    rows = [(f"15-{i:04d}", *[float((i * (j + 3)) % 97) for j in range(len(WF.MODEL_FEATURES))]) for i in range(400)]
    names = ", ".join(f"{c} double" for c in WF.MODEL_FEATURES)
    table = spark.createDataFrame(rows, f"id_clave_inc string, {names}")
    label = "CASE WHEN NDVI_mean < 32 THEN 'bajo' WHEN NDVI_mean < 64 THEN 'medio' WHEN NDVI_mean < 95 THEN 'alto' END"
    TableStore(spark, str(tmp_path / "f")).replace("lag_features", table.selectExpr("*", f"{label} AS riesgo"))
    jobs.main(["train", "--features", str(tmp_path / "f"), "--out", str(tmp_path / "m")])
    model = TableStore(spark, str(tmp_path / "m"))
    report = {r["class"]: r for r in model.read("model_report").collect()}
    assert report["accuracy"]["recall"] > 0.8 and report["accuracy"]["support"] == model.read("model_scores").count()
    best = model.read("model_importances").orderBy("importance", ascending=False).first()
    assert best["feature"] == "NDVI_mean" and model.read("model_scores").where("prediction is null").count() == 0


def register_rows(spark):
    base = {
        "Clave del incendio": "15-01-0001", "Año": "2025", "CVE_ENT": "15", "CVEGEO": "15102", "Región": "Centro",
        "Estado": " México ", "Municipio": "Toluca", "Fecha Inicio": "2025-03-01 00:00:00", "Latitud": "19,35",
        "Longitud": "-99.2", "Causa": "Fogata", "Causa especifica": "Paseantes", "Régimen de fuego": "Adaptado",
        "Tipo Vegetación": "Bosque", "Tipo de incendio": "Copa", "Arbolado Adulto": "1.5", "Renuevo": "x",
        "Arbustivo": "", "Herbáceo": "2", "Hojarasca": "0", "Total hectáreas": "3.5", "Tamaño": "0 a 5",
    }
    changes = [
        {}, {"Clave del incendio": "15-02", "Fecha Inicio": "02/03/2025", "Causa": "Quema"}, {"Estado": "Ciudad de México"},
        {"Clave del incendio": "15-03", "Fecha Inicio": "pronto"}, {"Clave del incendio": "15-04", "Latitud": "nan"}, {},
    ]
    rows = [tuple({**base, **c}.values()) for c in changes]
    return spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in base))


def test_register_is_conformed_and_split(spark, rows):
    raw = register_rows(spark)
    conformed = WF.conform_register(raw)
    assert rows(conformed, "id_clave_inc", "fecha_inicio", "latitud", "renuevo") == [
        ("15-01-0001", DAY(2025, 3, 1), 19.35, 0.0), ("15-01-0001", DAY(2025, 3, 1), 19.35, 0.0),
        ("15-02", DAY(2025, 3, 2), 19.35, 0.0),
    ]
    assert WF.register_quality(raw, "2025").first().asDict() == {
        "rows": 5, "bad_date": 1, "bad_lat": 1, "bad_lon": 0, "kept": 3,
    }
    stored = {n: spark.createDataFrame([], SCHEMAS[n]) for n in ("estado", "municipios", "vegetacion", "incendios", "danos")}
    stored["causa"] = spark.createDataFrame([(7, "Fogata", "Paseantes")], SCHEMAS["causa"])
    out = WF.split_register(conformed, stored)
    assert rows(out["causa"]) == [(7, "Fogata", "Paseantes"), (8, "Quema", "Paseantes")]
    assert rows(out["incendios"], "id_clave_inc", "id_causa", "id_vegetacion") == [("15-01-0001", 7, 1), ("15-02", 8, 1)]
    assert out["danos"].count() == 2 and rows(out["estado"]) == [(15, "Centro", "México")]


def test_jobs_run_from_the_command_line(spark, raw, tmp_path):
    from eavcube.plans import jobs

    people = tmp_path / "people.csv"
    people.write_text("CLAVE,Fecha,SEXO,POB_TOTAL," + ",".join(WF.POPULATION_BANDS) + "\n15102,2020,Mujeres,100," + ",".join("1" * 18))
    operations = tmp_path / "operations.csv"
    operations.write_text(",".join(WF.OPERATIONS) + "\n15-01,02/04/2025,12:30,13:05,36:10:00,2\n")
    folders = {n: str(tmp_path / n) for n in ("work", "cube", "features", "loaded")}
    jobs.main(["migrate", "--raw", raw.root, "--work", folders["work"], "--demography", str(people), "--operations", str(operations)])
    jobs.main(["cube", "--work", folders["work"], "--cube", folders["cube"]])
    jobs.main(["features", "--work", folders["work"], "--out", folders["features"]])
    assert TableStore(spark, folders["cube"]).read("vw_resumen_anual").first()["total_incendios"] == 5
    assert TableStore(spark, folders["features"]).read("propagation").count() == 5
    jobs.main(["audit", "--work", folders["work"], "--out", str(tmp_path / "audit")])
    audits = TableStore(spark, str(tmp_path / "audit"))
    assert audits.read("audit_references").agg({"orphans": "sum"}).first()[0] == 0
    assert audits.read("audit_duplicates").count() == len(KEYS) and audits.read("audit_schema").count() > 30
    assert audits.read("audit_texts").count() > 0 and audits.read("audit_series").count() > 0
    assert {r["check"]: r["failures"] for r in audits.read("audit_consistency").collect()} == {
        "impossible_times": 0, "out_of_range": 0, "negative_damage": 0, "invalid_population": 0}
    assert audits.read("audit_gaps").where("table = 'incendios' and column = 'latitud'").first()["nulls"] > 0
    assert audits.read("audit_variables").count() > 0 and audits.read("audit_impossible").columns[0] == "id_variable"
    for name in ("audit_chronology", "audit_arrivals", "audit_places", "audit_damage"):
        assert audits.read(name).count() == 0
    stored = TableStore(spark, folders["cube"]).read("fact_incendios")
    assert {"indice_severidad", "superficie_total", "num_incendios"} <= set(stored.columns) and "severity" not in stored.columns
    register = tmp_path / "register"
    register_rows(spark).coalesce(1).write.option("header", True).csv(str(register))
    for _ in range(2):
        jobs.main(["load", "--work", folders["loaded"], "--register", str(register)])
    assert TableStore(spark, folders["loaded"]).read("incendios").count() == 2


def test_a_stopped_migration_goes_on_where_it_was(spark, raw, migrated, tmp_path, monkeypatch, rows):
    header = "CLAVE int, Fecha int, SEXO string, POB_TOTAL int, " + ", ".join(f"{b} int" for b in WF.POPULATION_BANDS)
    bands = list(range(1, 19))
    people = spark.createDataFrame([(15102, 2020, "Mujeres", 1000, *bands), (15102, 2020, "Mujeres", 2000, *bands),
                                    (15102, 2020, "Hombres", 900, *bands), (15555, 2020, "Hombres", 0, *bands)], header)
    operations = spark.createDataFrame(
        [("15-01 ", "02/04/2025", "12:30", "13:05", "36:10:00", "2"), ("15-03", "garbage", "24:10", "", "3 days", "3.7"),
         ("15-77", "01/01/2025", "", "", "", "1")], ", ".join(f"`{c}` string" for c in WF.OPERATIONS))
    inputs, work = WF.MigrationInputs(raw, people, operations), TableStore(spark, str(tmp_path / "work"))
    replace, written = TableStore.replace, []

    def torn(self, name, df, partition_by=None):
        """Dies when phase 4 has written two of its four tables."""
        if name != "migracion":
            written.append(name)
        if len(written) == 12:
            raise RuntimeError("lost")
        return replace(self, name, df, partition_by)

    monkeypatch.setattr(TableStore, "replace", torn)
    with pytest.raises(RuntimeError):
        WF.migrate(inputs, work)
    monkeypatch.setattr(TableStore, "replace", replace)
    log = work.read("migracion")
    assert {r.phase for r in log.where("state = 'done'").collect()} == {"catalogues", "geography", "keys and duplicates"}
    assert log.where("state = 'begun' and phase = 'children'").count() > 0
    before = work.versions("causa")
    report = WF.migrate(inputs, work, resume=True, tidy=True)
    assert before[-1] in work.versions("causa") or len(work.versions("causa")) == 1
    whole, first = migrated
    assert rows(report) == rows(first)
    for name in SCHEMAS:
        assert rows(work.read(name)) == rows(whole.read(name)), name
        assert len(work.versions(name)) == 1
    assert rows(WF.migrate(inputs, work, resume=True)) == rows(first)


def test_the_stored_model_scores_new_fires(spark, tmp_path):
    from eavcube.plans import jobs

    rng = [(f"15-{i:04d}", float(i % 40), float(i % 7), ["bajo", "medio", "alto"][min(2, (i % 40) // 14)]) for i in range(600)]
    features = TableStore(spark, str(tmp_path / "features"))
    labels = WF.FE.TERCILES
    rows_ = [(k, a, b, labels[["bajo", "medio", "alto"].index(r)]) for k, a, b, r in rng]
    features.replace("lag_features", spark.createDataFrame(rows_, "id_clave_inc string, NDVI_mean double, mes double, riesgo string"))
    jobs.main(["train", "--features", features.root, "--out", str(tmp_path / "model")])
    fresh = TableStore(spark, str(tmp_path / "new"))
    fresh.replace("lag_features", spark.createDataFrame([("n1", 3.0, 1.0), ("n2", 35.0, 2.0), ("n3", None, 1.0)],
                                                        "id_clave_inc string, NDVI_mean double, mes double"))
    jobs.main(["score", "--model", str(tmp_path / "model"), "--features", fresh.root, "--out", str(tmp_path / "scores")])
    got = {r.id_clave_inc: r.riesgo_previsto for r in TableStore(spark, str(tmp_path / "scores")).read("fire_scores").collect()}
    assert got == {"n1": labels[0], "n2": labels[2], "n3": None}


def test_many_levels_make_a_sparse_vector(spark):
    from pyspark.ml.functions import vector_to_array

    df = spark.createDataFrame([(i, None if i == 0 else f"level {i % 5000:04d}") for i in range(10_000)], "id int, c string")
    got = WF.FE.one_hot_vector(df, "c", "v").select("id", "c", vector_to_array("v").alias("v")).where("id in (0, 1, 2, 4999, 5002, 5000)").collect()
    places = {r.id: (len(r.v), [i for i, x in enumerate(r.v) if x]) for r in got}
    assert places == {0: (4999, []), 1: (4999, [0]), 2: (4999, [1]), 4999: (4999, [4998]), 5002: (4999, [1]), 5000: (4999, [])}
    assert WF.FE.one_hot_vector(df.limit(0), "c", "v").count() == 0
