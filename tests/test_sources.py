from __future__ import annotations

import datetime as dt
import json
import os

import pytest

from eavcube.schemas import KEYS, REFERENCES, SCHEMAS
from eavcube.sources import delimited, responses
from eavcube.sources.tables import TableStore, copy_tables
from eavcube.streaming.incremental import SeriesLog, start_ingest


def test_text_file_with_signature_and_padded_headers(spark, tmp_path, rows):
    path = tmp_path / "register.csv"
    path.write_text("﻿Clave , Año \n 15-01 ,2025\n0015,\n", encoding="utf-8")
    df = delimited.read_text_columns(spark, str(path))
    assert df.columns == ["Clave", "Año"]
    assert [f.dataType.simpleString() for f in df.schema.fields] == ["string", "string"]
    assert rows(df)[0] == (" 15-01 ", "2025") or rows(df)[1] == (" 15-01 ", "2025")


def test_delimited_round_trip(spark, tmp_path, rows):
    df = spark.createDataFrame([(1, "México"), (2, None)], "id int, name string")
    delimited.write_delimited(df.coalesce(1), str(tmp_path / "out"), bom=True)
    (part,) = (tmp_path / "out").glob("part-*.csv")
    assert part.read_bytes().startswith(b"\xef\xbb\xbf")
    assert rows(delimited.read_typed(spark, str(tmp_path / "out"), "id int, name string")) == rows(df)
    assert delimited.read_text_columns(spark, str(tmp_path / "out")).columns == ["id", "name"]


def test_descriptor_catalogue(spark, tmp_path):
    path = tmp_path / "parameters.json"
    path.write_text(json.dumps([
        {"id": "T2M", "name": "Temperature", "sources": ["MERRA2", "GEOS"], "range": {"min": "-90"}},
        {"id": "X", "name": "Other", "sources": []},
    ]))
    shaped = responses.shape_descriptors(responses.read_json_list(spark, str(path), responses.DESCRIPTORS))
    got = {r["id"]: (r["nombre"], r["fuente"], r["rango"], r["unidades"]) for r in shaped.collect()}
    assert got == {
        "T2M": ("Temperature", "MERRA2", {"min": "-90"}, "Por definir"), "X": ("Other", "NASA", {}, "Por definir"),
    }
    responses.write_json(shaped, str(tmp_path / "clean"))
    back = spark.read.schema(responses.VERIFIED).json(str(tmp_path / "clean"))
    names = {r["id_variable"]: r["unidad_de_medida"] for r in responses.dictionary_rows(back).collect()}
    assert names == {"T2M": "Por definir", "X": "Por definir"}


def test_series_units_and_matrix_responses(spark, rows):
    series = json.dumps({"properties": {"parameter": {"T2M": {"20250101": 12.5, "bad": 1}, "WS2M": {}}}})
    df = spark.createDataFrame([("f1", series), ("f2", "not json")], "entity string, body string")
    assert rows(responses.parse_series(df, "body", ["entity"])) == [
        ("f1", "T2M", None, 1.0), ("f1", "T2M", dt.date(2025, 1, 1), 12.5),
    ]
    first = json.dumps({"parameters": {"T2M": {"units": "C"}}})
    second = json.dumps({"parameters": {}, "header": {"parameter": {"WS2M": {}}}})
    units = spark.createDataFrame([(first,), (second,)], "body string")
    assert rows(responses.parse_units(units, "body")) == [("T2M", "C"), ("WS2M", "n/a")]
    matrix = json.dumps([["id", "time", "NDVI"], ["p", 1735689600000, 0.5], ["p", 1735776000000, None]])
    empty = json.dumps([["id", "time", "NDVI"]])
    frames = spark.createDataFrame([("f1", matrix), ("f2", empty)], "entity string, body string")
    got = responses.parse_matrix(frames, "body", ["entity"], {"time": "epoch_ms", "NDVI": "double"})
    assert rows(got) == [("f1", dt.date(2025, 1, 1), 0.5), ("f1", dt.date(2025, 1, 2), None)]


def test_store_versions_views_and_second_root(spark, tmp_path, rows):
    store = TableStore(spark, str(tmp_path / "raw"))
    assert set(store.create_all()) == set(SCHEMAS) and store.names() == sorted(SCHEMAS)
    store.append("estado", spark.createDataFrame([("México", 15, "Centro")], "estado string, id_clave_ent long, region string"))
    # A table may be replaced by something computed from itself.
    store.replace("estado", store.read("estado").union(store.read("estado")))
    assert store.read("estado").count() == 2
    with pytest.raises(PermissionError):
        TableStore(spark, str(tmp_path / "raw"), read_only=True).replace("estado", store.read("estado"))
    work = TableStore(spark, str(tmp_path / "work"))
    copy_tables(store, work, ["estado"])
    assert work.register_views("w_") == ["w_estado"]
    assert spark.sql("SELECT count(*) FROM w_estado").first()[0] == 2
    assert work.drop_view("w_estado") and not work.drop_view("w_estado")
    assert rows(work.row_counts()) == [("estado", 2)]
    assert work.describe().where("`column` = 'id_clave_ent'").first()["type"] == "int"
    with pytest.raises(KeyError):
        work.read("missing")


def test_key_registry_is_consistent():
    for name, keys in KEYS.items():
        assert set(keys) <= set(SCHEMAS[name].names)
    for ref in REFERENCES:
        assert ref.column in SCHEMAS[ref.child].names and ref.parent_column in SCHEMAS[ref.parent].names


def test_incremental_ingest_resumes_and_replaces_by_key(spark, tmp_path, rows):
    landing = tmp_path / "landing"
    landing.mkdir()
    log = SeriesLog(spark, str(tmp_path / "log"))

    def land(name, entity, values):
        body = json.dumps({"properties": {"parameter": values}})
        (landing / name).write_text(json.dumps({"entity_id": entity, "body": body}) + "\n")

    def ingest():
        start_ingest(spark, str(landing), log, str(tmp_path / "state")).awaitTermination()

    land("1.json", "f1", {"T2M": {"20250101": 1.0, "20250102": 2.0}, "WS2M": {"20250101": 5.0}})
    ingest()
    assert log.read().count() == 3
    ingest()
    assert log.read().count() == 3
    land("2.json", "f1", {"T2M": {"20250103": 9.0}})
    ingest()
    assert rows(log.read(), "entity_id", "variable", "value") == [("f1", "T2M", 9.0), ("f1", "WS2M", 5.0)]
    # A batch that is written again stays the same.
    log.write_batch(log.read(), 7)
    log.write_batch(spark.read.parquet(f"{log.path}/batch=7"), 8)
    assert log.read().count() == 2


def test_compaction_keeps_the_newest_rows(spark, tmp_path, rows):
    log = SeriesLog(spark, str(tmp_path / "log"))
    kind = "entity_id string, variable string, value double"
    log.write_batch(spark.createDataFrame([("f1", "T2M", 1.0), ("f2", "T2M", 2.0)], kind), 0)
    log.write_batch(spark.createDataFrame([("f1", "T2M", 3.0)], kind), 1)
    small = log.compact_to(str(tmp_path / "small"))
    assert rows(small.read()) == rows(log.read()) == [("f1", "T2M", 3.0), ("f2", "T2M", 2.0)]


def test_partitioned_tables_skip_files_and_keep_types(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    data = [(i, v, "15-01", dt.date(2025, 1, 1), 1.0) for i, v in enumerate(["007", "T2M", "T2M"])]
    store.replace("climatologia", spark.createDataFrame(data, SCHEMAS["climatologia"]), "id_variable")
    back = store.read("climatologia")
    assert sorted(r["id_variable"] for r in back.collect()) == ["007", "T2M", "T2M"]
    plan = back.where("id_variable = 'T2M'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(id_variable" in plan


def test_quoted_fields_keep_quotes_and_line_breaks(spark, tmp_path):
    (tmp_path / "quoted.csv").write_text('a,b\n"x ""y"" z, w",1\n"two\nlines",2\n', encoding="utf-8")
    from eavcube.sources.delimited import read_text_columns

    got = sorted(tuple(r) for r in read_text_columns(spark, str(tmp_path / "quoted.csv")).collect())
    assert got == [("two\nlines", "2"), ('x "y" z, w', "1")]


def test_newest_response_of_a_batch_counts_and_unreadable_ones_are_kept(spark, tmp_path, rows):
    landing = tmp_path / "landing"
    landing.mkdir()
    log = SeriesLog(spark, str(tmp_path / "log"))

    def land(name, when, *bodies):
        lines = [json.dumps({"entity_id": "f1", "body": b if isinstance(b, str) else json.dumps(b)}) for b in bodies]
        (landing / name).write_text("\n".join(lines) + "\n")
        os.utime(landing / name, (when, when))

    def series(value):
        return {"properties": {"parameter": {"T2M": {"20250101": value}}}}

    land("b.json", 1_000_000, series(1.0), "{torn")
    land("a.json", 2_000_000, series(2.0), series(2.0))
    start_ingest(spark, str(landing), log, str(tmp_path / "state")).awaitTermination()
    assert rows(log.read(), "entity_id", "variable", "value") == [("f1", "T2M", 2.0)]
    assert rows(log.read_rejected(), "entity_id", "body") == [("f1", "{torn")]
