"""Keyed writes on stored tables, ingestion with a ledger, numbering, and what their plans read."""

from __future__ import annotations

import datetime as dt
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from eavcube.operators import aggregate as A
from eavcube.operators import features as FE
from eavcube.operators import quantile, window
from eavcube.operators import relational as R
from eavcube.operators.ordered import numbered_by
from eavcube.plans import jobs
from eavcube.plans import wildfire as WF
from eavcube.schemas import SCHEMAS
from eavcube.sources.keyed import KeyedTable
from eavcube.sources.tables import TableStore
from eavcube.streaming.incremental import start_taking


def table(spark, path, rows, schema="id int, name string", keys=("id",), parts=4):
    made = KeyedTable(spark, str(path), list(keys), parts=parts)
    frame = spark.createDataFrame(rows, schema)
    return made.create(frame.schema, frame)


def files_of(df):
    return {f.split("/parts=")[1] for f in df.inputFiles()}


def jobs_of(spark, run):
    group = f"count-{id(run)}"
    spark.sparkContext.setJobGroup(group, "count")
    try:
        run()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_insert_reads_only_touched_parts_and_rewrites_nothing(spark, tmp_path, rows):
    stored = table(spark, tmp_path / "t", [(i, f"n{i}") for i in range(40)], parts=8)
    before = files_of(stored.read())
    incoming = spark.createDataFrame([(3, "late"), (100, "b"), (100, "a"), (None, "x")], "id int, name string")
    touched = stored.touched(incoming)
    assert 0 < len(touched) < 8
    assert {f.split("__part=")[1].split("/")[0] for f in files_of(stored.read_for(incoming))} <= {str(p) for p in touched}
    stored.insert(incoming).insert(incoming)
    assert rows(stored.read().where("id = 3 or id = 100 or id is null")) == rows(
        spark.createDataFrame([(3, "n3"), (100, "a"), (None, "x")], "id int, name string"))
    assert stored.read().count() == 42 and before <= files_of(stored.read())


def test_upsert_rewrites_only_touched_parts(spark, tmp_path, rows):
    stored = table(spark, tmp_path / "t", [(i % 10, f"v{i % 2}", i) for i in range(40)], "e int, v string, x int", ("e", "v"), parts=8)
    stored = KeyedTable(spark, str(tmp_path / "t"), ["e", "v"])
    assert stored.parts == 8
    with pytest.raises(ValueError):
        stored.upsert(stored.read(), ["v"])
    incoming = spark.createDataFrame([(4, "v0", 400), (4, "v0", 401)], "e int, v string, x int")
    untouched = files_of(stored.read([p for p in range(8) if p not in stored.touched(incoming)]))
    stored.upsert(incoming)
    assert untouched <= files_of(stored.read())
    assert rows(stored.read().where("e = 4"), "v", "x") == [("v0", 400), ("v0", 401)]
    gone = stored.expire()
    assert gone and stored.read().count() == 38 and stored.expire() == []


def test_half_a_write_does_not_count(spark, tmp_path):
    stored = table(spark, tmp_path / "t", [(1, "a"), (2, "b")])
    stored.append(spark.createDataFrame([(3, "c")], "id int, name string"))
    last = sorted(p for p in (tmp_path / "t" / "parts=4").iterdir() if p.name.startswith("__write="))[-1]
    (last / "_SUCCESS").rename(last / "_TORN")
    assert stored.read().count() == 2
    stored.append(spark.createDataFrame([(4, "d")], "id int, name string"))
    assert {r.id for r in stored.read().collect()} == {1, 2, 4}


def test_widen_and_compact(spark, tmp_path, rows):
    stored = table(spark, tmp_path / "t", [(1, "a")], parts=1).widen("extra", "double").widen("extra", "double")
    for i in range(2, 6):
        stored.append(spark.createDataFrame([(i, "z", float(i))], "id int, name string, extra double"))
    with pytest.raises(ValueError):
        stored.append(spark.createDataFrame([(9, "z")], "id int, name string"))
    want = rows(stored.read())
    assert want[0] == (1, "a", None) and stored.compact(writes=3) == [0] and rows(stored.read()) == want
    assert len(stored.expire()) == 5 and rows(stored.read()) == want
    assert stored.compact(writes=3) == []


def test_empty_table_and_repeated_creation(spark, tmp_path):
    stored = KeyedTable(spark, str(tmp_path / "t"), ["id"])
    with pytest.raises(KeyError):
        stored.read()
    schema = spark.createDataFrame([], "id int, name string").schema
    stored.create(schema).create(schema)
    assert stored.read().count() == 0 and stored.read().schema == schema
    empty = spark.createDataFrame([], schema)
    assert stored.insert(empty).upsert(empty).append(empty).read().count() == 0


def test_store_turns_a_version_into_parts(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "s"))
    store.replace("estado", spark.createDataFrame([(15, "centro", "México")], SCHEMAS["estado"]))
    store.keyed("estado").insert(spark.createDataFrame([(15, "x", "y"), (9, "x", "z")], SCHEMAS["estado"]))
    assert {tuple(r) for r in store.read("estado").collect()} == {(15, "centro", "México"), (9, "x", "z")}
    with pytest.raises(ValueError):
        store.replace("estado", store.read("estado"))
    assert store.exists("estado") and store.names() == ["estado"]


def test_store_expires_old_versions(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "s"))
    for i in range(3):
        store.replace("estado", spark.createDataFrame([(i, "r", "e")], SCHEMAS["estado"]))
    assert len(store.expire()) == 2 and store.versions("estado") == [3] and store.read("estado").first()[0] == 2


# ---- numbering


def test_numbering_runs_no_job_before_the_action(spark):
    new = spark.createDataFrame([(f"{c}{i:03d}", i) for c in "bza" for i in range(50)] + [(None, 1)], "k string, x int").repartition(6)
    stored = spark.createDataFrame([(7,), (41,)], "id bigint")
    out = []
    assert jobs_of(spark, lambda: out.append(R.surrogate_keys(new, "id", ["k", "x"], stored))) == 0
    got = out[0].orderBy("id").collect()
    assert [r.id for r in got] == list(range(42, 42 + 151))
    assert [r.k for r in got][1:] == sorted(r.k for r in got[1:]) and got[0].k is None
    any_order = numbered_by(new, F.pmod(F.xxhash64("k", "x"), F.lit(16)), ["k", "x"], "n").collect()
    assert sorted(r.n for r in any_order) == list(range(1, 152))
    assert numbered_by(new.limit(0), F.col("x"), ["k"], "n").count() == 0


# ---- ingestion


def body(**series):
    return json.dumps({"properties": {"parameter": series}})


def land(folder, name, *lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps({"entity_id": e, "body": b}) for e, b in lines))


@pytest.fixture
def store(spark, tmp_path):
    made = TableStore(spark, str(tmp_path / "work"))
    for name in SCHEMAS:
        made.create_if_absent(name)
    day = dt.date(2025, 1, 5)
    made.keyed("incendios").append(spark.createDataFrame(
        [("f2", "1", 1, 1, 19.5, -99.0, dt.date(2025, 2, 1), "x", 2025), ("f1", "1", 1, 1, 19.0, -99.5, day, "x", 2025)], SCHEMAS["incendios"]))
    made.keyed("climatologia", ["id_clave_inc"]).append(spark.createDataFrame([(90, "OLD", "f1", day, 7.0)], SCHEMAS["climatologia"]))
    return made


def test_ingest_survives_a_lost_stream_state(spark, tmp_path, store):
    sink = WF.response_sink(store)
    landing = tmp_path / "landing"

    def take(state):
        start_taking(spark, str(landing), sink, str(tmp_path / state), max_files=1).awaitTermination()
        got = store.read("climatologia").collect()
        assert len({r.id_registro for r in got}) == len(got)
        return {(r.id_clave_inc, r.id_variable, str(r.fecha_de_observacion), r.resultado_numerico) for r in got}, got

    old = ("f1", "OLD", "2025-01-05", 7.0)
    land(landing, "a.json", ("f1", body(T2M={"20250101": 1.0, "20250102": 2.0}, RH={"20250101": 50.0})), ("f2", "torn {"), ("f2", body(T2M={"20250101": 9.0})))
    first, got = take("state")
    assert first == {old, ("f1", "T2M", "2025-01-01", 1.0), ("f1", "T2M", "2025-01-02", 2.0), ("f1", "RH", "2025-01-01", 50.0), ("f2", "T2M", "2025-01-01", 9.0)}
    assert {r.id_registro for r in got} == {90, 91, 92, 93, 94}
    # A later response replaces all days of its pairs and leaves other variables alone.
    land(landing, "b.json", ("f1", body(T2M={"20250103": 3.0})))
    second, got = take("state")
    assert second == (first - {("f1", "T2M", "2025-01-01", 1.0), ("f1", "T2M", "2025-01-02", 2.0)}) | {("f1", "T2M", "2025-01-03", 3.0)}
    # The state is lost: all files come again, in batches of other numbers, and change nothing.
    files = files_of(store.read("climatologia"))
    third, again = take("another state")
    assert third == second and {tuple(r) for r in again} == {tuple(r) for r in got} and files_of(store.read("climatologia")) == files
    # A batch whose ledger entry was not written is taken again and gives the same rows.
    ledger = sink.ledger.read()
    assert ledger.count() == 4 and ledger.where("rows = 0").count() == 0 or ledger.where("entity_id = 'f2'").count() == 2
    land(landing, "c.json", ("f2", body(RH={"20250101": 4.0})))
    sink.ledger.append, kept = (lambda lines: (_ for _ in ()).throw(RuntimeError("lost"))), sink.ledger.append
    with pytest.raises(Exception):
        take("state")
    sink.ledger.append = kept
    fourth, _ = take("state")
    assert fourth == second | {("f2", "RH", "2025-01-01", 4.0)}


def test_ingest_of_image_responses(spark, tmp_path, store):
    sink = WF.response_sink(store, "images")
    day = lambda d: int(dt.datetime(2025, 1, d, tzinfo=dt.timezone.utc).timestamp() * 1000)
    rows = [["id", "time", "NDVI", "NDWI", "NDMI"], ["p", day(2), 0.1, 0.2, 0.3], ["p", day(4), None, 0.5, 0.6], ["p", day(3), 0.4, None, 0.7]]
    land(tmp_path / "landing", "a.json", ("f1", json.dumps(rows)), ("f2", json.dumps([rows[0], rows[2]])))
    start_taking(spark, str(tmp_path / "landing"), sink, str(tmp_path / "state")).awaitTermination()
    got = {(r.id_clave_inc, r.id_variable, str(r.fecha_de_observacion), r.resultado_numerico) for r in store.read("climatologia").collect()}
    assert got == {("f1", "OLD", "2025-01-05", 7.0), ("f1", "NDVI", "2025-01-03", 0.4), ("f1", "NDWI", "2025-01-03", None), ("f1", "NDMI", "2025-01-03", 0.7)}


def test_requests_and_ingest_jobs(spark, tmp_path, store):
    names = [f"V{i:02d}" for i in range(16)]
    (tmp_path / "v.json").write_text(json.dumps([{"id": n} for n in names]))
    arguments = lambda job, **kw: jobs.main([job, *[x for k, v in kw.items() for x in (f"--{k}", str(v))]])
    arguments("requests", work=store.root, variables=tmp_path / "v.json", out=tmp_path / "open")
    asked = spark.read.json(str(tmp_path / "open")).collect()
    assert len(asked) == 4 and {(r.id_clave_inc, r.window_start, r.window_end, r.lat) for r in asked} == {
        ("f1", "20241227", "20250105", 19.0), ("f2", "20250123", "20250201", 19.5)}
    ordered = WF.open_requests(store, names).collect()
    assert [(r.id_clave_inc, r.bundle) for r in ordered] == [("f1", 0), ("f1", 1), ("f2", 0), ("f2", 1)]
    land(tmp_path / "landing", "a.json", ("f1", body(**{n: {"20250101": 1.0} for n in names[:15]})))
    arguments("ingest", work=store.root, landing=tmp_path / "landing", state=tmp_path / "state")
    left = [(r.id_clave_inc, r.bundle) for r in WF.open_requests(store, names).collect()]
    assert left == [("f1", 1), ("f2", 0), ("f2", 1)]


# ---- one sort, two reads, one scan


def test_interpolation_sorts_once(spark):
    df = spark.createDataFrame([("a", i, float(i) if i % 3 == 0 else None) for i in range(10)] + [("b", 1, None)], "k string, i int, v double")
    out = window.interpolate_linear(df, ["k"], ["i"], "v")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Sort [") == 1 and plan.count("Exchange") == 1
    assert [r.v for r in out.where("k = 'a'").orderBy("i").collect()] == [float(i) for i in range(10)]
    assert out.where("k = 'b'").first().v is None


@pytest.mark.parametrize("limit", [10, 1_000, 10**9])
def test_bracketed_quantiles_are_exact(spark, limit):
    rng = np.random.default_rng(2)
    values = np.concatenate([rng.normal(size=30_000), np.repeat(0.25, 5_000), rng.exponential(1e6, 5_000), [-np.inf, np.inf]])
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,), (float("nan"),)], "v double").repartition(5)
    probs = [0.0, 0.001, 0.3, 0.5, 0.64, 0.9, 0.9999, 1.0]
    got = quantile.quantile_list(df, "v", probs, limit)
    order = np.sort(values)
    for p, g in zip(probs, got):
        r = (len(order) - 1) * p
        low, high = order[int(np.floor(r))], order[int(np.ceil(r))]
        want = low if low == high else low + (high - low) * (r - np.floor(r))
        assert g == pytest.approx(want, rel=1e-12)


def test_quantiles_read_their_input_twice(spark):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        read.add(1)
        yield from batches

    df = spark.range(0, 50_000, numPartitions=4).select(F.col("id").cast("double").alias("v")).mapInArrow(counted, "v double")
    assert quantile.quantile_list(df, "v", [0.1, 0.5, 0.9]) == pytest.approx([4999.9, 24999.5, 44999.1])
    assert read.value == 2 * 4
    assert quantile.quantile_list(df.limit(0), "v", [0.5]) == [None]
    assert quantile.quantile_list(df.limit(1), "v", [0.0, 0.5, 1.0]) == [0.0, 0.0, 0.0]


def test_wide_correlations_from_one_gram_matrix(spark):
    rng = np.random.default_rng(4)
    k, n = 30, 400
    x = rng.normal(1e6, 1.0, (n, k)) + rng.normal(size=(n, 1))
    x[rng.random((n, k)) < 0.2] = np.nan
    x[:, 3], x[:, 4] = 5.0, np.nan
    df = spark.createDataFrame([tuple(None if v != v else float(v) for v in r) for r in x], ", ".join(f"c{i} double" for i in range(k))).repartition(3)
    got = {(r.var_a, r.var_b): r.r for r in A.correlation_matrix(df).collect()}
    narrow = {(r.var_a, r.var_b): r.r for r in A.correlation_matrix(df, tile=100).collect()}
    assert len(got) == k * (k - 1) // 2 and got.keys() == narrow.keys()
    for pair, r in got.items():
        a, b = (x[:, int(c[1:])] for c in pair)
        both = ~np.isnan(a) & ~np.isnan(b)
        if "c3" in pair or "c4" in pair:
            assert r is None and narrow[pair] is None
        else:
            assert r == pytest.approx(np.corrcoef(a[both], b[both])[0, 1], abs=1e-9) and narrow[pair] == pytest.approx(r, abs=1e-9)


def test_bucketed_copies_join_without_a_shuffle(spark, tmp_path, rows):
    store = TableStore(spark, str(tmp_path / "s"))
    series = spark.createDataFrame([(f"f{i % 7}", v, dt.date(2025, 1, 1 + i % 9), float(i)) for i in range(60) for v in ("A", "B")],
                                   "k string, variable string, day date, value double")
    starts = spark.createDataFrame([(f"f{i}", dt.date(2025, 1, 9)) for i in range(6)], "k string, start date")
    for name, df in (("series", series), ("starts", starts)):
        store.replace_bucketed(name, df.limit(1), "k", 4)
        store.replace_bucketed(name, df, "k", 4)
    stored, begun = store.read_bucketed("series", "k"), store.read_bucketed("starts", "k")
    assert store.read_bucketed("series", "day") is None and store.names() == []
    make = lambda a, b: FE.lag_features(a, b, "k", "start", "day", "variable", "value", ["A", "B"], hot_rows=None)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = make(stored, begun)._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "SortMergeJoin" in plan
        assert rows(make(stored, begun)) == rows(make(series, starts))
        # A session that does not know the files registers them again.
        for table in spark.catalog.listTables():
            if table.name.startswith("bucketed_"):
                spark.sql(f"DROP TABLE {table.name}")
        again = make(store.read_bucketed("series", "k"), store.read_bucketed("starts", "k"))
        assert "Exchange" not in again._jdf.queryExecution().executedPlan().toString() and rows(again) == rows(make(series, starts))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
