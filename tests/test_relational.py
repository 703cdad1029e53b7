from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from eavcube.operators import aggregate as A
from eavcube.operators import relational as R


def test_parents_and_orphans(spark, rows):
    child = spark.createDataFrame([(1,), (2,), (2,), (9,), (None,)], "k int")
    parent = spark.createDataFrame([(1,), (2,), (2,)], "id int")
    assert rows(R.with_parent(child, parent, "k", "id")) == [(1,), (2,), (2,)]
    assert rows(R.without_parent(child, parent, "k", "id")) == [(9,)]
    assert rows(R.not_in(child, parent.withColumnRenamed("id", "k"), ["k"])) == [(9,), (None,)]


@pytest.mark.parametrize("hot_rows", [1_000_000, 3, None])
def test_update_from_changes_only_matched_rows(spark, rows, hot_rows):
    target = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (3, None)] * 3, "k int, v string")
    source = spark.createDataFrame([(1, None), (3, "z")], "k int, w string")
    got = R.update_from(target, source, ["k"], {"v": F.col("w")}, hot_rows=hot_rows)
    assert rows(got) == sorted([(1, None), (1, None), (2, "c"), (3, "z")] * 3, key=repr)
    only = R.update_from(target, source, ["k"], {"v": F.col("w")}, F.col("v").isNull(), hot_rows)
    assert rows(only) == sorted([(1, "a"), (1, "b"), (2, "c"), (3, "z")] * 3, key=repr)


def test_first_source_wins(spark, rows):
    a = spark.createDataFrame([(1, "a1"), (1, "a0")], "k int, v string")
    b = spark.createDataFrame([(1, "b"), (2, "b")], "k int, v string")
    assert rows(R.insert_if_absent([a, b], ["k"])) == [(1, "a0"), (2, "b")]
    assert rows(R.insert_if_absent([b, a], ["k"])) == [(1, "b"), (2, "b")]


def test_upsert_replaces_whole_keys_and_is_idempotent(spark, rows):
    stored = spark.createDataFrame([(1, "x", 1.0), (1, "x", 2.0), (1, "y", 3.0)], "e int, var string, v double")
    fresh = spark.createDataFrame([(1, "x", 9.0)], "e int, var string, v double")
    once = R.upsert_by_key(stored, fresh, ["e", "var"])
    assert rows(once) == [(1, "x", 9.0), (1, "y", 3.0)]
    assert rows(R.upsert_by_key(once, fresh, ["e", "var"])) == rows(once)


def test_new_rows_treat_null_as_equal(spark, rows):
    stored = spark.createDataFrame([("a", None)], "p string, q string")
    fresh = spark.createDataFrame([("a", None), ("a", "b"), ("a", "b")], "p string, q string")
    assert rows(R.new_rows(fresh, stored)) == [("a", "b")]


def test_surrogate_keys_continue(spark, rows):
    stored = spark.createDataFrame([(7, "x")], "id int, p string")
    fresh = spark.createDataFrame([("c",), ("a",)], "p string")
    assert rows(R.surrogate_keys(fresh, "id", ["p"], stored), "p", "id") == [("a", 8), ("c", 9)]
    assert rows(R.surrogate_keys(fresh, "id", ["p"]), "p", "id") == [("a", 1), ("c", 2)]


def test_conditional_updates_and_deletes_keep_unknown_rows(spark, rows):
    df = spark.createDataFrame([(1, 5.0), (2, None), (3, -1.0)], "k int, v double")
    assert rows(R.delete_where(df, F.col("v") < 0)) == [(1, 5.0), (2, None)]
    assert rows(R.update_where(df, "v", F.col("v") < 0, F.lit(0))) == [(1, 5.0), (2, None), (3, 0.0)]
    assert R.add_column(df, "w", "string").columns == ["k", "v", "w"]
    assert R.add_column(df, "v", "string") is df
    with pytest.raises(ValueError):
        R.append_rows(df, df.drop("v"))


@pytest.mark.parametrize("hot_rows", [1_000_000, 2])
def test_latest_clear_day_in_the_window(spark, rows, hot_rows):
    day = dt.date
    entities = spark.createDataFrame([(1, day(2025, 3, 31)), (2, day(2025, 3, 31))], "e int, start date")
    bands = spark.createDataFrame(
        [
            (1, day(2025, 3, 1), 1.0, 3.0), (1, day(2025, 3, 20), 1.0, 7.0), (1, day(2025, 3, 25), None, 7.0),
            (1, day(2025, 3, 31), 1.0, 9.0), (2, day(2025, 2, 1), 1.0, 3.0),
        ],
        "e int, d date, red double, nir double",
    )
    got = R.latest_clear_indices(entities, bands, "e", "start", "d", {"NDVI": ("nir", "red")}, "NDVI", 30, hot_rows)
    assert rows(got) == [(1, day(2025, 3, 20), "NDVI", 0.75)]


def test_pending_and_request_plan(spark, rows):
    entities = spark.createDataFrame([(1, dt.date(2025, 3, 10)), (2, dt.date(2025, 3, 10))], "e int, start date")
    series = spark.createDataFrame([(1, v) for v in "abc"] + [(2, "a"), (2, "a")], "e int, var string")
    assert rows(R.pending_entities(entities, series, "e", "var", count=3), "e") == [(2,)]
    assert rows(R.pending_entities(entities, series, "e", "var", wanted=["a"]), "e") == []
    plan = R.request_plan(entities, series, "e", "start", "var", R.bundles(["a", "b", "c"], 2), 10)
    assert rows(plan) == [(2, 0, "a,b", "20250301", "20250310"), (2, 1, "c", "20250301", "20250310")]
    placed = entities.withColumn("lat", F.col("e") * 1.5)
    many = R.bundles(["a", *[f"v{i}" for i in range(1500)]], 500)
    plan = R.request_plan(placed, series, "e", "start", "var", many, 10, ["lat"])
    assert rows(plan, "e", "lat", "bundle") == [(e, e * 1.5, b) for e in (1, 2) for b in range(4)]


def test_sample_is_exact_and_repeatable(spark, rows):
    df = spark.range(500)
    first = rows(R.fixed_sample(df, 50, "id"))
    assert len(first) == 50
    assert first == rows(R.fixed_sample(df.repartition(7), 50, "id"))
    assert first != rows(R.fixed_sample(df, 50, "id", seed=1))


def test_lag_pivot_needs_the_base_window(spark, rows):
    data = [(1, "T", 0, 1.0), (1, "T", 2, 3.0), (1, "T", 3, 5.0), (2, "T", 1, 7.0), (3, "T", 0, None)]
    df = spark.createDataFrame(data, "e int, var string, lag int, v double")
    got = A.lag_pivot(df, "e", "var", "v", "lag", ["T", "U"], {"0d": (0, 0), "3d": (1, 3)}, "0d")
    assert got.columns == ["e", "T_0d", "U_0d", "T_3d", "U_3d"]
    assert rows(got) == [(1, 1.0, None, 4.0, None)]


def test_correlation_is_pairwise_and_null_for_constants(spark):
    df = spark.createDataFrame(
        [(1.0, 2.0, 5.0), (2.0, None, 5.0), (3.0, 6.0, 5.0), (4.0, 7.0, 5.0)], "a double, b double, c double"
    )
    got = {(r["var_a"], r["var_b"]): r["r"] for r in A.correlation_matrix(df, tile=1).collect()}
    assert got == {(r["var_a"], r["var_b"]): r["r"] for r in A.correlation_matrix(df, tile=2).collect()}
    assert set(got) == {("a", "b"), ("a", "c"), ("b", "c")}
    assert got[("a", "b")] == pytest.approx(df.toPandas()["a"].corr(df.toPandas()["b"]))
    assert got[("a", "c")] is None
    ranked = A.correlation_with(df, "a").collect()
    assert [r["variable"] for r in ranked] == ["b", "c"]


def test_column_profiles(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, None, "y"), (3, 3.0, None)], "a int, b double, c string")
    got = {r["column"]: (r["nulls"], r["pct_nulls"]) for r in A.null_counts(df).collect()}
    assert got == {"a": (0, 0.0), "b": (2, 66.67), "c": (1, 33.33)}
    assert A.dense_columns(df, 0.6) == ["a", "c"]
    assert A.numeric_columns(df) == ["a", "b"]
