"""Small and hot paths must give the same results; `hot_rows` is lowered to reach the hot ones."""

from __future__ import annotations

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from eavcube.operators import skew
from eavcube.operators.ordered import CHUNK, bounded_list, numbered, positioned
from eavcube.operators.quantile import EDGES, quantile_list, quantiles
from eavcube.operators.relational import lookup
from eavcube.operators.skew import hot_keys, skew_join
from eavcube.operators.window import (
    above_quantile, canonical_ids, first_n, interpolate_linear, keep_first, minmax_scale, quantile_labels,
    repeated_rows,
)


@pytest.fixture(autouse=True)
def several_slices(spark):
    """Keep the slices of tiny sorted frames apart, so that values are carried from one to the next."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    yield
    spark.conf.set(name, "true")


def skewed(spark, n=600, seed=3):
    """A third of the rows have the same key; values have gaps."""
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        key = 0 if rnd.random() < 0.34 else (None if rnd.random() < 0.05 else rnd.randrange(1, 40))
        rows.append((i, key, rnd.randrange(50), None if rnd.random() < 0.5 else round(rnd.uniform(-5, 5), 2)))
    return spark.createDataFrame(rows, "id long, key int, day int, value double").repartition(6, "id")


def test_hot_keys_are_found_and_small_frames_are_not_read(spark):
    df = skewed(spark)
    found = hot_keys(df, ["key"], 100)
    assert [r["key"] for r in found.collect()] == [0]
    assert hot_keys(df, ["key"], 10_000) is None


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_skew_join_equals_plain_join(spark, rows, how):
    left = skewed(spark)
    right = spark.createDataFrame([(k, f"n{k}") for k in range(0, 40, 2)] + [(None, "none")], "key int, name string")
    assert hot_keys(left, ["key"], 20) is not None
    assert rows(skew_join(left, right, ["key"], how, 20)) == rows(left.join(right, "key", how))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_skew_join_with_many_copies_of_one_row(spark, rows, how):
    left = spark.createDataFrame([(0,)] * 200 + [(1,)] * 150 + [(k % 7,) for k in range(70)] + [(None,)] * 90, "key int")
    right = spark.createDataFrame([(0, "a"), (0, "b"), (3, "c")], "key int, name string")
    got = skew_join(left, right, ["key"], how, 30)
    assert skew._COPIES in got._jdf.queryExecution().optimizedPlan().toString()
    assert rows(got) == rows(left.join(right, "key", how))


def test_skew_join_spreads_the_hot_key(spark):
    left = skewed(spark)
    right = spark.createDataFrame([(k, k) for k in range(40)], "key int, v int")
    plan = skew_join(left, right, ["key"], "inner", 20)._jdf.queryExecution().optimizedPlan().toString()
    assert skew._SALT in plan


def test_a_catalogue_lookup_spreads_every_key(spark, rows):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        fires = spark.range(4000).select("id", F.when(F.col("id") % 10 > 0, "a").when(F.col("id") % 20 > 0, "b").alias("cause"))
        fires = fires.unionByName(fires.where("id = 1"))
        causes = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id_cause int, cause string")
        found = lookup(fires, causes, ["cause"], spread_by=["id"])
        assert rows(found, "id", "id_cause") == rows(fires.join(causes, "cause"), "id", "id_cause")
        assert found.count() == 3801 and found.columns == ["cause", "id", "id_cause"]
        sizes = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
        assert len(sizes) > 4 and max(sizes) < 0.4 * 3801
        assert rows(lookup(fires, causes, ["cause"], "left", spread_by=["id"])) == rows(fires.join(causes, ["cause"], "left"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_numbering_is_consecutive_over_slices(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v"))
    assert positioned(df, ["v"]).select(CHUNK).distinct().count() > 3
    got = numbered(df, ["v"], "n", 11).collect()
    assert sorted((r["v"], r["n"]) for r in got) == [(i, i + 11) for i in range(1000)]
    assert numbered(df.where("v < 0"), ["v"], "n").count() == 0


def expected_interpolation(pdf):
    pdf = pdf.sort_values(["key", "day", "id"])
    filled = pdf.groupby("key", dropna=False)["value"].transform(
        lambda s: s.interpolate(method="linear", limit_direction="both")
    )
    return {i: None if np.isnan(v) else round(v, 9) for i, v in zip(pdf["id"], filled)}


@pytest.mark.parametrize("hot_rows", [1_000_000, 30, 5])
def test_interpolation_matches_pandas_on_both_paths(spark, hot_rows):
    df = skewed(spark)
    got = interpolate_linear(df, ["key"], ["day", "id"], "value", hot_rows).collect()
    assert len(got) == 600
    want = expected_interpolation(df.toPandas())
    assert {r["id"]: None if r["value"] is None else round(r["value"], 9) for r in got} == want


def test_interpolation_carries_values_over_slices_without_any(spark):
    """One hot group whose middle slices are empty: only the summaries of the outer ones can fill it."""
    data = [(1, i, {2: 10.0, 397: 405.0}.get(i)) for i in range(400)]
    df = spark.createDataFrame(data, "key int, pos int, value double").repartition(5)
    assert positioned(df, ["key", "pos"]).select(CHUNK).distinct().count() > 3
    got = interpolate_linear(df, ["key"], ["pos"], "value", 20).orderBy("pos").collect()
    assert [r["value"] for r in got] == [float(min(max(i, 2), 397) + 8) for i in range(400)]


def test_interpolation_ends_and_empty_groups(spark):
    data = [(1, i, v) for i, v in enumerate([None, 2.0, None, None, 8.0, None])] + [(2, 0, None), (2, 1, None)]
    df = spark.createDataFrame(data, "key int, pos int, value double")
    got = interpolate_linear(df, ["key"], ["pos"], "value").orderBy("key", "pos").collect()
    assert [r["value"] for r in got] == [2.0, 2.0, 4.0, 6.0, 8.0, 8.0, None, None]


def test_interpolation_keeps_known_points_and_never_leaves_the_neighbours(spark):
    df = skewed(spark, seed=9)
    before = {r["id"]: r for r in df.collect()}
    groups = {}
    for r in before.values():
        if r["value"] is not None:
            low, high = groups.get(r["key"], (r["value"], r["value"]))
            groups[r["key"]] = (min(low, r["value"]), max(high, r["value"]))
    for r in interpolate_linear(df, ["key"], ["day", "id"], "value", 30).collect():
        old = before[r["id"]]
        if old["value"] is not None:
            assert r["value"] == old["value"]
        elif r["key"] in groups:
            assert groups[r["key"]][0] - 1e-9 <= r["value"] <= groups[r["key"]][1] + 1e-9
        else:
            assert r["value"] is None


@pytest.mark.parametrize("hot_rows", [1_000_000, 30])
def test_quantiles_match_numpy_on_both_paths(spark, hot_rows):
    df = skewed(spark)
    probs = [0.0, 0.25, 1 / 3, 0.5, 0.9, 1.0]
    known = df.toPandas().dropna(subset=["value"])
    assert quantile_list(df, "value", probs, hot_rows) == pytest.approx(list(np.quantile(known["value"], probs)))
    got = {r["key"]: r[EDGES] for r in quantiles(df, "value", probs, ["key"], hot_rows).collect()}
    for key, group in known.groupby("key", dropna=False):
        name = None if pd.isna(key) else int(key)
        assert got[name] == pytest.approx(list(np.quantile(group["value"], probs)))


def test_quantile_labels_match_pandas(spark):
    df = skewed(spark).where("value is not null")
    want = df.toPandas().sort_values("id")
    want = pd.qcut(want["value"], 3, labels=["bajo", "medio", "alto"]).astype(str).tolist()
    got = quantile_labels(df, "value", ["bajo", "medio", "alto"], "label", hot_rows=30).orderBy("id").collect()
    assert [r["label"] for r in got] == want


def test_repeated_edges_raise_unless_merged(spark):
    df = spark.createDataFrame([(1.0,)] * 8 + [(2.0,), (None,)], "v double")
    with pytest.raises(ValueError, match="not unique"):
        quantile_labels(df, "v", ["a", "b", "c"], "label")
    merged = quantile_labels(df, "v", ["a", "b", "c"], "label", drop_duplicates=True)
    assert {r["label"] for r in merged.collect()} == {"a", None}


def test_keep_first_is_idempotent_and_limits_before_the_shuffle(spark, rows):
    df = skewed(spark)
    once = keep_first(df, ["key"], ["day", "id"])
    assert rows(keep_first(once, ["key"], ["day", "id"])) == rows(once)
    want = df.toPandas().sort_values(["day", "id"]).drop_duplicates("key")["id"]
    assert sorted(r["id"] for r in once.collect()) == sorted(want)
    assert "WindowGroupLimit" in once._jdf.queryExecution().executedPlan().toString()
    assert first_n(df, ["key"], ["id"], 2).groupBy("key").count().agg(F.max("count")).first()[0] == 2


@pytest.mark.parametrize("hot_rows", [1_000_000, 30])
def test_repeated_rows_and_canonical_ids(spark, hot_rows):
    df = skewed(spark).where("key is not null")
    first = df.groupBy("key").agg(F.min("id")).count()
    assert repeated_rows(df, ["key"], "id", hot_rows).count() == df.count() - first
    mapping = canonical_ids(skewed(spark), "id", ["key"], hot_rows).collect()
    want = skewed(spark).toPandas().groupby("key", dropna=False)["id"].transform("min")
    assert sorted(r["good_id"] for r in mapping) == sorted(want)


def test_scaling_and_top_share(spark):
    df = spark.createDataFrame([(float(i),) for i in range(11)], "v double")
    assert [r["s"] for r in minmax_scale(df, "v", "s").orderBy("v").collect()] == [i / 10 for i in range(11)]
    assert sorted(r["v"] for r in above_quantile(df, "v", 0.9).collect()) == [10.0]
    flat = spark.createDataFrame([(1.0,), (1.0,)], "v double")
    assert {r["s"] for r in minmax_scale(flat, "v", "s").collect()} == {None}


def test_bounded_list_refuses_large_columns(spark):
    assert bounded_list(spark.range(5), "id") == [0, 1, 2, 3, 4]
    with pytest.raises(ValueError):
        bounded_list(spark.range(20), "id", 10)


def test_hot_keys_have_no_upper_number(spark):
    df = spark.range(24_000).selectExpr("id % 12000 AS key")
    assert hot_keys(df, ["key"], 2).count() == 12_000


def test_known_values_come_before_unknown_ones(spark, rows):
    df = spark.createDataFrame([(1, None, None), (1, "a", 5), (2, None, 7)], "key int, day string, id int")
    assert rows(keep_first(df, ["key"], ["day", "id"])) == [(1, "a", 5), (2, None, 7)]
