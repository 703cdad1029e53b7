from __future__ import annotations

import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F

from eavcube.operators import cleaning as CL
from eavcube.operators import cube as C
from eavcube.operators import features as FE
from eavcube.operators import ml as M
from eavcube.operators import quality as Q
from eavcube.schemas import Reference


def points(spark):
    rows = [(i, 10.0 * (i % 5) + 0.01 * (i % 7), -10.0 * (i % 5), float(i % 5)) for i in range(200)]
    return spark.createDataFrame(rows + [(999, None, 1.0, 1.0)], "id int, lat double, lon double, index double")


def test_clusters_are_ranked_by_mean_index(spark):
    clustered = M.kmeans_clusters(points(spark), ["lat", "lon"], k=5)
    assert clustered.count() == 200 and clustered.where("cluster is null").count() == 0
    profile = M.cluster_profile(clustered, "index", "lat", "lon").orderBy("mean_index").collect()
    assert sum(r["rows"] for r in profile) == 200
    zones = [r["zone"] for r in profile]
    assert zones == M.ZONES[: len(zones)] and [r["mean_index"] for r in profile] == sorted(r["mean_index"] for r in profile)


def samples(spark, n=1200):
    rows = [(i, float(i % 50), float((i * 7) % 13), 1.0 if i % 50 > 39 else 0.0) for i in range(n)]
    return spark.createDataFrame(rows, "id int, a double, b double, label double")


def test_split_ignores_partitioning(spark):
    train, test = M.hash_split(samples(spark), "id")
    again, _ = M.hash_split(samples(spark).repartition(9), "id")
    assert train.count() + test.count() == 1200 and 0.7 < train.count() / 1200 < 0.9
    assert {r["id"] for r in train.collect()} == {r["id"] for r in again.collect()}


def test_tree_forest_and_importances(spark):
    train, test = M.hash_split(samples(spark), "id")
    tree = M.fit_tree(M.with_class_weights(train, "label"), ["a", "b"], "label", weighted=True)
    report = {r["class"]: r for r in M.classification_report(
        M.predict(tree, test, ["a", "b"]), "label", "prediction", [0.0, 1.0]).collect()}
    assert report["accuracy"]["f1"] > 0.99 and report["1.0"]["recall"] > 0.99
    forest = M.fit_forest(train, ["a", "b"], "label", trees=5, max_depth=4, min_rows=2)
    table = M.importances(forest, ["a", "b"], train)
    assert table.first()["feature"] == "a" and table.agg(F.sum("importance")).first()[0] == pytest.approx(1.0)
    groups = {r["group"]: r["importance"] for r in M.importance_groups(table, {"x": ["a"], "y": ["b", "zz"], "z": []}).collect()}
    assert groups["x"] > groups["y"] and groups["z"] == 0.0


def test_class_weights_are_balanced(spark):
    df = spark.createDataFrame([("x",)] * 6 + [("y",)] * 2, "label string")
    assert {r["label"]: r["weight"] for r in M.class_weights(df, "label").collect()} == {
        "x": pytest.approx(8 / 12), "y": pytest.approx(2.0),
    }


def test_report_without_predictions_of_a_class(spark):
    df = spark.createDataFrame([(0, 0), (1, 0)], "label int, prediction int")
    got = {r["class"]: (r["precision"], r["recall"], r["f1"], r["support"]) for r in M.classification_report(
        df, "label", "prediction", [0, 1]).collect()}
    assert got["1"] == (0.0, 0.0, 0.0, 1) and got["macro avg"][:2] == (0.25, 0.5) and got["accuracy"][0] == 0.5


def test_one_hot_matches_pandas(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, None), (4, "c")], "id int, kind string")
    want = pd.get_dummies(df.toPandas(), columns=["kind"], drop_first=True)
    got = FE.one_hot(df, "kind").orderBy("id").toPandas()
    assert list(got.columns) == list(want.columns) and (got.values == want.values).all()


def test_propagation_age_groups_and_redundancy(spark):
    df = spark.createDataFrame(
        [(1.0, 2.0, 3.0, None), (None, None, None, 10.0)], "NDVI double, NDMI double, NDWI double, TSOIL6 double"
    )
    got = [r["propagation"] for r in FE.propagation_index(df, 10.0).collect()]
    assert got == [pytest.approx(0.4 - 0.6 - 0.6 + 1.0), pytest.approx(1.0)]
    numbers = spark.createDataFrame([(float(i), 2.0 * i, float(i % 3)) for i in range(20)], "a double, b double, c double")
    assert FE.redundant_columns(numbers, ["a", "b", "c"]) == ["b"]
    assert FE.drop_redundant(numbers, ["a", "b", "c"]).columns == ["a", "c"]
    assert FE.columns_like(numbers.withColumn("r_1", F.lit(1)), ["r_"], ["c"]) == ["c", "r_1"]
    assert FE.model_table(numbers, ["a", "missing"], dummies="b").columns == ["a", "b"]


def test_clashing_names_are_renamed(spark):
    base = spark.createDataFrame([(1, 2025)], "k int, anio int")
    extra = spark.createDataFrame([(1, 2020), (1, 2021)], "k int, anio int")
    wide = FE.wide_table(base, [(extra, ["k"])])
    assert wide.columns == ["k", "anio", "anio_1"] and wide.count() == 2


def test_imputation_and_limits(spark, rows):
    df = spark.createDataFrame([(1, 1.0), (2, None), (3, 4.0), (4, 100.0)], "k int, v double")
    assert rows(CL.impute_mean(df, ["v"]))[1] == (2, 35.0)
    assert rows(CL.impute_median(df, ["v"]))[1] == (2, 4.0)
    assert rows(CL.impute_constant(df, ["v"]))[1] == (2, 0.0)
    assert rows(CL.within_limits(df, {"v": (1, 100)}, {"k": (1, 9)})) == [(3, 4.0)]


def test_interpolation_leaves_other_variables_alone(spark):
    data = [("a", 1, d, None if d == 3 else float(d)) for d in range(20)]
    data += [("b", 1, d, None if d % 2 else 1.0) for d in range(20)] + [("c", 1, 0, 5.0)]
    df = spark.createDataFrame(data, "var string, e int, d int, v double")
    got = CL.interpolate_rescuable(df, "var", "e", ["d"], "v")
    assert got.where("var = 'a' and v is null").count() == 0 and got.where("var = 'b' and v is null").count() == 10
    assert got.count() == 41
    assert [r["var"] for r in CL.rescuable_variables(df, "var", "v").collect()] == ["a"]


def test_null_profile_suggests_actions(spark):
    df = spark.createDataFrame([(1, "x", 1.0, dt.date(2025, 1, 1), True)], "id int, t string, v double, d date, f boolean")
    actions = {r["column"]: r["action"] for r in Q.null_profile(df, ["ID"]).collect()}
    assert actions == {"id": Q.PROTECT, "t": Q.LABEL, "v": Q.KEEP_METRIC, "d": Q.KEEP_TEMPORAL, "f": Q.REVIEW}
    assert Q.text_samples(df).columns == ["t"]


def test_reference_audit_counts_rows_and_lists_ids(spark):
    child = spark.createDataFrame([("a",), ("x",), ("x",), ("w",), ("y",), ("z",), (None,)], "k string")
    parent = spark.createDataFrame([("a",)], "k string")
    got = Q.reference_audit({"c": child, "p": parent}, [Reference("c", "k", "p", "k")]).first()
    assert (got["reference"], got["orphans"], got["samples"]) == ("c.k -> p.k", 5, "w:1,x:2,y:1")


@pytest.mark.parametrize("once", [False, True])
def test_population_views_equal_the_row_by_row_join(spark, once):
    fact = spark.createDataFrame([(i, i % 4) for i in range(40)], "fire int, k int")
    places = spark.createDataFrame([(0, "p", "s"), (1, "p", "s"), (2, "q", "s"), (3, "r", "s")], "k int, place string, state string")
    people = spark.createDataFrame([(0, 10), (0, 30), (1, 50), (2, None)], "k int, pop int")
    got = {r["place"]: (r["fires"], r["population"], r["impact"]) for r in C.population_impact(
        fact, places, people, "fire", "k", "pop", 1000.0, once).collect()}
    if once:
        assert got["p"] == (20, 30.0, pytest.approx(20000 / 30))
    else:
        joined = fact.join(places, "k").join(people, "k", "left").groupBy("place").agg(
            F.count("fire").alias("n"), F.avg("pop").alias("p"))
        want = {r["place"]: (r["n"], r["p"]) for r in joined.collect()}
        assert {k: v[:2] for k, v in got.items()} == want
    assert got["r"][1:] == (None, None)


def test_time_dimension_over_a_calendar(spark):
    time = C.time_dimension(C.calendar(spark, "2024-02-27", "2024-03-02"), "date").orderBy("date").collect()
    assert [r["date"].day for r in time] == [27, 28, 29, 1, 2]
    assert (time[-1]["quarter"], time[-1]["month_name"], time[-1]["season"], time[-1]["is_weekend"]) == (
        1, "Marzo", "Primavera", True,
    )


def test_long_value_lists_are_joined(spark, rows):
    df = spark.createDataFrame([(f"v{i % 1500}", i) for i in range(3000)] + [(None, -1)], "var string, i int")
    few = spark.createDataFrame([("v1",), ("v2",)], "var string")
    many = df.where("i < 1200").select("var")
    assert CL.split_by_values(df, "var", few)[0].count() == 4
    for chosen, size in ((few, 4), (many, 2400)):
        hit, rest = CL.split_by_values(df, "var", chosen)
        assert (hit.count(), rest.count()) == (size, 3001 - size) and rest.where("var is null").count() == 1
    labels = df.dropna().withColumnRenamed("var", "label")
    assert M.with_class_weights(labels, "label").select("weight").distinct().collect()[0][0] == 1.0


def test_rows_without_a_feature_have_no_prediction(spark):
    train, test = M.hash_split(samples(spark), "id")
    holes = train.limit(1).withColumn("a", F.lit(None).cast("double")).unionByName(train.limit(1).withColumn("b", F.lit(float("nan"))))
    tree = M.fit_tree(train.unionByName(holes), ["a", "b"], "label")
    scored = M.predict(tree, test.unionByName(holes), ["a", "b"])
    assert scored.columns == [*test.columns, "prediction"] and scored.count() == test.count() + 2
    assert scored.where("prediction is null").count() == 2
