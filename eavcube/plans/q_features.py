"""Pivots, statistics, features and models."""

from __future__ import annotations

import uuid

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eavcube.functions import dates as D
from eavcube.functions import numbers as N
from eavcube.functions import text as X
from eavcube.operators import aggregate as A
from eavcube.operators import cleaning as CL
from eavcube.operators import features as FE
from eavcube.operators import ml as M
from eavcube.operators import window as W
from eavcube.operators.ordered import checkpoint
from eavcube.operators.quantile import quantile_list
from eavcube.plans.registry import Tables, query
from eavcube.session import shared_folder
from eavcube.sources.tables import TableStore

VARIABLES = ["click", "error", "purchase", "view"]
LINE_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def known(t: Tables) -> DataFrame:
    return CL.neutralise_sentinel(t.obs, "value")


_KNOWN = "\n, k AS (SELECT obs_id, variable, entity_id, obs_date, nullif(value, -999) AS value FROM obs)"


def _mean(variable: str, cond: str = "true", name: str | None = None) -> str:
    return f"round(avg(CASE WHEN variable = '{variable}' AND {cond} THEN value END), 6) AS {name or variable}"


# Pivots ----------------------------------------------------------------------------------------


@query(_KNOWN + f"""
SELECT entity_id, {', '.join(_mean(v) for v in VARIABLES)} FROM k
WHERE variable IN ('click', 'error', 'purchase', 'view') GROUP BY entity_id""", "obs")
def pivot_mean(t: Tables) -> DataFrame:
    return A.pivot_mean(known(t), "entity_id", "variable", "value", [*VARIABLES, "never seen"], drop_empty=True)


@query(_KNOWN + """
SELECT entity_id, variable, round(avg(value), 6) AS mean FROM k GROUP BY 1, 2""", "obs")
def mean_per_variable(t: Tables) -> DataFrame:
    return A.mean_per_variable(known(t), "entity_id", "variable", "value", "mean")


_LAGS = _KNOWN + """
, lagged AS (SELECT k.*, date_diff('day', k.obs_date, e.start_date) AS lag FROM k JOIN entity e
    ON k.entity_id = e.entity_id WHERE date_diff('day', k.obs_date, e.start_date) >= 0)"""
_WINDOWS = {"0d": "lag = 0", "3d": "lag BETWEEN 1 AND 3", "7d": "lag BETWEEN 1 AND 7", "15d": "lag BETWEEN 1 AND 15"}
_LAG_COLUMNS = ", ".join(_mean(v, cond, f"{v}_{w}") for w, cond in _WINDOWS.items() for v in VARIABLES)
_LAG_TABLE = _LAGS + f"""
, lags AS (SELECT entity_id, {_LAG_COLUMNS} FROM lagged GROUP BY entity_id
    HAVING count(CASE WHEN lag = 0 AND variable IN ('click', 'error', 'purchase', 'view') THEN value END) > 0)"""


def lags(t: Tables) -> DataFrame:
    return FE.lag_features(known(t), t.entity, "entity_id", "start_date", "obs_date", "variable", "value", VARIABLES)


@query(_LAG_TABLE + "\nSELECT * FROM lags", "obs entity")
def lag_pivot(t: Tables) -> DataFrame:
    return lags(t)


@query(_LAG_TABLE + "\nSELECT * FROM lags", "obs entity")
def lag_pivot_bucketed(t: Tables) -> DataFrame:
    """The same over tables stored in buckets of the key, without a shuffle of the series."""
    store = TableStore(t.spark, f"{shared_folder(t.spark)}/buckets-{uuid.uuid4()}")
    store.replace_bucketed("series", known(t), "entity_id", 8)
    store.replace_bucketed("starts", t.entity, "entity_id", 8)
    series, starts = (store.read_bucketed(name, "entity_id") for name in ("series", "starts"))
    return FE.lag_features(series, starts, "entity_id", "start_date", "obs_date", "variable", "value", VARIABLES, hot_rows=None)


@query(_LAG_TABLE + """
SELECT f.fire_id, f.place_id, l.view_0d, l.error_7d, c.kind, d.segment, d.pop_total, m.tree, m.fire_id IS NOT NULL AS hit
FROM fire f LEFT JOIN lags l ON f.entity_id = l.entity_id LEFT JOIN cat c ON f.cat_id = c.id
    LEFT JOIN demo d ON f.place_id = d.place_id LEFT JOIN damage m ON f.fire_id = m.fire_id""",
       "obs entity fire cat demo damage")
def wide_features(t: Tables) -> DataFrame:
    wide = FE.wide_table(t.fire, [
        (t.damage.withColumn("hit", F.lit(True)), ["fire_id"]), (lags(t), ["entity_id"]),
        (t.cat.withColumnRenamed("id", "cat_id"), ["cat_id"]), (t.demo, ["place_id"]),
    ])
    return wide.select(
        "fire_id", "place_id", "view_0d", "error_7d", "kind", "segment", "pop_total", "tree",
        F.coalesce("hit", F.lit(False)).alias("hit"),
    )


@query("""
, wide AS (SELECT l_orderkey AS id, l_quantity AS dense,
    CASE WHEN l_linenumber = 1 THEN l_tax END AS sparse, CASE WHEN l_linenumber < 7 THEN l_discount END AS filled FROM lineitem)
SELECT id, dense, filled FROM wide""")
def sparse_columns(t: Tables) -> DataFrame:
    line = F.col("l_linenumber")
    wide = t.raw("lineitem").select(
        F.col("l_orderkey").alias("id"), F.col("l_quantity").alias("dense"),
        F.when(line == 1, F.col("l_tax")).alias("sparse"), F.when(line < 7, F.col("l_discount")).alias("filled"),
    )
    return A.drop_sparse(wide)


@query("""
SELECT e.entity_id, e.start_date, o.view FROM entity e JOIN (
    SELECT entity_id, round(avg(CASE WHEN variable = 'view' THEN value END), 6) AS view FROM obs
    WHERE variable = 'view' GROUP BY entity_id) o ON e.entity_id = o.entity_id""", "entity obs")
def entities_with_series(t: Tables) -> DataFrame:
    return t.entity.join(A.pivot_mean(t.obs, "entity_id", "variable", "value", ["view"]), "entity_id")


# Statistics ------------------------------------------------------------------------------------

_PAIRS = [(a, b) for i, a in enumerate(LINE_NUMBERS) for b in LINE_NUMBERS[i + 1:]]
_HOLES = """
, holes AS (SELECT l_quantity, CASE WHEN l_linenumber > 1 THEN l_extendedprice END AS l_extendedprice,
    CASE WHEN l_partkey % 3 > 0 THEN l_discount END AS l_discount, l_tax FROM lineitem)"""


def holes(t: Tables) -> DataFrame:
    return t.raw("lineitem").select(
        "l_quantity", F.when(F.col("l_linenumber") > 1, F.col("l_extendedprice")).alias("l_extendedprice"),
        F.when(F.col("l_partkey") % 3 > 0, F.col("l_discount")).alias("l_discount"), "l_tax",
    )


@query(_HOLES + "\n" + " UNION ALL ".join(
    f"SELECT '{a}' AS var_a, '{b}' AS var_b, round(corr({a}, {b}), 6) AS r FROM holes" for a, b in _PAIRS))
def corr_matrix(t: Tables) -> DataFrame:
    return A.correlation_matrix(holes(t), LINE_NUMBERS)


@query(_HOLES + "\n" + " UNION ALL ".join(
    f"SELECT '{a}' AS variable, round(corr({a}, l_extendedprice), 6) AS r FROM holes"
    for a in LINE_NUMBERS if a != "l_extendedprice"))
def corr_target(t: Tables) -> DataFrame:
    return A.correlation_with(holes(t), "l_extendedprice")


@query(_HOLES + """
, filled AS (SELECT l_quantity, coalesce(l_extendedprice, (SELECT avg(l_extendedprice) FROM holes)) AS l_extendedprice,
    coalesce(l_discount, (SELECT avg(l_discount) FROM holes)) AS l_discount FROM holes)
, complete AS (SELECT * FROM holes WHERE l_extendedprice IS NOT NULL AND l_discount IS NOT NULL)
SELECT 'complete' AS strategy, round(corr(l_extendedprice, l_discount), 6) AS r FROM complete
UNION ALL SELECT 'imputed', round(corr(l_extendedprice, l_discount), 6) FROM filled""")
def corr_strategies(t: Tables) -> DataFrame:
    columns = ["l_extendedprice", "l_discount"]
    rows = holes(t)
    complete = A.correlation_matrix(rows.dropna(), columns).select(F.lit("complete").alias("strategy"), "r")
    imputed = A.correlation_matrix(CL.impute_mean(rows, columns), columns)
    return complete.unionByName(imputed.select(F.lit("imputed").alias("strategy"), "r"))


@query("""
SELECT variable, min(value) AS minimum, round(quantile_cont(value, 0.25), 6) AS q1,
    round(quantile_cont(value, 0.5), 6) AS median, round(quantile_cont(value, 0.75), 6) AS q3, max(value) AS maximum
FROM obs GROUP BY variable""", "obs")
def five_number(t: Tables) -> DataFrame:
    return A.five_numbers(t.obs, "variable", "value")


@query("SELECT fire_type, count(*) AS n FROM fire WHERE fire_type IS NOT NULL GROUP BY fire_type", "fire")
def freq_table(t: Tables) -> DataFrame:
    return A.frequency(t.fire, "fire_type")


@query("""
SELECT l_returnflag, round(avg(l_quantity), 6) AS l_quantity, round(avg(l_tax), 6) AS l_tax FROM lineitem
WHERE l_returnflag IS NOT NULL GROUP BY 1""")
def group_means(t: Tables) -> DataFrame:
    return A.group_means(t.raw("lineitem"), "l_returnflag", ["l_quantity", "l_tax"], "l_quantity")


# Features --------------------------------------------------------------------------------------


@query("""
SELECT fire_id, coalesce(shrub, 0) + coalesce(herb, 0) + coalesce(tree, 0) AS total,
    round(list_avg([v for v in [shrub, herb, tree] if v IS NOT NULL]), 6) AS mean, shrub - tree AS trend FROM damage
""", "damage")
def row_sum_mean(t: Tables) -> DataFrame:
    parts = ["shrub", "herb", "tree"]
    rows = FE.with_means_and_trends(t.damage, {"mean": parts}, {"trend": ("shrub", "tree")})
    return rows.select("fire_id", N.row_sum(parts).alias("total"), "mean", "trend")


_AGES = """
, bands AS (SELECT c_nationkey AS place_id, CAST(sum(c_custkey % 5) AS BIGINT) AS r_00_04, CAST(sum(c_custkey % 7) AS BIGINT) AS r_05_09,
    CAST(sum(c_custkey % 11) AS BIGINT) AS r_60_64, nullif(CAST(max(c_custkey % 13) AS BIGINT), 12) AS r_65_69
    FROM customer GROUP BY c_nationkey)"""


@query(_AGES + """
SELECT place_id, CAST(r_00_04 + r_05_09 AS DOUBLE) AS young, CAST(r_60_64 + coalesce(r_65_69, 0) AS DOUBLE) AS senior,
    CAST(r_00_04 + r_05_09 + r_60_64 + coalesce(r_65_69, 0) AS DOUBLE) AS population_total FROM bands""")
def age_groups(t: Tables) -> DataFrame:
    n = F.col("c_custkey")
    bands = t.raw("customer").groupBy(F.col("c_nationkey").alias("place_id")).agg(
        F.sum(n % 5).alias("r_00_04"), F.sum(n % 7).alias("r_05_09"), F.sum(n % 11).alias("r_60_64"),
        F.nullif(F.max(n % 13), F.lit(12)).alias("r_65_69"),
    )
    return FE.age_groups(bands, {"young": ["r_00_04", "r_05_09"], "senior": ["r_60_64", "r_65_69"]})


@query("""
SELECT f.fire_id, round(d.tree + d.herb, 6) AS fuel_sum, round(d.tree * d.herb, 6) AS fuel_product,
    round(d.herb - d.shrub, 6) AS stress, round(f.entity_id / (abs(f.lat) + abs(f.lon) + 1), 6) AS pressure_location,
    round(d.tree / nullif(d.herb, 0), 6) AS pressure_age
FROM fire f JOIN damage d ON f.fire_id = d.fire_id""", "fire damage")
def ratios(t: Tables) -> DataFrame:
    rows = t.fire.join(t.damage, "fire_id")
    tree, herb, shrub = F.col("tree"), F.col("herb"), F.col("shrub")
    return rows.select(
        "fire_id", FE.fuel_temperature_sum(tree, herb).alias("fuel_sum"),
        FE.fuel_temperature_product(tree, herb).alias("fuel_product"), FE.water_stress(herb, shrub).alias("stress"),
        FE.human_pressure_by_location(F.col("entity_id"), F.col("lat"), F.col("lon")).alias("pressure_location"),
        FE.human_pressure_by_age(tree, herb).alias("pressure_age"),
    )


_WIDE = _KNOWN + f"""
, wide AS (SELECT entity_id, {', '.join(_mean(v).replace('round(', '(').replace(', 6)', ')') for v in VARIABLES)} FROM k
    WHERE variable IN ('click', 'error', 'purchase', 'view') GROUP BY entity_id)
, indexed AS (SELECT entity_id, coalesce(view, 0) * CAST(0.4 AS DOUBLE) - coalesce(click, 0) * CAST(0.3 AS DOUBLE)
    - coalesce(error, 0) * CAST(0.2 AS DOUBLE)
    + coalesce(purchase, (SELECT median(purchase) FROM wide)) * CAST(0.1 AS DOUBLE) AS propagation FROM wide)"""
_NAMES = {"view": "NDVI", "click": "NDMI", "error": "NDWI", "purchase": "TSOIL6"}


def indexed(t: Tables) -> DataFrame:
    # Stored, as the median, the index and the quantile of the index all read it.
    wide = checkpoint(A.pivot_mean(known(t), "entity_id", "variable", "value", VARIABLES).withColumnsRenamed(_NAMES))
    (median,) = quantile_list(wide, "TSOIL6", [0.5])
    return FE.propagation_index(wide, median).select("entity_id", "propagation")


@query(_WIDE + "\nSELECT entity_id, round(propagation, 6) AS propagation FROM indexed", "obs")
def propagation_index(t: Tables) -> DataFrame:
    return indexed(t)


@query("""
, edges AS (SELECT quantile_cont(value, CAST(1 AS DOUBLE) / 3) AS a, quantile_cont(value, CAST(2 AS DOUBLE) / 3) AS b FROM events)
SELECT event_id, CASE WHEN value <= a THEN 'bajo' WHEN value <= b THEN 'medio' ELSE 'alto' END AS risk FROM events, edges
""")
def terciles(t: Tables) -> DataFrame:
    return FE.risk_terciles(t.raw("events").select("event_id", "value"), "value").drop("value")


@query(_WIDE + """
SELECT entity_id, round(propagation, 6) AS propagation FROM indexed
WHERE propagation > (SELECT quantile_cont(propagation, 0.9) FROM indexed)""", "obs")
def hot_quantile(t: Tables) -> DataFrame:
    return W.above_quantile(indexed(t), "propagation", 0.9)


@query("""
, spot AS (SELECT obs_id, value FROM obs WHERE value IS NOT NULL),
span AS (SELECT min(value) AS lo, max(value) AS hi FROM spot)
SELECT obs_id, round((value - lo) / (hi - lo), 6) AS weight FROM spot, span""", "obs")
def minmax_weight(t: Tables) -> DataFrame:
    spots = FE.heat_rows(t.obs, "obs_id", "entity_id", "value")
    return W.minmax_scale(spots, "value", "weight").select("obs_id", "weight")


@query("""
, sizes AS (SELECT c_custkey AS id, CASE c_custkey % 8 WHEN 0 THEN '0 a 5 Hectáreas' WHEN 1 THEN '06 a 10' WHEN 2 THEN '11 a 20'
    WHEN 3 THEN '21 a 50' WHEN 4 THEN '51 a 100' WHEN 5 THEN 'MAYOR A 100' WHEN 6 THEN 'otra' END AS size FROM customer)
SELECT id, CASE WHEN size LIKE '0 a 5%' THEN 2.5::DOUBLE WHEN size = '06 a 10' THEN 8 WHEN size = '11 a 20' THEN 15
    WHEN size = '21 a 50' THEN 35 WHEN size = '51 a 100' THEN 75 WHEN size = 'MAYOR A 100' THEN 150 END AS midpoint,
    replace(size, '06 a 10', '6 a 10') AS label FROM sizes""")
def size_midpoint(t: Tables) -> DataFrame:
    n = F.col("c_custkey")
    names = ["0 a 5 Hectáreas", "06 a 10", "11 a 20", "21 a 50", "51 a 100", "MAYOR A 100", "otra"]
    size = X.map_labels((n % 8).cast("int"), dict(enumerate(names)))
    sized = t.raw("customer").select(n.alias("id"), size.alias("size"))
    return sized.select("id", X.size_midpoint(F.col("size")).alias("midpoint"), X.repair_size_label(F.col("size")).alias("label"))


@query("""
SELECT fire_id, fire_type = '2-HIGH' AS "fire_type_2-HIGH", fire_type = '3-MEDIUM' AS "fire_type_3-MEDIUM",
    fire_type = '4-NOT SPECIFIED' AS "fire_type_4-NOT SPECIFIED", fire_type = '5-LOW' AS "fire_type_5-LOW"
FROM fire""", "fire")
def one_hot(t: Tables) -> DataFrame:
    return FE.one_hot(t.fire.select("fire_id", "fire_type"), "fire_type")


@query("""
SELECT fire_id, CAST(month(start_date) % 12 // 3 + 1 AS BIGINT) AS season,
    CASE WHEN month(start_date) IN (12, 1, 2) THEN 'Invierno' WHEN month(start_date) IN (3, 4, 5) THEN 'Primavera'
        WHEN month(start_date) IN (6, 7, 8) THEN 'Verano' ELSE 'Otoño' END AS name FROM fire""", "fire")
def season(t: Tables) -> DataFrame:
    d = F.col("start_date")
    return t.fire.select("fire_id", D.season_number(d).alias("season"), D.season_name(d).alias("name"))


@query("""
SELECT l_orderkey AS id, l_quantity, l_discount FROM lineitem WHERE l_quantity IS NOT NULL AND l_discount > 0""")
def model_table(t: Tables) -> DataFrame:
    rows = t.raw("lineitem").select(
        F.col("l_orderkey").alias("id"), "l_quantity", "l_returnflag",
        F.nullif(F.col("l_discount"), F.lit(0.0)).alias("l_discount"),
    )
    return FE.model_table(rows, ["id", "l_quantity", "l_discount", "missing_column"])


@query("SELECT l_orderkey, l_quantity, l_tax FROM lineitem")
def drop_redundant(t: Tables) -> DataFrame:
    rows = t.raw("lineitem").select(
        "l_orderkey", "l_quantity", (F.col("l_quantity") * 2 + F.col("l_tax")).alias("twice"), "l_tax"
    )
    return FE.drop_redundant(rows, ["l_quantity", "twice", "l_tax"])


@query("""
SELECT l_orderkey, l_partkey, l_suppkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_quantity, l_extendedprice,
    l_discount, l_tax FROM lineitem""")
def numeric_only(t: Tables) -> DataFrame:
    return FE.numeric_only(t.raw("lineitem"))


@query("SELECT o_orderkey, o_orderdate, o_totalprice FROM orders")
def columns_by_name(t: Tables) -> DataFrame:
    orders = t.raw("orders").drop("o_orderpriority", "o_orderstatus", "o_custkey")
    return orders.select(*FE.columns_like(orders, ["o_order"], ["price"]))


# Models ----------------------------------------------------------------------------------------


def spots(t: Tables) -> DataFrame:
    return t.fire.join(t.damage, "fire_id").select(
        "fire_id", "lat", "lon", N.row_sum(["shrub", "herb", "tree"]).alias("index")
    )


@query()
def kmeans_places(t: Tables) -> DataFrame:
    return M.kmeans_clusters(spots(t), ["lat", "lon"]).select("fire_id", "cluster")


@query()
def cluster_profile(t: Tables) -> DataFrame:
    return M.cluster_profile(M.kmeans_clusters(spots(t), ["lat", "lon"]), "index", "lat", "lon")


TREE_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def labelled(t: Tables) -> DataFrame:
    """Line items with a class that depends on two of the features."""
    risky = (F.col("l_quantity") > 30) & (F.col("l_discount") > 0.04)
    return t.raw("lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("key"), *TREE_FEATURES, risky.cast("double").alias("label")
    )


_TEST = """
, test AS (SELECT CASE WHEN l_quantity > 30 AND l_discount > 0.04 THEN 1 ELSE 0 END AS label FROM lineitem
    WHERE CAST('0x' || substr(md5(CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || ':42'), 1, 8) AS BIGINT) % 10000 >= 8000)"""


@query(_TEST + """
SELECT CAST(CAST(label AS DOUBLE) AS VARCHAR) AS class, CAST(1 AS DOUBLE) AS precision, CAST(1 AS DOUBLE) AS recall,
    CAST(1 AS DOUBLE) AS f1, count(*) AS support FROM test GROUP BY label
UNION ALL SELECT name, 1, 1, 1, (SELECT count(*) FROM test) FROM (VALUES ('accuracy'), ('macro avg'), ('weighted avg')) AS n(name)""")
def tree_report(t: Tables) -> DataFrame:
    """The classes follow a rule that a tree of this depth must learn exactly, so every held-out row is right."""
    train, test = M.hash_split(labelled(t), "key")
    model = M.fit_tree(M.with_class_weights(train, "label"), TREE_FEATURES, "label", 5, weighted=True, max_bins=64)
    return M.classification_report(M.predict(model, test, TREE_FEATURES), "label", "prediction", [0.0, 1.0])


@query(_TEST + """
SELECT CAST(label AS DOUBLE) AS prediction, count(*) AS rows FROM test GROUP BY label""")
def stored_model_scores(t: Tables) -> DataFrame:
    """A tree that is stored, read back and applied to the held-out rows."""
    train, test = M.hash_split(labelled(t), "key")
    path = f"{shared_folder(t.spark)}/model-{uuid.uuid4()}"
    M.save_model(M.fit_tree(train, TREE_FEATURES, "label", 5, max_bins=64), TREE_FEATURES, path)
    model, features = M.load_model(path)
    return M.predict(model, test, features).groupBy("prediction").agg(F.count(F.lit(1)).alias("rows"))


@query("""
, spot AS (SELECT c_custkey AS id, c_custkey % 5 AS g, CAST(10 * (c_custkey % 5) AS DOUBLE) + CAST(c_nationkey AS DOUBLE) / 100 AS lat,
    CAST(-20 * (c_custkey % 5) AS DOUBLE) + CAST(c_nationkey AS DOUBLE) / 50 AS lon, CAST(c_custkey % 5 AS DOUBLE) + 1 AS size FROM customer),
per AS (SELECT g, avg(size) AS mean_index, count(*) AS rows, avg(lat) AS lat, avg(lon) AS lon FROM spot GROUP BY g)
SELECT round(mean_index, 6) AS mean_index, rows, round(lat, 6) AS lat, round(lon, 6) AS lon, ['Bajo', 'Medio-Bajo', 'Medio', 'Alto', 'Crítico'][1 + g] AS zone FROM per""")
def separated_clusters(t: Tables) -> DataFrame:
    """Five groups of places that lie far apart, so that the clusters must be these groups."""
    g, nation = F.col("c_custkey") % 5, F.col("c_nationkey").cast("double")
    points = t.raw("customer").select(
        F.col("c_custkey").alias("id"), ((g * 10).cast("double") + nation / 100).alias("lat"), ((g * -20).cast("double") + nation / 50).alias("lon"),
        (g.cast("double") + 1).alias("size"))
    return M.cluster_profile(M.kmeans_clusters(points, ["lat", "lon"]), "size", "lat", "lon").drop("cluster")


@query("""
, levels AS (SELECT p_name, row_number() OVER (ORDER BY p_name) - 1 AS place, count(*) OVER () - 1 AS size FROM (SELECT DISTINCT p_name FROM part))
SELECT p_partkey, levels.place, levels.size FROM part JOIN levels USING (p_name)""")
def one_hot_many_levels(t: Tables) -> DataFrame:
    """A column of very many levels as one sparse vector: the place of its 1 (0 for the first level, which has none)."""
    encoded = FE.one_hot_vector(t.raw("part").select("p_partkey", "p_name"), "p_name", "v")
    dense = vector_to_array("v")
    return encoded.select("p_partkey", F.coalesce(F.nullif(F.array_position(dense, 1.0), F.lit(0)), F.lit(0)).alias("place"), F.size(dense).alias("size"))


def importance_table(t: Tables) -> DataFrame:
    train, _ = M.hash_split(labelled(t), "key")
    model = M.fit_forest(train, TREE_FEATURES, "label", trees=20, max_depth=6, min_rows=5)
    return M.importances(model, TREE_FEATURES, train)


@query()
def forest_importance(t: Tables) -> DataFrame:
    return importance_table(t).limit(20)


@query()
def importance_groups(t: Tables) -> DataFrame:
    groups = {"amount": ["l_quantity", "l_extendedprice"], "rate": ["l_discount", "l_tax", "not a feature"]}
    return M.importance_groups(importance_table(t), groups)


_PREDICTED = """
, predicted AS (SELECT CASE WHEN l_quantity > 25 THEN 1 ELSE 0 END AS label,
    CASE WHEN l_quantity + l_discount * 100 > 30 THEN 1 ELSE 0 END AS prediction FROM lineitem)"""


def predicted(t: Tables) -> DataFrame:
    return t.raw("lineitem").select(
        (F.col("l_quantity") > 25).cast("int").alias("label"),
        (F.col("l_quantity") + F.col("l_discount") * 100 > 30).cast("int").alias("prediction"),
    )


@query(_PREDICTED + """
SELECT CAST(label AS BIGINT) AS label, count(*) FILTER (WHERE prediction = 0) AS pred_0,
    count(*) FILTER (WHERE prediction = 1) AS pred_1 FROM predicted GROUP BY 1""")
def confusion(t: Tables) -> DataFrame:
    return M.confusion_matrix(predicted(t), "label", "prediction", [0, 1])


@query(_PREDICTED + """
, cells AS (SELECT c, CAST(count(*) FILTER (WHERE label = c AND prediction = c) AS DOUBLE) AS tp,
    CAST(count(*) FILTER (WHERE prediction = c) AS DOUBLE) AS pp,
    CAST(count(*) FILTER (WHERE label = c) AS DOUBLE) AS sup, CAST(count(*) AS DOUBLE) AS n
    FROM predicted, (VALUES (0), (1)) AS classes(c) GROUP BY c),
per AS (SELECT c, tp, sup, n, tp / pp AS p, tp / sup AS r, 2 * tp / (pp + sup) AS f FROM cells)
SELECT CAST(c AS VARCHAR) AS class, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1,
    CAST(sup AS BIGINT) AS support FROM per
UNION ALL SELECT 'accuracy', round(sum(tp) / max(n), 6), round(sum(tp) / max(n), 6), round(sum(tp) / max(n), 6),
    CAST(max(n) AS BIGINT) FROM per
UNION ALL SELECT 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f), 6), CAST(max(n) AS BIGINT) FROM per
UNION ALL SELECT 'weighted avg', round(sum(p * sup / n), 6), round(sum(r * sup / n), 6), round(sum(f * sup / n), 6),
    CAST(max(n) AS BIGINT) FROM per""")
def classification_report(t: Tables) -> DataFrame:
    return M.classification_report(predicted(t), "label", "prediction", [0, 1])


@query("""
SELECT l_returnflag AS label, count(*) AS rows,
    round((SELECT count(*) FROM lineitem) / (3 * CAST(count(*) AS DOUBLE)), 6) AS weight
FROM lineitem GROUP BY l_returnflag""")
def class_weights(t: Tables) -> DataFrame:
    return M.class_weights(t.raw("lineitem").select(F.col("l_returnflag").alias("label")), "label")
