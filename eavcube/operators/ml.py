"""Clustering, tree models and their reports on Spark MLlib."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eavcube.operators.ordered import small_list
from eavcube.operators.skew import skew_join

FEATURES = "__features"
WEIGHT = "weight"

# Zone labels from the lowest to the highest mean index.
ZONES = ["Bajo", "Medio-Bajo", "Medio", "Alto", "Crítico"]


def complete(features: Sequence[str]) -> Column:
    """Every feature of the row is a number."""
    known = F.lit(True)
    for c in features:
        known = known & F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
    return known


def assemble(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Rows with a vector of their features; all of them have to be complete."""
    doubles = df.withColumns({c: F.col(c).cast("double") for c in features})
    return VectorAssembler(inputCols=list(features), outputCol=FEATURES, handleInvalid="error").transform(doubles)


def kmeans_clusters(df: DataFrame, features: Sequence[str], k: int = 5, seed: int = 42,
                    out: str = "cluster") -> DataFrame:
    """Complete rows with the number of their cluster."""
    points = assemble(df.where(complete(features)), features)
    model = KMeans(k=k, seed=seed, featuresCol=FEATURES, predictionCol=out).fit(points)
    return model.transform(points).drop(FEATURES)


def cluster_profile(df: DataFrame, index: str, lat: str, lon: str, cluster: str = "cluster",
                    zones: Sequence[str] = ZONES) -> DataFrame:
    """Mean index, size, centre and zone per cluster; zones follow the rank of the mean index."""
    stats = df.groupBy(cluster).agg(
        F.avg(index).alias("mean_index"), F.count(F.lit(1)).alias("rows"),
        F.avg(lat).alias("lat"), F.avg(lon).alias("lon"),
    )
    # One entry per cluster (k of them) is gathered to rank them.
    entry = F.struct("mean_index", cluster, "rows", "lat", "lon")
    ranked = stats.agg(F.array_sort(F.collect_list(entry)).alias("all")).select(F.posexplode("all"))
    names = F.array(*[F.lit(z) for z in zones])
    return ranked.select(
        f"col.{cluster}", "col.mean_index", "col.rows", "col.lat", "col.lon",
        F.try_element_at(names, F.col("pos") + 1).alias("zone"),
    )


def hash_split(df: DataFrame, key: str, train: float = 0.8, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Train and test rows by a hash of the key: the same split whatever the partitioning, and in any engine with MD5."""
    digest = F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed))))
    bucket = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % 10_000
    chosen = bucket < F.lit(int(train * 10_000))
    return df.where(chosen), df.where(~chosen)


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weight per class: rows / (classes * rows of the class)."""
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("rows"))
    # One entry per class is gathered, so that the totals need no second pass.
    row = counts.agg(
        F.sum("rows").alias("__n"), F.count(F.lit(1)).alias("__k"), F.collect_list(F.struct(label, "rows")).alias("__all")
    )
    weight = F.col("__n") / (F.col("__k") * F.col("rows"))
    return row.select("__n", "__k", F.inline("__all")).select(label, "rows", weight.alias(WEIGHT))


def with_class_weights(df: DataFrame, label: str, limit: int = 1000) -> DataFrame:
    """Rows with the weight of their class: a literal lookup for a short class list, else a join."""
    table = class_weights(df, label).select(label, WEIGHT)
    if small_list(table, label, limit) is None:
        return skew_join(df, table, [label], "left")
    pairs = [F.lit(x) for row in table.collect() for x in row]
    return df.withColumn(WEIGHT, F.try_element_at(F.create_map(*pairs), F.col(label)))


def fit_tree(df: DataFrame, features: Sequence[str], label: str, max_depth: int = 5, weighted: bool = False,
             seed: int = 42, max_bins: int = 32):
    """Decision tree on a numeric label; features of fewer than `max_bins` values are split exactly."""
    tree = DecisionTreeClassifier(featuresCol=FEATURES, labelCol=label, maxDepth=max_depth, seed=seed, maxBins=max_bins)
    return _fit(tree, df, features, weighted)


def fit_forest(df: DataFrame, features: Sequence[str], label: str, trees: int = 100, max_depth: int = 12,
               min_rows: int = 1, weighted: bool = False, seed: int = 42):
    """Random forest on a numeric label."""
    forest = RandomForestClassifier(
        featuresCol=FEATURES, labelCol=label, numTrees=trees, maxDepth=max_depth,
        minInstancesPerNode=min_rows, seed=seed,
    )
    return _fit(forest, df, features, weighted)


def _fit(estimator, df: DataFrame, features: Sequence[str], weighted: bool):
    data = assemble(df.where(complete(features)), features)
    if weighted:
        estimator = estimator.setWeightCol(WEIGHT)
    return estimator.fit(data)


def predict(model, df: DataFrame, features: Sequence[str]) -> DataFrame:
    """All rows with their prediction, NULL where a feature is missing."""
    filled = df.withColumns({f"__f{i}": F.when(complete([c]), F.col(c).cast("double")).otherwise(0.0) for i, c in enumerate(features)})
    names = [f"__f{i}" for i in range(len(features))]
    scored = model.transform(assemble(filled, names))
    known = F.when(complete(features), F.col(model.getPredictionCol()))
    return scored.withColumn(model.getPredictionCol(), known).drop(FEATURES, "rawPrediction", "probability", *names)


def save_model(model, features: Sequence[str], path: str) -> None:
    """Store a fitted model with the names of its features, as a pipeline that Spark reads back."""
    assembler = VectorAssembler(inputCols=list(features), outputCol=FEATURES, handleInvalid="error")
    PipelineModel(stages=[assembler, model]).write().overwrite().save(path)


def load_model(path: str) -> tuple:
    """The model stored by `save_model` and the names of its features."""
    assembler, model = PipelineModel.load(path).stages
    return model, assembler.getInputCols()


def importances(model, features: Sequence[str], df: DataFrame) -> DataFrame:
    """(feature, importance), highest first."""
    rows = [(f, float(model.featureImportances[i])) for i, f in enumerate(features)]
    table = df.sparkSession.createDataFrame(rows, "feature string, importance double")
    return table.orderBy(F.desc("importance"), "feature")


def importance_groups(table: DataFrame, groups: Mapping[str, Sequence[str]]) -> DataFrame:
    """Importance summed per named group of features, highest first; a feature may be in several groups."""
    sums = [F.coalesce(F.sum(F.when(F.col("feature").isin(list(f)), F.col("importance"))), F.lit(0.0)).alias(n)
            for n, f in groups.items()]
    entries = [F.struct(F.lit(n).alias("group"), F.col(n).alias("importance")) for n in groups]
    return table.agg(*sums).select(F.inline(F.array(*entries))).orderBy(F.desc("importance"), "group")


def confusion(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Rows per (label, prediction)."""
    return df.groupBy(label, prediction).agg(F.count(F.lit(1)).alias("rows"))


def confusion_matrix(df: DataFrame, label: str, prediction: str, classes: Sequence) -> DataFrame:
    """One row per label, one column per predicted class."""
    cells = [F.count_if(F.col(prediction) == F.lit(c)).alias(f"pred_{c}") for c in classes]
    return df.groupBy(label).agg(*cells)


def classification_report(df: DataFrame, label: str, prediction: str, classes: Sequence) -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy, macro and weighted averages.

    The rows are counted once per (label, prediction); all measures come from that small table.
    """
    cells = confusion(df, label, prediction)
    sums = []
    for i, c in enumerate(classes):
        is_label, is_pred = F.col(label) == F.lit(c), F.col(prediction) == F.lit(c)
        sums += [_rows(is_label & is_pred, f"tp{i}"), _rows(is_pred, f"pp{i}"), _rows(is_label, f"sup{i}")]
    sums += [_rows(F.col(label) == F.col(prediction), "hits"), F.sum("rows").alias("total")]
    per_class = [_class_entry(str(c), i) for i, c in enumerate(classes)]
    row = cells.agg(*sums).select("hits", "total", F.array(*per_class).alias("per_class"))
    n, total = F.lit(float(len(classes))), F.col("total")

    def average(field: str, weighted: bool) -> Column:
        weight = (lambda x: x["support"] / total) if weighted else (lambda x: F.lit(1.0) / n)
        return F.aggregate("per_class", F.lit(0.0), lambda acc, x: acc + x[field] * weight(x))

    accuracy = F.col("hits") / total
    summary = [F.struct(F.lit("accuracy").alias("class"), accuracy.alias("precision"), accuracy.alias("recall"),
                        accuracy.alias("f1"), total.alias("support"))]
    for name, weighted in (("macro avg", False), ("weighted avg", True)):
        summary.append(F.struct(
            F.lit(name).alias("class"), *[average(m, weighted).alias(m) for m in ("precision", "recall", "f1")],
            total.alias("support"),
        ))
    return row.select(F.inline(F.concat("per_class", F.array(*summary))))


def _rows(cond: Column, name: str) -> Column:
    return F.coalesce(F.sum(F.when(cond, F.col("rows"))), F.lit(0)).alias(name)


def _class_entry(name: str, i: int) -> Column:
    zero = F.lit(0.0)
    tp, predicted, support = F.col(f"tp{i}"), F.col(f"pp{i}"), F.col(f"sup{i}")
    return F.struct(
        F.lit(name).alias("class"),
        F.coalesce(F.try_divide(tp, predicted), zero).alias("precision"),
        F.coalesce(F.try_divide(tp, support), zero).alias("recall"),
        F.coalesce(F.try_divide(tp * 2, predicted + support), zero).alias("f1"),
        support.alias("support"),
    )
