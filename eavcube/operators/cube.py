"""Star schema, indices and summary views.

Views over dates and places aggregate the fact per date or place key first. Only these partial sums are
shuffled and joined to the dimension, so neither a busy day nor a busy place gathers fact rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eavcube.functions import dates as D
from eavcube.functions.numbers import row_sum, safe_ratio, weighted_sum
from eavcube.functions.text import keyword_weight
from eavcube.operators.relational import update_from

# Weights of the two severity and the two climate-risk formulas, and of vegetation words.
SEVERITY_1 = {"total_area": 0.6, "duration_days": 0.4}
SEVERITY_2 = {"total_area": 0.5, "duration_days": 0.3, "tree_area": 0.2}
CLIMATE_RISK_1 = {"temperature": 0.4, "wind": 0.3, "humidity": 0.3}
CLIMATE_RISK_2 = {"temperature": 0.4, "wind": 0.3, "humidity": -0.2}
VEGETATION_RISK = {"bosque": 0.9, "selva": 0.95, "pastizal": 0.7}
OTHER_VEGETATION_RISK = 0.5


# Dimensions ------------------------------------------------------------------------------------


def calendar(spark: SparkSession, first: str, last: str) -> DataFrame:
    """Every date of a closed range, for a time dimension that does not depend on observations."""
    days = F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))
    return spark.range(1).select(F.explode(days).alias("date"))


def time_dimension(df: DataFrame, date: str) -> DataFrame:
    """Distinct dates with year, month, quarter, month and season name and weekend flag."""
    d = F.col("date")
    return df.select(F.col(date).alias("date")).where(d.isNotNull()).distinct().select(
        "date",
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.quarter(d).alias("quarter"),
        D.month_name(d).alias("month_name"),
        D.season_name(d).alias("season"),
        D.is_weekend(d).alias("is_weekend"),
    )


def place_dimension(places: DataFrame, key: str, name: str, prefix: int = 2) -> DataFrame:
    """Distinct places with the state prefix of their key."""
    return places.select(key, F.col(name).alias("place"), F.substring(key, 1, prefix).alias("state")).distinct()


def with_state_names(dimension: DataFrame, places: DataFrame, states: DataFrame, key: str, state_key: str,
                     state: str, region: str) -> DataFrame:
    """Replace the prefix by state and region names, through the highest state key of each place."""
    owner = places.groupBy(key).agg(F.max(state_key).alias(state_key))
    named = owner.join(states.select(state_key, F.col(state).alias("__s"), F.col(region).alias("__r")), state_key)
    wide = dimension if "region" in dimension.columns else dimension.withColumn("region", F.lit(None).cast("string"))
    return update_from(wide, named, [key], {"state": F.col("__s"), "region": F.col("__r")}, hot_rows=None)


def vegetation_dimension(df: DataFrame, key: str, kind: str, regime: str,
                         weights: Mapping[str, float] = VEGETATION_RISK,
                         default: float = OTHER_VEGETATION_RISK) -> DataFrame:
    """Vegetation types with a risk weight from the first keyword of their name."""
    return df.select(key, kind, regime, keyword_weight(F.col(kind), weights, default).alias("vegetation_risk"))


def type_dimension(df: DataFrame, kind: str) -> DataFrame:
    return df.select(F.col(kind).alias("type")).distinct()


# Facts -----------------------------------------------------------------------------------------


def fire_fact(fires: DataFrame, operations: DataFrame, damage: DataFrame, key: str) -> DataFrame:
    """Fires with their operations and damage columns (one row each at most) and a unit measure."""
    marked = damage.withColumn("has_damage", F.lit(True))
    return (
        fires.join(operations, key, "left")
        .join(marked, key, "left")
        .withColumn("has_damage", F.coalesce("has_damage", F.lit(False)))
        .withColumn("n_fires", F.lit(1))
    )


def with_areas(fact: DataFrame, tree: str, herb: str, shrub: str) -> DataFrame:
    """Tree, herb and total area of the fires that have a damage row; NULL for the others."""
    known = F.col("has_damage")
    return fact.withColumns({
        "tree_area": F.when(known, F.col(tree)),
        "herb_area": F.when(known, F.col(herb)),
        "total_area": F.when(known, row_sum([tree, herb, shrub])),
    })


def with_severity(fact: DataFrame, weights: Mapping[str, float] = SEVERITY_1, only_missing: bool = False,
                  out: str = "severity") -> DataFrame:
    """Weighted severity; with `only_missing`, rows that already have one keep it."""
    index = weighted_sum(weights)
    if only_missing and out in fact.columns:
        index = F.coalesce(F.col(out), index)
    return fact.withColumn(out, index)


def climate_fact(series: DataFrame, key: str, variable: str, value: str, temperature: str = "T2M",
                 wind: str = "WS2M", humidity: str = "QV2M", radiation: str = "SW") -> DataFrame:
    """Mean temperature, wind, humidity and radiation (every code containing a text) per entity."""
    code = F.col(variable)
    measures = {
        "temperature": code == temperature,
        "wind": code == wind,
        "humidity": code == humidity,
        "radiation": code.contains(radiation),
    }
    return series.groupBy(key).agg(
        *[F.avg(F.when(cond, F.col(value))).alias(name) for name, cond in measures.items()]
    )


def with_climate_risk(fact: DataFrame, climate: DataFrame, key: str, weights: Mapping[str, float] = CLIMATE_RISK_1,
                      null_when_unknown: bool = False, only_missing: bool = False, out: str = "risk") -> DataFrame:
    """Weighted climate risk of fires that have a climate row; others keep what they had."""
    risk = weighted_sum(weights)
    if null_when_unknown:
        unknown = F.lit(True)
        for c in weights:
            unknown = unknown & F.col(c).isNull()
        risk = F.when(~unknown, risk)
    target = fact if out in fact.columns else fact.withColumn(out, F.lit(None).cast("double"))
    missing = F.col(out).isNull() if only_missing else None
    return update_from(target, climate, [key], {out: risk}, missing, hot_rows=None)


# Views -----------------------------------------------------------------------------------------


def _partial(fact: DataFrame, key: str) -> DataFrame:
    return fact.groupBy(key).agg(
        F.count(F.lit(1)).alias("__n"),
        F.sum("severity").alias("__s"),
        F.count("severity").alias("__k"),
        F.sum("total_area").alias("__a"),
    )


def _mean_severity() -> Column:
    return F.try_divide(F.sum("__s"), F.sum("__k")).alias("severity")


def _over_time(fact: DataFrame, time: DataFrame, date: str, levels: Sequence[str], *measures: Column) -> DataFrame:
    joined = _partial(fact, date).join(time, F.col(date) == F.col("date"))
    return joined.groupBy(*levels).agg(F.sum("__n").alias("fires"), *measures)


def annual_summary(fact: DataFrame, time: DataFrame, date: str) -> DataFrame:
    """Fires, mean severity and burned area per year."""
    return _over_time(fact, time, date, ["year"], _mean_severity(), F.sum("__a").alias("area"))


def time_hierarchy(fact: DataFrame, time: DataFrame, date: str) -> DataFrame:
    """Fires per year and month."""
    return _over_time(fact, time, date, ["year", "month"])


def time_cube(fact: DataFrame, time: DataFrame, date: str) -> DataFrame:
    """Fires, severity and area per year, quarter, month and month name."""
    levels = ["year", "quarter", "month", "month_name"]
    return _over_time(fact, time, date, levels, _mean_severity(), F.sum("__a").alias("area"))


def geographic_cube(fact: DataFrame, places: DataFrame, key: str) -> DataFrame:
    """Fires, severity and area per state and place."""
    joined = _partial(fact, key).join(places, key)
    area = F.sum(F.coalesce("__a", F.lit(0.0))).alias("area")
    return joined.groupBy("state", "place").agg(F.sum("__n").alias("fires"), _mean_severity(), area)


def climate_buckets(fact: DataFrame, climate: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Fires and severity per rounded temperature (units) and wind (tenths)."""
    joined = fact.select(key, "severity").join(climate.select(key, "temperature", "wind"), key, how)
    return joined.groupBy(
        F.round("temperature").alias("temperature"), F.round("wind", 1).alias("wind")
    ).agg(F.count(F.lit(1)).alias("fires"), F.avg("severity").alias("severity"))


def population_impact(fact: DataFrame, places: DataFrame, population: DataFrame, fire: str, key: str, people: str,
                      scale: float = 1.0, pre_aggregate: bool = False) -> DataFrame:
    """Fires, mean population and fires per `scale` inhabitants of each place.

    A fire counts once per population row of its place (year and sex), as a join of the two tables gives;
    the product is formed from per-place counts instead of repeated rows. With `pre_aggregate` a fire
    counts once.
    """
    fires = fact.groupBy(key).agg(F.count(fire).alias("__f"), F.count(F.lit(1)).alias("__r"))
    people_per_place = population.groupBy(key).agg(
        F.count(F.lit(1)).alias("__d"), F.sum(F.col(people).cast("double")).alias("__p"), F.count(people).alias("__k")
    )
    joined = fires.join(places, key).join(people_per_place, key, "left")
    copies = F.lit(1) if pre_aggregate else F.greatest(F.coalesce("__d", F.lit(1)), F.lit(1))
    grouped = joined.groupBy("place").agg(
        F.sum(F.col("__f") * copies).alias("fires"),
        F.try_divide(F.sum(F.col("__p") * F.col("__r")), F.sum(F.col("__k") * F.col("__r"))).alias("population"),
    )
    return grouped.withColumn("impact", safe_ratio(F.col("fires") * F.lit(scale), F.col("population")))


def critical_places(fact: DataFrame, places: DataFrame, climate: DataFrame, fire: str, key: str,
                    more_than: int = 100) -> DataFrame:
    """Places with more than a number of fires, their mean severity and temperature."""
    rows = fact.select(fire, key, "severity").join(climate.select(fire, "temperature"), fire, "left")
    partial = rows.groupBy(key).agg(
        F.count(F.lit(1)).alias("__n"), F.sum("severity").alias("__s"), F.count("severity").alias("__k"),
        F.sum("temperature").alias("__t"), F.count("temperature").alias("__kt"),
    )
    joined = partial.join(places, key).groupBy("place").agg(
        F.sum("__n").alias("fires"), _mean_severity(), F.try_divide(F.sum("__t"), F.sum("__kt")).alias("temperature")
    )
    return joined.where(F.col("fires") > more_than)


def top_k(df: DataFrame, measure: str, k: int, tie: Sequence[str], where: Column | None = None) -> DataFrame:
    """The k rows with the highest measure, ties by the given columns."""
    rows = df if where is None else df.where(where)
    return rows.orderBy(F.desc_nulls_last(measure), *tie).limit(k)
