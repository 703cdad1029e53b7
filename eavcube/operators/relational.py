"""Joins, set operations and keyed writes expressed as DataFrame functions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eavcube.functions.numbers import normalised_difference
from eavcube.operators.ordered import numbered, numbered_by
from eavcube.operators.skew import HOT_ROWS, skew_join, spread_join
from eavcube.operators.window import keep_first

_MATCHED = "__matched"
_SOURCE = "__source"


# Joins -----------------------------------------------------------------------------------------


def with_parent(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None,
                hot_rows: int = HOT_ROWS) -> DataFrame:
    """Child rows whose key exists in the parent (semi-join; NULL keys do not qualify)."""
    return skew_join(child, _key_set(parent, parent_key or key, key), [key], "left_semi", hot_rows)


def without_parent(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None,
                   hot_rows: int = HOT_ROWS) -> DataFrame:
    """Child rows whose non-null key is missing in the parent (orphans)."""
    known = child.where(F.col(key).isNotNull())
    return skew_join(known, _key_set(parent, parent_key or key, key), [key], "left_anti", hot_rows)


def not_in(df: DataFrame, other: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Rows whose key is not listed in `other`; rows with a NULL key are kept."""
    return skew_join(df, other.select(*keys).distinct(), keys, "left_anti", hot_rows)


def lookup(df: DataFrame, catalogue: DataFrame, on: Sequence[str], how: str = "inner",
           hot_rows: int | None = HOT_ROWS, spread_by: Sequence[str] = ()) -> DataFrame:
    """Join a frame to a catalogue on one or several natural keys.

    With `spread_by`, columns that tell the rows of a key apart, nothing runs while the plan is made, and the rows of
    each key are dealt over tasks whether it is hot or not.
    """
    return spread_join(df, catalogue, on, spread_by, how) if spread_by else skew_join(df, catalogue, on, how, hot_rows)


def _key_set(parent: DataFrame, parent_key: str, key: str) -> DataFrame:
    return parent.select(F.col(parent_key).alias(key)).distinct()


def update_from(target: DataFrame, source: DataFrame, on: Sequence[str], values: Mapping[str, Column],
                where: Column | None = None, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Set columns of the rows that match `source` (unique on the keys); other rows keep their values.

    `values` maps target columns to expressions over source columns, `where` restricts the matched target
    rows. Pass `hot_rows=None` when the keys are unique in the target too.
    """
    on = list(on)
    new = {name: f"__new_{i}" for i, name in enumerate(values)}
    fresh = source.select(*on, *[values[n].alias(a) for n, a in new.items()], F.lit(True).alias(_MATCHED))
    joined = skew_join(target, fresh, on, "left", hot_rows)
    hit = F.col(_MATCHED).isNotNull() if where is None else F.col(_MATCHED).isNotNull() & where
    kept = [
        F.when(hit, F.col(new[c])).otherwise(F.col(c)).cast(target.schema[c].dataType).alias(c)
        if c in new else F.col(c)
        for c in target.columns
    ]
    return joined.select(*kept)


def remap_ids(df: DataFrame, mapping: DataFrame, column: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Replace ids through a (bad_id, good_id) mapping; ids outside it stay."""
    source = mapping.select(F.col("bad_id").alias(column), "good_id").where(F.col(column).isNotNull())
    joined = skew_join(df, source, [column], "left", hot_rows)
    kept = [F.coalesce("good_id", column).alias(c) if c == column else F.col(c) for c in df.columns]
    return joined.select(*kept)


def latest_before(entities: DataFrame, observations: DataFrame, key: str, start: str, observed: str,
                  days: int, valid: Column, keep: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Newest valid observation of each entity in [start - days, start).

    Invalid rows and rows without an entity go before the shuffle; `max_by` then combines map-side, so an
    entity with very many observations costs one row per task. Ties are resolved by the kept columns.
    """
    rows = observations.where(valid).select(key, observed, *keep)
    joined = skew_join(rows, entities.select(key, F.col(start).alias("__start")), [key], "inner", hot_rows)
    window = (F.col(observed) >= F.date_sub("__start", days)) & (F.col(observed) < F.col("__start"))
    best = F.max_by(F.struct(observed, *keep), F.struct(observed, *keep)).alias("__best")
    return joined.where(window).groupBy(key).agg(best).select(key, "__best.*")


def latest_clear_indices(entities: DataFrame, bands: DataFrame, key: str, start: str, observed: str,
                         indices: Mapping[str, Sequence[str]], clear: str, days: int = 30,
                         hot_rows: int = HOT_ROWS) -> DataFrame:
    """Normalised-difference indices of the newest clear day before the start, as long rows.

    `indices` maps a name to its two bands; a day is clear when the index `clear` is known.
    """
    values = [normalised_difference(F.col(a), F.col(b)).alias(name) for name, (a, b) in indices.items()]
    measured = bands.select(key, observed, *values)
    best = latest_before(entities, measured, key, start, observed, days, F.col(clear).isNotNull(),
                         list(indices), hot_rows)
    pairs = F.array(*[F.struct(F.lit(n).alias("variable"), F.col(n).alias("value")) for n in indices])
    return best.select(key, F.to_date(observed).alias("obs_date"), F.inline(pairs))


def latest_clear_rows(bands: DataFrame, keys: Sequence[str], observed: str, indices: Mapping[str, Column],
                      clear: str) -> DataFrame:
    """Indices of the newest day per key on which the index `clear` is known, as rows (keys, variable, obs_date, value)."""
    measured = bands.select(*keys, observed, *[c.alias(n) for n, c in indices.items()]).where(F.col(clear).isNotNull() & F.col(observed).isNotNull())
    best = measured.groupBy(*keys).agg(F.max(F.struct(observed, *indices)).alias("__best"))
    pairs = F.array(*[F.struct(F.lit(n).alias("variable"), F.col(f"__best.{n}").alias("value")) for n in indices])
    return best.select(*keys, F.to_date(F.col(f"__best.{observed}")).alias("obs_date"), F.inline(pairs))


# Set operations and keyed writes ---------------------------------------------------------------


def union_ids(frames: Sequence[DataFrame], column: str) -> DataFrame:
    """Distinct ids over several sets."""
    united = frames[0].select(column)
    for frame in frames[1:]:
        united = united.unionByName(frame.select(column))
    return united.distinct()


def new_rows(candidates: DataFrame, stored: DataFrame) -> DataFrame:
    """Distinct candidate rows that are not stored yet (NULL equals NULL)."""
    return candidates.select(*stored.columns).subtract(stored)


def insert_if_absent(sources: Sequence[DataFrame], keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """Rows of several sources in order of priority; the first source to bring a key wins.

    `order` picks the row within one source; by default the lowest of the other columns.
    """
    columns = sources[0].columns
    united = None
    for i, source in enumerate(sources):
        part = source.select(*columns).withColumn(_SOURCE, F.lit(i))
        united = part if united is None else united.unionByName(part)
    rest = list(order) or [c for c in columns if c not in keys]
    return keep_first(united, keys, [_SOURCE, *rest]).drop(_SOURCE)


def upsert_by_key(existing: DataFrame, incoming: DataFrame, keys: Sequence[str],
                  hot_rows: int = HOT_ROWS) -> DataFrame:
    """Delete stored rows whose key set arrives again, then add all incoming rows."""
    return not_in(existing, incoming, keys, hot_rows).unionByName(incoming.select(*existing.columns))


def update_where(df: DataFrame, column: str, cond: Column, value: Column) -> DataFrame:
    """Set one column on the rows for which the condition is true."""
    kind = df.schema[column].dataType
    return df.withColumn(column, F.when(cond, value).otherwise(F.col(column)).cast(kind))


def delete_where(df: DataFrame, cond: Column) -> DataFrame:
    """Drop rows for which the condition is true; unknown keeps the row."""
    return df.where(~F.coalesce(cond, F.lit(False)))


def add_column(df: DataFrame, name: str, kind: str | T.DataType) -> DataFrame:
    """Add a typed NULL column unless it exists."""
    return df if name in df.columns else df.withColumn(name, F.lit(None).cast(kind))


def append_rows(table: DataFrame, rows: DataFrame) -> DataFrame:
    """Rows of a frame added to a table, cast to the table's types; columns must match by name."""
    missing = set(table.columns) ^ set(rows.columns)
    if missing:
        raise ValueError(f"columns differ: {sorted(missing)}")
    typed = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in table.schema.fields])
    return table.unionByName(typed)


def surrogate_keys(new: DataFrame, name: str, order: Sequence[str], stored: DataFrame | None = None) -> DataFrame:
    """Number distinct rows along their natural key, continuing after the highest stored id.

    A text key is numbered within the plan, by its first three characters; any other key is sorted over the cluster.
    """
    top = None if stored is None else stored.agg(F.max(name).alias(name))
    if isinstance(new.schema[order[0]].dataType, T.StringType):
        return numbered_by(new, F.substring(order[0], 1, 3), order, name, top)
    return numbered(new, order, name, ((top.first()[0] if top is not None else None) or 0) + 1)


def fixed_sample(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """`n` uniformly chosen rows; the same rows for the same seed, whatever the partitioning.

    Only draws below a bound that leaves `n` and six standard deviations are ordered, so the task that merges
    them gets about `n` rows, not `n` of every task. Where repeated keys leave fewer, all rows are ordered.
    """
    draw = F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed))))
    share = (n + 6 * n**0.5) / max(df.count(), 1)
    if share < 1:
        near = df.where(F.substring(draw, 1, 8) <= F.lit(f"{int(share * 16**8):08x}"))
        if near.count() >= n:
            df = near
    return df.orderBy(draw, key).limit(n)


# Work still to be fetched ----------------------------------------------------------------------


def pending_entities(entities: DataFrame, series: DataFrame, key: str, variable: str,
                     wanted: Sequence[str] | None = None, count: int | None = None, order: Sequence[str] = ()) -> DataFrame:
    """Entities whose series has fewer than `count` distinct variables (of the wanted ones, if given), in an `order`, if given."""
    rows = series if wanted is None else series.where(F.col(variable).isin(list(wanted)))
    enough = count if count is not None else len(wanted or [])
    done = rows.groupBy(key).agg(F.countDistinct(variable).alias("__n")).where(F.col("__n") >= enough)
    pending = not_in(entities, done, [key])
    return pending.orderBy(*order) if order else pending


def bundles(variables: Sequence[str], size: int) -> list[list[str]]:
    """Variables in slices of `size`, in the given order."""
    return [list(variables[i:i + size]) for i in range(0, len(variables), size)]


def request_plan(entities: DataFrame, series: DataFrame, key: str, start: str, variable: str,
                 groups: Sequence[Sequence[str]], days: int, details: Sequence[str] = ()) -> DataFrame:
    """One row per entity and bundle that is not complete yet, with the inclusive window to ask for.

    `details` are further columns of the entities that a request needs, such as coordinates. The bundles an
    entity already has become one array per entity, so the entities are joined once and only the missing
    bundles are made rows.
    """
    number = {v: i for i, group in enumerate(groups) for v in group}
    if len(number) < sum(len(group) for group in groups):
        raise ValueError("a variable is listed twice")
    plan = F.array(*[
        F.struct(F.lit(i).alias("bundle"), F.lit(",".join(g)).alias("variables"), F.lit(len(g)).alias("__size"))
        for i, g in enumerate(groups)
    ])
    table = F.create_map(*[F.lit(x) for pair in number.items() for x in pair])
    present = (
        series.where(F.col(variable).isin(list(number)))
        .withColumn("bundle", F.try_element_at(table, F.col(variable)))
        .groupBy(key, "bundle")
        .agg(F.countDistinct(variable).alias("__present"))
        .groupBy(key)
        .agg(F.map_from_entries(F.collect_list(F.struct("bundle", "__present"))).alias("__counts"))
    )
    open_ones = F.filter(plan, lambda b: F.coalesce(F.try_element_at("__counts", b["bundle"]), F.lit(0)) < b["__size"])
    return (
        entities.select(key, start, *details).join(present, key, "left")
        .select(key, start, *details, F.inline(open_ones))
        .select(
            key,
            *details,
            "bundle",
            "variables",
            F.date_format(F.date_sub(start, days - 1), "yyyyMMdd").alias("window_start"),
            F.date_format(start, "yyyyMMdd").alias("window_end"),
        )
    )
