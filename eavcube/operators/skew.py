"""Keys that hold a large share of all rows: finding them and joining on them.

A hot key is one whose rows should not meet in a single task. Detection reads a thin sample and only
decides the strategy; results never depend on it.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eavcube.operators.ordered import checkpoint

# A key with more rows than this is worth splitting.
HOT_ROWS = 1_000_000
# Up to so many hot keys are broadcast; more of them are joined as the optimizer sees fit.
BROADCAST_KEYS = 100_000
# Where the plan may not look at the rows, every key is dealt over so many tasks.
BLIND_SALTS = 32

ROWS = "__rows"
_SALT = "__salt"
_SALTS = "__salts"
_COPIES = "__copies"


def will_broadcast(df: DataFrame) -> bool:
    """The optimizer's size estimate is within its broadcast threshold, so a join side is broadcast."""
    try:
        conf = df.sparkSession._jsparkSession.sessionState().conf()
        size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
        return int(str(size)) <= conf.autoBroadcastJoinThreshold()
    except AttributeError:
        return False


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame | None:
    """Keys with about `hot_rows` rows or more and their estimated count, or None when there are none.

    About 1,000 sampled rows stand for one hot key, and only the key columns are read. All hot keys are
    kept, in a checkpointed frame, so that every use of it sees the same keys; only their number reaches
    the driver, which decides whether they are broadcast.
    """
    fraction = min(1.0, 1000.0 / hot_rows)
    sample = df.select(*keys)
    if fraction < 1.0:
        sample = sample.sample(fraction, seed=17)
    found = (
        sample.groupBy(*keys)
        .agg((F.count(F.lit(1)) / F.lit(fraction)).cast("bigint").alias(ROWS))
        .where(F.col(ROWS) >= (hot_rows if fraction == 1.0 else hot_rows // 2))
    )
    if found.isEmpty():
        return None
    found = checkpoint(found)
    return F.broadcast(found) if found.count() <= BROADCAST_KEYS else found


def same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Null-safe equality on all keys."""
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def split_hot(df: DataFrame, keys: Sequence[str], hot: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of ordinary keys and rows of hot keys (`hot` as `hot_keys` returns it)."""
    flags = hot.select(*keys)
    cond = same_keys(df, flags, keys)
    return df.join(flags, cond, "left_anti"), df.join(flags, cond, "left_semi")


def skew_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    hot_rows: int | None = HOT_ROWS,
    probe: DataFrame | None = None,
) -> DataFrame:
    """Equi-join whose left side may be dominated by a few keys.

    When the right side is small enough to be broadcast, or no key is hot, this is an ordinary join and
    the optimizer decides by the sizes it measures. With hot keys, their left rows are spread over salts
    by a hash of the row and only the matching right rows are repeated, once per salt. A hash keeps a
    retried task's rows where they were; a random salt would not.

    `probe` is a cheaper frame with the same key distribution to look for hot keys in, for a left side
    that is itself the result of joins. `hot_rows=None` states that no left key can repeat much.
    """
    on = list(on)
    # A lowered hot_rows asks for the split even where a broadcast would do.
    safe = hot_rows is None or (hot_rows >= HOT_ROWS and will_broadcast(right))
    hot = None if safe else hot_keys(left if probe is None else probe, on, hot_rows)
    if hot is None:
        return left.join(right, on, how)
    # Copies of one row share their hash, so many copies are counted before and repeated after the join.
    if hot_keys(left, left.columns, hot_rows) is None:
        return _salted_join(left, right, on, how, hot, hot_rows)
    counted = left.groupBy(*left.columns).agg(F.count(F.lit(1)).alias(_COPIES))
    return repeat_rows(_salted_join(counted, right, on, how, hot, hot_rows), _COPIES, hot_rows)


def _salted_join(left: DataFrame, right: DataFrame, on: list[str], how: str, hot: DataFrame, hot_rows: int) -> DataFrame:
    salts = hot.select(*on, F.ceil(F.col(ROWS) / F.lit(hot_rows)).cast("int").alias(_SALTS))
    spread = left.alias("l").join(salts.alias("s"), _aliased(on), "left").select(
        "l.*",
        F.pmod(F.xxhash64(*[F.col(f"l.{c}") for c in left.columns]), F.coalesce(F.col(f"s.{_SALTS}"), F.lit(1)))
        .cast("int")
        .alias(_SALT),
    )
    repeated = right.alias("l").join(salts.alias("s"), _aliased(on), "left").select(
        "l.*",
        F.explode(F.sequence(F.lit(0), F.coalesce(F.col(f"s.{_SALTS}"), F.lit(1)) - 1)).alias(_SALT),
    )
    return spread.join(repeated, [*on, _SALT], how).drop(_SALT)


def spread_join(left: DataFrame, right: DataFrame, on: Sequence[str], by: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join of a left side that a few keys may dominate, planned without a look at the rows.

    Left rows are dealt over BLIND_SALTS by a hash of the columns `by`, which should tell the rows of a key apart, and
    every right row is repeated as often: `right` should be a catalogue, much smaller than the left side.
    """
    on = list(on)
    if will_broadcast(right):
        return left.join(right, on, how)
    salt = F.pmod(F.xxhash64(*by), F.lit(BLIND_SALTS)).cast("int")
    repeated = right.withColumn(_SALT, F.explode(F.sequence(F.lit(0), F.lit(BLIND_SALTS - 1))))
    return left.withColumn(_SALT, salt).join(repeated, [*on, _SALT], how).drop(_SALT)


def repeat_rows(df: DataFrame, copies: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Repeat every row as often as its `copies` column says; a very large count is spread over tasks."""
    size, count = F.lit(hot_rows), F.col(copies)
    parts = df.withColumn("__part", F.explode(F.sequence(F.lit(0), F.floor((count - 1) / size))))
    # With a stated number the small counted rows are not coalesced into one task before they are repeated.
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = parts.repartition(tasks, F.xxhash64(*df.columns), "__part")
    here = F.least(size, count - F.col("__part") * size).cast("int")
    return spread.withColumn("__copy", F.explode(F.sequence(F.lit(1), here))).select(
        *[c for c in df.columns if c != copies]
    )


def _aliased(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"l.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys])
