"""Exact quantiles (linear interpolation between ranks) of small and of very large groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eavcube.operators.ordered import CHUNK, positioned
from eavcube.operators.skew import HOT_ROWS, hot_keys, split_hot

EDGES = "edges"


def quantiles(
    df: DataFrame, value: str, probs: Sequence[float], keys: Sequence[str] = (), hot_rows: int = HOT_ROWS
) -> DataFrame:
    """One row per group with `edges`, the exact quantile of `value` at each of `probs`.

    The built-in `percentile` keeps a map of all values of a group in one task, so it only serves groups
    below `hot_rows`. Larger ones are counted per value, sorted over the cluster and read off at the
    wanted ranks.
    """
    keys = list(keys)
    known = df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    known = known.select(*keys, F.col(value).cast("double").alias(value))
    if not keys:
        large = known.count() > hot_rows
        return _by_rank(known, value, probs, keys) if large else _builtin(known, value, probs, keys)
    hot = hot_keys(known, keys, hot_rows)
    if hot is None:
        return _builtin(known, value, probs, keys)
    ordinary, large = split_hot(known, keys, hot)
    return _builtin(ordinary, value, probs, keys).unionByName(_by_rank(large, value, probs, keys))


# A sketch of this size knows a rank to within 0.2 % of the rows; brackets leave more on both sides.
_SKETCH, _GRID, _SLACK = 4096, 200, 0.005


def quantile_list(df: DataFrame, value: str, probs: Sequence[float], hot_rows: int = HOT_ROWS) -> list[float]:
    """Exact quantiles of the whole column as plain numbers.

    A mergeable sketch brackets every wanted rank by two values of the column. Brackets that still hold more than about
    `hot_rows` rows are cut again the same way. The last pass counts the rows between the brackets as one number each and
    those inside by value, and reads the ranks off. So the input is read twice, and once more for each factor of about
    fifty by which it exceeds `hot_rows`. Should a sketch have missed a rank, which the last pass sees, the column is
    sorted instead.
    """
    known = df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double"))).select(F.col(value).cast("double").alias("x"))
    brackets: list[tuple[float, float]] = [(float("-inf"), float("inf"))] * len(probs)
    rows = None
    while True:
        spans = sorted(set(brackets))
        found = dict(zip(spans, _sketched(known, spans)))
        rows = found[spans[0]][1] if rows is None else rows
        if not rows:
            return [None] * len(probs)
        cut, most = [], 0.0
        for span, p in zip(brackets, probs):
            below, inside, grid = found[span]
            rank = (rows - 1) * float(p)
            low = max(0, int((((rank // 1) - below) / max(inside, 1) - _SLACK) * _GRID))
            high = min(_GRID, -int(-((-(-rank // 1) + 1 - below) / max(inside, 1) + _SLACK) * _GRID // 1))
            cut.append((grid[low], grid[high]) if inside and low <= _GRID and high >= 0 else span)
            most = max(most, inside * (high - low) / _GRID)
        done = most <= hot_rows or cut == brackets
        brackets = cut
        if done:
            break
    edges = _read_off(known, sorted(set(brackets)), probs, rows)
    if None in edges:
        (row,) = _by_rank(known, "x", probs, []).collect()
        return list(row[EDGES])
    return edges


def _sketched(known: DataFrame, spans: list[tuple[float, float]]) -> list[tuple[int, int, list[float]]]:
    """For each span of values the rows below it, the rows in it, and their values at _GRID + 1 even ranks."""
    aggregates, x = [], F.col("x")
    for i, (low, high) in enumerate(spans):
        inside = x.between(F.lit(low), F.lit(high))
        aggregates += [F.count_if(x < F.lit(low)).alias(f"b{i}"), F.count_if(inside).alias(f"n{i}"),
                       F.kll_sketch_agg_double(F.when(inside, x), F.lit(_SKETCH)).alias(f"s{i}")]
    ranks = F.array(*[F.lit(j / _GRID) for j in range(_GRID + 1)])
    grids = [F.when(F.col(f"n{i}") > 0, F.kll_sketch_get_quantile_double(f"s{i}", ranks)).alias(f"g{i}") for i in range(len(spans))]
    counts = [f"{c}{i}" for i in range(len(spans)) for c in "bn"]
    row = known.agg(*aggregates).select(*counts, *grids).first()
    return [(row[f"b{i}"], row[f"n{i}"], row[f"g{i}"] and list(row[f"g{i}"])) for i in range(len(spans))]


def _read_off(known: DataFrame, spans: list[tuple[float, float]], probs: Sequence[float], rows: int) -> list[float | None]:
    """Values at the wanted ranks, None where a rank lies outside all spans; one pass over the input."""
    merged: list[list[float]] = []
    for low, high in spans:
        if merged and low <= merged[-1][1]:
            merged[-1][1] = max(high, merged[-1][1])
        else:
            merged.append([low, high])
    x, section = F.col("x"), F.lit(2 * len(merged))
    for i, (low, high) in reversed(list(enumerate(merged))):
        section = F.when(x < F.lit(low), F.lit(2 * i)).when(x <= F.lit(high), F.lit(2 * i + 1)).otherwise(section)
    cells = known.select(section.alias("section"), "x").select("section", F.when(F.col("section") % 2 == 1, x).alias("x"))
    cells = cells.groupBy("section", "x").agg(F.count(F.lit(1)).alias("__n"))
    # The values inside the brackets and a row for each gap.
    upto = F.sum("__n").over(Window.partitionBy(F.lit(0)).orderBy("section", "x").rowsBetween(Window.unboundedPreceding, 0))
    ranked = cells.withColumn("__upto", upto)
    wanted = [(rows - 1) * float(p) for p in probs]
    picked = [F.max(F.when(_holds(F.lit(int(r))), x)).alias(f"lo{i}") for i, r in enumerate(wanted)]
    picked += [F.max(F.when(_holds(F.lit(-int(-r // 1))), x)).alias(f"hi{i}") for i, r in enumerate(wanted)]
    row = ranked.agg(*picked).first()
    out: list[float | None] = []
    for i, r in enumerate(wanted):
        low, high = row[f"lo{i}"], row[f"hi{i}"]
        out.append(None if low is None or high is None else low + (high - low) * (r - int(r)) if high != low else low)
    return out


def _builtin(df: DataFrame, value: str, probs: Sequence[float], keys: list[str]) -> DataFrame:
    edges = F.percentile(value, F.array(*[F.lit(float(p)) for p in probs])).alias(EDGES)
    return df.groupBy(*keys).agg(edges)


def _by_rank(df: DataFrame, value: str, probs: Sequence[float], keys: list[str]) -> DataFrame:
    counts = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__n"))
    ordered = positioned(counts, [*keys, value])
    # Rows per group and slice: at most one row per slice and hot group, so the windows below stay small.
    slices = ordered.groupBy(*keys, CHUNK).agg(F.sum("__n").alias("__rows"))
    group = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    before = F.sum("__rows").over(group.orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1))
    slices = slices.select(
        *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)],
        F.col(CHUNK).alias("__c"),
        F.coalesce(before, F.lit(0)).alias("__before"),
        F.sum("__rows").over(group).alias("__total"),
    )
    cond = F.col(CHUNK) == F.col("__c")
    for i, k in enumerate(keys):
        cond = cond & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    inside = Window.partitionBy(*keys, CHUNK).orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    ranked = (
        ordered.withColumn("__upto", F.sum("__n").over(inside))
        .join(F.broadcast(slices), cond)
        .withColumn("__upto", F.col("__before") + F.col("__upto"))
    )
    at_ranks = []
    for i, p in enumerate(probs):
        rank = (F.col("__total") - 1) * F.lit(float(p))
        at_ranks += [
            F.max(F.when(_holds(F.floor(rank)), F.col(value))).alias(f"__lo{i}"),
            F.max(F.when(_holds(F.ceil(rank)), F.col(value))).alias(f"__hi{i}"),
            F.max(rank - F.floor(rank)).alias(f"__f{i}"),
        ]
    edges = [
        F.col(f"__lo{i}") + (F.col(f"__hi{i}") - F.col(f"__lo{i}")) * F.col(f"__f{i}") for i in range(len(probs))
    ]
    return ranked.groupBy(*keys).agg(*at_ranks).select(*keys, F.array(*edges).alias(EDGES))


def _holds(rank: Column) -> Column:
    """The row's run of equal values covers the 0-based rank."""
    return (F.col("__upto") > rank) & (F.col("__upto") - F.col("__n") <= rank)
