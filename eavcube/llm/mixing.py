"""Mixing sources to target weights with capped water-filling. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eavcube.llm.common import WORD, quoted, staged, text_hash, unused

# Documents of a source are ordered by a seeded hash, whose first 10 bits make the buckets.
BUCKETS = 1024


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def cycled_weights(sources: DataFrame, weights: tuple[int, ...] = (3, 1, 2)) -> DataFrame:
    """Weights in turn over the sources by code point, null last. `sources` has a row for each source, not each document."""
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    return sources.select("source", F.get(cycle, (rank - 1) % len(weights)).alias("weight"))


def fill_targets(sources: DataFrame, share: float, max_epochs: float) -> DataFrame:
    """source, source_size, weight -> the same with target: `share` of all sizes by weight, none above its cap.

    Clamping sources at the cap and giving the excess to the others in proportion, until none is above, ends at one
    water level: with the sources by cap / weight, the first k are at their cap and the rest get level * weight,
    where level is what the k leave over the rest's weight and k is the smallest for which no other cap is exceeded.
    Sources of weight 0 get nothing. If all caps together are too small, each source gets its cap.
    """
    cap = F.col("source_size") * F.lit(float(max_epochs))
    ratio = F.when(F.col("weight") > 0, F.col("cap") / F.col("weight")).otherwise(F.lit(0.0))
    usable = F.when(F.col("weight") > 0, F.col("cap")).otherwise(F.lit(0.0))
    # One row for each source: the whole list is small enough for one task.
    before = Window.orderBy("ratio", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(F.lit(1))
    ranked = sources.withColumn("cap", cap).withColumn("ratio", ratio).withColumn("usable", usable)
    level = F.try_divide(F.col("goal") - F.col("clamped"), F.col("heft"))
    levelled = ranked.select(
        "*", (F.sum("source_size").over(whole) * F.lit(float(share))).alias("goal"),
        F.coalesce(F.sum("usable").over(before), F.lit(0.0)).alias("clamped"),
        (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))).alias("heft"),
    ).withColumn("level", level)
    # From the first source on that the level leaves below its cap, the level is final.
    final = F.min(F.when((F.col("weight") > 0) & (F.col("level") <= F.col("ratio")), F.struct("ratio", "clamped", "level"))).over(whole)
    leveled = levelled.withColumn("final", final)
    target = (F.when(F.col("weight") <= 0, F.lit(0.0))
              .when(F.col("final").isNull() | (F.col("ratio") < F.col("final.ratio")), F.col("cap"))
              .otherwise(F.least(F.col("cap"), F.col("weight") * F.col("final.level"))))
    return leveled.select("source", "source_size", "weight", target.cast("double").alias("target"))


def _key(seed: str) -> Column:
    """A seeded hash of the doc_id, and for rows of one id that of the text."""
    return F.concat(F.md5(F.concat_ws(":", F.lit(seed), F.col("doc_id").cast("string"))), F.lpad(F.hex(text_hash("text")), 16, "0"))


def _bucket(key: str) -> Column:
    return F.floor(F.conv(F.substring(key, 1, 3), 16, 10).cast("int") * BUCKETS / 4096).cast("int")


def _copies(key: str) -> Column:
    """Repetitions of a document, from its key and the cut of its source; rows of a shared key come after their number."""
    bucket = _bucket(key)
    first = (bucket < F.col("_end")) | ((bucket == F.col("_end")) & F.coalesce(F.col(key) <= F.col("_cut"), F.lit(False)))
    return F.col("_whole") + F.coalesce((F.col("_rest") > 0) & first, F.lit(False)).cast("long")


def _dealt(rows: DataFrame, cuts: DataFrame, source: str, key: str) -> DataFrame:
    """Rows with their source's cut and their repetitions in `_copies`.

    If the rest of a target ends among rows of one key, which have one doc_id and text, only as many of these as it takes
    are repeated once more. There are such rows only where ids repeat.
    """
    joined = rows.join(cuts, F.col(source).eqNullSafe(F.col("_s"))).withColumn("_copies", _copies(key))
    if cuts.where("_shared is not null").isEmpty():
        return joined
    shared = F.coalesce(F.col(key) == F.col("_shared"), F.lit(False))
    number = F.row_number().over(Window.partitionBy(source, key).orderBy(F.lit(0)))
    split = joined.where(shared).withColumn("_number", number)
    split = split.withColumn("_copies", F.col("_copies") + (F.col("_number") <= F.col("_quota")).cast("long")).drop("_number")
    return joined.where(~shared).unionByName(split)


def _cuts(rows: DataFrame, weights: DataFrame | None, share: float, max_epochs: float) -> DataFrame:
    """One row for each source: _s, _source_size, _target, _whole repetitions, _rest of the target, and the bucket _end
    and key _cut where the rest is reached; if it is reached among several rows of one key, that key in _shared and how
    many of them it takes in _quota."""
    bucket = _bucket("key")
    buckets = staged(rows.groupBy("source", bucket.alias("bucket")).agg(F.sum("size").alias("words")))
    totals = buckets.groupBy("source").agg(F.sum("words").alias("source_size"))
    weights = cycled_weights(totals) if weights is None else weights
    joined = totals.join(weights.select(F.col("source").alias("_s"), F.col("weight").cast("double").alias("weight")),
                         F.col("source").eqNullSafe(F.col("_s")), "left")
    targets = staged(fill_targets(joined.select("source", "source_size", F.coalesce("weight", F.lit(0.0)).alias("weight")),
                                  share, max_epochs))
    whole = F.coalesce(F.floor(F.try_divide(F.col("target"), F.col("source_size"))), F.lit(0)).cast("long")
    plan = targets.select(F.col("source").alias("_s"), "source_size", "target", whole.alias("whole"),
                          (F.col("target") - whole * F.col("source_size")).alias("rest"))
    # The bucket in which the rest of the target ends; a window holds at most BUCKETS rows of a source.
    by_bucket = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = buckets.withColumn("before", F.coalesce(F.sum("words").over(by_bucket), F.lit(0)))
    ends = sums.join(plan, F.col("source").eqNullSafe(F.col("_s"))).where(
        (F.col("before") <= F.col("rest")) & (F.col("rest") < F.col("before") + F.col("words")))
    ends = staged(ends.select("_s", "source_size", "target", "whole", "rest", F.col("bucket").alias("end"), "before"))
    last = rows.join(ends, F.col("source").eqNullSafe(F.col("_s")) & (bucket == F.col("end"))).select(
        "source", "key", "size", "before", "rest")
    last = last.groupBy("source", "key").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("rows"), F.max("size").alias("each"),
                                             F.max("before").alias("before"), F.max("rest").alias("rest"))
    by_key = Window.partitionBy("source").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    left = F.col("rest") - F.col("before") - F.coalesce(F.sum("size").over(by_key), F.lit(0))
    # Rows of a key that fit: those whose middle does not pass the rest.
    fits = F.when(F.col("size") == 0, F.when(left >= 0, F.col("rows")).otherwise(F.lit(0))).otherwise(
        F.greatest(F.lit(0), F.least(F.col("rows"), F.floor(F.try_divide(left, F.col("each")) + F.lit(0.5)))))
    middle = F.col("before") + F.coalesce(F.sum("size").over(by_key), F.lit(0)) + F.col("size") / F.lit(2.0)
    fits = F.when(F.col("rows") == 1, (middle <= F.col("rest")).cast("long")).otherwise(fits).cast("long")
    placed = last.withColumn("fits", fits)
    cuts = placed.where("fits > 0").groupBy(F.col("source").alias("_c")).agg(
        F.max(F.when(F.col("fits") == F.col("rows"), F.col("key"))).alias("cut"),
        F.max(F.when(F.col("fits") < F.col("rows"), F.struct("key", "fits"))).alias("part"))
    ready = plan.join(ends.select(F.col("_s").alias("_e"), "end"), F.col("_s").eqNullSafe(F.col("_e")), "left").join(
        cuts, F.col("_s").eqNullSafe(F.col("_c")), "left")
    return staged(ready.select("_s", F.col("source_size").alias("_source_size"), F.col("target").alias("_target"),
                               F.col("whole").alias("_whole"), F.col("rest").alias("_rest"), F.col("end").alias("_end"),
                               F.col("cut").alias("_cut"), F.col("part.key").alias("_shared"), F.col("part.fits").alias("_quota")))


def _sized(docs: DataFrame, seed: str) -> DataFrame:
    return staged(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), _key(seed).alias("key")))


def mix_sources(docs: DataFrame, weights: DataFrame | None = None, share: float = 1.5, max_epochs: float = 2.0,
                seed: str = "mix") -> DataFrame:
    """How often the mix takes each document: doc_id, source, size, source_size, target, copies, taken.

    Every document is taken floor(target / source_size) times. What is left of the target goes, once more each, to
    the documents that come first by md5(seed, doc_id), up to the one whose middle passes it, so that a source misses
    its target by half a document at most. Reruns agree. Sizes are summed by source and hash bucket before they are
    shuffled; only the one bucket that holds the cut is ordered row by row.

    `weights` (source, weight) defaults to 3, 1, 2 in turn. A null source is a source. A null doc_id is hashed as an
    empty string; rows of one id are ordered by their text, and of rows with one id and text as many are taken as fit.
    Null or wordless texts have size 0 and are taken 0 words. An empty table gives an empty mix. Further columns are not
    looked at.
    """
    rows = _sized(docs, seed)
    out = _dealt(rows, _cuts(rows, weights, share, max_epochs), "source", "key")
    return out.select("doc_id", "source", "size", F.col("_source_size").cast("long").alias("source_size"),
                      F.col("_target").alias("target"), F.col("_copies").alias("copies"),
                      (F.col("size") * F.col("_copies")).cast("long").alias("taken"))


def repeat_documents(docs: DataFrame, weights: DataFrame | None = None, share: float = 1.5, max_epochs: float = 2.0,
                     seed: str = "mix") -> DataFrame:
    """The mix itself: every row of `docs` as often as `mix_sources` takes it, numbered from 1 in a new last column `copy`.

    All columns stay, whatever their names; if one is called `copy`, the number is in `_copy`. Nulls, repeats and empty
    tables are as in `mix_sources`.
    """
    (copy,) = unused(docs, "copy")
    rows = _sized(docs, seed)
    # The row in one column, so that no name of it meets another.
    keyed = docs.select(F.struct(*[F.col(quoted(c)) for c in docs.columns]).alias("_row"), F.col("source").alias("_source"), _key(seed).alias("_key"))
    mixed = _dealt(keyed, _cuts(rows, weights, share, max_epochs), "_source", "_key").where("_copies > 0")
    return mixed.select("_row.*", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int"))).alias(copy))
