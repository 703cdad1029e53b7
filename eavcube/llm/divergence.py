"""How far the sources of a language are from each other, and which terms set a source apart: merged dominance skybands."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eavcube.llm.common import LOWER, UPPER, slices, staged

# A term is a run of A-Z, a-z and all code points above ASCII, here as UTF-8 bytes; shares are in billionths.
TERM = re.compile(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
SHARE = 1_000_000_000
_FOLD = bytes.maketrans(UPPER.encode(), LOWER.encode())
_POINTS = "lang string, source string, term string, n long, lang_n long"
# Points whose dominators are counted at once.
_BLOCK = 256


def _count_terms(limit: int):
    """Occurrences and documents of each term by (lang, source), summed in the task until `limit` different ones."""

    def emit(held):
        columns = [[], [], [], [], []]
        for (lang, source), (total, documents) in held.items():
            columns[0] += [lang] * len(total)
            columns[1] += [source] * len(total)
            columns[2] += total
            columns[3] += total.values()
            columns[4] += map(documents.__getitem__, total)
        types = [pa.string()] * 2 + [pa.binary()] + [pa.int64()] * 2
        arrays = [pa.array(c, t) for c, t in zip(columns, types)]
        arrays[2] = arrays[2].cast(pa.string())
        return pa.RecordBatch.from_arrays(arrays, ["lang", "source", "term", "n", "docs"])

    def count(batches):
        held: dict = {}
        for batch in batches:
            rows = zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(),
                       batch.column("text").cast(pa.large_binary()).to_pylist())
            for lang, source, text in rows:
                terms = TERM.findall(text.translate(_FOLD))
                total, documents = held.setdefault((lang, source), (Counter(), Counter()))
                total.update(terms)
                documents.update(set(terms))
            if sum(len(total) for total, _ in held.values()) >= limit:
                yield emit(held)
                held = {}
        if held:
            yield emit(held)

    return count


def _plain(docs: DataFrame) -> DataFrame:
    return docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])


def kept_terms(docs: DataFrame, min_docs: int = 3, flush: int = 300_000) -> DataFrame:
    """lang, term, n (in the language), sources (array of source and n): the terms in at least `min_docs` rows of their lang."""
    counted = _plain(docs).mapInArrow(_count_terms(flush), "lang string, source string, term string, n long, docs long")
    # Tasks have summed their own rows; dealt by (lang, term), both sums below need no further shuffle.
    by_source = counted.repartition("lang", "term").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    # The array has an entry for each source of the language at most.
    by_lang = by_source.groupBy("lang", "term").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs"), F.collect_list(F.struct("source", "n")).alias("sources"))
    return by_lang.where(F.col("docs") >= min_docs).select("lang", "term", "n", "sources")


def in_skyband(n: np.ndarray, lang_n: np.ndarray, term: np.ndarray, k: int) -> np.ndarray:
    """Which points fewer than `k` others dominate: at least as high in n, as low in lang_n and as early in term.

    Points come sorted by n descending, lang_n, term, so that dominators come first. Of k dominators or more, the first
    k are in the skyband themselves, so it is enough to count among the points kept so far and those of the same block.
    """
    keep = np.zeros(len(n), bool)
    for low in range(0, len(n), _BLOCK):
        high = min(low + _BLOCK, len(n))
        own_c, own_t = lang_n[low:high], term[low:high]
        before = np.flatnonzero(keep[:low])
        count = np.count_nonzero((lang_n[before] <= own_c[:, None]) & (term[before] <= own_t[:, None]), axis=1)
        inside = (own_c <= own_c[:, None]) & (own_t <= own_t[:, None])
        count += np.count_nonzero(np.tril(inside, -1), axis=1)
        keep[low:high] = count < k
    return keep


def _bands(k: int, limit: int):
    """The skyband of each (lang, source) among the rows of a task, cut whenever `limit` rows are held."""

    def cut(held: list) -> pa.Table:
        rows = pa.Table.from_batches(held).combine_chunks()
        if not rows.num_rows:
            return rows
        codes = [rows[c].combine_chunks().dictionary_encode().indices.to_numpy() for c in ("lang", "source")]
        group = codes[0].astype(np.int64) * (int(codes[1].max()) + 1) + codes[1]
        n, lang_n = rows["n"].to_numpy(), rows["lang_n"].to_numpy()
        # Arrow orders binary values byte by byte.
        term = pc.rank(rows["term"].combine_chunks().cast(pa.binary()), tiebreaker="dense").to_numpy().astype(np.int64)
        order = np.lexsort((term, lang_n, -n, group))
        # Ranks serve as well as the values and compare faster.
        lang_n, term = np.unique(lang_n, return_inverse=True)[1].astype(np.int32), term.astype(np.int32)
        keep = [order[a:b][in_skyband(n[order[a:b]], lang_n[order[a:b]], term[order[a:b]], k)]
                for a, b in zip(*slices(group[order]))]
        return rows.take(pa.array(np.concatenate(keep)))

    def stream(batches):
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= limit:
                band = cut(held)
                if band.num_rows > limit // 2:  # very many groups: later steps merge what leaves here
                    yield from band.to_batches()
                    held, size = [], 0
                else:
                    held, size = band.to_batches(), band.num_rows
        if held:
            yield from cut(held).to_batches()

    return stream


def skybands(points: DataFrame, k: int = 200, limit: int = 400_000, fan: int = 8) -> DataFrame:
    """Points (lang, source, term, n, lang_n) that fewer than `k` points of their group dominate.

    Partitions cut their own rows first; what they keep is merged in `fan` parts of each group and then by group, so no
    task sees more of a group than the bands of a part of its predecessors.
    """
    band = points.select("lang", "source", "term", "n", "lang_n")
    part = F.pmod(F.xxhash64("term"), F.lit(fan))
    band = band.mapInArrow(_bands(k, limit), _POINTS).repartition("lang", "source", part)
    band = band.mapInArrow(_bands(k, limit), _POINTS).repartition("lang", "source")
    return band.mapInArrow(_bands(k, limit), _POINTS)


def share(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(10^9 * (n + 1) / (total + terms)), with a decimal product, so that large counts stay exact."""
    product = (n + F.lit(1)).cast("decimal(20,0)") * F.lit(SHARE).cast("decimal(10,0)")
    return F.lit(1).cast("long") + F.call_function("div", product, (total + terms).cast("decimal(20,0)"))


def gap(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / q); shares are at most 10^9 + 1, so the square fits into 64 bits."""
    return F.call_function("div", (p - q) * (p - q), q)


def _common_terms(batches):
    """What terms of two sources add to the sums of both beyond the case that only one of them has the term.

    All ordered pairs of a term's sources are summed in place by pair of sources; only sums leave the task.
    """
    def f(p, q):
        return (p - q) ** 2 // q

    def emit(sums):
        keys = list(sums)
        return pa.RecordBatch.from_arrays(
            [pa.array([k[i] for k in keys], pa.string()) for i in range(3)] + [pa.array([sums[k] for k in keys], pa.int64())],
            ["lang", "source", "item", "value"])

    sums: dict = {}
    for batch in batches:
        lists = batch.column("sources")
        at = lists.offsets.to_numpy().astype(np.int64)
        flat = lists.values
        p, zero = (flat.field(c).to_numpy() for c in ("p", "zero"))
        langs = batch.column("lang").dictionary_encode()
        sources = flat.field("source").dictionary_encode()
        lang_names, names = langs.dictionary.to_pylist(), sources.dictionary.to_pylist()
        group = np.zeros(len(p), np.int64)
        group[at[0] : at[-1]] = np.repeat(langs.indices.to_numpy().astype(np.int64), np.diff(at))
        source = sources.indices.to_numpy().astype(np.int64)
        size, first = np.zeros(len(p), np.int64), np.zeros(len(p), np.int64)
        size[at[0] : at[-1]] = np.repeat(np.diff(at), np.diff(at))
        first[at[0] : at[-1]] = np.repeat(at[:-1], np.diff(at))
        # Blocks of entries whose partners together are about a million.
        block = np.cumsum(size) // 1_000_000
        for a, b in zip(*slices(block)):
            n = size[a:b]
            x = np.repeat(np.arange(a, b), n)
            y = np.repeat(first[a:b], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            x, y = x[x != y], y[x != y]
            value = f(p[x], p[y]) - f(p[x], zero[y]) - f(zero[x], p[y]) + f(zero[x], zero[y])
            code, which = np.unique((group[x] * len(names) + source[x]) * len(names) + source[y], return_inverse=True)
            total = np.zeros(len(code), np.int64)
            np.add.at(total, which, value)
            for c, v in zip(code.tolist(), total.tolist()):
                key = (lang_names[c // len(names) ** 2], names[c // len(names) % len(names)], names[c % len(names)])
                sums[key] = sums.get(key, 0) + v
        if len(sums) > 500_000:
            yield emit(sums)
            sums = {}
    if sums:
        yield emit(sums)


def _source_pairs(scored: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, item, value: the summed gap of every source to every other one of its language.

    Written with z for the share of a term that a source lacks, the sum over all V terms is V f(z, z), plus for each
    term of the source f(p, z) - f(z, z), plus for each term of the item f(z, q) - f(z, z), plus for terms of both
    f(p, q) - f(p, z) - f(z, q) + f(z, z). Only the last part looks at two sources of one term; the others need how
    often each share occurs in a source.
    """
    left = groups.select("lang", "source", F.col("zero").alias("z"), "n_terms")
    right = groups.select("lang", F.col("source").alias("item"), F.col("zero").alias("y"))
    base = left.join(right, "lang").where(F.col("source") != F.col("item")).select(
        "lang", "source", "item",
        F.when(F.col("n_terms") == 0, F.lit(0)).otherwise(F.col("n_terms") * gap(F.col("z"), F.col("y"))).cast("long").alias("value"))
    shares = scored.groupBy("lang", "source", "p", "zero").agg(F.count("*").alias("terms"))
    met = shares.join(right, "lang").where(F.col("source") != F.col("item"))
    p, z, y = F.col("p"), F.col("zero"), F.col("y")
    both = met.select("lang", F.explode(F.array(
        F.struct(F.col("source").alias("source"), F.col("item").alias("item"),
                 (F.col("terms") * (gap(p, y) - gap(z, y))).alias("value")),
        F.struct(F.col("item").alias("source"), F.col("source").alias("item"),
                 (F.col("terms") * (gap(y, p) - gap(y, z))).alias("value")))).alias("e")).select("lang", "e.*")
    lists = scored.groupBy("lang", "term").agg(F.collect_list(F.struct("source", "p", "zero")).alias("sources")).where(
        F.size("sources") > 1).select("lang", "sources")
    common = lists.mapInArrow(_common_terms, "lang string, source string, item string, value long")
    return base.union(both).union(common).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def source_divergence(docs: DataFrame, min_docs: int = 3, k: int = 200) -> DataFrame:
    """Ranked differences of every (lang, source): lang, source, part, item, value, rank.

    Part `pair` has every other source of the language, part `term` the `k` terms that are most over-represented
    against the language. A term's share is `share`, its contribution `gap`; both are integers, and ties go to the item
    that comes first in UTF-8. The gap grows with the group's count and falls with the language's, so a term that `k`
    others dominate in (group count, language count, UTF-8 order) is not among the first `k`: partitions keep their
    skybands, which are merged, and only those terms are ranked. Sources without a kept term still have pairs, with
    value 0 where the language keeps no term at all.

    Each row is a document, also with a null or repeated doc_id, and repeated rows count each. Null text, lang and source
    are empty strings. Very long texts are read whole. An empty table gives no rows. Other columns are not looked at.
    """
    terms = staged(kept_terms(docs, min_docs))
    flat = terms.select("lang", "term", F.col("n").alias("lang_n"), F.explode("sources").alias("s")).select(
        "lang", "term", "lang_n", "s.source", "s.n")
    langs = terms.groupBy("lang").agg(F.count("*").alias("n_terms"), F.sum("n").alias("lang_total"))
    sizes = flat.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    seen = _plain(docs).select("lang", "source").distinct()
    groups = seen.join(sizes, ["lang", "source"], "left").join(langs, "lang", "left").select(
        "lang", "source", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("total", "n_terms", "lang_total")])
    zero = F.when(F.col("n_terms") > 0, share(F.lit(0).cast("long"), F.col("total"), F.col("n_terms"))).otherwise(F.lit(1))
    groups = staged(groups.withColumn("zero", zero.cast("long")))

    p = share(F.col("n"), F.col("total"), F.col("n_terms"))
    q = share(F.col("lang_n"), F.col("lang_total"), F.col("n_terms"))
    scored = flat.join(groups, ["lang", "source"]).select("lang", "source", "term", "n", "lang_n", p.alias("p"), q.alias("q"), "zero")
    pairs = _source_pairs(scored.select("lang", "source", "term", "p", "zero"), groups).withColumn("part", F.lit("pair"))

    # What dominates an over-represented term is over-represented too, so the others need no place in the skybands.
    over = skybands(scored.where("p > q"), k).join(groups, ["lang", "source"]).select(
        "lang", "source", F.col("term").alias("item"), gap(p, q).alias("value"), F.lit("term").alias("part"))

    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), F.asc("item"))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.withColumn("rank", F.row_number().over(order)).select(*columns).union(
        over.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(*columns))
