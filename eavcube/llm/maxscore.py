"""Exact top-k by integer inner product, with MaxScore bounds in each shard of the vectors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eavcube.llm.common import staged

# Doubles hold integers up to here exactly.
EXACT = 2.0**53
# Vectors whose posting lists are made together, and non-essential terms that are probed together.
_BLOCK, _PROBE = 4096, 8
_LARGE = 2.0**20
_FOUND = "query_id long, vec_id long, score long"


def whole_vectors(ids: pa.Array, vectors: pa.Array, scale: float) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Ids and floor(scale * x) of usable vectors, by dimension. Null ids and null or non-finite parts drop a row."""
    lengths = np.diff(vectors.offsets.to_numpy())
    flat = vectors.values.slice(vectors.offsets[0].as_py(), int(lengths.sum()))
    values = flat.to_numpy(zero_copy_only=False).astype(np.float64)  # nulls become NaN
    starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    usable = ids.is_valid().to_numpy(zero_copy_only=False) & vectors.is_valid().to_numpy(zero_copy_only=False)
    numbers = ids.fill_null(0).to_numpy(zero_copy_only=False)
    out = {}
    for d in np.unique(lengths[usable]):
        rows = np.flatnonzero(usable & (lengths == d))
        block = values[(starts[rows][:, None] + np.arange(d)).reshape(-1)].reshape(len(rows), d)
        fine = np.isfinite(block).all(axis=1)
        out[int(d)] = numbers[rows[fine]], np.floor(scale * block[fine])
    return out


def _blocks(vectors: DataFrame, scale: float, size: int) -> Iterator[dict]:
    """The queries in blocks of at most `size`, streamed through the driver."""
    ids, parts = [], []

    def block():
        return whole_vectors(pa.array(ids, pa.int64()), pa.array(parts, pa.list_(pa.float64())), scale)

    for row in vectors.toLocalIterator():
        ids.append(row[0])
        parts.append(row[1])
        if len(ids) == size:
            yield block()
            ids, parts = [], []
    if ids:
        yield block()


class _Postings:
    """A block of vectors by term: for each dimension its range, and the vectors in which it is above or below 0."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        self.low, self.high = vectors.min(axis=0, initial=0), vectors.max(axis=0, initial=0)
        self.above, self.below = np.asfortranarray(vectors > 0), np.asfortranarray(vectors < 0)
        self.largest = np.abs(vectors).max(initial=0)
        self.whole = None

    def containing(self, term: int, weight: float) -> np.ndarray:
        """The posting list of a term as a mask: the vectors whose score it raises."""
        return (self.above if weight > 0 else self.below)[:, term]


def _maxscore(query: np.ndarray, block: _Postings, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Places and scores of the vectors of a block that can reach `least`, the k-th best score so far.

    Terms are taken by their bounds, the highest contribution each can have in the block. The last ones, whose bounds
    together stay below `least`, are non-essential: a vector that none of the other terms raises cannot reach it. The
    posting lists of the essential terms give the candidates; further terms are added a few at a time, for those that
    their bounds still leave competitive.
    """
    bound = np.maximum(query * block.low, query * block.high)
    order = np.argsort(-bound, kind="stable")
    after = np.concatenate((np.cumsum(bound[order][::-1])[::-1], [0.0]))
    raising = np.concatenate((np.cumsum(np.maximum(bound[order], 0)[::-1])[::-1], [0.0]))
    essential = int(np.argmax(raising < least)) if raising[-1] < least else len(order)
    if essential < len(order):
        found = np.zeros(len(block.ids), bool)
        for term in order[:essential]:
            found |= block.containing(term, query[term])
        place = np.flatnonzero(found)
    else:
        place = np.arange(len(block.ids))
    score, at, step = np.zeros(len(place)), 0, max(essential, 1)
    while at < len(order) and len(place):
        terms = order[at : at + step]
        score += block.vectors[np.ix_(place, terms)] @ query[terms] if len(place) < len(block.ids) else block.vectors[:, terms] @ query[terms]
        at, step = at + len(terms), _PROBE
        competitive = score + after[at] >= least
        if not competitive.all():
            place, score = place[competitive], score[competitive]
    return place, score


def _exact(query: np.ndarray, block: _Postings) -> np.ndarray:
    """Scores that doubles may not hold, as Python integers, saturated in a long."""
    whole = np.frompyfunc(int, 1, 1)
    if block.whole is None:
        block.whole = whole(block.vectors)
    score = block.whole @ whole(query) if len(query) else np.zeros(len(block.ids), object)
    return np.array([max(-(2**63), min(2**63 - 1, int(s))) for s in score], np.int64)


def _shard(queries: dict, k: int, scale: float):
    def search(batches):
        best = {(d, i): (np.zeros(0, np.int64), np.zeros(0, np.int64)) for d in queries for i in range(len(queries[d][0]))}
        for batch in batches:
            for d, (vid, v) in whole_vectors(batch.column(0), batch.column(1), scale).items():
                if d not in queries:
                    continue
                # Vectors so large that scores may pass what doubles hold keep to themselves.
                large = np.abs(v).max(axis=1, initial=0) >= _LARGE
                parts = [(vid[own][low : low + _BLOCK], v[own][low : low + _BLOCK]) for own in (~large, large)
                         for low in range(0, int(own.sum()), _BLOCK)]
                for block in (_Postings(*part) for part in parts):
                    for i, (qid, q) in enumerate(zip(*queries[d])):
                        ids, scores = best[d, i]
                        if np.abs(q).max(initial=0) * block.largest * max(d, 1) >= EXACT:
                            place, score = np.arange(len(block.ids)), _exact(q, block)
                        else:
                            place, score = _maxscore(q, block, float(scores.min()) if len(scores) >= k else -np.inf)
                        other = block.ids[place] != qid
                        ids = np.concatenate((ids, block.ids[place][other]))
                        scores = np.concatenate((scores, score[other].astype(np.int64)))
                        order = np.lexsort((ids, _descending(scores)))[:k]
                        best[d, i] = ids[order], scores[order]
        for (d, i), (ids, scores) in best.items():
            if len(ids):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), queries[d][0][i])), pa.array(ids), pa.array(scores)],
                                                 [f.split()[0] for f in _FOUND.split(", ")])

    return search


def _descending(scores: np.ndarray) -> np.ndarray:
    """A sort key for the highest first; unlike a minus sign it holds for the lowest long."""
    return ~scores


def exact_top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, scale: float = 256.0, block: int = 8192) -> DataFrame:
    """The k vectors with the highest integer inner product for each query: query_id, rank, vec_id, score.

    Both frames have vec_id and embedding; components become floor(scale * x). Queries go out in blocks of at most
    `block` rows; each task is a shard, finds its k best of each query with `_maxscore` and hands those to the merge.
    Scores are exact integers, in doubles as long as these hold them. A query's own vec_id is no candidate; ties go to
    the smaller vec_id. Null ids, null vectors and vectors with null or non-finite parts take no part; vectors of another
    length score nothing; scores beyond a long are saturated. A query row that occurs again is the same query; different
    vectors of one query id compete for its k ranks. Repeated rows of one candidate fill several ranks. No queries give
    no rows. The result does not depend on `block`.
    """
    vectors = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"))
    queries = queries.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>")).distinct()
    merged = None
    for part in _blocks(queries, scale, block):
        part = {d: x for d, x in part.items() if len(x[0])}
        found = staged(vectors.mapInArrow(_shard(part, k, scale), _FOUND))
        merged = found if merged is None else merged.union(found)
    if merged is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    by_query = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = merged.withColumn("rank", F.row_number().over(by_query)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
