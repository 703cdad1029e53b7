"""Quality scores from compressed sizes: texts are compressed with a dictionary of good and one of bad text."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eavcube.llm.common import staged

LEVEL = 3
# Bytes compressed at a time, so that the dictionary and not the text itself is what helps: long texts compare with
# short ones, whose sizes are those of one block.
BLOCK = 512


@dataclass(frozen=True)
class Model:
    """Raw zstandard dictionaries and the calibration of the sizes they give; without dictionaries all scores are 0.5."""

    good: bytes = b""
    bad: bytes = b""
    low: tuple = ()
    high: tuple = ()
    mean: tuple = ()
    scale: tuple = ()
    weights: tuple = ()


def held_out(doc_id: Column) -> Column:
    """A third of the documents, by the checksum of their id, whose labels are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _compressors(good: bytes, bad: bytes) -> list:
    out = [zstandard.ZstdCompressor(level=LEVEL)]
    for raw in (good, bad):
        words = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        words.precompute_compress(level=LEVEL)
        out.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=words))
    return out


def _sizes(text: str | None, tools: list) -> list[float]:
    """Normalised difference of the two compressed sizes, and compression without a dictionary."""
    data = (text or "").encode()
    sizes = [0, 0, 0]
    for at in range(0, len(data) or 1, BLOCK):
        piece = data[at : at + BLOCK]
        for i, tool in enumerate(tools):
            sizes[i] += len(tool.compress(piece))
    plain, good, bad = sizes
    return [(bad - good) / (bad + good), min(plain / max(len(data), 1), 2.0)]


def _features(sizes: np.ndarray, low: tuple, high: tuple) -> np.ndarray:
    """Both sizes and their products. Values beyond those of the calibration count as the nearest one, because the
    squares mean nothing there."""
    d, r = np.clip(sizes.reshape(-1, 2), low, high).T
    return np.column_stack((d, r, d * d, r * r, d * r))


def _sampled(labels: DataFrame, sample: int) -> tuple[DataFrame, dict]:
    """At most `sample` labelled documents of each class, by the smallest hash of their id, and the size of each class."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("most"))
    known = staged(known.where("quality = most").select(
        "doc_id", "quality", F.xxhash64(F.lit("quality"), "doc_id").alias("hash")))
    sizes = {q: n for q, n in known.groupBy("quality").count().collect()}
    picked = None
    for q, n in sorted(sizes.items()):
        # A bound that leaves a few more than the sample, so that tasks do not send `sample` rows each.
        bound = min(1.0, (sample + 6 * sample**0.5 + 10) / n)
        near = known.where((F.col("quality") == q) & (F.col("hash") <= min(int(bound * 2**64) - 2**63, 2**63 - 1)))
        part = near.orderBy("hash").limit(sample)
        picked = part if picked is None else picked.union(part)
    return (staged(picked) if picked is not None else known), sizes


def _cut(blocks: int, size: int):
    """Up to `blocks` pieces of each text, from all over it."""

    def cut(batches):
        for batch in batches:
            out = []
            for q, h, text in zip(*(batch.column(c).to_pylist() for c in ("quality", "hash", "text"))):
                data = (text or "").encode()
                rng = np.random.default_rng(h & 0x7FFFFFFF)
                for i in range(blocks if len(data) > size else 1):
                    at = int(rng.integers(0, max(1, len(data) - size)))
                    out.append((q, h, i, data[at : at + size]))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), pa.int64(), pa.int32(), pa.binary()))],
                    ["quality", "hash", "n", "piece"])

    return cut


def _measure(good: bytes, bad: bytes):
    def measure(batches):
        tools = _compressors(good, bad)
        for batch in batches:
            rows = [_sizes(t, tools) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("quality"), batch.column("hash"), pa.array(rows, pa.list_(pa.float64()))],
                                             ["quality", "hash", "sizes"])

    return measure


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple:
    """Weighted logistic regression with a unit ridge, by damped Newton steps."""
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    a = np.column_stack((np.ones(len(x)), (x - mean) / scale))
    ridge = np.diag([0.0] + [1.0] * x.shape[1])

    def loss(b):
        z = a @ b
        return float((weight * (np.logaddexp(0, z) - y * z)).sum() + b @ ridge @ b / 2)

    b = np.zeros(a.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a @ b, -30, 30)))
        gradient = a.T @ (weight * (p - y)) + ridge @ b
        step = np.linalg.solve((a.T * (weight * p * (1 - p))) @ a + ridge + 1e-9 * np.eye(len(b)), gradient)
        size = 1.0
        while loss(b - size * step) > loss(b) and size > 1e-6:
            size /= 2
        b = b - size * step
        if np.abs(size * step).max() < 1e-8:
            break
    return tuple(mean.tolist()), tuple(scale.tolist()), tuple(b.tolist())


def fit(docs: DataFrame, labels: DataFrame, sample: int = 3000, pieces: int = 2, piece_bytes: int = 512,
        dictionary_bytes: int = 1 << 19) -> Model:
    """Learn from labelled rows that are not held out: at most `sample` documents of each class, two thirds of them for
    the dictionaries (`pieces` cuts of `piece_bytes` each, at most `dictionary_bytes` a class), the others, whole, for
    the calibration, weighted back to the size of each class.

    Labels other than 0 and 1, null ids and documents with conflicting labels are not learned from. If a class is
    missing the model is empty.
    """
    picked, sizes = _sampled(labels.select("doc_id", "quality"), sample)
    if len(sizes) < 2:
        return Model()
    # At most 2 * sample short rows.
    picked = picked.select(F.col("doc_id").alias("_id"), F.col("quality").cast("int").alias("quality"), "hash")
    texts = docs.select("doc_id", "text").join(F.broadcast(picked), F.col("doc_id") == F.col("_id")).select("quality", "hash", "text")
    into_dictionary = F.pmod(F.xxhash64("hash"), F.lit(3)) != 0
    cuts = texts.where(into_dictionary).mapInArrow(_cut(pieces, piece_bytes), "quality int, hash long, n int, piece binary").collect()
    cuts.sort(key=lambda r: (r["hash"], r["n"], r["piece"]))
    good, bad = (b"".join(bytes(r["piece"]) for r in cuts if r["quality"] == q)[-dictionary_bytes:] for q in (1, 0))
    if not good or not bad:
        return Model()
    rows = texts.where(~into_dictionary).mapInArrow(_measure(good, bad), "quality int, hash long, sizes array<double>").collect()
    rows.sort(key=lambda r: (r["hash"], r["sizes"]))
    y = np.array([float(r["quality"]) for r in rows])
    if len(set(y.tolist())) < 2:
        return Model()
    share = {q: sizes[int(q)] / (y == q).sum() for q in (0.0, 1.0)}
    weight = np.array([share[q] for q in y])
    measured = np.array([r["sizes"] for r in rows])
    low, high = tuple(measured.min(axis=0).tolist()), tuple(measured.max(axis=0).tolist())
    return Model(good, bad, low, high, *_logistic(_features(measured, low, high), y, weight * len(y) / weight.sum()))


def quality_score(text: Column, model: Model) -> Column:
    """Score of whole texts from 0 to 1, higher where label 1 is likelier. Null text counts as empty text."""
    if not model.weights:
        return F.lit(0.5)
    held: dict = {}

    def score(texts: pa.Array) -> pa.Array:
        if not held:
            held["tools"] = _compressors(model.good, model.bad)
        x = _features(np.array([_sizes(t.as_py(), held["tools"]) for t in texts]), model.low, model.high)
        z = model.weights[0] + ((x - np.array(model.mean)) / np.array(model.scale)) @ np.array(model.weights[1:])
        return pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30))))

    return F.arrow_udf(score, T.DoubleType())(text)


def keep_good(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of `docs` whose score is at least 0.5."""
    return docs.where(quality_score(F.col("text"), fit(docs, labels, **options)) >= 0.5)
