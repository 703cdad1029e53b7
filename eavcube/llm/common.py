"""What the operators share: settings, staged tables, text as numpy arrays, packed arrays."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eavcube.session import shared_folder, tune

# A Python worker holds one batch of texts at a time; one longer text makes a batch of its own.
RUNTIME = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "10000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
}
# The white space of all contracts, and the letters that are lower-cased.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def prepare(spark: SparkSession) -> SparkSession:
    tune(spark)
    for name, value in RUNTIME.items():
        spark.conf.set(name, value)
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def staged(df: DataFrame) -> DataFrame:
    """Write a frame to a new table in the folder all executors share and read it back: cuts lineage, survives losses."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def lower_ascii(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def text_hash(c: Column) -> Column:
    """Tells rows apart that share a doc_id; null and empty text differ."""
    return F.xxhash64(c)


def quoted(name: str) -> str:
    """A column name as it is, also with dots."""
    return "`" + name.replace("`", "``") + "`"


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, with underscores in front where the frame has such a column."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


# ---- texts of a batch as bytes

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[ord(c) for c in SPACES]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_A, _B, _M = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits."""
    x = (x ^ (x >> np.uint64(30))) * _B
    x = (x ^ (x >> np.uint64(27))) * _M
    return x ^ (x >> np.uint64(31))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts of an Arrow array as one byte array and the offsets of each; null counts as empty."""
    flat = texts.cast(pa.large_binary())
    if flat.null_count:
        flat = flat.fill_null(b"")
    offsets = np.frombuffer(flat.buffers()[1], np.int64)[flat.offset : flat.offset + len(flat) + 1]
    data = flat.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, document, start and end of every word, A-Z as a-z."""
    empty = np.zeros(0, np.int64)
    if not len(data):
        return empty.astype(np.uint64), empty, empty, empty
    word = ~_IS_SPACE[data]
    before = np.concatenate(([False], word[:-1]))
    after = np.concatenate((word[1:], [False]))
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    before[edges] = False
    after[edges - 1] = False
    start, end = np.flatnonzero(word & ~before), np.flatnonzero(word & ~after) + 1
    if not len(start):
        return empty.astype(np.uint64), empty, empty, empty
    length = end - start
    at = np.flatnonzero(word) - np.repeat(start, length)
    powers = np.ones(int(length.max()), np.uint64)
    powers[1:] = _A
    powers = np.multiply.accumulate(powers)
    sums = np.add.reduceat((_FOLD[data[word]].astype(np.uint64) + np.uint64(1)) * powers[at],
                           np.concatenate(([0], np.cumsum(length)[:-1])))
    return mix(sums + length.astype(np.uint64) * _M), np.searchsorted(offsets, start, "right") - 1, start, end


def _chain(words: np.ndarray, first: np.ndarray, k: int) -> np.ndarray:
    h = np.full(len(first), k, np.uint64)
    for j in range(k):
        h = mix(h * _A + words[first + j])
    return h


def shingle_sets(texts: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct k-word shingles of each text as 64-bit hashes, ascending within a text, and the offsets of each text.

    A text of fewer words has its whole sequence as one shingle; one without words has none.
    """
    data, offsets = text_bytes(texts)
    words, doc, _, _ = word_hashes(data, offsets)
    count = np.bincount(doc, minlength=len(texts))
    first = np.concatenate(([0], np.cumsum(count)[:-1])).astype(np.int64)
    full = np.flatnonzero(doc[: len(doc) - k + 1] == doc[k - 1 :]) if len(doc) >= k else np.zeros(0, np.int64)
    found, owner = [_chain(words, full, k)], [doc[full]]
    for short in range(1, k):
        own = np.flatnonzero(count == short)
        found.append(_chain(words, first[own], short))
        owner.append(own)
    h, d = np.concatenate(found), np.concatenate(owner)
    order = np.lexsort((h, d))
    h, d = h[order], d[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    h, d = h[new], d[new]
    return h, np.concatenate(([0], np.cumsum(np.bincount(d, minlength=len(texts))))).astype(np.int64)


# ---- arrays as bytes

def pack(values: np.ndarray, ascending: bool = False) -> bytes:
    """Compress an integer array byte plane by byte plane; ascending ones by their steps."""
    if ascending:
        values = np.diff(values, prepend=values.dtype.type(0))
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(blob: bytes, dtype, ascending: bool = False) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    size = np.dtype(dtype).itemsize
    values = np.ascontiguousarray(planes.reshape(size, -1).T).view(dtype).reshape(-1)
    return np.cumsum(values, dtype=dtype) if ascending else values


def slices(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of equal values in a sorted array."""
    if not len(keys):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    start = np.concatenate(([0], np.flatnonzero(keys[1:] != keys[:-1]) + 1))
    return start, np.concatenate((start[1:], [len(keys)]))
