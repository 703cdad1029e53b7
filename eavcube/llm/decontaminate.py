"""Finding benchmark items inside documents by MinHash containment, verified on all shingles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eavcube.llm.common import mix, shingle_sets, staged, text_bytes, text_hash, unused, word_hashes

_HITS = "item_id long, doc_id long, row long, n_shingles long, n_found long"


def sketch_size(n: int, percent: int) -> int:
    """MinHash values that are enough for an item of n shingles: a document that holds `percent` of them misses at most
    n - ceil(percent * n / 100), so one of these more must be in it."""
    return n - (percent * n + 99) // 100 + 1


def _item_sets(words: int):
    def sets(batches):
        for batch in batches:
            h, at = shingle_sets(batch.column("text"), words)
            data, offsets = text_bytes(batch.column("text"))
            n_words = np.bincount(word_hashes(data, offsets)[1], minlength=batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column("item_id"), pa.LargeListArray.from_arrays(pa.array(at), pa.array(h.view(np.int64))).cast(pa.list_(pa.int64())),
                 pa.array(np.where(n_words < words, n_words, 0).astype(np.int32))], ["item_id", "shingles", "short"])

    return sets


def _blocks(items: DataFrame, words: int, limit: int) -> Iterator[list]:
    """The items, streamed through the driver, in blocks of about `limit` shingles."""
    held, size = [], 0
    shaped = items.select(F.col("item_id").cast("long"), "text").where("item_id is not null").mapInArrow(
        _item_sets(words), "item_id long, shingles array<long>, short int")
    for row in shaped.toLocalIterator():
        if row[1]:
            held.append((row[0], np.array(row[1], np.int64).view(np.uint64), row[2]))
            size += len(row[1])
        if size >= limit:
            yield held
            held, size = [], 0
    if held:
        yield held


class _Index:
    """Sketches of one block of items by size partition, and their whole sets; items of fewer words than a shingle by
    their number of words."""

    def __init__(self, items: list, percent: int):
        self.short = {}
        for k in sorted({k for _, _, k in items if k}):
            own = sorted((int(s[0]), i) for i, s, n in items if n == k)
            self.short[k] = np.array([h for h, _ in own], np.uint64), np.array([i for _, i in own], np.int64)
        items = [(i, s) for i, s, k in items if not k]
        self.ids = np.array([i for i, _ in items], np.int64)
        self.sizes = np.array([len(s) for _, s in items], np.int64)
        self.shingles = np.concatenate([s for _, s in items] or [np.zeros(0, np.uint64)])
        self.starts = np.concatenate(([0], np.cumsum(self.sizes)[:-1]))
        keys, owners = [], []
        # Size partitions: all items of a power of two share one sketch length, that of the largest.
        partition = np.floor(np.log2(self.sizes)).astype(int)
        for p in np.unique(partition):
            own = np.flatnonzero(partition == p)
            length = max(sketch_size(int(n), percent) for n in self.sizes[own])
            for i in own:
                s = items[i][1]
                small = s[np.argsort(mix(s), kind="stable")[:length]]
                keys.append(small)
                owners.append(np.full(len(small), i))
        keys, owners = np.concatenate(keys or [np.zeros(0, np.uint64)]), np.concatenate(owners or [np.zeros(0, np.int64)])
        order = np.argsort(keys, kind="stable")
        self.keys, self.owners = keys[order], owners[order]

    def candidates(self, h: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(document, item) pairs with a common sketch value."""
        low, high = np.searchsorted(self.keys, h, "left"), np.searchsorted(self.keys, h, "right")
        hit = np.flatnonzero(high > low)
        n = high[hit] - low[hit]
        at = np.repeat(low[hit], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        pairs = np.unique(np.stack((np.repeat(doc[hit], n), self.owners[at])), axis=1) if len(hit) else np.zeros((2, 0), np.int64)
        return pairs[0], pairs[1]


def _scan(parts, words: int, percent: int):
    def scan(batches):
        index = _Index.__new__(_Index)
        index.__dict__.update(parts.value)
        for batch in batches:
            h, at = shingle_sets(batch.column("text"), words)
            doc = np.repeat(np.arange(batch.num_rows), np.diff(at))
            rows, items = index.candidates(h, doc)
            ids, hashes = batch.column("doc_id").to_pylist(), batch.column("row").to_pylist()
            out = []
            for k, (keys, owners) in index.short.items():
                runs, ends = shingle_sets(batch.column("text"), k)
                low, high = np.searchsorted(keys, runs, "left"), np.searchsorted(keys, runs, "right")
                for at_ in np.flatnonzero(high > low):
                    d = int(np.searchsorted(ends, at_, "right")) - 1
                    out += [(int(i), ids[d], hashes[d], 1, 1) for i in owners[low[at_] : high[at_]]]
            for d, i in zip(rows, items):
                own = index.shingles[index.starts[i] : index.starts[i] + index.sizes[i]]
                here = h[at[d] : at[d + 1]]
                place = np.searchsorted(here, own)
                n = int((here[np.minimum(place, len(here) - 1)] == own).sum())
                if 100 * n >= percent * len(own):
                    out.append((int(index.ids[i]), ids[d], hashes[d], len(own), n))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)],
                                                 [f.split()[0] for f in _HITS.split(", ")])

    return scan


def find_contained(docs: DataFrame, items: DataFrame, words: int = 5, percent: int = 80, block: int = 2_000_000) -> DataFrame:
    """Items of which a document holds at least `percent` of the distinct `words`-word shingles:
    item_id, doc_id, n_shingles, n_found, containment.

    Items are partitioned by set size; each partition has its own MinHash sketch length, long enough that no item above
    the threshold is missed however long the document is. Documents look up their shingles among the sketches, and
    candidates are verified on the item's whole set. Items go out in blocks of about `block` shingles, so what is
    broadcast is bounded; each block is one scan of the documents, without a shuffle.

    A-Z count as a-z. An item of fewer words is one shingle of all its words, looked up among the documents' runs of as
    many words. Null or wordless texts have no shingles and are never found. Rows with a null item_id are no items; a null
    doc_id is returned as null. Repeated rows give one result row. Empty tables give no rows; other columns are not
    looked at.
    """
    return _find(docs, items, words, percent, block).drop("row").distinct()


def _find(docs: DataFrame, items: DataFrame, words: int, percent: int, block: int = 2_000_000) -> DataFrame:
    """`find_contained` with the hash of the text in `row`, which tells rows of one doc_id apart."""
    docs = docs.select(F.col("doc_id").cast("long"), "text", text_hash("text").alias("row"))
    spark, found = docs.sparkSession, None
    for held in _blocks(items, words, block):
        parts = spark.sparkContext.broadcast(vars(_Index(held, percent)))
        part = docs.mapInArrow(_scan(parts, words, percent), _HITS)
        found = part if found is None else found.union(part)
    if found is None:
        found = spark.createDataFrame([], _HITS)
    ratio = F.col("n_found") / F.col("n_shingles")
    return found.distinct().withColumn("containment", ratio.cast("double"))


def decontaminate(docs: DataFrame, items: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of `docs` that hold no benchmark item, with all their columns, whatever their names.

    Rows are told apart by (doc_id, text), so a clean text stays that shares its id, or the lack of one, with a leaking
    one, and copies of a leaking row all go. Null, empty and very long texts: see `find_contained`.
    """
    doc, row = unused(docs, "_l_doc", "_l_row")
    leaks = staged(_find(docs, items, words, percent).select(F.col("doc_id").alias(doc), F.col("row").alias(row)).distinct())
    return docs.join(leaks, docs["doc_id"].cast("long").eqNullSafe(F.col(doc)) & (text_hash(docs["text"]) == F.col(row)), "left_anti")
