"""Dropping lines that many documents share, as compressed keep bitmaps."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eavcube.llm.common import SPACES, lower_ascii, parts, quoted, staged, text_hash, unused

_RUNS = "kind int, h1 long, h2 long, doc_id long, row long, pos int, n_docs long, part int, first boolean"
_RUN_NAMES = [f.split()[0] for f in _RUNS.split(", ")]


def split_lines(text: Column) -> Column:
    """Lines of a text; null or empty text is one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_key(line: Column) -> Column:
    return lower_ascii(F.btrim(line, F.lit(SPACES)))


class _Run:
    """A line's rows as they pass: its documents so far, its first row, and rows that wait for enough documents."""

    def __init__(self, block: dict, at: int, edge: bool):
        self.key = block["h1"][at], block["h2"][at]
        self.lead = {c: block[c][at] for c in ("doc_id", "known", "row", "pos")}
        self.edge, self.n_docs, self.last, self.held = edge, 0, None, []


def _runs(min_docs: int, keep_first: bool):
    """Stream sorted (hash, document, position) rows of one range partition.

    Lines inside the partition are decided here; a line's rows wait until it has documents enough and then leave as they
    come. The first line may have begun in the partition before, so its rows leave undecided (kind 1) with a summary (kind
    2); so do those of the last one, unless it has documents enough already.
    """

    def rows(kind, block, mask, n_docs, first):
        n = int(mask.sum())
        columns = [np.full(n, kind, np.int32)] + [block[c][mask] for c in ("h1", "h2")]
        return pa.RecordBatch.from_arrays(
            [pa.array(c) for c in columns]
            + [pa.array(block["doc_id"][mask], mask=~block["known"][mask]), pa.array(block["row"][mask]),
               pa.array(block["pos"][mask].astype(np.int32)), pa.array(n_docs[mask].astype(np.int64)),
               pa.array(np.full(n, TaskContext.get().partitionId(), np.int32)), pa.array(first[mask])], _RUN_NAMES)

    def whole(block):
        """Rows to drop of a block of whole lines."""
        h1, h2 = block["h1"], block["h2"]
        new_run = np.ones(len(h1), bool)
        new_run[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        same_doc = np.zeros(len(h1), bool)
        same_doc[1:] = (~new_run[1:] & (block["doc_id"][1:] == block["doc_id"][:-1])
                        & (block["known"][1:] == block["known"][:-1]))
        run = np.cumsum(new_run) - 1
        n_docs = np.bincount(run, weights=~same_doc).astype(np.int64)[run]
        lead = np.flatnonzero(new_run)[run]
        first = np.ones(len(h1), bool)
        for c in ("doc_id", "known", "row", "pos"):
            first &= block[c] == block[c][lead]
        drop = (n_docs >= min_docs) & ~(first & keep_first)
        if drop.any():
            yield rows(0, block, drop, n_docs, first)

    def leave(run, kind, block):
        first = np.ones(len(block["h1"]), bool)
        for c, value in run.lead.items():
            first &= block[c] == value
        mask = ~first if kind == 0 and keep_first else np.ones(len(first), bool)
        if mask.any():
            yield rows(kind, block, mask, np.full(len(first), run.n_docs), first)

    def feed(run, block):
        """Further rows of a line."""
        new_doc = np.ones(len(block["h1"]), bool)
        new_doc[1:] = (block["doc_id"][1:] != block["doc_id"][:-1]) | (block["known"][1:] != block["known"][:-1])
        new_doc[0] = run.last != (block["doc_id"][0], block["known"][0])
        run.n_docs += int(new_doc.sum())
        run.last = block["doc_id"][-1], block["known"][-1]
        if run.edge:
            yield from leave(run, 1, block)
        elif run.n_docs >= min_docs:
            for held in [*run.held, block]:
                yield from leave(run, 0, held)
            run.held = []
        else:
            run.held.append(block)

    def close(run, end=False):
        """A line has no more rows in this partition; `end` if none follows it."""
        if end and not run.edge:
            for held in run.held:
                yield from leave(run, 1, held)
        if end or run.edge:
            one = {c: np.array([v]) for c, v in (("h1", run.key[0]), ("h2", run.key[1]), *run.lead.items())}
            yield rows(2, one, np.ones(1, bool), np.array([run.n_docs]), np.ones(1, bool))

    def stream(batches):
        run = None
        for batch in batches:
            if not batch.num_rows:
                continue
            block = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in ("h1", "h2", "row", "pos")}
            ids = batch.column("doc_id")
            block["known"] = ids.is_valid().to_numpy(zero_copy_only=False)
            block["doc_id"] = ids.fill_null(0).to_numpy(zero_copy_only=False)
            cut = lambda a, b: {c: v[a:b] for c, v in block.items()}
            starts = np.flatnonzero((block["h1"][1:] != block["h1"][:-1]) | (block["h2"][1:] != block["h2"][:-1])) + 1
            n = batch.num_rows
            lead = int(starts[0]) if len(starts) else n
            if run is not None and run.key != (block["h1"][0], block["h2"][0]):
                yield from close(run)
                run = _Run(block, 0, False)
            run = run or _Run(block, 0, True)
            yield from feed(run, cut(0, lead))
            if lead < n:
                yield from close(run)
                last = int(starts[-1])
                if lead < last:
                    yield from whole(cut(lead, last))
                run = _Run(block, last, False)
                yield from feed(run, cut(last, n))
        if run is not None:
            yield from close(run, True)

    return stream


def _bitmaps(batches):
    """Positions to drop as a keep bitmap (bit 1: keep) up to the last dropped line; later lines stay."""
    for batch in batches:
        maps, counts = [], []
        for positions in batch.column("positions"):
            dropped = np.unique(np.array(positions.as_py(), np.int64))
            bits = np.ones((dropped[-1] // 8 + 1) * 8, np.uint8)
            bits[dropped] = 0
            maps.append(zlib.compress(np.packbits(bits, bitorder="little").tobytes()))
            counts.append(len(dropped))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("row"), pa.array(counts, pa.int64()), pa.array(maps, pa.binary())],
            ["doc_id", "row", "n_dropped", "keep"])


def shared_line_bitmaps(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, keep: str = "none") -> DataFrame:
    """Keep bitmaps of the documents that lose lines: doc_id, row (hash of the text), n_dropped, keep (zlib bits).

    A line counts by its key (stripped, A-Z lower-cased); keys of at least `min_chars` code points that occur in at
    least `min_docs` documents lose all their lines, or with `keep="first"` all but the first by (doc_id, position).
    Line hashes are range-partitioned together with the document, so a line that half of all documents share is dealt
    over many tasks; only the two runs at the ends of a task are settled afterwards from one summary row each.

    Null text is one empty line. Rows with a null doc_id count as one document. Repeated rows count once. An empty
    table gives no bitmaps. Other columns are not looked at.
    """
    if keep not in ("none", "first"):
        raise ValueError("keep is none or first")
    lines = docs.select("doc_id", text_hash("text").alias("row"), F.posexplode(split_lines(F.col("text"))).alias("pos", "line"))
    key = line_key(F.col("line"))
    # Staged, because sampling the range bounds reads the hashes once more than the sort does.
    hashed = staged(lines.where(F.char_length(key) >= min_chars).select(
        F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2"), F.col("doc_id").cast("long"), "row", "pos"))
    ordered = hashed.repartitionByRange(parts(docs.sparkSession), "h1", "h2", "doc_id").sortWithinPartitions(
        "h1", "h2", "doc_id", "row", "pos")
    runs = staged(ordered.mapInArrow(_runs(min_docs, keep == "first"), _RUNS))
    # At most two summaries for each partition.
    totals = runs.where("kind = 2").groupBy("h1", "h2").agg(
        F.sum("n_docs").alias("total"), F.min("part").alias("first_part")).where(F.col("total") >= min_docs)
    edges = runs.where("kind = 1").join(F.broadcast(totals), ["h1", "h2"])
    if keep == "first":
        edges = edges.where(~(F.col("first") & (F.col("part") == F.col("first_part"))))
    drops = runs.where("kind = 0").select("doc_id", "row", "pos").union(edges.select("doc_id", "row", "pos"))
    grouped = drops.groupBy("doc_id", "row").agg(F.collect_list("pos").alias("positions"))
    return grouped.mapInArrow(_bitmaps, "doc_id long, row long, n_dropped long, keep binary")


@F.arrow_udf(T.StringType())
def _kept_lines(text: pa.Array, keep: pa.Array) -> pa.Array:
    out = []
    for t, b in zip(text, keep):
        if b.is_valid:
            lines = (t.as_py() or "").split("\n")
            bits = np.unpackbits(np.frombuffer(zlib.decompress(b.as_py()), np.uint8), bitorder="little")[: len(lines)]
            keepers = np.ones(len(lines), bool)
            keepers[: len(bits)] = bits
            out.append("\n".join(x for x, k in zip(lines, keepers) if k))
        else:
            out.append(t.as_py())
    return pa.array(out, pa.string())


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, text: str = "text", dropped: str = "n_dropped") -> DataFrame:
    """All rows and columns of `docs` with the kept lines in `text` and the number of lost lines in `dropped`.

    A column of `docs` with one of these two names is replaced, all others stay, whatever their names. Null ids, repeated
    rows and several texts under one id are told apart by (doc_id, text). A null text that loses nothing stays null.
    """
    doc, row, n, keep, out = unused(docs, "_b_doc", "_b_row", "_b_n", "_b_keep", "_b_text")
    marked = bitmaps.select(F.col("doc_id").alias(doc), F.col("row").alias(row), F.col("n_dropped").alias(n), F.col("keep").alias(keep))
    joined = docs.join(marked, docs["doc_id"].cast("long").eqNullSafe(F.col(doc)) & (text_hash(docs["text"]) == F.col(row)), "left")
    kept = joined.withColumn(out, _kept_lines(docs["text"], F.col(keep)))
    columns = [F.col(out).alias(text) if c == "text" == text else F.col(quoted(c)) for c in docs.columns
               if c != dropped and (c != text or text == "text")]
    if text != "text":
        columns.append(F.col(out).alias(text))
    return kept.select(*columns, F.coalesce(n, F.lit(0)).cast("long").alias(dropped))
