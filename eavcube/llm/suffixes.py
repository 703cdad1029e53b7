"""Removing repeated byte strings: suffixes that can repeat are sorted to the string's length by deep-shallow sorting."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eavcube.llm.common import mix, pack, parts, slices, staged, text_bytes, text_hash, unpack

_BASE = np.uint64(0x9E3779B97F4A7C15)
_LAST = 2**63 - 1
# Window starts that are hashed at a time; places inside a piece fit the low bits of a hash.
_SLICE, _PLACE = 1 << 16, np.uint64(17)
# Entries of a slot are sorted in so many parts, one after the other, by further bits of the anchor's hash.
_PARTS = 64
_PACKED = "slot int, kind int, a binary, b binary, c binary, d binary, e binary"
_NAMES = [f.split()[0] for f in _PACKED.split(", ")]
_TYPES = [pa.int32(), pa.int32()] + [pa.binary()] * 5


# ---- anchors: one of the inner strings of every window of `length` bytes, chosen by the window's content alone

def _rolling(data: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k bytes at every place, from hashes of 1, 2, 4, ... bytes."""
    span, part, power = 1, data.astype(np.uint64) + np.uint64(1), np.array([_BASE])
    total, taken = None, 0
    while True:
        if k & span:
            n = len(data) - k + 1
            piece = part[taken : taken + n]
            total = piece.copy() if total is None else total * power + piece
            taken += span
        if span * 2 > k:
            return mix(total)
        part = part[:-span] * power + part[span:]
        power, span = power * power, span * 2


def _sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    span = 1
    while span * 2 <= width:
        values = pick(values[:-span], values[span:])
        span *= 2
    rest = width - span
    return pick(values[: len(values) - rest], values[rest:]) if rest else values


def anchors(data: np.ndarray, offsets: np.ndarray, length: int, k: int) -> tuple[np.ndarray, ...]:
    """Runs of window starts with one anchor: text, 47-bit hash of the anchor, first and last window start.

    The anchor of a window of `length` bytes is the leftmost of its k-byte strings with the smallest hash, so equal
    windows have equal anchors. Every window inside a text is in exactly one run.
    """
    width, found = length - k + 1, []
    for at in range(0, len(data) - length + 1, _SLICE):
        h = _rolling(data[at : at + _SLICE + length - 1], k)
        h = (h >> _PLACE << _PLACE) | np.arange(len(h), dtype=np.uint64)
        least = _sliding(h, width, np.minimum)
        start = np.arange(at, at + len(least))
        text = np.searchsorted(offsets, start, "right") - 1
        inside = np.flatnonzero(start + length <= offsets[text + 1])
        if not len(inside):
            continue
        least, start, text = least[inside], start[inside], text[inside]
        new = np.ones(len(start), bool)
        new[1:] = (least[1:] != least[:-1]) | (text[1:] != text[:-1])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(start)) - 1
        found.append((text[first], least[first] >> _PLACE, start[first], start[last]))
    if not found:
        none = np.zeros(0, np.int64)
        return none, none.astype(np.uint64), none, none
    return tuple(np.concatenate(x) for x in zip(*found))


# ---- rows that carry packed arrays to a slot

def _rows(rows: list) -> pa.Table:
    columns = zip(*rows) if rows else [[] for _ in _TYPES]
    return pa.table({n: pa.array(c, t) for n, c, t in zip(_NAMES, columns, _TYPES)})


def _cut(slot: np.ndarray, arrays: list, make) -> Iterator[tuple]:
    """Rows of the elements of each slot; elements keep their order."""
    order = np.argsort(slot, kind="stable")
    slot, arrays = slot[order], [a[order] for a in arrays]
    for a, b in zip(*slices(slot)):
        yield make(int(slot[a]), [x[a:b] for x in arrays])


def _doc_slot(doc: np.ndarray, slots: int) -> np.ndarray:
    return ((doc ^ (doc >> 17) ^ (doc >> 31)) % slots).astype(np.int64)


def _doc_slot_column(doc: Column, slots: int) -> Column:
    """The same of a column, where no multiplication can overflow."""
    return F.pmod(doc.bitwiseXOR(F.shiftright(doc, 17)).bitwiseXOR(F.shiftright(doc, 31)), F.lit(slots)).cast("int")


def _reply(slot: int, kind: int, arrays: list) -> tuple:
    doc, h, wide = arrays
    return slot, kind, pack(doc), pack(h), pack(wide), None, None


class _Texts:
    """The documents of a slot as bytes, without those that are copies of a document with a smaller id."""

    def __init__(self, docs: pa.Table, copies: pa.Table):
        gone = _copies(copies)
        keep = [i for i, x in enumerate(zip(docs.column("ord").to_pylist(), docs.column("row").to_pylist())) if x not in gone]
        docs = docs.take(keep).combine_chunks()
        self.ids, self.rows = docs.column("ord").to_numpy(), docs.column("row").to_numpy()
        texts = docs.column("text").combine_chunks() if docs.num_rows else pa.array([], pa.string())
        self.data, self.offsets = text_bytes(texts)


def _copies(rows: pa.Table) -> set[tuple[int, int]]:
    """Copies are told as rows of kind 2: document and row as decimal text."""
    return {(int(a), int(b)) for k, a, b in zip(*(rows.column(c).to_pylist() for c in ("kind", "a", "b"))) if k == 2}


def _send_anchors(length: int, k: int, slots: int):
    """Phase 1, each slot of documents: one document for every anchor goes to the anchor's slot (kind 0). Where several
    documents of the slot share an anchor, that is told to all of them at once (kind 1)."""

    def send(key, docs, copies):
        texts = _Texts(docs, copies)
        text, h, _, _ = anchors(texts.data, texts.offsets, length, k)
        if not len(h):
            return _rows([])
        doc = texts.ids[text]
        order = np.lexsort((doc, h))
        h, doc = h[order], doc[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
        h, doc = h[new], doc[new]
        start, end = slices(h)
        rows = list(_cut((h[start] % np.uint64(slots)).astype(np.int64), [h[start], doc[start]],
                         lambda s, x: (s, 0, pack(x[0], True), pack(x[1]), None, None, None)))
        several = np.repeat(end - start > 1, end - start)
        if several.any():
            own = doc[several], h[several], np.zeros(int(several.sum()), np.uint8)
            rows += _cut(_doc_slot(own[0], slots), list(own), lambda s, x: _reply(s, 1, x))
        return _rows(rows)

    return send


def _answer_anchors(slots: int, hot: int):
    """Phase 1, each slot: tell the documents of an anchor that others have it too, and whether it is a hot one."""

    def answer(key, group):
        kinds = group.column("kind").to_pylist()
        columns = [group.column(c).to_pylist() for c in "abcde"]
        rows = [(key[0].as_py(), 1, *(c[i] for c in columns)) for i, kind in enumerate(kinds) if kind == 1]
        own = [i for i, kind in enumerate(kinds) if kind == 0]
        if own:
            h = np.concatenate([unpack(columns[0][i], np.uint64, True) for i in own])
            doc = np.concatenate([unpack(columns[1][i], np.int64) for i in own])
            order = np.argsort(h, kind="stable")
            h, doc = h[order], doc[order]
            start, end = slices(h)
            shared = np.minimum.reduceat(doc, start) != np.maximum.reduceat(doc, start)
            size = end - start
            sel = np.repeat(shared, size)
            own = doc[sel], h[sel], np.repeat(size > hot, size)[sel].astype(np.uint8)
            rows += _cut(_doc_slot(own[0], slots), list(own), lambda s, x: _reply(s, 1, x))
        return _rows(rows)

    return answer


def _entries(slot: int, arrays: list) -> tuple:
    context, doc, row, place, count, part = arrays
    return (slot, 0, zstandard.ZstdCompressor(level=1).compress(context.tobytes()), pack(doc), pack(row), pack(place),
            pack((count | part << 16).astype(np.uint32)))


def _spans(slot: int, arrays: list) -> tuple:
    doc, row, start, end = arrays
    return slot, 1, pack(doc), pack(row), pack(start), pack(end), None


def _send_contexts(length: int, k: int, slots: int):
    """Phase 2, each slot of documents: the bytes of the windows around every shared anchor go to the anchor's slot,
    equal contexts once with their smallest document; of the others all windows repeat, which is told at once (kind 1).

    The windows of a hot anchor go out one by one to a slot of their own content, so no slot gathers all texts that
    share a frequent string.
    """
    size = 2 * length - k

    def send(key, docs, replies):
        told_rows = replies.filter(pa.compute.equal(replies.column("kind"), 1))
        if not docs.num_rows or not told_rows.num_rows:
            return _rows([])
        texts = _Texts(docs, replies)
        told = [np.concatenate([unpack(b, t) for b in told_rows.column(c).to_pylist()])
                for c, t in (("a", np.int64), ("b", np.uint64), ("c", np.uint8))]
        text, h, first, last = anchors(texts.data, texts.offsets, length, k)
        # Anchors that were told of, as hashed (document, anchor) pairs in one sorted array.
        pair = mix(told[0].view(np.uint64)) ^ told[1]
        order = np.argsort(pair, kind="stable")
        pair = pair[order]
        wanted = mix(texts.ids.view(np.uint64))[text] ^ h
        left, right = np.searchsorted(pair, wanted, "left"), np.searchsorted(pair, wanted, "right")
        hit = np.flatnonzero(right > left)
        text, h, first, last = text[hit], h[hit], first[hit], last[hit]
        # One document of the slot was told that an anchor is hot; it is hot for all of them.
        hot = np.isin(h, told[1][told[2] == 1])
        padded = np.concatenate((texts.data, np.zeros(size, np.uint8)))
        key_of = h
        if hot.any():
            own, cold = np.flatnonzero(hot), np.flatnonzero(~hot)
            n = last[own] - first[own] + 1
            each = np.repeat(own, n)
            at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + first[each]
            powers = np.multiply.accumulate(np.full(length, _BASE))
            content = np.concatenate([
                mix((padded[at[i : i + 50_000][:, None] + np.arange(length)].astype(np.uint64) * powers).sum(axis=1))
                for i in range(0, len(at), 50_000)])
            text = np.concatenate((text[cold], text[each]))
            first, last = np.concatenate((first[cold], at)), np.concatenate((last[cold], at))
            key_of = np.concatenate((h[cold], content))
        slot = (key_of % np.uint64(slots)).astype(np.int64)
        part = (key_of // np.uint64(slots) % np.uint64(_PARTS)).astype(np.int64)
        out, column = [], np.arange(size)
        for at in range(0, len(text), 100_000):
            t, a, z, to, p = (x[at : at + 100_000] for x in (text, first, last, slot, part))
            context = padded[a[:, None] + column]
            context[column >= (z - a + length)[:, None]] = 0
            doc, row, local, count = texts.ids[t], texts.rows[t], a - texts.offsets[t], z - a + 1
            # Equal contexts: the smallest document stands for all, with all places it has them at.
            same = np.column_stack((context, count.astype(np.uint16).view(np.uint8).reshape(-1, 2)))
            _, group = np.unique(np.ascontiguousarray(same).view(f"V{same.shape[1]}").reshape(-1), return_inverse=True)
            order = np.lexsort((doc, group))
            begin = np.flatnonzero(np.concatenate(([True], group[order][1:] != group[order][:-1])))
            least = np.repeat(doc[order][begin], np.diff(np.append(begin, len(order))))
            later, keep = order[doc[order] > least], order[doc[order] == least]
            out += _cut(to[keep], [x[keep] for x in (context, doc, row, local, count, p)], _entries)
            if len(later):
                found = merge_spans(doc[later], row[later], local[later], (local + count)[later] + length - 1)
                out += _cut(_doc_slot(found[0], slots), list(found), _spans)
        return _rows(out)

    return send


def merge_spans(doc, row, start, end) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of overlapping or touching spans of each (document, row)."""
    order = np.lexsort((start, row, doc))
    doc, row, start, end = doc[order], row[order], start[order], end[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (row[1:] != row[:-1])
    far = np.int64(max(end.max(initial=0), 1) + 1)
    shift = (np.cumsum(new) - 1) * far
    reach = np.maximum.accumulate(end + shift)
    new[1:] |= (start + shift)[1:] > reach[:-1]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(doc)) - 1
    return doc[first], row[first], start[first], (reach - shift)[last]


def equal_windows(context: np.ndarray, entry: np.ndarray, start: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Deep-shallow sort of the suffixes context[entry, start:] to `length` bytes: the suffixes that have an equal one,
    in order, and where each group of equals starts.

    Shallow: multikey quicksort on characters of eight bytes, two deep. Deep: the groups that are still together go into
    blind tries, all groups at once: a node skips the characters that its suffixes have in common and branches at the
    first that differs.
    """
    characters = (length + 7) // 8
    columns = context.shape[1]
    data = np.concatenate((context.reshape(-1), np.zeros(8, np.uint8)))
    # The eight bytes from every place on as a number, without a copy.
    flat = np.ndarray((len(data) - 7,), ">u8", data, strides=(1,))
    base = entry * columns + start

    def character(i: np.ndarray, depth: int) -> np.ndarray:
        c = flat[base[i] + 8 * depth].astype(np.uint64)
        extra = 8 * (depth + 1) - length
        return c >> np.uint64(8 * extra) if extra > 0 else c

    def groups(i: np.ndarray, new: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Without the groups of one."""
        first = np.flatnonzero(new)
        n = np.diff(np.append(first, len(i)))
        keep = np.repeat(n > 1, n)
        n = n[n > 1]
        return i[keep], np.cumsum(n) - n

    i = np.arange(len(base))
    c0 = character(i, 0)
    shallow = [c0] if characters == 1 else [character(i, 1), c0]
    order = np.lexsort(shallow) if characters > 1 else np.argsort(c0, kind="stable")
    new = np.zeros(len(i), bool)
    new[:1] = True
    for c in shallow:
        new[1:] |= c[order][1:] != c[order][:-1]
    i, first = groups(i[order], new)
    for depth in range(2, characters):
        if not len(i):
            break
        c = character(i, depth)
        n = np.diff(np.append(first, len(i)))
        node = np.repeat(np.arange(len(first)), n)
        branches = np.logical_or.reduceat(c != np.repeat(c[first], n), first)
        if not branches.any():
            continue
        own = np.flatnonzero(branches[node])
        order = np.lexsort((c[own], node[own]))
        i[own], c[own] = i[own][order], c[own][order]
        new = np.ones(len(i), bool)
        new[1:] = (node[1:] != node[:-1]) | (c[1:] != c[:-1])
        i, first = groups(i, new)
    return i, first


def _find_repeats(length: int, k: int, slots: int):
    """Phase 2, each slot of anchors: windows that also start in a smaller document, as merged spans."""
    size = 2 * length - k

    def find(key, group):
        kinds = group.column("kind").to_pylist()
        columns = [group.column(c).to_pylist() for c in "abcde"]
        rows = [(key[0].as_py(), 1, *(c[i] for c in columns)) for i, kind in enumerate(kinds) if kind == 1]
        own = [i for i, kind in enumerate(kinds) if kind == 0]
        if own:
            context = np.concatenate([np.frombuffer(zstandard.ZstdDecompressor().decompress(columns[0][i]), np.uint8) for i in own]).reshape(-1, size)
            doc, row, place = (np.concatenate([unpack(columns[j][i], np.int64) for i in own]) for j in (1, 2, 3))
            counts = np.concatenate([unpack(columns[4][i], np.uint32) for i in own]).astype(np.int64)
            del columns
            order = np.argsort(counts >> 16, kind="stable")
            told = []
            for a, z in zip(*slices((counts >> 16)[order])):
                mine = order[a:z]
                n = counts[mine] & 0xFFFF
                entry = np.repeat(np.arange(len(mine)), n)
                start = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                i, first = equal_windows(context[mine], entry, start, length)
                if len(i):
                    ids = doc[mine[entry[i]]]
                    least = np.repeat(np.minimum.reduceat(ids, first), np.diff(np.append(first, len(i))))
                    i = i[ids > least]
                if len(i):
                    e = mine[entry[i]]
                    at = place[e] + start[i]
                    told.append(merge_spans(doc[e], row[e], at, at + length))
            if told:
                found = merge_spans(*(np.concatenate(c) for c in zip(*told)))
                rows += _cut(_doc_slot(found[0], slots), list(found), _spans)
        return _rows(rows)

    return find


_RESULT = "doc_id long, n_bytes long, spans array<struct<start: long, end: long>>, kept binary"


def _apply_spans(key, docs, found):
    """Remove the spans of every document of a slot."""
    own: dict = {}
    copies = _copies(found)
    found = found.filter(pa.compute.equal(found.column("kind"), 1))
    if found.num_rows:
        arrays = [np.concatenate([unpack(b, np.int64) for b in found.column(c).to_pylist()]) for c in "abcd"]
        doc, row, start, end = merge_spans(*arrays)
        for d, r, a, b in zip(doc.tolist(), row.tolist(), start.tolist(), end.tolist()):
            own.setdefault((d, r), []).append((a, b))
    out = []
    for doc_id, d, r, text in zip(*(docs.column(c).to_pylist() for c in ("doc_id", "ord", "row", "text"))):
        data, kept, last = (text or "").encode(), [], 0
        spans = [(0, len(data))] if (d, r) in copies else own.get((d, r), [])
        for a, b in spans:
            kept.append(data[last:a])
            last = b
        out.append((doc_id, len(data), [{"start": a, "end": b} for a, b in spans], b"".join(kept) + data[last:]))
    types = [pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.binary()]
    names = ["doc_id", "n_bytes", "spans", "kept"]
    columns = list(zip(*out)) if out else [[]] * 4
    return pa.table({n: pa.array(c, t) for n, c, t in zip(names, columns, types)})


def remove_repeats(docs: DataFrame, length: int = 50, hot: int = 50_000, slots: int | None = None) -> DataFrame:
    """Remove every byte covered by a `length`-byte string that also starts in a document with a smaller doc_id:
    doc_id, n_bytes, spans (maximal removed runs as byte offsets), kept (the remaining bytes).

    A suffix array of all bytes would shuffle each byte `length` times. Only suffixes that can have an equal are
    sorted: every window of `length` bytes has an anchor, an inner string picked by content alone, so equal windows
    share one. Phase 1 finds the anchors that two documents have; phase 2 sorts the windows around those by deep-shallow
    sorting. Texts are shuffled once, by document, and all phases use that shuffle. Copies of a whole document are found
    by their hash before and take no part.

    In each slot equal anchors and equal contexts are sent once, so near copies do not pile up; anchors of more than
    `hot` senders are split by window content. The windows of a slot are sorted part by part, so a task holds the sorted
    windows of one part only. Results do not depend on `hot` or `slots`.

    Null text is empty. A null doc_id comes after all others. Rows with equal doc_id do not repeat each other; repeated
    rows get the same result. Texts shorter than `length` stay. Other columns are not looked at.
    """
    if length < 2:
        raise ValueError("length is 2 at least")
    spark = docs.sparkSession
    k = length // 2
    slots = slots or parts(spark) | 1
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("ord"),
        text_hash("text").alias("row"), "text")
    rows = rows.withColumn("slot", _doc_slot_column(F.col("ord"), slots))
    copies = _whole_copies(rows, length)
    none = F.lit(None).cast("binary")
    copies = copies.select(
        _doc_slot_column(F.col("ord"), slots).alias("slot"), F.lit(2).alias("kind"),
        F.col("ord").cast("string").cast("binary").alias("a"), F.col("row").cast("string").cast("binary").alias("b"),
        none.alias("c"), none.alias("d"), none.alias("e"))
    texts = rows.groupBy("slot")
    told = texts.cogroup(copies.groupBy("slot")).applyInArrow(_send_anchors(length, k, slots), _PACKED)
    told = told.groupBy("slot").applyInArrow(_answer_anchors(slots, hot), _PACKED).union(copies)
    contexts = texts.cogroup(told.groupBy("slot")).applyInArrow(_send_contexts(length, k, slots), _PACKED)
    spans = contexts.groupBy("slot").applyInArrow(_find_repeats(length, k, slots), _PACKED).union(copies)
    return texts.cogroup(spans.groupBy("slot")).applyInArrow(_apply_spans, _RESULT)


def _whole_copies(rows: DataFrame, length: int) -> DataFrame:
    """Rows whose whole text, of `length` bytes or more, is also that of a document with a smaller id: ord, row."""
    thin = staged(rows.where(F.octet_length("text") >= length).select(
        "ord", "row", F.xxhash64(F.lit(1), "text").alias("again"), F.octet_length("text").alias("bytes")))
    least = staged(thin.groupBy("row", "again", "bytes").agg(F.min("ord").alias("least"), F.max("ord").alias("most"))
                   .where("most > least").select(F.col("row").alias("_row"), F.col("again").alias("_again"), "bytes", "least"))
    same = (thin["row"] == least["_row"]) & (thin["again"] == least["_again"]) & (thin["bytes"] == least["bytes"])
    return staged(thin.join(least, same).where("ord > least").select("ord", "row").distinct())
