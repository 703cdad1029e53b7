"""Personal data: patterns, and terms that give protected values away by their co-occurrence in the corpus."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eavcube.llm.common import mix, slices, staged, text_bytes

# The kinds in their order. The patterns are those of the contract, with possessive or anchored parts
# that match the same text in linear time.
KINDS = ("email", "ip", "card", "phone", "term")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]")

SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.IntegerType()), T.StructField("start", T.IntegerType()),
                                  T.StructField("end", T.IntegerType())]))
_SPANS = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of emails, IPs, cards and phones, leftmost and non-overlapping within a kind."""
    out, last = [], 0
    if "@" in text:
        for m in _DOMAIN.finditer(text):
            at = start = m.start()
            while start > last and text[start - 1] in _LOCAL:
                start -= 1
            if start < at:
                out.append((0, start, m.end()))
                last = m.end()
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append((1, m.start(), m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(digits := "".join(_DIGITS.findall(m[0]))) <= 19 and luhn(digits):
            out.append((2, m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_DIGITS.findall(m[0])) <= 15:
                out.append((3, m.start(), m.end()))
    return out


# Terms are runs of ASCII letters and digits and of all other Unicode text, A-Z as a-z.
_TERM = np.zeros(256, bool)
_TERM[48:58] = _TERM[65:91] = _TERM[97:123] = _TERM[128:] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, text, start and end byte of every term."""
    inside = _TERM[data] if len(data) else np.zeros(0, bool)
    before, after = np.concatenate(([False], inside[:-1])), np.concatenate((inside[1:], [False]))
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    if len(data):
        before[edges] = False
        after[edges - 1] = False
    start, end = np.flatnonzero(inside & ~before[: len(inside)]), np.flatnonzero(inside & ~after[: len(inside)]) + 1
    if not len(start):
        return np.zeros(0, np.uint64), start, start, start
    length = end - start
    at = np.flatnonzero(inside) - np.repeat(start, length)
    powers = np.ones(int(length.max()), np.uint64)
    powers[1:] = _STEP
    powers = np.multiply.accumulate(powers)
    sums = np.add.reduceat((_FOLD[data[inside]].astype(np.uint64) + np.uint64(1)) * powers[at],
                           np.concatenate(([0], np.cumsum(length)[:-1])))
    return mix(sums + length.astype(np.uint64)), np.searchsorted(offsets, start, "right") - 1, start, end


def _hash_of(text: str) -> np.uint64:
    data = np.frombuffer(text.encode(), np.uint8).astype(np.uint64) + np.uint64(1)
    powers = np.full(max(len(data), 1), _STEP)
    powers[0] = 1
    return mix(np.array([(data * np.multiply.accumulate(powers)[: len(data)]).sum() + np.uint64(len(data))], np.uint64))[0]


_FACTS = "kind int, term long, n long, doc long, mark long, entities array<long>, terms array<long>"


def _values(text: str, spans: list, min_bytes: int) -> tuple[list, list, int]:
    """Distinct entities and terms of a text, and a hash of all terms in order. Values are no terms."""
    data = np.frombuffer(text.encode(), np.uint8).copy()
    place = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
    entities = {int(_hash_of(f"{kind}:{text[a:b]}").view(np.int64)) for kind, a, b in spans}
    for _, a, b in spans:
        data[place[a] : place[b]] = 32
    h, _, start, end = _terms(data, np.array([0, len(data)]))
    h = h[end - start >= min_bytes]
    mark = (h * np.multiply.accumulate(np.full(len(h), _STEP))).sum(dtype=np.uint64)
    return sorted(entities), np.unique(h).view(np.int64).tolist(), int(mix(np.array([mark])).view(np.int64)[0])


def _statistics(min_bytes: int):
    """In how many documents each term is (kind 0), and the values and terms of each document with a value (kind 1)."""
    names = [f.split()[0] for f in _FACTS.split(", ")]
    types = [pa.int32(), *[pa.int64()] * 4, *[pa.list_(pa.int64())] * 2]

    def counted(found):
        h, n = np.concatenate([x for x, _ in found]), np.concatenate([x for _, x in found])
        order = np.argsort(h, kind="stable")
        h, n = h[order], n[order]
        start, _ = slices(h)
        for at in range(0, len(start), 100_000):
            own = start[at : at + 100_000]
            stop = start[at + 100_000] if at + 100_000 < len(start) else len(h)
            sums = np.add.reduceat(n[own[0] : stop], own - own[0])
            none = [pa.nulls(len(own), t) for t in types[3:]]
            yield pa.RecordBatch.from_arrays([pa.array(np.zeros(len(own), np.int32)), pa.array(h[own].view(np.int64)),
                                              pa.array(sums.astype(np.int64)), *none], names)

    def statistics(batches):
        found, held, doc = [], 0, TaskContext.get().partitionId() << 40
        for batch in batches:
            texts = batch.column("text")
            data, offsets = text_bytes(texts)
            h, owner, start, end = _terms(data, offsets)
            long = end - start >= min_bytes
            order = np.lexsort((h[long], owner[long]))
            hd, dd = h[long][order], owner[long][order]
            new = np.ones(len(hd), bool)
            new[1:] = (hd[1:] != hd[:-1]) | (dd[1:] != dd[:-1])
            values, n = np.unique(hd[new], return_counts=True)
            found.append((values, n))
            held += len(values)
            if held > 2_000_000:
                yield from counted(found)
                found, held = [], 0
            rows = []
            for text in texts.to_pylist():
                doc += 1
                spans = base_spans(text) if text else []
                if spans:
                    entities, terms, mark = _values(text, spans, min_bytes)
                    rows.append((1, None, None, doc, mark, entities, terms))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
        if found:
            yield from counted(found)

    return statistics


def _least_texts(n: int, terms: int, max_chance: float) -> int:
    """So many different texts with both can make a term certain, if neither is anywhere else."""
    k, ways = 1, float(n)
    while k < n and terms > max_chance * ways:
        ways *= (n - k) / (k + 1)
        k += 1
    return k


def revealing_terms(docs: DataFrame, threshold: float = 0.9, max_chance: float = 0.01, min_bytes: int = 3) -> DataFrame:
    """Terms that give an entity away: term (hash), disclosure.

    An entity is one value found by a pattern. With N documents, n(t) with the term, n(e) with the entity and n(t, e)
    with both, wherever they stand in it, disclosure is pointwise mutual information over the information of the entity,
    log2(n(t, e) N / (n(t) n(e))) / log2(N / n(e)): 1 where the term is never seen without the entity. Terms at
    `threshold` or above are returned unless chance explains them: with k different texts that have both (documents
    with the same terms in the same order are one), the number of terms of the corpus expected to meet the entity so often
    by chance, terms * C(n(t), k) * C(n(e), k) / C(N, k), copies taken off, is at most `max_chance`. Two texts are enough
    in all but small corpora; one is only if the corpus has fewer terms than `max_chance` * N, since else every rare word
    of a document with a value would be certain.

    All counts are over all documents. Entities that no term can be certain for, and terms that are too frequent or too
    rare for all entities of their document, go before terms and entities are paired.
    """
    facts = staged(docs.select("text").mapInArrow(_statistics(min_bytes), _FACTS))
    n = docs.count()
    counts = facts.where("kind = 0")
    n_terms = counts.agg(F.approx_count_distinct("term", 0.01)).first()[0]
    least = _least_texts(n, n_terms, max_chance)
    held = facts.where("kind = 1").select("doc", "mark", F.explode("entities").alias("entity"))
    entities = held.groupBy("entity", "mark").agg(F.count(F.lit(1)).alias("n")).groupBy("entity").agg(
        F.sum("n").alias("n_entity"), F.count(F.lit(1)).alias("texts_entity")).where(F.col("texts_entity") >= least)
    # threshold * log2(N / n(e)) <= log2(N / n(t)), as n(t, e) <= n(e)
    most = F.ceil(F.pow(F.col("n_entity"), F.lit(threshold)) * F.lit(float(max(n, 1))) ** F.lit(1 - threshold) * 1.000001)
    entities = staged(entities.withColumn("most", most))
    held = staged(held.join(entities, "entity"))
    wanted = staged(held.groupBy(F.col("doc").alias("_doc")).agg(F.max("most").alias("most_doc")))
    own = staged(facts.where("kind = 1").join(wanted, F.col("doc") == F.col("_doc")).select(
        "doc", "most_doc", F.explode("terms").alias("term")))
    terms = counts.groupBy("term").agg(F.sum("n").alias("n_term")).where(F.col("n_term") >= least)
    own = own.join(terms, "term").where(F.col("n_term") <= F.col("most_doc")).select("doc", "term", "n_term")
    pairs = own.join(held, "doc").where(F.col("n_term") <= F.col("most"))
    pairs = pairs.groupBy("term", "entity", "mark").agg(F.count(F.lit(1)).alias("n"), *[F.first(c).alias(c) for c in (
        "n_term", "n_entity", "texts_entity")])
    pairs = pairs.groupBy("term", "entity").agg(F.sum("n").alias("n_both"), F.count(F.lit(1)).alias("texts"), *[
        F.first(c).alias(c) for c in ("n_term", "n_entity", "texts_entity")])
    shared = F.log2(F.col("n_both") * F.lit(float(n)) / (F.col("n_term") * F.col("n_entity")))
    whole = F.log2(F.lit(float(n)) / F.col("n_entity"))
    scored = pairs.withColumn("disclosure", F.try_divide(shared, whole)).where(F.col("disclosure") >= threshold)
    # Copies of a text say nothing new: they are taken off both counts. Fewer texts bound the chance of more.
    texts_term = F.col("n_term") - F.col("n_both") + F.col("texts")
    each = F.transform(F.sequence(F.lit(0), F.least(F.col("texts"), F.lit(50)).cast("int") - 1), lambda i: F.log(
        (texts_term - i) * (F.col("texts_entity") - i) / ((i + 1) * (F.lit(float(n)) - i))))
    chance = F.aggregate(each, F.log(F.lit(float(max(n_terms, 1)))), lambda total, x: total + x)
    return scored.where(chance <= math.log(max_chance)).groupBy("term").agg(F.max("disclosure").alias("disclosure"))


@F.arrow_udf(SPANS)
def _base(texts: pa.Array) -> pa.Array:
    return pa.array([[dict(zip(("kind", "start", "end"), s)) for s in base_spans(t.as_py() or "")] for t in texts], _SPANS)


def _covered(spans: list[dict], first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Which ranges overlap one of the spans; these are merged, so that only the one before a range's end can."""
    merged: list[list[int]] = []
    for a, b in sorted((s["start"], s["end"]) for s in spans):
        if merged and a <= merged[-1][1]:
            merged[-1][1] = max(b, merged[-1][1])
        else:
            merged.append([a, b])
    if not merged:
        return np.zeros(len(first), bool)
    starts, ends = np.array(merged).T
    at = np.searchsorted(starts, last, "left") - 1
    return (at >= 0) & (ends[at] > first)


def _with_terms(text: Column, spans: Column, terms: np.ndarray) -> Column:
    """`spans` and those of the given terms that lie outside of them."""

    def add(texts: pa.Array, found: pa.Array) -> pa.Array:
        data, offsets = text_bytes(texts)
        h, doc, start, end = _terms(data, offsets)
        at = np.minimum(np.searchsorted(terms, h), len(terms) - 1)
        hit = np.flatnonzero(terms[at] == h)
        # Code points up to each byte, counted once for all texts.
        points = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
        own = doc[hit]
        first, last = points[start[hit]] - points[offsets[own]], points[end[hit]] - points[offsets[own]]
        ends = np.searchsorted(own, np.arange(len(texts)), "right")
        out = []
        for i, spans_ in enumerate(found.to_pylist()):
            spans_ = spans_ or []
            a, b = first[ends[i - 1] if i else 0 : ends[i]], last[ends[i - 1] if i else 0 : ends[i]]
            if len(a):
                free = ~_covered(spans_, a, b)
                spans_ += [{"kind": 4, "start": x, "end": y} for x, y in zip(a[free].tolist(), b[free].tolist())]
            out.append(spans_)
        return pa.array(out, _SPANS)

    return F.arrow_udf(add, SPANS)(text, spans)


def _term_blocks(terms: DataFrame, size: int) -> Iterator[np.ndarray]:
    held: list = []
    for row in terms.select("term").toLocalIterator():
        held.append(row[0])
        if len(held) == size:
            yield np.sort(np.array(held, np.int64).view(np.uint64))
            held = []
    if held:
        yield np.sort(np.array(held, np.int64).view(np.uint64))


def find_spans(docs: DataFrame, terms: DataFrame | None = None, into: str = "spans", block: int = 1_000_000) -> DataFrame:
    """All rows and columns of `docs` and the column `into`: array of (kind, start, end) in code points, base kinds first.

    `terms` defaults to `revealing_terms(docs)`; they go out in sorted blocks of at most `block` hashes. Null text is
    empty text and has no spans; an empty table stays empty; doc_id is not looked at, repeated rows get the same spans.
    """
    terms = revealing_terms(docs) if terms is None else terms
    spans = _base(F.col("text"))
    for part in _term_blocks(terms, block):
        spans = _with_terms(F.col("text"), spans, part)
    columns = [F.col(f"`{c}`") for c in docs.columns if c != into]
    return docs.select(*columns, F.sort_array(spans).alias(into))


def sanitise(docs: DataFrame, terms: DataFrame | None = None, remove_terms: bool = False) -> DataFrame:
    """`docs` with every span generalised to its kind, as in [EMAIL]; with `remove_terms`, revealing terms go entirely."""
    names = [f"[{k.upper()}]" for k in KINDS]
    if remove_terms:
        names[4] = ""

    def replace(texts: pa.Array, found: pa.Array) -> pa.Array:
        out = []
        for text, spans in zip(texts.to_pylist(), found.to_pylist()):
            if text and spans:
                parts, last = [], 0
                for s in sorted(spans, key=lambda s: (s["start"], -s["end"])):
                    if s["end"] <= last:
                        continue
                    parts += [text[last : s["start"]], names[s["kind"]]]
                    last = s["end"]
                text = "".join(parts) + text[last:]
            out.append(text)
        return pa.array(out, pa.string())

    marked = find_spans(docs, terms, into="_pii_spans")
    clean = F.arrow_udf(replace, T.StringType())(F.col("text"), F.col("_pii_spans"))
    return marked.select(*[clean.alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns])


def span_count(spans: Column, kind: str) -> Column:
    """How many of the spans are of one kind."""
    # A second parameter of the function, even one with a default, would be given the position in the array.
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("long")


def span_list(spans: Column, base_only: bool = False) -> Column:
    """kind:start:end of the sorted spans, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    kept = F.filter(spans, lambda s: s["kind"] < 4) if base_only else spans
    return F.array_join(F.transform(kept, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")
