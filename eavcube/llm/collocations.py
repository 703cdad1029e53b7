"""Phrases whose words occur together more than apart: count streams in prefix and suffix order, joined in step."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eavcube.llm.common import _FOLD, mix, parts, slices, staged, text_bytes

# What ends a piece, what separates words in it, and the scale of a score.
BREAKS, BLANKS = ".,;:!?\n\x0b\x0c\r", " \t"
SCALE = 2_000_000
_KIND = np.zeros(256, np.uint8)
_KIND[[ord(c) for c in BLANKS]] = 1
_KIND[[ord(c) for c in BREAKS]] = 2
_BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))
# A number for each byte, A-Z as a-z.
_LETTERS = mix(_FOLD.astype(np.uint64) + np.uint64(1))
# Bytes of text that are turned into words at once.
_SEGMENT = 1_000_000


def _segments(data: np.ndarray, offsets: np.ndarray):
    """Cut texts at ends of pieces into parts of about _SEGMENT bytes: start and end. No phrase crosses a cut."""
    low = 0
    while low < len(data):
        high, text = low + _SEGMENT, int(offsets[min(np.searchsorted(offsets, low + _SEGMENT), len(offsets) - 1)])
        while high < text:
            ends = np.flatnonzero(_KIND[data[high : min(high + 10_000, text)]] == 2)
            if len(ends):
                text = high + int(ends[0]) + 1
                break
            high += 10_000
        yield low, text
        low = text


def _powers(n: int, which: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of a base modulo 2^64, and of its inverse; kept for the next segment."""
    if which not in _POWERS or len(_POWERS[which][0]) < n:
        base = int(_BASES[which])
        made = []
        for x in (base, pow(base, -1, 2**64)):
            row = np.full(n, x, np.uint64)
            row[0] = 1
            made.append(np.multiply.accumulate(row))
        _POWERS[which] = made
    up, down = _POWERS[which]
    return up[:n], down[:n]


_POWERS: dict = {}


class _Words:
    """The words of a segment: byte ranges, piece, document, and two hashes of each, with the language in them.

    A hash is a polynomial in the word's letters, taken from sums over the whole segment: what lies between the word's
    ends, divided by the power at its start.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, low: int, high: int, seeds: np.ndarray):
        part = data[low:high]
        self.part = part
        kind = _KIND[part]
        word = np.zeros(len(part) + 1, bool)
        word[:-1] = kind == 0
        begins, ends = word.copy(), word.copy()
        begins[1:] &= ~word[:-1]
        ends[:-1] &= ~word[1:]
        edges = offsets[(offsets > low) & (offsets < high)] - low
        begins[edges] |= word[edges]
        ends[edges - 1] |= word[edges - 1]
        self.start, self.end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        self.doc = np.searchsorted(offsets, self.start + low, "right") - 1
        self.piece = np.searchsorted(np.flatnonzero(kind == 2), self.start) + self.doc
        self.hash = []
        letters = _LETTERS[part]
        length = (self.end - self.start).astype(np.uint64)
        for i in range(2):
            up, down = _powers(len(part), i)
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(letters * up, out=sums[1:])
            self.hash.append(mix((sums[self.end] - sums[self.start]) * down[self.start] + length * _BASES[i] + seeds[self.doc]))

    def windows(self, n: int) -> np.ndarray:
        """First words of all runs of n words inside a piece."""
        if len(self.piece) < n:
            return np.zeros(0, np.int64)
        return np.flatnonzero(self.piece[: len(self.piece) - n + 1] == self.piece[n - 1 :])

    def chain(self, first: np.ndarray, n: int, which: int = 0) -> np.ndarray:
        h = np.full(len(first), n, np.uint64)
        for j in range(n):
            h = mix(h * _BASES[which] + self.hash[which][first + j])
        return h

    def phrases(self, place: np.ndarray, n: int) -> tuple[pa.Array, np.ndarray]:
        """The runs of n words that begin at `place`, joined by a space, A-Z as a-z; and the order they come in."""
        text = _FOLD[self.part]
        # Words that something else than one space separates are joined anew.
        other = np.zeros(len(place), bool)
        for j in range(n - 1):
            gap = self.end[place + j]
            other |= (self.start[place + j + 1] != gap + 1) | (self.part[gap] != 32)
        plain = place[~other]
        start, length = self.start[plain], self.end[plain + n - 1] - self.start[plain]
        cuts = np.concatenate(([0], np.cumsum(length)))
        letters = text[np.arange(cuts[-1]) + np.repeat(start - cuts[:-1], length)]
        found = pa.StringArray.from_buffers(len(plain), pa.py_buffer(cuts.astype(np.int32)), pa.py_buffer(letters))
        joined = [" ".join(text[self.start[p + j] : self.end[p + j]].tobytes().decode() for j in range(n)) for p in place[other].tolist()]
        return pa.concat_arrays([found, pa.array(joined, pa.string())]), np.concatenate((np.flatnonzero(~other), np.flatnonzero(other)))


def _seed(lang: str) -> int:
    return xxhash.xxh64_intdigest(lang.encode())


def _distinct(words: _Words, first: np.ndarray, n: int, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first place and the number of each distinct run of words, told apart by both hashes."""
    order = np.argsort(h)
    g = words.chain(first[order], n, 1)
    start, end = slices(h[order])
    if len(start) and (np.minimum.reduceat(g, start) != np.maximum.reduceat(g, start)).any():
        again = np.lexsort((g, h[order]))
        order, g = order[again], g[again]
        new = np.concatenate(([True], (np.diff(h[order]) != 0) | (np.diff(g) != 0)))
        start = np.flatnonzero(new)
        end = np.concatenate((start[1:], [len(g)]))
    return first[order[start]], end - start


_COUNTED = ["lang", "phrase", "a"]


def _count(n: int, frequent, bits: int, limit: int):
    """Count the phrases of n words in a task, summed until there are `limit` rows; from two words on only those whose both shorter parts may be frequent.

    `frequent` is a bit table of the frequent phrases of n - 1 words. It never misses one, so no phrase that reaches
    the minimum is left out at any place. With n = 1 a row without a phrase holds the number of all words.
    """

    def merged(held):
        return pa.concat_tables(held).group_by(["lang", "phrase"]).aggregate([("a", "sum")]).rename_columns(_COUNTED)

    def count(batches):
        held, size = [], 0
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            langs = batch.column("lang")
            seeds = np.array([_seed(x) for x in langs.to_pylist()], np.uint64)
            for low, high in _segments(data, offsets):
                words = _Words(data, offsets, low, high, seeds)
                first = words.windows(n)
                if n > 1:
                    shorter = words.chain(np.arange(max(len(words.start) - n + 2, 0)), n - 1)
                    cell = shorter >> np.uint64(64 - bits)
                    known = (frequent.value[cell >> np.uint64(3)] >> (cell & np.uint64(7)).astype(np.uint8)) & 1 != 0
                    first = first[known[first] & known[first + 1]]
                place, number = _distinct(words, first, n, words.chain(first, n))
                phrases, order = words.phrases(place, n)
                held.append(pa.table([langs.take(pa.array(words.doc[place[order]])), phrases, pa.array(number[order].astype(np.int64))], _COUNTED))
                if n == 1:
                    own, a = np.unique(words.doc, return_counts=True)
                    held.append(pa.table([langs.take(pa.array(own)), pa.nulls(len(own), pa.string()), pa.array(a.astype(np.int64))], _COUNTED))
                size += sum(t.num_rows for t in held[-2:]) if n == 1 else held[-1].num_rows
                if size >= limit:
                    total = merged(held)
                    held, size = [total], total.num_rows
                    if size > limit // 2:
                        yield from total.to_batches(max_chunksize=100_000)
                        held, size = [], 0
        if held:
            yield from merged(held).to_batches(max_chunksize=100_000)

    return count


def _cells(n: int, bits: int):
    """The bit of each phrase of n words in a table of 2^bits bits: byte and value."""

    def cells(batches):
        for batch in batches:
            data, offsets = text_bytes(batch.column("phrase"))
            seeds = np.array([_seed(x) for x in batch.column("lang").to_pylist()], np.uint64)
            for low, high in _segments(data, offsets):
                words = _Words(data, offsets, low, high, seeds)
                cell = words.chain(words.windows(n), n) >> np.uint64(64 - bits)
                yield pa.RecordBatch.from_arrays(
                    [pa.array((cell >> np.uint64(6)).astype(np.int64)), pa.array((np.uint64(1) << (cell & np.uint64(63))).view(np.int64))],
                    ["cell", "bit"])

    return cells


def _bit_table(phrases: DataFrame, n: int, bits: int) -> np.ndarray:
    """The bits of all phrases of n words as bytes. What reaches the driver is 2^bits bits at most, however many there are."""
    found = phrases.select("lang", "phrase").mapInArrow(_cells(n, bits), "cell long, bit long")
    rows = found.groupBy("cell").agg(F.bit_or("bit").alias("bit")).toArrow()
    table = np.zeros(2**bits // 64, np.int64)
    table[rows["cell"].to_numpy()] = rows["bit"].to_numpy()
    return table.view(np.uint8)


def frequent_phrases(docs: DataFrame, min_count: int = 30, longest: int = 4, bits: int = 26, flush: int = 500_000) -> DataFrame:
    """lang, phrase (words joined by a space), a: all phrases of up to `longest` words with a count of `min_count` or more.
    A row without a phrase has the number of words of the language.

    A phrase is never more frequent than its parts, so each length is counted where both parts of one word less may be
    frequent; a bit table of 2^bits bits says where not. It only saves work: the counts are whole at any size of it.
    """
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text")
    found, table = None, None
    for n in range(1, longest + 1):
        sent = None if n == 1 else spark.sparkContext.broadcast(table)
        counted = texts.mapInArrow(_count(n, sent, bits, flush), "lang string, phrase string, a long")
        # Tasks have summed their own rows, so there is nothing to combine before the shuffle.
        counted = counted.repartition("lang", "phrase").groupBy("lang", "phrase").agg(F.sum("a").alias("a"))
        counted = staged(counted.where((F.col("a") >= min_count) | F.col("phrase").isNull()))
        found = counted if found is None else found.union(counted)
        if n < longest:
            table = _bit_table(counted.where("phrase is not null"), n, bits)
    return found


_STREAM = "lang string, words array<string>, a long, c1 long, c2 long, c3 long, ext long, part int, edge boolean"


def _in_step(batches):
    """Walk phrases in the order of their words: each gets the counts of its first 1, 2 and 3 words, which came before
    it, and the highest count of those that continue it by one word, which come right after it.

    A part of the range may begin in the middle of a word's phrases. What its first row lacks leaves as `edge` rows:
    the beginnings of that row, with the highest count of their continuations in this part.
    """
    part = TaskContext.get().partitionId()
    out: list[list] = [[] for _ in range(9)]

    def put(lang, words, a, counts, ext, edge):
        for column, value in zip(out, (lang, words, a, *counts, ext, part, edge)):
            column.append(value)

    def drain():
        types = [pa.string(), pa.list_(pa.string()), *[pa.int64()] * 5, pa.int32(), pa.bool_()]
        batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], [f.split()[0] for f in _STREAM.split(", ")])
        for column in out:
            column.clear()
        return batch

    # The open phrases, one for each length: words, count (None at an edge), counts of beginnings, best continuation.
    open_: list[list] = []
    lang = None

    def close(depth):
        while len(open_) > depth:
            words, a, counts, ext = open_.pop()
            put(lang, words, a, counts, ext, a is None)

    for batch in batches:
        for row_lang, words, a in zip(batch.column("lang").to_pylist(), batch.column("words").to_pylist(), batch.column("a").to_pylist()):
            first = lang is None
            shared = 0
            if row_lang == lang and open_:
                last = open_[-1][0]
                while shared < min(len(last), len(words) - 1) and last[shared] == words[shared]:
                    shared += 1
            close(shared)
            lang = row_lang
            if first:
                open_ += [[words[:k], None, (None, None, None), 0] for k in range(1, len(words))]
            if open_:
                open_[-1][3] = max(open_[-1][3], a)
            counts = [o[1] for o in open_]
            open_.append([words, a, (*counts, *[None] * (3 - len(counts))), 0])
        if len(out[0]) > 20_000:
            yield drain()
    close(0)
    if out[0]:
        yield drain()


def _stream(phrases: DataFrame, backward: bool) -> DataFrame:
    """lang, words, c1, c2, c3, ext of every phrase in prefix order, or of its reversed words, in suffix order."""
    words = F.reverse("words") if backward else F.col("words")
    ordered = phrases.select("lang", words.alias("words"), "a")
    rows = staged(ordered.repartitionByRange(parts(phrases.sparkSession), "lang", "words").sortWithinPartitions("lang", "words").mapInArrow(
        _in_step, _STREAM))
    # Three rows for each range at most: small enough to broadcast at any size of the input.
    edges = rows.where("edge").select(F.col("lang").alias("e_lang"), F.col("words").alias("e_words"), F.col("ext").alias("e_ext"),
                                      F.col("part").alias("e_part"))
    same = (F.col("lang") == F.col("e_lang")) & (F.col("words") == F.col("e_words"))
    counts = ordered.join(F.broadcast(edges), same).groupBy("e_part").agg(
        *[F.max(F.when(F.size("words") == k, F.col("a"))).alias(f"m{k}") for k in (1, 2, 3)])
    late = edges.groupBy("e_lang", "e_words").agg(F.max("e_ext").alias("e_ext"))
    whole = rows.where("not edge").join(F.broadcast(counts), F.col("part") == F.col("e_part"), "left").join(F.broadcast(late), same, "left")
    filled = [F.when(F.size("words") > k, F.coalesce(f"c{k}", f"m{k}")).alias(f"c{k}") for k in (1, 2, 3)]
    return whole.select("lang", words.alias("words"), "a", *filled, F.greatest("ext", F.coalesce("e_ext", F.lit(0))).alias("ext"))


def score(a: Column, both: Column) -> Column:
    """floor(SCALE * a / both) by long division: no product passes 64 bits while counts stay below 9 * 10^15 / 2."""
    out, rest = F.lit(0).cast("long"), a
    for step in (1000, 1000, SCALE // 1_000_000):
        scaled = rest * F.lit(step)
        out, rest = out * F.lit(step) + F.call_function("div", scaled, both), scaled % both
    return out


def mine_collocations(docs: DataFrame, min_count: int = 30, first: int = 2000, cover: int = 80, bits: int = 26) -> DataFrame:
    """The `first` best phrases of 2 to 4 words of each language: lang, rank, phrase, a, l, r, n, score.

    a, l and r are the counts of the phrase and of the two parts at its weakest cut, n the words of the language. Counts
    are streamed in the order of their words and of their reversed words; each order gives every phrase the counts of
    its parts on one side and of its extensions by one word on the other, and the two are merge-joined. A phrase goes
    if a longer one with `cover` percent of its count holds it; one with one word more is always the most frequent.

    Texts are cut at .,;:!? and line breaks, A-Z count as a-z. A null lang is `und`; each row is a document, also with a
    null or repeated doc_id. Null and empty texts have no words. Very long texts are read whole, in parts that end
    where a piece ends. An empty table gives no rows. Other columns are not looked at.
    """
    found = staged(frequent_phrases(docs, min_count, 4, bits).select("lang", "phrase", "a", F.split("phrase", " ").alias("words")))
    phrases = found.where("phrase is not null").select("lang", "words", "a")
    left = _stream(phrases, False).where(F.size("words") > 1)
    right = _stream(phrases, True).select("lang", "words", *[F.col(c).alias(f"s_{c}") for c in ("c1", "c2", "c3", "ext")])
    joined = left.join(right.hint("merge"), ["lang", "words"])
    size = F.size("words")
    cuts = []
    for k in (1, 2, 3):
        l, r = F.col(f"c{k}"), F.coalesce(*[F.when(size - k == m, F.col(f"s_c{m}")) for m in (1, 2, 3)])
        cuts.append(F.when(size > k, F.struct(score(F.col("a"), l + r).alias("score"), F.lit(k).alias("k"), l.alias("l"), r.alias("r"))))
    kept = joined.where(F.greatest("ext", "s_ext") * F.lit(100) < F.col("a") * F.lit(cover))
    kept = kept.select("lang", F.concat_ws(" ", "words").alias("phrase"), "a", F.least(*cuts).alias("cut")).select(
        "lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # A part of a hash keeps its own best, so that no task sorts a whole language.
    part = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(64))).orderBy(*order)
    best = kept.withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= first)
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= first)
    totals = found.where("phrase is null").select("lang", F.col("a").alias("n"))
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
