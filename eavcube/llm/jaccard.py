"""Exact Jaccard join of shingle sets by vertical partitioning."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eavcube.llm.common import mix, pack, parts, quoted, shingle_sets, slices, staged, text_hash, unpack, unused
from eavcube.llm.components import components

# Shingle frequencies are counted in this many cells; an order of shingles needs no exact counts.
CELLS, PIECES = 1 << 20, 64
# Pieces of the global order; overlaps are counted in each and summed.
FRAGMENTS = 4
# Pairs of one set that a block takes.
HUB_PAIRS = 256
_KEY_BITS = np.uint64(5)


def required_overlap(n, m, percent: int):
    """Smallest intersection of sets of n and m that makes 100 * intersection >= percent * union."""
    return (percent * (n + m) + 99 + percent) // (100 + percent)


def prefix_length(n, percent: int):
    """So many of the rarest shingles of a set hold at least one of those of any set it links to."""
    return np.where(n > 0, n - (percent * n + 99) // 100 + 1, 0)


class Order:
    """The global order of shingles: rare cells first, by hash within a level of frequency; and its cuts."""

    def __init__(self, counts: np.ndarray):
        self.level = np.minimum(np.ceil(np.log2(counts + 1.0)), 31).astype(np.uint8)
        weight = np.bincount(self.level, weights=counts, minlength=32)
        total, before = weight.sum(), np.concatenate(([0.0], np.cumsum(weight)[:-1]))
        cuts = []
        for i in range(1, FRAGMENTS):
            at = total * i / FRAGMENTS
            level = int(np.searchsorted(before, at, "right")) - 1
            inside = (at - before[level]) / weight[level] if weight[level] else 0.0
            cuts.append((level << 59) + min(int(inside * 2**59), 2**59 - 1))
        self.cuts = np.array(cuts, np.uint64)


def order_keys(level: np.ndarray, h: np.ndarray) -> np.ndarray:
    """A shingle's place in the order, which also identifies it."""
    cell = (h & np.uint64(CELLS - 1)).astype(np.int64)
    return (level[cell].astype(np.uint64) << np.uint64(59)) | (h >> _KEY_BITS)


# Bits of the parity sketch of a set, 64 in each long.
PARITY = 1024
_FACTS = "kind int, doc_id long, row long, n long, set long, again long, parity array<long>, cell int, counts binary"


def _digests(h: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of each set."""
    out = []
    for salt in (np.uint64(0x2545F4914F6CDD1D), np.uint64(0x9E6C63D0876A9A35)):
        sums = np.concatenate(([np.uint64(0)], np.cumsum(mix(h ^ salt), dtype=np.uint64)))
        out.append(mix(sums[at[1:]] - sums[at[:-1]]).view(np.int64))
    return out[0], out[1]


def _parities(h: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For each set, PARITY bits: whether an odd number of its shingles fall on the bit. The bits in which two sets
    differ are no more than the shingles in which they differ."""
    bit = (h >> np.uint64(20)) % np.uint64(PARITY)
    words = np.concatenate((np.zeros(1, np.uint64), np.uint64(1) << (bit % np.uint64(64))))
    column = (bit // np.uint64(64)).astype(np.int64)
    doc = np.repeat(np.arange(len(at) - 1), np.diff(at))
    out = np.zeros((len(at) - 1) * (PARITY // 64), np.uint64)
    np.bitwise_xor.at(out, doc * (PARITY // 64) + column, words[1:])
    return out.view(np.int64)


def _facts(words: int):
    """A row for each document with its set's size and digest (kind 0), and the counts of a task by cell (kind 1)."""
    names = [f.split()[0] for f in _FACTS.split(", ")]
    types = [pa.int32(), *[pa.int64()] * 5, pa.list_(pa.int64()), pa.int32(), pa.binary()]

    def facts(batches):
        counts = np.zeros(CELLS, np.int64)
        for batch in batches:
            h, at = shingle_sets(batch.column("text"), words)
            counts += np.bincount((h & np.uint64(CELLS - 1)).astype(np.int64), minlength=CELLS)
            one, two = _digests(h, at)
            rows = batch.num_rows
            none = pa.nulls(rows, pa.int32()), pa.nulls(rows, pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.zeros(rows, np.int32)), batch.column("doc_id"), batch.column("row"), pa.array(np.diff(at)),
                 pa.array(one), pa.array(two),
                 pa.ListArray.from_arrays(np.arange(rows + 1, dtype=np.int32) * (PARITY // 64), pa.array(_parities(h, at))), *none], names)
        width = CELLS // PIECES
        rows = [(1, None, None, None, None, None, None, i, pack(counts[i * width : (i + 1) * width])) for i in range(PIECES)
                if counts[i * width : (i + 1) * width].any()]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    return facts


def _sum_counts(key, group):
    total = np.zeros(CELLS // PIECES, np.int64)
    for blob in group.column("counts"):
        total += unpack(blob.as_py(), np.int64)
    return pa.table({"cell": pa.array([key[0].as_py()], pa.int32()), "counts": pa.array([pack(total)], pa.binary())})


def _order(facts: DataFrame) -> Order:
    """Counts of all documents; CELLS numbers reach the driver at any size of the input."""
    sent = facts.where("kind = 1").select("cell", "counts")
    # Summed in two steps, so that no group holds the counts of all tasks.
    part = F.pmod(F.xxhash64("counts"), F.lit(1024))
    summed = sent.groupBy("cell", part.alias("part")).applyInArrow(_sum_counts, "cell int, counts binary")
    summed = summed.groupBy("cell").applyInArrow(_sum_counts, "cell int, counts binary")
    counts = np.zeros(CELLS, np.int64)
    width = CELLS // PIECES
    for cell, blob in summed.collect():
        counts[cell * width : (cell + 1) * width] = unpack(bytes(blob), np.int64)
    return Order(counts)


_PREFIX = "slot int, key binary, set binary, n binary, pos binary"


def _send_prefixes(order, words: int, percent: int, slots: int):
    """The prefix shingles of each different set of a batch, packed by slot."""

    def send(batches):
        for batch in batches:
            h, at = shingle_sets(batch.column("text"), words)
            one, _ = _digests(h, at)
            n = np.diff(at)
            _, first = np.unique(one, return_index=True)
            chosen = np.zeros(len(n), bool)
            chosen[first] = True
            doc = np.repeat(np.arange(len(n)), n)
            own = chosen[doc]
            key, doc = order_keys(order.value[0], h)[own], doc[own]
            place = np.lexsort((key, doc))
            key, doc = key[place], doc[place]
            start, end = slices(doc)
            pos = np.arange(len(doc)) - np.repeat(start, end - start)
            keep = pos < prefix_length(n[doc], percent)
            key, doc, pos = key[keep], doc[keep], pos[keep]
            slot = (mix(key) % np.uint64(slots)).astype(np.int64)
            place = np.lexsort((key, slot))
            slot, key, doc, pos = slot[place], key[place], doc[place], pos[place]
            rows = [(int(slot[a]), pack(key[a:b], True), pack(one[doc[a:b]]), pack(n[doc[a:b]].astype(np.uint32)),
                     pack(pos[a:b].astype(np.uint32))) for a, b in zip(*slices(slot))]
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), [pa.int32()] + [pa.binary()] * 4)],
                    [f.split()[0] for f in _PREFIX.split(", ")])

    return send


def _fits(n: np.ndarray, pos: np.ndarray, m: np.ndarray, at: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets of n and m that have their first common shingle at `pos` and `at` can still link."""
    return ((percent * np.maximum(n, m) <= 100 * np.minimum(n, m))
            & (np.minimum(n - pos, m - at) >= required_overlap(n, m, percent)))


_MEMBERS = "kind int, key long, set long, n long, pos long, other long, m long"
_MEMBER_TYPES = [pa.int32()] + [pa.int64()] * 6


def _member_table(*columns) -> pa.Table:
    return pa.table({f.split()[0]: pa.array(c, t) for f, c, t in zip(_MEMBERS.split(", "), columns, _MEMBER_TYPES)})


def _stars(percent: int):
    """Each prefix shingle of a slot: pairs of the set that has it first in its own order with all others (kind 0), and
    the members of larger groups that could link to each other as well (kind 1)."""

    def stars(key, group):
        columns = {c: group.column(c).to_pylist() for c in ("key", "set", "n", "pos")}
        k = np.concatenate([unpack(b, np.uint64, True) for b in columns["key"]])
        s = np.concatenate([unpack(b, np.int64) for b in columns["set"]])
        n, pos = (np.concatenate([unpack(b, np.uint32) for b in columns[c]]).astype(np.int64) for c in ("n", "pos"))
        order = np.lexsort((s, pos, k))
        k, s, n, pos = k[order], s[order], n[order], pos[order]
        new = np.ones(len(k), bool)
        new[1:] = (k[1:] != k[:-1]) | (s[1:] != s[:-1])
        k, s, n, pos = k[new], s[new], n[new], pos[new]
        start, end = slices(k)
        size = end - start
        several = np.repeat(size > 1, size)
        k, s, n, pos = k[several], s[several], n[several], pos[several]
        start, end = slices(k)
        lead = np.repeat(start, end - start)
        fits = _fits(n[lead], pos[lead], n, pos, percent) & (s != s[lead])
        x, y = s[lead][fits], s[fits]
        nx, ny = n[lead][fits], n[fits]
        low = x < y
        pairs = np.column_stack((np.where(low, x, y), np.where(low, nx, ny), np.where(low, y, x), np.where(low, ny, nx)))
        pairs = np.unique(pairs, axis=0) if len(pairs) else pairs.reshape(0, 4)
        more = np.zeros(len(k), bool)
        for a, b in zip(start, end):
            if b - a > 2:
                cells, where, count = np.unique(n[a + 1 : b] << 32 | pos[a + 1 : b], return_inverse=True, return_counts=True)
                cn, cp = cells >> 32, cells & 0xFFFFFFFF
                linked = np.zeros(len(cells), bool)
                for at in range(0, len(cells), 1000):
                    part = slice(at, at + 1000)
                    can = _fits(cn[part, None], cp[part, None], cn, cp, percent)
                    alone = np.arange(len(cells))[part]
                    can[np.arange(len(alone)), alone] &= count[part] > 1
                    linked[part] |= can.any(axis=1)
                more[a + 1 : b] = linked[where]
        zero = np.zeros(len(pairs), np.int64)
        out = _member_table(zero.astype(np.int32), zero, pairs[:, 0], pairs[:, 1], zero, pairs[:, 2], pairs[:, 3])
        one = np.ones(int(more.sum()), np.int64)
        rest = _member_table(one.astype(np.int32), k[more].view(np.int64), s[more], n[more], pos[more], 0 * one, 0 * one)
        return pa.concat_tables((out, rest))

    return stars


_PAIRS = "x long, n long, y long, m long"


def _remaining(percent: int):
    """All pairs of a slot's groups that can link and are not in one component yet."""

    def remaining(key, group):
        k, s, n, pos, c = (group.column(x).to_numpy() for x in ("key", "set", "n", "pos", "component"))
        order = np.lexsort((c, pos, n, k))
        k, s, n, pos, c = (x[order] for x in (k, s, n, pos, c))
        found = []
        for a, b in zip(*slices(k)):
            new = np.ones(b - a, bool)
            new[1:] = (n[a + 1 : b] != n[a : b - 1]) | (pos[a + 1 : b] != pos[a : b - 1]) | (c[a + 1 : b] != c[a : b - 1])
            first = np.flatnonzero(new) + a
            last = np.append(first[1:], b)
            for i in range(len(first)):
                f = first[i]
                can = np.flatnonzero(_fits(n[f], pos[f], n[first[i + 1 :]], pos[first[i + 1 :]], percent) & (c[first[i + 1 :]] != c[f]))
                for j in can + i + 1:
                    x, y = np.meshgrid(np.arange(f, last[i]), np.arange(first[j], last[j]), indexing="ij")
                    x, y = x.reshape(-1), y.reshape(-1)
                    low = s[x] < s[y]
                    x, y = np.where(low, x, y), np.where(low, y, x)
                    found.append(np.column_stack((s[x], n[x], s[y], n[y])))
        pairs = np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 4), np.int64)
        return pa.table({f.split()[0]: pa.array(pairs[:, i], pa.int64()) for i, f in enumerate(_PAIRS.split(", "))})

    return remaining


_SEGMENTS = "set long, fragment int, segment binary"


def _segments(order, words: int):
    """The set of each document, cut into its fragments."""

    def cut(batches):
        for batch in batches:
            h, at = shingle_sets(batch.column("text"), words)
            sets, rows = batch.column("set").to_pylist(), []
            for i, s in enumerate(sets):
                key = np.sort(order_keys(order.value[0], h[at[i] : at[i + 1]]))
                cuts = np.concatenate(([0], np.searchsorted(key, order.value[1]), [len(key)]))
                rows += [(s, f, pack(key[cuts[f] : cuts[f + 1]], True)) for f in range(FRAGMENTS) if cuts[f + 1] > cuts[f]]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int32(), pa.binary()))],
                                                 ["set", "fragment", "segment"])

    return cut


def _count_overlaps(key, pairs, segments):
    """Common shingles of all pairs of a block in one fragment."""
    x, y = pairs.column("x").to_numpy(), pairs.column("y").to_numpy()
    held = dict(zip(segments.column("set").to_pylist(), segments.column("segment").to_pylist()))
    common, last, one = np.zeros(len(x), np.int64), None, None
    for i in np.lexsort((y, x)):
        if x[i] not in held or y[i] not in held:
            continue
        if x[i] != last:
            last, one = x[i], unpack(held[x[i]], np.uint64, True)
        two = unpack(held[y[i]], np.uint64, True)
        place = np.searchsorted(one, two)
        common[i] = (one[np.minimum(place, len(one) - 1)] == two).sum()
    own = common > 0
    return pa.table({"x": x[own], "y": y[own], "common": common[own]})


def _linked(pairs: DataFrame, sets: DataFrame, rows: DataFrame, order, words: int, percent: int, blocks: int) -> DataFrame:
    """The pairs that link.

    Pairs whose parity sketches differ in more bits than linked sets can differ in shingles go first. The texts of the
    others are cut into fragments. In a pair the set with more pairs is the hub. Pairs go to the block of their other
    set's largest hub, so most sets are sent once; a hub with many pairs is dealt over several blocks by its partners.
    Each (block, fragment) counts its partial overlaps, which are summed for each pair. Everything here grows with the
    corpus: large sides meet by merge joins at every size.
    """
    of = lambda end: sets.select(F.col("set").alias(f"set_{end}"), F.col("parity").alias(f"parity_{end}"))
    sketched = pairs.join(of("x"), F.col("x") == F.col("set_x")).join(of("y"), F.col("y") == F.col("set_y"))
    differ = F.aggregate(F.zip_with("parity_x", "parity_y", lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0), lambda t, b: t + b)
    most = F.col("n") + F.col("m") - 2 * F.ceil(percent * (F.col("n") + F.col("m")) / (100 + percent))
    pairs = staged(sketched.where(differ <= most).select("x", "n", "y", "m"))
    wanted = pairs.select(F.col("x").alias("_set")).union(pairs.select("y")).distinct()
    wanted = staged(wanted.join(sets, F.col("_set") == F.col("set")).select("set", F.col("doc_id").alias("_d"), F.col("row").alias("_r")))
    # Repeated rows give the same segments again, of which a block keeps one.
    texts = rows.hint("merge").join(wanted, rows["doc_id"].eqNullSafe(F.col("_d")) & (rows["row"] == F.col("_r")))
    segments = staged(texts.select("set", "text").mapInArrow(_segments(order, words), _SEGMENTS))
    ends = pairs.select(F.col("x").alias("end")).union(pairs.select("y"))
    degrees = staged(ends.groupBy("end").agg(F.count(F.lit(1)).alias("degree")))
    deg = lambda end: degrees.select(F.col("end").alias(f"end_{end}"), F.col("degree").alias(f"degree_{end}"))
    both = pairs.join(deg("x"), F.col("x") == F.col("end_x")).join(deg("y"), F.col("y") == F.col("end_y"))
    hub = (F.col("degree_x") > F.col("degree_y")) | ((F.col("degree_x") == F.col("degree_y")) & (F.col("x") < F.col("y")))
    ends = both.select("x", "n", "y", "m", F.when(hub, F.col("x")).otherwise(F.col("y")).alias("hub"),
                       F.when(hub, F.col("y")).otherwise(F.col("x")).alias("other"), F.greatest("degree_x", "degree_y").alias("degree"))
    ends = staged(ends)
    # All pairs of a set meet in the block of its largest hub.
    main = staged(ends.groupBy(F.col("other").alias("_other")).agg(F.max(F.struct("degree", "hub")).alias("main")))
    dealt = F.pmod(F.xxhash64("other"), F.ceil(F.col("main.degree") / HUB_PAIRS))
    block = F.pmod(F.xxhash64("main.hub", dealt), F.lit(blocks)).cast("int")
    blocked = staged(ends.join(main, F.col("other") == F.col("_other")).select("x", "n", "y", "m", block.alias("block")))
    asked = blocked.select(F.col("x").alias("s"), F.col("block").alias("to")).union(blocked.select("y", "block")).distinct()
    sent = asked.hint("merge").join(segments, F.col("s") == F.col("set")).select("to", "fragment", "set", "segment")
    every = blocked.withColumn("fragment", F.explode(F.array(*[F.lit(f) for f in range(FRAGMENTS)])))
    partial = every.select("block", "fragment", "x", "y").groupBy("block", "fragment").cogroup(
        sent.groupBy("to", "fragment")).applyInArrow(_count_overlaps, "x long, y long, common long")
    total = partial.groupBy("x", "y").agg(F.sum("common").alias("common"))
    enough = F.lit(100) * F.col("common") >= percent * (F.col("n") + F.col("m") - F.col("common"))
    return total.join(pairs, ["x", "y"]).where(enough).select("x", "y")


def similar_documents(docs: DataFrame, words: int = 4, percent: int = 85) -> DataFrame:
    """Components of documents whose shingle sets link: doc_id, row (hash of the text), n_shingles, component_id.

    Two sets link when 100 * intersection >= percent * union. Equal sets are one class from the start. Shingles have
    one global order, rare ones first; linked sets share a shingle of their prefixes in it. Each prefix shingle pairs
    its members with the one that is earliest; after these pairs are counted, all others that can still link and are not
    connected yet follow, so every link between components is found while a group of near copies costs a number of
    pairs in proportion to its size. Overlaps are counted in fragments of the order and summed for each pair.

    component_id is the smallest doc_id reachable. A-Z count as a-z. A text with fewer words is one shingle; a null or
    wordless text has none, links with nothing and is its own component. Rows with a null doc_id link but are never a
    component_id unless alone (null). Repeated rows give repeated results. Other columns are not looked at.
    """
    return _similar(docs, words, percent).select("doc_id", "row", "n_shingles", F.when(
        F.col("_empty"), F.col("doc_id")).otherwise(F.col("least")).alias("component_id"))


def _similar(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """Rows of `similar_documents` with the number of their component in _group, its smallest doc_id, and if they are empty."""
    spark = docs.sparkSession
    slots = parts(spark) | 1
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_hash("text").alias("row"), "text")
    facts = staged(rows.mapInArrow(_facts(words), _FACTS))
    order = _order(facts)
    order = spark.sparkContext.broadcast((order.level, order.cuts))
    members = facts.where("kind = 0").select("doc_id", "row", "n", "set", "again")
    sent = rows.select("text").mapInArrow(_send_prefixes(order, words, percent, slots), _PREFIX)
    found = staged(sent.groupBy("slot").applyInArrow(_stars(percent), _MEMBERS))
    stars = staged(found.where("kind = 0").select(F.col("set").alias("x"), "n", F.col("other").alias("y"), "m").distinct())
    groups = found.where("kind = 1").select("key", "set", "n", "pos")
    sets = staged(facts.where("kind = 0").groupBy("set").agg(
        F.min(F.struct("doc_id", "row")).alias("one"), F.first("parity").alias("parity")).select("set", "one.doc_id", "one.row", "parity"))
    blocks = parts(spark)
    links = staged(_linked(stars, sets, rows, order, words, percent, blocks))
    label = components(links).select(F.col("node").alias("_node"), "component")
    labelled = staged(groups.join(label, F.col("set") == F.col("_node"), "left").select(
        "key", "set", "n", "pos", F.coalesce("component", "set").alias("component")))
    open_ = labelled.groupBy("key").agg(F.min("component").alias("a"), F.max("component").alias("b")).where("a <> b").select("key")
    open_ = labelled.join(staged(open_), "key", "left_semi")
    slot = F.pmod(F.xxhash64("key"), F.lit(slots)).cast("int")
    rest = open_.withColumn("slot", slot).groupBy("slot").applyInArrow(_remaining(percent), _PAIRS).distinct()
    rest = staged(rest.join(stars, ["x", "y"], "left_anti"))
    if not rest.isEmpty():
        links = staged(links.union(_linked(rest, sets, rows, order, words, percent, blocks)))
        label = components(links).select(F.col("node").alias("_node"), "component")
    # Rows of one set, or without any shingle, and what their component is.
    label = staged(label)
    empty = F.col("n") == 0
    named = staged(members.join(label, F.col("set") == F.col("_node"), "left").select(
        "doc_id", "row", F.col("n").alias("n_shingles"), F.coalesce("component", "set").alias("_group"), empty.alias("_empty")))
    least = staged(named.where(~F.col("_empty")).groupBy("_group").agg(F.min("doc_id").alias("least")).select(
        F.col("_group").alias("_g"), "least"))
    return named.join(least, (F.col("_group") == F.col("_g")) & ~F.col("_empty"), "left")


# Members of a prefix shingle that a block of its pairs takes on one side.
KEY_BLOCK = 1000
_ROWS = "key long, set long, n long, pos long"


def _prefix_rows(batches):
    for batch in batches:
        for k, s, n, pos in zip(*(batch.column(c).to_pylist() for c in ("key", "set", "n", "pos"))):
            columns = (unpack(k, np.uint64, True).view(np.int64), unpack(s, np.int64), unpack(n, np.uint32).astype(np.int64),
                       unpack(pos, np.uint32).astype(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], [f.split()[0] for f in _ROWS.split(", ")])


def _every_link(docs: DataFrame, words: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Documents with their sets, and all pairs of different sets that link.

    Nothing is left out for being in one component: all sets of a prefix shingle meet, dealt by blocks of one side if they
    are many, and what lengths and positions rule out goes within the join.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_hash("text").alias("row"), "text")
    facts = staged(rows.mapInArrow(_facts(words), _FACTS))
    order = _order(facts)
    order = spark.sparkContext.broadcast((order.level, order.cuts))
    members = facts.where("kind = 0").select("doc_id", "row", "n", "set", "parity")
    sets = staged(members.groupBy("set").agg(F.min(F.struct("doc_id", "row")).alias("one"), F.first("parity").alias("parity")).select(
        "set", "one.doc_id", "one.row", "parity"))
    sent = rows.select("text").mapInArrow(_send_prefixes(order, words, percent, parts(spark) | 1), _PREFIX)
    prefixes = staged(sent.mapInArrow(_prefix_rows, _ROWS).distinct())
    size = prefixes.groupBy(F.col("key").alias("_key")).agg(F.ceil(F.count(F.lit(1)) / KEY_BLOCK).cast("int").alias("blocks"), F.count(F.lit(1)).alias("_c"))
    prefixes = staged(prefixes.join(size.where("_c > 1"), F.col("key") == F.col("_key")).select("key", "set", "n", "pos", "blocks"))
    left = prefixes.select("key", F.pmod(F.xxhash64("set"), F.col("blocks")).cast("int").alias("block"), F.col("set").alias("x"), "n", "pos")
    right = prefixes.select(F.col("key").alias("_key"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("_block"),
                            F.col("set").alias("y"), F.col("n").alias("m"), F.col("pos").alias("at"))
    fits = F.expr(f"{percent} * greatest(n, m) <= 100 * least(n, m) and "
                  f"least(n - pos, m - at) >= ({percent} * (n + m) + 99 + {percent}) div {100 + percent}")
    pairs = left.join(right, (F.col("key") == F.col("_key")) & (F.col("block") == F.col("_block")) & (F.col("x") < F.col("y")) & fits)
    pairs = staged(pairs.select("x", "n", "y", "m").distinct())
    return members, staged(_linked(pairs, sets, rows, order, words, percent, parts(spark)))


def similar_links(docs: DataFrame, words: int = 4, percent: int = 85) -> DataFrame:
    """Every link between two different shingle sets, verified and once: set_x, set_y, doc_id_x, doc_id_y.

    Sets are given by a hash and the smallest doc_id that has them (null if all are null). Documents of one set are not
    linked but of one class: see `count_links`. The number of rows is that of the links, also in groups of near copies.
    """
    members, links = _every_link(docs, words, percent)
    least = staged(members.groupBy("set").agg(F.min("doc_id").alias("least")))
    of = lambda end: least.select(F.col("set").alias(f"set_{end}"), F.col("least").alias(f"doc_id_{end}"))
    both = links.join(of("x"), F.col("x") == F.col("set_x")).join(of("y"), F.col("y") == F.col("set_y"))
    return both.select("set_x", "set_y", "doc_id_x", "doc_id_y")


def count_links(docs: DataFrame, words: int = 4, percent: int = 85) -> DataFrame:
    """One row for each document: doc_id, row (hash of the text), n_shingles, class_id, n_links.

    class_id is the smallest doc_id with the same shingle set, n_links the number of other sets that this set links to. A
    text without shingles is its own class and has no links. Repeated rows give repeated results.
    """
    members, links = _every_link(docs, words, percent)
    ends = links.select(F.col("x").alias("_set")).union(links.select("y"))
    degrees = staged(ends.groupBy("_set").agg(F.count(F.lit(1)).alias("degree")))
    least = staged(members.groupBy("set").agg(F.min("doc_id").alias("least")).join(degrees, F.col("set") == F.col("_set"), "left").select(
        F.col("set").alias("_set"), "least", "degree"))
    out = members.join(least, F.col("set") == F.col("_set"))
    return out.select("doc_id", "row", F.col("n").alias("n_shingles"), F.when(F.col("n") == 0, F.col("doc_id")).otherwise(
        F.col("least")).alias("class_id"), F.coalesce("degree", F.lit(0)).cast("long").alias("n_links"))


def keep_one(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """`docs` with one row of each component, with all its columns, whatever their names.

    The row with the smallest doc_id stays, a null one last; of several texts under that id the one with the smallest hash,
    and of repeated rows one. Null, empty and wordless texts link with nothing: of these one row stays for each doc_id and
    text. Very long texts are read whole; an empty table stays empty.
    """
    doc, row, again = unused(docs, "_k_doc", "_k_row", "_k_again")
    found = _similar(docs, words, percent).select("_group", "_empty", "doc_id", "row")
    counted = found.groupBy("_group", "_empty", "doc_id", "row").agg(F.count(F.lit(1)).alias("n"))
    # Each text without shingles is a component of its own.
    alone = F.when(F.col("_empty"), F.struct("doc_id", "row"))
    first = counted.groupBy("_empty", F.when(~F.col("_empty"), F.col("_group")), alone).agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "row", "n")).alias("first"))
    first = staged(first.select(F.col("first.doc_id").alias(doc), F.col("first.row").alias(row), (F.col("first.n") > 1).alias(again)))
    same = docs["doc_id"].cast("long").eqNullSafe(F.col(doc)) & (text_hash(docs["text"]) == F.col(row))
    kept = docs.hint("merge").join(first, same)
    columns = [F.col(quoted(c)) for c in docs.columns]
    if first.where(F.col(again)).isEmpty():
        return kept.select(*columns)
    # Rows that are there again, with whatever other columns: one of each.
    plain = [F.col(quoted(f.name)) for f in docs.schema.fields if "map<" not in f.dataType.simpleString()]
    group = Window.partitionBy(doc, row).orderBy(F.xxhash64(*plain))
    repeated = kept.where(F.col(again)).withColumn(again, F.row_number().over(group)).where(F.col(again) == 1)
    return kept.where(~F.col(again)).select(*columns).union(repeated.select(*columns))
