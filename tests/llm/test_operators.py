"""The training-data operators against brute force, with nulls, empty and long texts, ties, repeats and extra columns."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from eavcube.llm import decontaminate, jaccard, licenses, lines, maxscore, mixing, pii, quality, suffixes, warc
from eavcube.llm.common import pack, prepare, unpack
from eavcube.llm.queries import QUERIES

DOCS = "doc_id long, text string, lang string, source string, n_chars long, row string, size int, key string, slot int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = {c: c + 32 for c in range(65, 91)}


def corpus(seed=7, n=60):
    rng = random.Random(seed)
    words = ["alpha", "Beta", "gamma", "délta", "eps", "zeta", "eta", "theta", "iota", "kappa", "x@y.example.com"]
    texts = ["\n".join(" ".join(rng.choice(words) for _ in range(rng.randint(1, 40))) for _ in range(rng.randint(1, 5))) for _ in range(n)]
    for i in range(0, n, 4):  # near copies, exact copies, shared lines
        texts[i + 1] = texts[i].replace("alpha", "omega", 1)
        if i % 8 == 0:
            texts[i + 2] = texts[i]
        texts[i] += "\n  Shared LINE of all \t"
    texts += [None, "", " \t\n ", "one", "é" * 3000, "ab " * 4000]
    return texts


@pytest.fixture(scope="module")
def docs(spark):
    prepare(spark)
    texts = corpus()
    rows = [(i, t, "en", ("s0" if i % 3 else f"s{i % 5}") if i % 11 else None, 0, "r", 1, "k", 2) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows + [rows[0]], DOCS), {r[0]: r[1] or "" for r in rows}


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def odd(spark):
    """Null and repeated ids."""
    return spark.createDataFrame([(None, "a b c d e f g", "en", None, 0, "r", 1, "k", 2)] * 2
                                 + [(1, None, None, None, None, None, None, None, None), (1, "x", "en", "s", 0, "r", 1, "k", 2)], DOCS)


def shingles(text, k):
    w = WORD.findall(text.translate(FOLD))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def test_pack_round_trip():
    for a in (np.array([], np.int64), np.array([5, -3, 2**62], np.int64), np.arange(1000, dtype=np.uint32)):
        assert (unpack(pack(a), a.dtype) == a).all()
    up = np.sort(np.random.default_rng(1).integers(0, 2**63, 500).astype(np.uint64))
    assert (unpack(pack(up, True), np.uint64, True) == up).all()


def test_mixing_comes_near_its_targets_and_keeps_the_cap(docs, empty, odd):
    df, texts = docs
    rows = mixing.mix_sources(df).collect()
    assert len(rows) == df.count()
    by_source = {}
    for r in rows:
        assert r.size == len(WORD.findall(texts[r.doc_id])) and r.taken in (0, r.size, 2 * r.size)
        by_source.setdefault(r.source, []).append(r)
    total = sum(r.size for r in rows)
    assert abs(sum(rs[0].target for rs in by_source.values()) - 1.5 * total) < 1e-6
    for rs in by_source.values():
        assert rs[0].target <= 2 * rs[0].source_size + 1e-9
        assert abs(sum(r.taken for r in rs) - rs[0].target) <= 2 * max(r.size for r in rs)
    assert sorted(map(tuple, rows), key=repr) == sorted(map(tuple, mixing.mix_sources(df).collect()), key=repr)
    mixed = mixing.repeat_documents(df)
    assert mixed.columns == [*df.columns, "copy"] and mixed.count() == sum(r.copies for r in rows)
    assert mixing.mix_sources(empty).count() == 0 and mixing.mix_sources(odd).count() == 4


def test_leaks_are_all_found(spark, docs, empty, odd):
    df, texts = docs
    rng = random.Random(3)
    items = [(i, " ".join(WORD.findall(texts[i])[:25]) + (" new words here" if i % 2 else "")) for i in rng.sample(range(50), 20)]
    items += [(100, None), (101, ""), (102, "one"), (None, "alpha alpha")]
    table = spark.createDataFrame(items, "item_id long, text string")
    want = {(i, d) for i, t in items if t and i is not None for d, text in texts.items()
            if (s := shingles(t, 5)) and 100 * len(s & shingles(text, 5)) >= 80 * len(s)}
    for block in (2_000_000, 10):
        got = decontaminate.find_contained(df, table, block=block).collect()
        assert {(r.item_id, r.doc_id) for r in got} == want and len(got) == len(want) > 10
    clean = decontaminate.decontaminate(df, table)
    assert clean.columns == df.columns and {r.doc_id for r in clean.collect()} == set(texts) - {d for _, d in want}
    assert decontaminate.find_contained(empty, table).count() == 0 == decontaminate.find_contained(df, table.limit(0)).count()
    assert decontaminate.find_contained(odd, table).count() == 0


def test_licenses(spark, empty, odd):
    rows = [(1, "text\nReleased under the MIT License.\nmore"), (2, "Licensed under the Apache License, Version 1.1."),
            (3, "licence to sing"), (4, "x " * 5000 + "This work is licensed under the GNU General Public License, version 3. " + "y " * 5000),
            (None, "Licensed under CC BY-NC 4.0."), (5, None), (6, "")]
    found = licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.line, r.license) for r in found if r.confirmed} == {(1, 1, "MIT"), (4, 0, "GPL-3.0"), (None, 0, "CC-BY-NC-4.0")}
    assert licenses.scan_licenses(empty).count() == 0 == licenses.scan_licenses(odd).count()


@pytest.mark.parametrize("around", [50, 500, 3000, 12000])
def test_licenses_inside_prose_that_does_not_compress(spark, around):
    rng = random.Random(around)

    def prose():
        out = []
        while sum(map(len, out)) < around // 2:
            out.append("".join(rng.choice("abcdefghijklmnopqrstuvwxyzäß") for _ in range(rng.randint(2, 12))))
        return " ".join(out)

    names = list(licenses.TEMPLATES)
    rows = [(i, f"{prose()} {licenses.TEMPLATES[n]} {prose()}") for i, n in enumerate(names)]
    found = licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).where("confirmed").collect()
    assert {(r.doc_id, r.line, r.license) for r in found} == {(i, 0, n) for i, n in enumerate(names)}


def test_licenses_of_one_line_and_broken_over_lines(spark):
    mit, gpl, nc = (licenses.TEMPLATES[n] for n in ("MIT", "GPL-3.0", "CC-BY-NC-4.0"))
    rows = [(1, f"{nc} {mit}"), (2, f"{mit} {'word ' * 4000}{gpl}"), (3, "one\nReleased under the\n * MIT License. two"),
            (4, "This work is\nlicensed under the GNU General\nPublic License, version 3.\n" + mit),
            (5, "Released under\n\nthe MIT License."), (6, f"{mit} and {mit}"), (7, licenses.TEMPLATES["Apache-2.0-text"]),
            (8, "Licensed x under CC y BY 4.0. LICENSED UNDER CC BY-SA 4.0.")]
    df = licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string"))
    found = [(r.doc_id, r.line, r.license, r.nth) for r in df.where("confirmed").collect()]
    assert sorted(found) == [(1, 0, "CC-BY-NC-4.0", 0), (1, 0, "MIT", 0), (2, 0, "GPL-3.0", 0), (2, 0, "MIT", 0), (3, 1, "MIT", 0),
                             (4, 0, "GPL-3.0", 0), (4, 3, "MIT", 0), (6, 0, "MIT", 0), (6, 0, "MIT", 1),
                             (7, 0, "Apache-2.0-text", 0), (8, 0, "CC-BY-4.0", 0), (8, 0, "CC-BY-SA-4.0", 0)]


@pytest.mark.parametrize(("words", "percent"), [(4, 85), (5, 80)])
def test_similar_documents_have_the_components_of_all_links(docs, empty, odd, words, percent):
    df, texts = docs
    sets = {d: shingles(t, words) for d, t in texts.items()}
    parent = {d: d for d in texts}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    for a in texts:
        for b in texts:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.similar_documents(df, words, percent).collect()}
    assert got == {d: (len(sets[d]), root(d)) for d in texts}
    kept = jaccard.keep_one(df, words, percent)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {root(d) for d in texts}
    assert jaccard.similar_documents(empty).count() == 0 and jaccard.similar_documents(odd).count() == 4


def test_every_link_between_different_sets_is_returned(spark, docs, empty, monkeypatch):
    monkeypatch.setattr(jaccard, "KEY_BLOCK", 3)
    rng = random.Random(9)
    base = [f"w{i}" for i in range(80)]
    texts = dict(docs[1])
    for i in range(12):  # near copies that all link to each other, one of them twice
        own = list(base)
        own[rng.choice((0, 79))] = f"v{i}"
        texts[1000 + i] = " ".join(own)
    texts[1012] = texts[1003]
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    classes: dict = {}
    for d in sorted(texts):
        if s := frozenset(shingles(texts[d], 4)):
            classes.setdefault(s, d)
    want = {(a, b) for s, a in classes.items() for t, b in classes.items() if a < b and 100 * len(s & t) >= 85 * len(s | t)}
    found = [tuple(sorted((r.doc_id_x, r.doc_id_y))) for r in jaccard.similar_links(df, 4, 85).collect()]
    assert sorted(found) == sorted(want) and {(1000 + a, 1000 + b) for a in range(12) for b in range(a + 1, 12)} <= want
    got = {r.doc_id: (r.n_shingles, r.class_id, r.n_links) for r in jaccard.count_links(df, 4, 85).collect()}
    sets = {d: frozenset(shingles(t, 4)) for d, t in texts.items()}
    assert got == {d: (len(s), classes.get(s, d), sum(classes.get(s) in pair for pair in want)) for d, s in sets.items()}
    assert jaccard.similar_links(empty).count() == 0 == jaccard.count_links(empty).count()


def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(size=12)]) for i in range(300)]
    rows += [(300, None), (301, [1.0, float("nan")] + [0.0] * 10), (302, [None] + [1.0] * 11), (303, []), (304, [1.0]), (None, [1.0] * 12)]
    rows += [(400 + i, rows[10][1]) for i in range(8)] + [(500, [1e30] * 12), (550, [-1e30] + [1e29] * 11)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    ints = {i: [int(np.floor(256 * x)) for x in v] for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    want = set()
    for q in (i for i in ints if i % 50 == 0):
        score = sorted((-max(-(2**63), min(2**63 - 1, sum(a * b for a, b in zip(ints[q], v)))), i) for i, v in ints.items() if i != q and len(v) == len(ints[q]))
        want |= {(q, rank + 1, i, -s) for rank, (s, i) in enumerate(score[:5])}
    for block in (8192, 3):
        got = {tuple(r) for r in maxscore.exact_top_k(df, df.where("vec_id % 50 = 0"), block=block).collect()}
        assert got == want
    assert maxscore.exact_top_k(df.limit(0), df.limit(0)).count() == 0


def test_top_k_scores_are_integers_and_do_not_depend_on_blocks(spark):
    rows = [(50, [2.0**27 + 1, 1.0]), (1, [2.0**27 + 1, 1.0]), (2, [2.0**27 + 3, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {tuple(r) for r in maxscore.exact_top_k(df, df.where("vec_id = 50"), scale=1.0).collect()}
    assert got == {(50, 1, 2, 18014399046352899), (50, 2, 1, 18014398777917442)}
    # A query row that is repeated, another vector under its id, and candidates that repeat or tie.
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (0, [0.0, 2.0])] + [(i, [float(i % 4), float(i % 3)]) for i in range(1, 30)] + [(3, [3.0, 0.0])] * 2
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    ints = [(i, [256 * x for x in v]) for i, v in rows]
    scores = sorted((-sum(a * b for a, b in zip(q, v)), i) for q in ([256, 0], [0, 512]) for i, v in ints if i)
    want = [(0, r + 1, i, int(-s)) for r, (s, i) in enumerate(scores[:5])]
    for block in (8192, 2, 1):
        assert [tuple(r) for r in maxscore.exact_top_k(df, df.where("vec_id = 0"), block=block).orderBy("rank").collect()] == want


def test_archives_round_trip(spark, tmp_path):
    bodies = ["<p>a</p>", "<p>a</p>", "b\r\n\r\nWARC/1.1\r\n\r\n", "ends in\r\n", "ends in\r", "", None, "é" * 70000, "<p>a</p>", "\r\n\r\n"]
    rows = [(i, f"http://x/{i}\r\nevil: 1", b, "extra") for i, b in enumerate(bodies)] + [(None, None, "<p>a</p>", "e"), (0, "http://x/0", "<p>a</p>", "e")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digest string")
    for least in (0, 3):
        path = str(tmp_path / f"archive{least}")
        warc.write_archives(pages, path, min_bytes=least)
        got = warc.read_archives(spark, path).collect()
        assert len(got) == len(rows)
        first = {}
        for i, _, b, _ in rows:
            first[b or ""] = min(i if i is not None else 99, first.get(b or "", 99))
        text = dict(enumerate(bodies)) | {None: "<p>a</p>"}
        for r in got:
            body = text[r.page_id] or ""
            revisit = len(body.encode()) >= least and r.page_id != first[body]
            assert (r.record_type, r.refers_to) == (("revisit", first[body]) if revisit else ("response", None))
            assert r.payload_bytes == len(body.encode()) and (revisit or (bytes(r.payload).decode() == body and r.digest_ok))
    warc.write_archives(pages.limit(0), str(tmp_path / "none"))
    assert warc.read_archives(spark, str(tmp_path / "none")).count() == 0


@pytest.mark.parametrize("length", [7, 20, 50])
def test_repeated_strings_are_removed(docs, empty, odd, length):
    df, texts = docs
    raw = {d: t.encode() for d, t in texts.items()}
    first = {}
    for d, t in sorted(raw.items()):
        for i in range(len(t) - length + 1):
            first.setdefault(t[i : i + length], d)
    want = {}
    for d, t in raw.items():
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if first[t[i : i + length]] < d:
                gone[i : i + length] = b"\1" * length
        want[d] = (bytes(b for b, g in zip(t, gone) if not g), sum(1 for i in range(len(t)) if gone[i] and (not i or not gone[i - 1])))
    for hot in (50_000, 1):
        got = suffixes.remove_repeats(df, length, hot=hot).collect()
        assert len(got) == df.count() and {r.doc_id: (bytes(r.kept), len(r.spans)) for r in got} == want
    assert suffixes.remove_repeats(empty).count() == 0
    assert {bytes(r.kept) for r in suffixes.remove_repeats(odd, 5).collect()} == {b"a b c d e f g", b"", b"x"}


def test_quality_on_held_out_rows(spark, docs, empty, odd):
    rng = random.Random(2)
    good = lambda: " ".join(rng.choice(["the", "river", "runs", "over", "stone", "and", "field"]) for _ in range(60))
    bad = lambda: " ".join(rng.choice(["BUY!!", "NOW!!", "CHEAP!!", "$$$", "###"]) for _ in range(60))
    rows = [(i, good() if i % 3 else bad()) for i in range(600)] + [(600, None), (601, ""), (602, " ".join(good() for _ in range(300)))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(600)] + [(3, 1), (None, 1), (5, None)], "doc_id long, quality int")
    model = quality.fit(df, labels)
    out = {r.doc_id: (r.h, r.s) for r in df.select("doc_id", quality.held_out(F.col("doc_id")).alias("h"), quality.quality_score(F.col("text"), model).alias("s")).collect()}
    assert all(h == (zlib.crc32(str(d).encode()) % 3 == 1) and 0 <= s <= 1 for d, (h, s) in out.items())
    held = [(s >= 0.5) == (d % 3 > 0) for d, (h, s) in out.items() if h and d < 600]
    assert np.mean(held) > 0.98 and out[602][1] >= 0.5 and out[600][1] == out[601][1]
    assert quality.fit(df, labels.limit(0)) == quality.Model() == quality.fit(df, labels.where("quality = 1"))
    assert quality.keep_good(odd, labels.limit(0)).count() == 4 and quality.keep_good(empty, labels).count() == 0


def brute_spans(text):
    out = []
    luhn = lambda d: sum((lambda n: n - 9 if n > 9 else n)(int(x) * (1 + i % 2)) for i, x in enumerate(d[::-1])) % 10 == 0
    for k, p in enumerate((r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
                           r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")):
        for m in re.finditer(p, text):
            d = re.sub("[^0-9]", "", m[0])
            if (k == 0 or k == 1 and all(int(x) <= 255 for x in m[0].split(".")) or k == 2 and 13 <= len(d) <= 19 and luhn(d)
                    or k == 3 and 9 <= len(d) <= 15):
                out.append((k, m.start(), m.end()))
    return out


def test_base_spans_equal_the_patterns():
    rng = random.Random(11)
    for _ in range(3000):
        text = "".join(rng.choice("ab1234056789.@+-() \né%") for _ in range(rng.randint(0, 60)))
        assert sorted(pii.base_spans(text)) == sorted(brute_spans(text)), text
    assert pii.base_spans("4111 1111-1111 1111") == [(2, 0, 19)]


def test_personal_data_of_the_contract(spark, tmp_path):
    texts = ["ip 10.0.0.1, 10.0.0.2 and 10.0.0.3", "call +52 55 1234 5678", "a@b.co c@d.org 4111 1111 1111 1111", "1.2.3.256",
             "x@y.mx 8.8.8.8 +1 (555) 123-4567, 5500-0055-5555-5559", "ñandú 😀 1.1.1.1", "", None, "ip 10.0.0.1, 10.0.0.2 and 10.0.0.3"]
    rows = [(min(i, 7), t) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = QUERIES["op9_find_personal_data"](spark, str(tmp_path)).select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256").collect()
    expected = []
    for i, text in rows:
        spans = brute_spans(text or "")
        listed = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in spans)
        counts = [sum(k == kind for k, _, _ in spans) for kind in range(4)]
        expected.append((i, *counts, hashlib.sha256(listed.encode()).hexdigest()))
    assert sorted(map(tuple, found)) == sorted(expected)
    assert [e[1:5] for e in expected[:5]] == [(0, 3, 0, 0), (0, 0, 0, 1), (2, 0, 1, 0), (0, 0, 0, 0), (1, 1, 1, 1)]


def test_terms_that_reveal_an_entity_are_found_and_replaced(spark, empty):
    rng = random.Random(4)
    fill = lambda: " ".join(rng.choice(["lorem", "ipsum", "dolor", "sit", "amet"]) for _ in range(12))
    rows = [(i, f"{fill()}\ncall Zebulon {fill().split()[0]} at zeb@mail.example.com {fill()}" if i % 10 == 0 else fill(), "x") for i in range(200)]
    rows += [(300, "Zebulon was here", "x"), (301, None, "x"), (302, "", "x")] + [(400 + i, "unique copied note to ann@mail.example.com", "x") for i in range(5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    out = {r.doc_id: r for r in pii.find_spans(df, into="found").collect()}
    assert any(s.kind == 4 for s in out[0].found) and [tuple(s) for s in out[300].found] == [(4, 0, 7)]
    assert [s.kind for s in out[400].found] == [0] and not out[301].found and not out[302].found and not out[1].found
    clean = {r.doc_id: r.text for r in pii.sanitise(df).collect()}
    assert clean[300] == "[TERM] was here" and "@" not in clean[0] and "[EMAIL]" in clean[0] and clean[301] is None
    assert pii.sanitise(df).columns == df.columns and pii.find_spans(empty).count() == 0


def test_rare_and_distant_terms_reveal_an_entity(spark):
    rng = random.Random(5)
    fill = lambda n=12: " ".join(rng.choice(["lorem", "ipsum", "dolor", "sit", "amet"]) for _ in range(n))
    rows = [(i, fill()) for i in range(300)]
    rows[3:5] = [(i, f"Ottokar\n{fill()}\nott@mail.example.com {fill()}") for i in (3, 4)]  # two documents, another line
    rows[10:14] = [(i, f"Walburga {fill(30)} {i}.wal@mail.example.com wal@mail.example.com") for i in range(10, 14)]  # far away
    rows[20:22] = [(i, f"Kunibert {fill()} kun@mail.example.com") for i in (20, 21)]
    rows[22:30] = [(i, f"Kunibert {fill()}") for i in range(22, 30)]  # mostly elsewhere
    rows[40:44] = [(i, f"copied Adelheid {rows[40][1]} ade@mail.example.com") for i in range(40, 44)]  # one text, four times
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.term: r.disclosure for r in pii.revealing_terms(df).collect()}
    want = {int(pii._hash_of(w).view(np.int64)) for w in ("ottokar", "walburga")}
    assert set(got) == want and all(abs(d - 1) < 1e-9 for d in got.values())
    rare = pii.revealing_terms(df, max_chance=1e-6).collect()  # two documents are too few for this
    assert [r.term for r in rare] == [int(pii._hash_of("walburga").view(np.int64))]


@pytest.mark.parametrize("keep", ["none", "first"])
def test_shared_lines(docs, empty, odd, keep):
    df, texts = docs
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(FOLD)
    seen = {}
    for d, t in sorted(texts.items()):
        for i, line in enumerate(t.split("\n")):
            if key(line):
                seen.setdefault(key(line), []).append((d, i))
    gone = {place for places in seen.values() if len({d for d, _ in places}) >= 3 for place in (places if keep == "none" else places[1:])}
    want = {d: "\n".join(x for i, x in enumerate(t.split("\n")) if (d, i) not in gone) for d, t in texts.items()}
    got = lines.apply_bitmaps(df, lines.shared_line_bitmaps(df, 3, 1, keep))
    assert set(got.columns) == {*df.columns, "n_dropped"} and gone
    assert {r.doc_id: r.text or "" for r in got.collect()} == want and got.count() == df.count()
    assert lines.shared_line_bitmaps(empty, 2).count() == 0 and lines.apply_bitmaps(odd, lines.shared_line_bitmaps(odd, 2)).count() == 4
    with pytest.raises(ValueError):
        lines.shared_line_bitmaps(df, keep="last")


def test_line_digest_of_the_contract(spark):
    text = "a\n\nB\n"
    rows = spark.createDataFrame([(i, text) for i in range(12)], "doc_id long, text string")
    got = lines.apply_bitmaps(rows, lines.shared_line_bitmaps(rows, 10), text="kept").collect()
    assert {hashlib.sha256(r.kept.encode()).hexdigest() for r in got} == {hashlib.sha256(b"\n").hexdigest()} and {r.n_dropped for r in got} == {2}


NAMES = ["_dropped", "_b_doc", "_b_row", "_b_n", "_b_keep", "_b_text", "_l_doc", "_l_row", "_k_doc", "_k_row", "_k_again", "_s", "_whole",
         "_end", "_cut", "_key", "_row", "_source", "_copies", "_d", "_r", "_mix_key", "copy", "a.b", "line", "n", "set", "_pii_spans"]


@pytest.fixture(scope="module")
def clashing(spark):
    """Documents whose other columns have the names of helper columns, one with a dot."""
    prepare(spark)
    texts = ["one two three four five six seven", "one two three four five six seven", "shared\nown text of this one", None, "", "x y"]
    rows = [(i // 2 if i < 4 else None, t, "en", f"s{i % 2}", 5) for i, t in enumerate(texts)] + [(20 + i, f"shared\nrow {i} " + "w " * i, "en", "s1", 3) for i in range(12)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for i, name in enumerate(NAMES):
        df = df.withColumn(name, F.lit(f"v{i}"))
    return df


def test_helper_columns_clash_with_nothing(spark, clashing):
    bitmaps = lines.shared_line_bitmaps(clashing, min_docs=10)
    kept = lines.apply_bitmaps(clashing, bitmaps, dropped="lost")
    assert kept.columns == [*clashing.columns, "lost"] and kept.count() == clashing.count()
    assert kept.where("lost = 1").count() == 13 and kept.where("text like 'shared%'").count() == 0
    one = jaccard.keep_one(clashing)
    assert one.columns == clashing.columns and one.select("`a.b`", "copy").distinct().collect() == [(f"v{NAMES.index('a.b')}", f"v{NAMES.index('copy')}")]
    items = spark.createDataFrame([(1, "two three four five six")], "item_id long, text string")
    clean = decontaminate.decontaminate(clashing, items)
    assert clean.columns == clashing.columns and clean.count() == clashing.count() - 2
    mixed = mixing.repeat_documents(clashing)
    assert mixed.columns == [*clashing.columns, "_copy"] and {r["copy"] for r in mixed.collect()} == {f"v{NAMES.index('copy')}"}
    assert pii.sanitise(clashing).columns == clashing.columns


def test_leaking_rows_are_told_apart_by_text(spark):
    rows = [(1, "a clean text under a shared id here"), (1, "so q1 q2 q3 q4 q5 q6 q7 it leaks"), (None, "q1 q2 q3 q4 q5 q6 q7"), (None, "clean without an id"),
            (2, "long text with Answer is 42 in it " + "w " * 500), (3, "answer is 43"), (4, "answer IS 42"), (5, "answer is"), (6, None), (7, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame([(10, "q1 q2 q3 q4 q5 q6 q7"), (11, "answer is 42"), (12, ""), (13, None), (None, "clean without an id"), (14, "Answer is 42")],
                                  "item_id long, text string")
    kept = {tuple(r) for r in decontaminate.decontaminate(docs, items).collect()}
    assert kept == {r for i, r in enumerate(rows) if i not in (1, 2, 4, 6)}
    found = {(r.item_id, r.doc_id, r.n_shingles, r.n_found) for r in decontaminate.find_contained(docs, items).collect()}
    assert found == {(10, 1, 3, 3), (10, None, 3, 3), *((i, d, 1, 1) for i in (11, 14) for d in (2, 4))}


def test_one_row_of_each_component_is_kept(spark):
    long = " ".join(f"w{i}" for i in range(60))
    near = long.replace("w59", "v59")
    rows = [(5, long, "a"), (5, long, "a"), (3, near, "b"), (None, long, "c"), (3, "", "d"), (3, "", "d"), (4, None, "e"), (None, "alone with null id", "f"),
            (None, "alone with null id", "f"), (None, "another text of no id at all", "g"), (7, "same id other text x y z", "h"), (7, "same id but unlike text p q r", "i")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, other string").repartition(4)
    got = sorted((tuple(r) for r in jaccard.keep_one(docs).collect()), key=repr)
    assert got == sorted([rows[2], rows[4], rows[6], rows[7], rows[9], rows[10], rows[11]], key=repr)


def test_rows_of_one_key_are_divided(spark):
    rows = [(None, "a b c d", "s0")] * 50 + [(i, "a b c d", "s1") for i in range(150)] + [(7, "a b c d", "s2")] * 30
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(6)
    weights = spark.createDataFrame([("s0", 3), ("s1", 9), ("s2", 2)], "source string, weight int")
    got = mixing.mix_sources(docs, weights).collect()
    taken, target = {}, {}
    for r in got:
        taken[r.source] = taken.get(r.source, 0) + r.taken
        target[r.source] = r.target
        assert r.copies <= 2
    assert len(got) == len(rows) and all(abs(taken[s] - target[s]) <= 2 for s in taken)
    copies = mixing.repeat_documents(docs, weights).groupBy("source").count().collect()
    assert {r.source: 4 * r["count"] for r in copies} == taken


@pytest.mark.parametrize("batch", ["1", "3", "10000"])
def test_lines_that_pass_in_many_batches(spark, batch):
    """Long runs of one line, cut by Arrow batches and by partitions."""
    rng = random.Random(4)
    rows = [(rng.choice([None, *range(40)]), "\n".join(rng.choice(["hot", " HOT ", "rare", "b", "c", f"own {i}"]) for _ in range(rng.randint(1, 9)))) for i in range(150)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    where: dict = {}
    for d, t in rows:
        for pos, line in enumerate(t.split("\n")):
            where.setdefault(line.strip().lower(), set()).add((d is not None, d or 0))
    common = {k for k, ids in where.items() if len(ids) >= 10 and k}
    order = lambda d, t: (d is not None, d or 0)  # noqa: E731  Spark sorts nulls first
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    prepare(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        none = {(r.doc_id, r.text, r.kept) for r in lines.apply_bitmaps(df, lines.shared_line_bitmaps(df, 10), text="kept").collect()}
        first = [(r.doc_id, r.text, r.kept) for r in lines.apply_bitmaps(df, lines.shared_line_bitmaps(df, 10, keep="first"), text="kept").collect()]
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert none == {(d, t, "\n".join(x for x in t.split("\n") if x.strip().lower() not in common)) for d, t in rows}
    lines_of = lambda t: [x.strip().lower() for x in t.split("\n")]
    for key in common:
        keepers = {(d, t) for d, t, kept in first if key in lines_of(kept)}
        lowest = min(order(d, t) for d, t in rows if key in lines_of(t))
        assert len(keepers) == 1 and order(*next(iter(keepers))) == lowest
        assert sum(lines_of(kept).count(key) for kept in {(d, t, k)[2] for d, t, k in first}) == 1


def test_terms_of_a_very_long_text_take_linear_time(spark):
    words = ["Überraschung", "mail", "me@x.example.com", "term"]
    text = " ".join(words[i % 4] for i in range(300_000))
    data, offsets = pii.text_bytes(__import__("pyarrow").array([text[:200], text]))
    terms = np.unique(pii._terms(data, offsets)[0])
    df = spark.createDataFrame([(1, text), (2, text[:300])], "doc_id long, text string")
    found = df.select("text", pii._base(F.col("text")).alias("spans"))
    begin = __import__("time").time()
    got = found.select("text", pii._with_terms(F.col("text"), F.col("spans"), terms).alias("spans")).collect()
    assert __import__("time").time() - begin < 90
    for r in got:
        spans = sorted((s.start, s.end, s.kind) for s in r.spans)
        assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
        texts = {(r.text[a:b], kind) for a, b, kind in spans if b < 290}
        assert ("me@x.example.com", 0) in texts and ("Überraschung", 4) in texts and ("mail", 4) in texts
