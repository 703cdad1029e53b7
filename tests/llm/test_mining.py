"""Source divergence, collocations and page templates against brute force, with nulls, ties, repeats and extra columns."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict
from html.parser import HTMLParser

import numpy as np
import pytest
from pyspark.sql import functions as F

from eavcube.llm import collocations, divergence, templates
from eavcube.llm.common import prepare

DOCS = "doc_id long, text string, lang string, source string, n long, term string, rank int, part int, words string"
PAGES = "page_id long, url string, html string, host string, tokens string, page string"
FOLD = {c: c + 32 for c in range(65, 91)}


def rows_of(seed=3, n=150):
    rng = random.Random(seed)
    words = ["Alpha", "beta", "gamma", "déjà", "eps", "zeta", "Eta2theta", "iota", "kappa", "x-y", "the", "of"]
    out = []
    for i in range(n):
        pieces = []
        for _ in range(rng.randint(1, 6)):
            if rng.random() < 0.4:
                pieces.append(rng.choice(["new  york city", "the quick\tbrown fox", "New York", "of the of the of the"]))
            pieces.append(" ".join(rng.choices(words, weights=range(1, 13), k=rng.randint(1, 12))))
        text = rng.choice([", ", ". ", "\n", " "]).join(pieces)
        out.append((i, text, rng.choice(["en", "en", "de", None]), rng.choice(["s0", "s0", "s0", "s1", "s2", None, ""]), 1, "t", 2, 3, "w"))
    out += [out[0], (None, "the of the", "en", "s0", 1, "t", 2, 3, "w"), (None, None, None, None, None, None, None, None, None),
            (7, "", "fr", "lonely", 1, "t", 2, 3, "w"), (8, "once only", "fr", "other", 1, "t", 2, 3, "w")]
    return out


@pytest.fixture(scope="module")
def docs(spark):
    prepare(spark)
    return spark.createDataFrame(rows_of(), DOCS).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


# ---- source divergence

def plain_divergence(rows, min_docs, k):
    docs = [(r[2] or "", r[3] or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (r[1] or "").translate(FOLD))) for r in rows]
    counts, lang_counts, seen, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, terms in docs:
        groups[lang].add(source)
        counts[lang, source].update(terms)
        lang_counts[lang].update(terms)
        seen[lang].update(set(terms))
    out = set()
    for lang, sources in groups.items():
        kept = [t for t, n in seen[lang].items() if n >= min_docs]

        def shares(c):
            total = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 1) // (total + len(kept)) for t in kept}

        p = {s: shares(counts[lang, s]) for s in sources}
        q = shares(lang_counts[lang])
        for s in sources:
            pairs = [(-sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o) for o in sources if o != s]
            terms = [(-((p[s][t] - q[t]) ** 2 // q[t]), t) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, found in (("pair", sorted(pairs, key=lambda x: (x[0], x[1].encode()))),
                                ("term", sorted(terms, key=lambda x: (x[0], x[1].encode()))[:k])):
                out |= {(lang, s, part, item, -v, i + 1) for i, (v, item) in enumerate(found)}
    return out


@pytest.mark.parametrize(("min_docs", "k"), [(3, 200), (1, 2), (10**6, 5)])
def test_divergence_equals_brute_force(docs, min_docs, k):
    got = divergence.source_divergence(docs, min_docs, k)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert [t for _, t in got.dtypes][4:] == ["bigint", "int"]
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == plain_divergence(rows_of(), min_docs, k)


def test_divergence_of_nothing(empty):
    assert divergence.source_divergence(empty).count() == 0


def test_skyband_equals_brute_force_and_merges(spark):
    rng = np.random.default_rng(5)
    points = {(int(rng.integers(1, 12)), int(rng.integers(1, 30)), i) for i in range(900)}
    order = sorted(points, key=lambda x: (-x[0], x[1], x[2]))
    want = {x for x in points if sum(y != x and y[0] >= x[0] and y[1] <= x[1] and y[2] <= x[2] for y in points) < 4}
    n, c, t = (np.array(x) for x in zip(*order))
    assert {x for x, k in zip(order, divergence.in_skyband(n, c, t, 4)) if k} == want
    frame = spark.createDataFrame([("l", "s", f"{x[2]:04d}", x[0], x[1]) for x in points], divergence._POINTS).repartition(7)
    for limit in (50, 10_000):  # cut early, or once for each task
        got = {(r.n, r.lang_n, int(r.term)) for r in divergence.skybands(frame, 4, limit).collect()}
        assert got == want


def test_shares_stay_exact_beyond_64_bits(spark):
    n, total = 7 * 10**14 + 3, 9 * 10**14 + 1
    row = spark.range(1).select(divergence.share(F.lit(n), F.lit(total), F.lit(11)).alias("p")).first()
    assert row.p == 1 + 10**9 * (n + 1) // (total + 11)
    a, both = 4 * 10**15 - 1, 8 * 10**15 + 7
    assert spark.range(1).select(collocations.score(F.lit(a), F.lit(both)).alias("s")).first().s == 2_000_000 * a // both


# ---- collocations

def plain_collocations(rows, min_count, first, cover=80):
    f, n = defaultdict(Counter), Counter()
    for r in rows:
        lang = "und" if r[2] is None else r[2]
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (r[1] or "").translate(FOLD)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for size in (1, 2, 3, 4):
                f[lang].update(tuple(w[i : i + size]) for i in range(len(w) - size + 1))
    out = set()
    for lang, counts in f.items():
        candidates = {p: a for p, a in counts.items() if len(p) > 1 and a >= min_count}
        kept = []
        for p, a in candidates.items():
            inside = [b for x, b in candidates.items() if len(x) > len(p) and any(x[i : i + len(p)] == p for i in range(len(x) - len(p) + 1))]
            if inside and 100 * max(inside) >= cover * a:
                continue
            s, _, left, right = min((2_000_000 * a // (counts[p[:k]] + counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
            kept.append((-s, -a, " ".join(p).encode(), left, right))
        out |= {(lang, i + 1, p.decode(), -a, left, right, n[lang], -s) for i, (s, a, p, left, right) in enumerate(sorted(kept)[:first])}
    return out


@pytest.mark.parametrize(("min_count", "first", "bits"), [(5, 2000, 26), (2, 7, 26), (3, 50, 6)])
def test_collocations_equal_brute_force(docs, min_count, first, bits):
    got = collocations.mine_collocations(docs, min_count, first, bits=bits)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == plain_collocations(rows_of(), min_count, first)


def test_collocations_of_nothing_and_of_a_very_long_text(spark, empty):
    assert collocations.mine_collocations(empty).count() == 0
    text = "one two three. " * 400_000  # longer than several segments
    long = spark.createDataFrame([(1, text, "en", None, 1, "t", 2, 3, "w")], DOCS)
    assert {tuple(r) for r in collocations.mine_collocations(long).collect()} == {
        ("en", 1, "one two three", 400_000, 400_000, 400_000, 1_200_000, 1_000_000)}


def test_streams_fill_what_a_range_does_not_hold(spark):
    """With more ranges than phrases every beginning is in another range than its continuations."""
    phrases = [("en", ["a"], 90)] + [("en", ["a", f"b{i:02d}"], 40 + i) for i in range(30)] + [("en", ["a", "b07", "c"], 33), ("en", ["a", "b07", "c", "d"], 31)]
    frame = spark.createDataFrame(phrases, "lang string, words array<string>, a long")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "40")
        got = {tuple(r.words): (r.c1, r.c2, r.c3, r.ext) for r in collocations._stream(frame, False).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got[("a",)] == (None, None, None, 69)
    assert got[("a", "b07")] == (90, None, None, 33) and got[("a", "b12")] == (90, None, None, 0)
    assert got[("a", "b07", "c")] == (90, 47, None, 31) and got[("a", "b07", "c", "d")] == (90, 47, 33, 0)


# ---- page templates

FRAME = ('<!DOCTYPE html><html lang="en"><head><title>T {i}</title><style>p{{}}</style><script>var t="</p>";</script></head><body class="has-sidebar">'
         '<nav><ul><li><a href="/{i}">Menu {i}</a></li></ul></nav><div class="ad">Buy {i}</div><div id="page-{i}">{body}</div>'
         '<aside>More {i}</aside><form><p>Search {i}</p></form><footer>&copy; {i}</footer></body></html>')


def article(i):
    extra = "<p>Only here &amp; now.</p>" if i % 3 == 0 else ""
    return (f"<article><header><h1>Head &lt;{i}&gt;</h1></header><p>Read   this\n first</p><p><b>Text {i} <i>one</i><br>two<p>Last&nbsp;{i}</p>{extra}"
            f'<ul><li>a{i}<li>b</ul><table><tr><td>c<td>{i}</table><div class="comments"><article class="comment"><p>me {i}</p></article></div>'
            f'<p>see <span class="ad">advert {i}</span>below {i}</p></article>')


def want_article(i, learned):
    extra = ["Only here & now."] if i % 3 == 0 else []
    return "\n\n".join([f"Head <{i}>", *([] if learned else ["Read this first"]), f"Text {i} one two", f"Last {i}", *extra,
                        f"a{i}", *([] if learned else ["b"]), f"c {i}", f"see below {i}"])


@pytest.fixture(scope="module")
def pages(spark):
    prepare(spark)
    rows = [(i, f"https://user@Host.example.com:80/{i}?q#x", FRAME.format(i=i, body=article(i)), "h", "t", "p") for i in range(12)]
    rows += [(100 + i, f"http://few.example.com/{i}", FRAME.format(i=i, body=article(i)), "h", "t", "p") for i in range(3)]
    # Copies and near copies: one page of the host is different, so half of its distinct pages share nothing unusual.
    rows += [(200 + i, "http://copies.example.com/", FRAME.format(i=1, body=article(1)), "h", "t", "p") for i in range(6)]
    # No article element: the slot with most text outside links.
    rows += [(300 + i, f"http://plain.example.com/{i}", f"<html><body><div class=top><a href=/>Home {i}</a> all</div><div class=x><p>Body {'long ' * i}text {i}</p>"
              f"<p>second {i}</p></div><div class=links><a href=/a>one link {i} and more and more words in links than text</a></div><div class=end>Ends {i}</div></body></html>", "h", "t", "p")
             for i in range(5)]
    odd = ["", None, "plain text only", "<p>cut at <b", "<!-- never closed <p>x</p>", "a < b <3 &unknown; &amp", "<div>" * 5_000 + "deep", "<p>" + "word " * 300_000,
           "<article><p title=it's>one's</p><p title='a>b'>two</p></article>", "<script>never closed <p>x"]
    rows += [(400 + i, None if i % 2 else "no host", h, None, None, None) for i, h in enumerate(odd)]
    rows += [rows[0], (None, None, None, None, None, None)]
    return spark.createDataFrame(rows, PAGES).repartition(4)


def test_main_text(pages):
    got = templates.extract_main_text(pages)
    assert got.columns == ["page_id", "url", "text", "n_chars"] and got.count() == pages.count()
    rows = got.collect()
    texts = {r.page_id: r.text for r in rows}
    assert all(r.n_chars == len(r.text) for r in rows) and texts[None] == ""
    for i in range(12):
        assert texts[i] == want_article(i, True)
    for i in range(3):
        assert texts[100 + i] == want_article(i, False)
    assert all(texts[200 + i] == want_article(1, False) for i in range(6))
    for i in range(5):
        assert texts[300 + i] == f"Body {'long ' * i}text {i}\n\nsecond {i}"
    assert [texts[400 + i] for i in range(7)] == ["", "", "plain text only", "cut at", "", "a < b <3 &unknown; &", "deep"]
    assert texts[407] == " ".join(["word"] * 300_000) and texts[408] == "one's\n\ntwo" and texts[409] == ""


def test_main_text_of_nothing(spark):
    assert templates.extract_main_text(spark.createDataFrame([], PAGES)).count() == 0


def test_templates_equal_brute_force(spark, pages):
    """Vectors held whole, classes by equal vectors, order and nesting checked page by page."""
    got = {r.host: {(t.token, frozenset(x.token for x in r.tokens if x["class"] == t["class"])) for t in r.tokens}
           for r in templates.page_templates(pages).collect()}
    by_host = defaultdict(set)
    for r in pages.collect():
        host = re.sub(":[0-9]*$", "", re.sub("^.*@", "", (re.match(templates._HOST, r.url or "") or ["", ""])[1])).lower()
        if host and r.html:
            by_host[host].add(r.html)
    want = {}
    for host, texts in by_host.items():
        seqs = [[templates._signed(t[0]) for t in templates.read_page(p, host)] for p in sorted(texts)]
        vectors = defaultdict(set)
        for token in {t for s in seqs for t in s}:
            vectors[tuple(s.count(token) for s in seqs)].add(token)
        classes = [(v, frozenset(ts)) for v, ts in vectors.items() if sum(x > 0 for x in v) >= max(4, len(seqs) / 2)
                   and len(ts) > 1 and any(t % 2 == 0 for t in ts)]
        found = set()
        for v, ts in classes:
            orders = set()
            for s in seqs:
                own = [t for t in s if t in ts]
                orders |= {tuple(own[i : i + len(ts)]) for i in range(0, len(own), len(ts))}
            if len(orders) == 1:
                found |= {(t, ts) for t in ts}
        if found:
            want[host] = found
    assert set(got) == set(want) == {"host.example.com", "plain.example.com"}
    for host, tokens in got.items():
        assert tokens <= want[host] and len(tokens) >= 8


class _Plain(HTMLParser):
    """The article's blocks, read another way."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks, self.inside = [""], False

    def handle_starttag(self, tag, attrs):
        self.inside |= tag == "article"
        if tag in ("p", "h1"):
            self.blocks.append("")
        elif tag == "br":
            self.blocks[-1] += " "

    def handle_endtag(self, tag):
        if tag == "article":
            self.inside = False
        if tag in ("p", "h1"):
            self.blocks.append("")

    def handle_data(self, data):
        if self.inside:
            self.blocks[-1] += data


def test_main_text_of_the_given_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    texts = {r.page_id: r.text for r in templates.extract_main_text(pages).collect()}
    for r in pages.collect():
        reader = _Plain()
        reader.feed(r.html)
        assert texts[r.page_id] == "\n\n".join(b for b in (" ".join(x.split()) for x in reader.blocks) if b)
