"""Main text of web pages: templates deduced from tokens that share their occurrence vectors, then the remaining slots."""

from __future__ import annotations

import html
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eavcube.llm.common import staged

# Elements of HTML by what they do to text.
RAW = frozenset("script style title textarea noscript template iframe noembed noframes xmp".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "html head body address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr legend li main menu nav ol p pre search section summary table caption thead tbody tfoot tr ul".split())
# What an element's start closes if it is open inside the nearest of the second.
CLOSES = {"li": (("li",), {"ul", "ol", "menu", "dir"}), "dt": (("dt", "dd"), {"dl"}), "dd": (("dt", "dd"), {"dl"}),
          "tr": (("tr",), {"table"}), "td": (("td", "th"), {"tr", "table"}), "th": (("td", "th"), {"tr", "table"}),
          "body": (("head",), {"html"})}
# Elements that never hold an article's text, and names that say so of any element.
ASIDE = frozenset("nav footer aside form menu dialog search button select svg canvas object audio video map".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar".split())
NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner nav navbar navigation menu "
    "breadcrumb breadcrumbs sidebar aside footer topbar cookie cookies consent gdpr notice notification popup modal overlay "
    "newsletter subscribe signup login search share sharing social related recommended comment comments respond replies disqus "
    "pagination pager".split())
# Of an article element only these; a page's header by its whole name; and beginnings of names that tell of something else.
ARTICLE_NAMES = frozenset("ad ads advert advertisement sponsored promo related recommended comment comments respond replies".split())
HEADERS = frozenset({"header", "site-header", "page-header", "masthead"})
OTHERS = ("has-", "with-", "no-", "is-", "not-")
ARTICLE = frozenset({"article", "main"})

_MARKUP = re.compile(
    r"<!--(?:.*?-->|.*\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*+)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_NAME = re.compile(r"[a-z]+")
_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)"


def host_of(url: Column) -> Column:
    """Lower-case host of a URL, without user and port; empty if there is none."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), _HOST, 1)
    return F.lower(F.regexp_replace(F.regexp_replace(host, "^.*@", ""), ":[0-9]*$", ""))


class _Open:
    """An open element: its name, the hash of its path, and whether its text is an aside, an article's or a link's."""

    __slots__ = ("name", "path", "aside", "article", "link")

    def __init__(self, name, path, aside, article, link):
        self.name, self.path, self.aside, self.article, self.link = name, path, aside, article, link


def _attributes(text: str) -> dict:
    return {k.lower(): html.unescape(v.strip("\"'")) for k, v in _ATTRIBUTE.findall(text)} if text.strip(" /") else {}


def _is_aside(name: str, attributes: dict, article: bool) -> bool:
    if name in ASIDE or name == "header" and not article:
        return True
    if not attributes:
        return False
    if "hidden" in attributes or attributes.get("aria-hidden") == "true" or "display:none" in attributes.get("style", "").replace(" ", ""):
        return True
    if name in ("html", "body", "main"):
        return False
    names = [n for n in f"{attributes.get('class', '')} {attributes.get('id', '')}".lower().split() if not n.startswith(OTHERS)]
    if not article and HEADERS.intersection(names):
        return True
    known = ARTICLE_NAMES if name == "article" else NAMES
    return attributes.get("role", "").lower() in ROLES or any(w in known for n in names for w in _NAME.findall(n))


def read_page(page: str, host: str) -> list[tuple]:
    """Tokens of a page in order: (hash, None) of each element by its path, and of each block of text by its path and
    text (hash, text, aside, article, link characters). Element hashes are even, text hashes odd, both with the host.
    """
    out: list[tuple] = []
    stack = [_Open("", xxhash.xxh64_intdigest(host.encode()), False, False, False)]
    opened: Counter = Counter()  # open elements by name, so that only names that are open are looked for
    held: list[str] = []  # pieces of the current block
    linked = 0
    begun = stack[0]

    def flush():
        nonlocal linked
        if held:
            text = " ".join("".join(held).split())
            if text:
                out.append((xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"), begun.path) | 1, text, begun.aside, begun.article, linked))
            held.clear()
        linked = 0

    def say(text: str):
        nonlocal begun, linked
        if not held:
            if text.isspace():
                return
            begun = next((e for e in reversed(stack) if e.name in BLOCK), stack[0])
        # An aside inside a block (an inline advert) leaves the block's own text alone.
        if stack[-1].aside and not begun.aside:
            return
        text = html.unescape(text)
        held.append(text)
        if stack[-1].link:
            linked += len(text)

    def close_to(depth: int):
        if any(e.name in BLOCK for e in stack[depth:]):
            flush()
        opened.subtract(e.name for e in stack[depth:])
        del stack[depth:]

    at = 0
    while at < len(page):
        found = _MARKUP.search(page, at)
        if not found:
            say(page[at:])
            break
        if found.start() > at:
            say(page[at : found.start()])
        at = found.end()
        name = found[2]
        if name is None:
            continue
        name = name.lower()
        if found[1]:
            depth = opened[name] and next(i for i in range(len(stack) - 1, 0, -1) if stack[i].name == name)
            # The end of an inline element does not end blocks that began inside it.
            if depth and (name in BLOCK or not any(e.name in BLOCK for e in stack[depth + 1 :])):
                close_to(depth)
            elif name in BLOCK:
                flush()
            continue
        if name in RAW:
            end = re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if name in BLOCK:
            flush()
            if opened["p"]:
                close_to(next(i for i in range(len(stack) - 1, 0, -1) if stack[i].name == "p"))
        if name in CLOSES:
            closed, scope = CLOSES[name]
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].name in closed:
                    close_to(i)
                    break
                if stack[i].name in scope:
                    break
        if held and name in ("br", "td", "th"):
            held.append(" ")
        attributes = _attributes(found[3])
        top = stack[-1]
        article = top.article or name in ARTICLE or attributes.get("role", "").lower() in ARTICLE
        sign = f"{name}#{attributes.get('id', '')}.{attributes.get('class', '')}" if attributes else name
        path = xxhash.xxh64_intdigest(re.sub(r"\d+", "", sign).encode("utf-8", "surrogatepass"), top.path)
        out.append((path & ~1, None))
        if name not in VOID:
            aside = name != "main" and (top.aside or _is_aside(name, attributes, top.article))
            opened[name] += 1
            stack.append(_Open(name, path, aside, article, top.link or name == "a"))
    flush()
    return out


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _sequences(batches):
    """host, page (a hash of its text), and the hashes of its tokens in order."""
    for batch in batches:
        hosts, pages = batch.column("host").to_pylist(), batch.column("html").to_pylist()
        seqs = [[_signed(t[0]) for t in read_page(p or "", h)] for h, p in zip(hosts, pages)]
        yield pa.RecordBatch.from_arrays([batch.column("host"), batch.column("page"), pa.array(seqs, pa.list_(pa.int64()))], ["host", "page", "seq"])


def _occurrences(batches):
    """One row for each distinct token of a page: its count, and a hash of (page, count) to add up to its vector."""
    for batch in batches:
        lists = batch.column("seq")
        n = np.diff(lists.offsets.to_numpy())
        token = lists.values.to_numpy()[lists.offsets[0].as_py() : lists.offsets[-1].as_py()]
        row = np.repeat(np.arange(batch.num_rows), n)
        order = np.lexsort((token, row))
        token, row = token[order], row[order]
        new = np.ones(len(token), bool)
        new[1:] = (token[1:] != token[:-1]) | (row[1:] != row[:-1])
        start = np.flatnonzero(new)
        count = np.diff(np.concatenate((start, [len(token)])))
        page = batch.column("page").to_numpy()[row[start]].view(np.uint64)
        with np.errstate(over="ignore"):
            mark = (page + count.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xBF58476D1CE4E5B9)
            mark = (mark ^ (mark >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
            mark ^= mark >> np.uint64(32)
        yield pa.RecordBatch.from_arrays(
            [batch.column("host").take(pa.array(row[start])), pa.array(token[start]), pa.array(count.astype(np.int32)), pa.array(mark.view(np.int64))],
            ["host", "token", "n", "mark"])


class _ByHost:
    """What was read for the hosts of late, as the rows of a host repeat it."""

    def __init__(self, limit: int = 2_000):
        self.held, self.limit = {}, limit

    def of(self, host, value, read):
        if host not in self.held:
            if len(self.held) >= self.limit:
                self.held.clear()
            self.held[host] = read(value.as_py() or [])
        return self.held[host]


_PLACES = "host string, class long, fits boolean, form long, parent long, gap int"


def _places(batches):
    """How the classes of a host lie in each page: host, class, whether its tokens repeat in one order and nest, a hash
    of that order (form), the class around it and the gap of that class it lies in."""
    held = _ByHost()
    for batch in batches:
        out: list[list] = [[] for _ in range(6)]
        for row, (host, seq) in enumerate(zip(batch.column("host").to_pylist(), batch.column("seq").to_pylist())):
            of = held.of(host, batch.column("classes")[row], lambda classes: {c["token"]: c["class"] for c in classes})
            found: dict = {}
            for at, token in enumerate(seq):
                if token in of:
                    found.setdefault(of[token], []).append((at, token))
            spans = []
            for kind, places in found.items():
                period = len({t for _, t in places})
                form = tuple(t for _, t in places[:period])
                fits = len(places) % period == 0 and all(t == form[i % period] for i, (_, t) in enumerate(places))
                rounds = [places[i : i + period] for i in range(0, len(places), period)]
                spans += [(r[0][0], r[-1][0], kind, fits, form, [p for p, _ in r]) for r in rounds]
            seen: dict = {}
            open_: list = []
            for first, last, kind, fits, form, places in sorted(spans, key=lambda s: (s[0], -s[1])):
                while open_ and open_[-1][0] < first:
                    open_.pop()
                crossing = bool(open_) and last > open_[-1][0]
                parent, gap = (open_[-1][1], int(np.searchsorted(open_[-1][2], first))) if open_ else (0, 0)
                here = (fits and not crossing, _signed(xxhash.xxh64_intdigest(np.array(form, np.int64).tobytes())), parent, gap)
                # All rounds of a repeated class must lie alike.
                old = seen.setdefault(kind, here)
                if old != here:
                    seen[kind] = (False, *old[1:])
                open_.append((last, kind, places))
            for kind, here in seen.items():
                for column, value in zip(out, (host, kind, *here)):
                    column.append(value)
        types = [pa.string(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int32()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], [f.split()[0] for f in _PLACES.split(", ")])


def page_templates(pages: DataFrame, min_pages: int = 4, min_share: float = 0.5) -> DataFrame:
    """host, tokens: the tokens of the template of each host, as an array of (token, class, most, parent, gap).

    Every distinct page of a host is one coordinate of its tokens' occurrence vectors; equal vectors show as equal sums
    of hashed coordinates, so no vector is ever held. An equivalence class counts if it has an element and two tokens or
    more, and pages enough. It is valid if its tokens come in one order, repeat whole, and lie in the same gap of the
    same class around it in every page. `nested` leaves out what lies in an invalid class.
    """
    texts = pages.select(host_of(F.col("url")).alias("host"), "html").where("host <> '' and html is not null and html <> ''")
    read = texts.withColumn("page", F.xxhash64("html")).mapInArrow(_sequences, "host string, page long, seq array<long>")
    # Copies of a page are one page.
    pages_once = staged(read.groupBy("host", "page").agg(F.first("seq").alias("seq")))
    sizes = pages_once.groupBy("host").agg(F.count("*").alias("pages"))
    rows = pages_once.mapInArrow(_occurrences, "host string, token long, n int, mark long")
    tokens = rows.groupBy("host", "token").agg(
        F.bit_xor("mark").alias("vector"), F.count("*").alias("support"), F.max("n").alias("most")).where(F.col("support") >= min_pages)
    tokens = tokens.join(sizes, "host").where(F.col("support") >= F.col("pages") * F.lit(min_share))
    same = Window.partitionBy("host", "vector", "support", "most")
    element = (F.col("token").bitwiseAND(F.lit(1)) == 0).cast("int")
    tokens = tokens.withColumn("size", F.count("*").over(same)).withColumn("elements", F.sum(element).over(same))
    tokens = staged(tokens.where("size > 1 and elements > 0").select(
        "host", "token", "most", F.xxhash64("vector", "support", "most").alias("class")))
    # At most min_share^-1 times as many tokens as a page of the host has on average.
    lists = tokens.groupBy("host").agg(F.collect_list(F.struct("token", "class")).alias("classes"))
    places = pages_once.join(lists, "host").mapInArrow(_places, _PLACES)
    one = lambda c: F.min(c) == F.max(c)
    valid = places.groupBy("host", "class").agg(
        (F.min("fits") & one("form") & one("parent") & one("gap")).alias("valid"), F.min("parent").alias("parent"), F.min("gap").alias("gap"))
    chosen = tokens.join(valid.where("valid").drop("valid"), ["host", "class"])
    return chosen.groupBy("host").agg(F.collect_list(F.struct("token", "class", "most", "parent", "gap")).alias("tokens"))


def nested(tokens: list[dict]) -> list[dict]:
    """The tokens of classes that nest in valid classes up to the outermost."""
    parents = {t["class"]: t["parent"] for t in tokens}

    def rooted(kind: int) -> bool:
        for _ in range(len(parents)):
            kind = parents.get(kind, kind)
        return kind == 0

    good = {kind for kind in parents if rooted(kind)}
    return [t for t in tokens if t["class"] in good]


def main_blocks(page: str, host: str, template: list[dict]) -> list[str]:
    """The blocks of a page that fill the slots of its article.

    Blocks of asides go, and so do those of the template. If the page has an article or main element, the slots in it
    are the text; if not, the slots between two tokens of the outermost class that hold most characters outside links.
    A page that the template covers altogether keeps its blocks.
    """
    tokens = read_page(page, host)
    known = {t["token"] for t in template}
    around = {t["token"] for t in template if t["parent"] == 0 and t["most"] == 1 and not t["token"] & 1}
    gap, slots, covered = 0, [], []
    for token in tokens:
        signed = _signed(token[0])
        if signed in around:
            gap += 1
        if token[1] is not None and not token[2]:
            (covered if signed in known else slots).append((gap, token))
    blocks = slots or covered
    inside = [t[1] for _, t in blocks if t[3]]
    if inside:
        return inside
    plain: dict = {}
    for place, t in blocks:
        plain[place] = plain.get(place, 0) + len(t[1]) - t[4]
    # Without a template the whole page is one slot, of which only lists of links go.
    best = max(plain, key=lambda g: (plain[g], -g), default=None)
    return [t[1] for place, t in blocks if place == best and 2 * t[4] <= len(t[1])]


def _texts(batches):
    held = _ByHost()
    for batch in batches:
        out = []
        for row, (page, host) in enumerate(zip(batch.column("html").to_pylist(), batch.column("host").to_pylist())):
            out.append("\n\n".join(main_blocks(page or "", host, held.of(host, batch.column("tokens")[row], nested))))
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(out, pa.string())], ["page_id", "url", "text"])


def extract_main_text(pages: DataFrame, min_pages: int = 4, min_share: float = 0.5) -> DataFrame:
    """page_id, url, text, n_chars: the main text of every row of `pages`, its blocks joined by an empty line.

    Character references are decoded once, white space inside a block becomes one space. Templates come from
    `page_templates`; hosts with fewer than `min_pages` different pages, and rows without a host, have none and are
    read by their elements alone. Null and empty pages have an empty text. Repeated rows, ids and nulls in any column
    give one row each. Very long pages are read whole, one at a time. Other columns are not looked at.
    """
    templates = staged(page_templates(pages, min_pages, min_share))
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), "html", host_of(F.col("url")).alias("host"))
    found = rows.join(templates, "host", "left").mapInArrow(_texts, "page_id long, url string, text string")
    return found.withColumn("n_chars", F.char_length("text").cast("long"))
