"""Every stage of the pipeline against a plain version of it, on whole texts of the smallest tables."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import corpus_pipeline
import numpy as np
import pytest
import zstandard

from eavcube.llm import quality

FOLDER = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SPACES = " \t\n\x0b\x0c\r"
FOLD = {c: c + 32 for c in range(65, 91)}


def shingles(text):
    w = WORD.findall((text or "").translate(FOLD))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def plain_quality(docs, model):
    """Sizes of 512-byte blocks, without and with each dictionary, and the logistic curve of the calibration."""
    tools = [zstandard.ZstdCompressor(level=3)]
    for raw in (model.good, model.bad):
        tools.append(zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)))
    kept = []
    for doc in docs:
        data = (doc["text"] or "").encode()
        blocks = [data[i : i + 512] for i in range(0, len(data), 512)] or [b""]
        none, good, bad = (sum(len(t.compress(b)) for b in blocks) for t in tools)
        d, r = np.clip([(bad - good) / (bad + good), min(none / max(len(data), 1), 2.0)], model.low, model.high)
        x = (np.array([d, r, d * d, r * r, d * r]) - model.mean) / model.scale
        if model.weights[0] + float(x @ model.weights[1:]) >= 0:
            kept.append(doc)
    return kept


def plain_lines(docs):
    key = lambda line: line.strip(SPACES).translate(FOLD)
    holders: dict = {}
    for doc in docs:
        for k in {key(x) for x in (doc["text"] or "").split("\n")}:
            holders.setdefault(k, set()).add(doc["doc_id"])
    shared, seen, out = {k for k, ids in holders.items() if k and len(ids) >= 10}, set(), []
    for doc in sorted(docs, key=lambda x: x["doc_id"]):
        left = []
        for line in (doc["text"] or "").split("\n"):
            if key(line) in shared:
                if key(line) in seen:
                    continue
                seen.add(key(line))
            left.append(line)
        text = "\n".join(left)
        if len(left) == len((doc["text"] or "").split("\n")):
            out.append(doc)
        elif text.strip(SPACES):
            out.append({**doc, "text": text, "n_chars": len(text)})
    return out


def plain_groups(docs):
    sets = {d["doc_id"]: shingles(d["text"]) for d in docs}
    group = {d: d for d in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                low, high = sorted((group[a], group[b]))
                group = {d: low if g == high else g for d, g in group.items()}
    return [d for d in docs if group[d["doc_id"]] == d["doc_id"]]


def plain_leaks(docs, items):
    wanted = [s for s in map(shingles, items) if s]
    return [d for d in docs if not any(100 * len(s & shingles(d["text"])) >= 80 * len(s) for s in wanted)]


def plain_mix(docs):
    """Clamp and share out again until no source is above twice its size; then whole and partial repetitions."""
    size = {d["doc_id"]: len(WORD.findall(d["text"] or "")) for d in docs}
    total = Counter()
    for d in docs:
        total[d["source"]] += size[d["doc_id"]]
    names = sorted((s for s in total if s is not None)) + [None] * (None in total)
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    target, clamped = {}, set()
    while True:
        left = 1.5 * sum(total.values()) - sum(2 * total[s] for s in clamped)
        heft = sum(weight[s] for s in names if s not in clamped)
        target = {s: 2 * total[s] if s in clamped else left * weight[s] / heft for s in names}
        above = {s for s in names if s not in clamped and target[s] > 2 * total[s]}
        if not above:
            break
        clamped |= above
    out, used = Counter(), Counter()
    for d in sorted(docs, key=lambda x: hashlib.md5(f"mix:{x['doc_id']}".encode()).hexdigest()):
        s, n = d["source"], size[d["doc_id"]]
        whole = int(target[s] // total[s]) if total[s] else 0
        rest = target[s] - whole * total[s]
        out[d["doc_id"]] = whole + (rest > 0 and used[s] + n / 2 <= rest)
        used[s] += n
    return out, size


def dicts(df):
    return [r.asDict() for r in df.collect()]


def same(got, want):
    order = lambda rows: sorted(rows, key=lambda r: r["doc_id"])
    return order(got) == order(want)


@pytest.fixture(scope="module")
def steps(spark):
    """The input of every stage, and the last one's output."""
    docs = [spark.read.parquet(f"{FOLDER}/documents.parquet")]
    for _, stage in corpus_pipeline.STAGES:
        docs.append(corpus_pipeline.staged(stage(spark, docs[-1], FOLDER)))
    return docs


def test_each_stage_equals_its_plain_version(spark, steps):
    start, good, lines, single, clean = (dicts(df) for df in steps[:5])
    model = quality.fit(steps[0], spark.read.parquet(f"{FOLDER}/labels.parquet"))
    assert model.weights and same(good, plain_quality(start, model)) and len(good) < len(start)
    assert same(lines, plain_lines(good)) and lines != good
    assert same(single, plain_groups(lines)) and len(single) < len(lines)
    items = [r.text for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    assert same(clean, plain_leaks(single, items)) and len(clean) < len(single)
    want, size = plain_mix(clean)
    got = Counter(r.doc_id for r in steps[5].collect())
    assert {d: n for d, n in got.items() if size[d]} == {d: n for d, n in want.items() if n and size[d]}


def test_run_equals_its_stages(spark, steps):
    rows = lambda df: sorted(map(tuple, df.collect()), key=repr)
    assert rows(corpus_pipeline.run(spark, FOLDER)) == rows(steps[5])


def test_labelled_documents_go_by_their_quality(spark, steps):
    """Good documents of the labels stay, apart from a few; most bad ones go, those held out as well."""
    quality_of = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    kept = {r["doc_id"] for r in dicts(steps[1])}
    known = [r["doc_id"] for r in dicts(steps[0]) if quality_of.get(r["doc_id"]) is not None]
    good = [d in kept for d in known if quality_of[d] == 1]
    bad = [d in kept for d in known if quality_of[d] == 0]
    assert np.mean(good) > 0.95 and (not bad or np.mean(bad) < 0.5)
