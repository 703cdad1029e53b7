"""License notices by conditional compression, confirmed word by word."""

from __future__ import annotations

import bisect
import difflib
import re
from collections import Counter

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Public license notices, in natural order.
TEMPLATES = {
    "MIT": "Released under the MIT License.",
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-text": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at"),
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-text": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version."),
    "BSD-text": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met:"),
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
}
# Words of which every template has one; only their surroundings are compressed.
_CUE = re.compile(r"licen[cs]|permission|redistribut|permitted", re.IGNORECASE)
_WORD = re.compile(r"[A-Za-z0-9.]*[A-Za-z0-9]")
_BLANK = re.compile(r"\n[^\S\n]*(?=\n)")
_FOUND = ("doc_id long, line int, license string, reduction double, n_missing int, n_extra int, confirmed boolean, nth int, text string")


def _words(text: str) -> list[str]:
    return [w.lower() for w in _WORD.findall(text)]


def wording_differences(block: str, template: str) -> tuple[int, int]:
    """Template words that the block lacks, and other words of the block between its first and last template word."""
    a, b = _words(template), _words(block)
    runs = [m for m in difflib.SequenceMatcher(None, a, b, autojunk=False).get_matching_blocks() if m.size]
    if not runs:
        return len(a), len(b)
    same = sum(m.size for m in runs)
    return len(a) - same, runs[-1].b + runs[-1].size - runs[0].b - same


def _side(wanted: list[str], there: list[str], most: int) -> list[int | None]:
    """How many words of `there`, from its start, hold `wanted` in order with m words missing, for m up to `most`."""
    reach: list = [0] + [None] * most
    for word in wanted:
        new: list = [None] * (most + 1)
        for m, at in enumerate(reach):
            if at is None:
                continue
            if m < most and (new[m + 1] is None or at < new[m + 1]):
                new[m + 1] = at
            hit = next((i for i in range(at, len(there)) if there[i] == word), None)
            if hit is not None and (new[m] is None or hit + 1 < new[m]):
                new[m] = hit + 1
        reach = new
    return reach


def _aligned(words: list[str], at: int, template: list[str], cue: int, low: int, high: int, most: int):
    """The wording with the fewest differences that has the template's word `cue` at `at`, of those that count as
    confirmed: missing words, extra words, first word, word after the last. None if there is none."""
    left = _side(template[:cue][::-1], words[low:at][::-1], most)
    right = _side(template[cue + 1 :], words[at + 1 : high], most)
    best = None
    for m1, a in enumerate(left):
        for m2, b in enumerate(right[: most + 1 - m1]):
            if a is None or b is None:
                continue
            missing = m1 + m2
            extra = a - (cue - m1) + b - (len(template) - 1 - cue - m2)
            if extra <= max(missing, 2) and (best is None or (missing + extra, missing) < (best[0] + best[1], best[0])):
                best = missing, extra, at - a, at + 1 + b
    return best


def _passages(text: str, reach: int):
    """Start and end of the parts of a text within `reach` characters of a cue, not beyond a blank line."""
    low = high = 0
    edge = iter([*(m.start() for m in _BLANK.finditer(text)), len(text)])
    before, after = 0, next(edge)
    for m in _CUE.finditer(text):
        while after < m.start():
            before, after = after, next(edge)
        a, b = max(before, m.start() - reach), min(after, m.end() + reach)
        if a >= high:
            if high > low:
                yield low, high
            low = a
        high = b
    if high > low:
        yield low, high


class _Template:
    def __init__(self, name: str, text: str, max_missing: float):
        self.name, self.words = name, _words(text)
        self.cues = [i for i, w in enumerate(self.words) if _CUE.search(w)]
        self.missing = int(max_missing * len(self.words) + 1e-9)
        self.extra = max(self.missing, 2)
        data = " ".join(self.words).encode()
        raw = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        raw.precompute_compress(level=3)
        self.tool = zstandard.ZstdCompressor(level=3, dict_data=raw)
        self.size = len(zstandard.ZstdCompressor(level=3).compress(data))


def _notices(text: str, tools: list[_Template], plain, min_reduction: float, reach: int):
    """All candidates of a text: confirmed, score, reduction, template, missing, extra, start, end, cue (in characters)."""
    out, sizes = [], {}
    for low, high in _passages(text, reach):
        spans = [(m.start(), m.end()) for m in _WORD.finditer(text, low, high)]
        # A word that the passage cuts is none.
        if spans and spans[0][0] == low > 0 and _WORD.match(text[low - 1]):
            del spans[0]
        if spans and spans[-1][1] == high < len(text) and _WORD.match(text[high]):
            del spans[-1]
        words = [text[a:b].lower() for a, b in spans]
        for at in (i for i, w in enumerate(words) if _CUE.search(w)):
            for tool in tools:
                same = [c for c in tool.cues if tool.words[c] == words[at]]
                for cue in same or tool.cues:
                    a, b = max(at - cue - tool.extra, 0), min(at - cue + len(tool.words) + tool.extra, len(words))
                    block = " ".join(words[a:b])
                    if (tool.name, block) not in sizes:
                        data = block.encode()
                        if block not in sizes:
                            sizes[block] = len(plain.compress(data))
                        sizes[tool.name, block] = sizes[block] - len(tool.tool.compress(data))
                    reduction = sizes[tool.name, block] / tool.size
                    if reduction < min_reduction:
                        continue
                    found = _aligned(words, at, tool.words, cue, a, b, tool.missing) if same else None
                    if found:
                        missing, extra, first, last = found
                    else:
                        (missing, extra), first, last = wording_differences(block, " ".join(tool.words)), a, b
                    score = len(tool.words) - 2 * missing - extra if found else -missing - extra
                    out.append((bool(found), score, reduction, tool.name, missing, extra, spans[first][0], spans[last - 1][1], spans[at][0]))
    return out


def _chosen(found: list) -> list:
    """Of confirmed notices that overlap, the one with the most words in place; and all others."""
    kept: list = []
    for row in sorted((f for f in found if f[0]), key=lambda f: (-f[1], f[6], f[3])):
        i = bisect.bisect_left(kept, (row[6],))
        if (i == 0 or kept[i - 1][1] <= row[6]) and (i == len(kept) or kept[i][0] >= row[7]):
            kept.insert(i, (row[6], row[7], row))
    return [row for _, _, row in kept]


def _scan(templates: dict, min_reduction: float, max_missing: float, reach: int):
    reach = max(reach, 4 * max(map(len, templates.values()), default=0))

    def scan(batches):
        plain = zstandard.ZstdCompressor(level=3)
        tools = [_Template(name, template, max_missing) for name, template in templates.items()]
        names = [f.split()[0] for f in _FOUND.split(", ")]
        types = [pa.int64(), pa.int32(), pa.string(), pa.float64(), pa.int32(), pa.int32(), pa.bool_(), pa.int32(), pa.string()]
        for batch in batches:
            out = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                if not text or not _CUE.search(text):
                    continue
                found = _notices(text, tools, plain, min_reduction, reach)
                ends = [m.start() for m in re.finditer("\n", text)] if found else []
                line = lambda at: bisect.bisect_left(ends, at)  # noqa: B023, E731
                taken, times, best = set(), Counter(), {}
                for _, _, reduction, name, missing, extra, start, end, _ in _chosen(found):
                    n = line(start)
                    taken.update(range(n, line(end - 1) + 1))
                    out.append((doc, n, name, reduction, missing, extra, True, times[n, name], text[start:end]))
                    times[n, name] += 1
                for row in found:
                    n = line(row[8])
                    if n not in taken and (n not in best or row[1:3] > best[n][1:3]):
                        best[n] = row
                out += [(doc, n, r[3], r[2], r[4], r[5], False, 0, text[r[6] : r[7]]) for n, r in best.items()]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    return scan


def scan_licenses(docs: DataFrame, templates: dict[str, str] | None = None, min_reduction: float = 0.2,
                  max_missing: float = 0.1, reach: int = 2000) -> DataFrame:
    """License notices: doc_id, line, license, reduction, n_missing, n_extra, confirmed, nth, text.

    Around every cue word, as many words as a template has on each side of the same cue are compressed alone and with
    the template as raw zstandard dictionary; of both only the lower-case words count. `reduction` is what the dictionary
    saves over the compressed size of the template itself, whatever else stands around. Of the templates at `min_reduction`
    or above the exact wording decides: a notice is confirmed if at most `max_missing` of its words are missing and
    hardly any are put in between.

    Every confirmed notice gives a row, in the line where it starts; it may go on over lines up to a blank one. Of notices
    that overlap (a short one inside a longer one) the one with the most words in place is returned. `nth` counts the
    places of a license before on the same line. A line without a confirmed notice gives its nearest template, if any, as
    one row that is not confirmed.

    Null and empty texts give no rows; a null doc_id is returned as null; repeated rows give repeated results.
    """
    templates = TEMPLATES if templates is None else templates
    for name, template in templates.items():
        if not _CUE.search(template):
            raise ValueError(f"template {name} has no cue word")
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    return docs.mapInArrow(_scan(templates, min_reduction, max_missing, reach), _FOUND)
