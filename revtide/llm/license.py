"""License scans by MinHash bands over overlapping windows.

A document's shingles are cut into segments; windows of four segments, each shifted by one, overlap. A
template belongs to the level whose window is just large enough to hold it at any place, so the part of
a window that a copy of it fills is bounded from below. Templates whose MinHash values meet those of
a window in one band are retrieved and compared exactly: the share of the template's shingles that the
window holds.
"""

from __future__ import annotations

import math
import re
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from revtide.llm.common import packed, text_batches

SHINGLE = 5
MIN_CONTAINMENT = 0.8
#: Bands of one row: a window that shares the part j of its shingles with a template is retrieved with
#: probability 1 - (1 - j)^BANDS; a template fills at least 4/15 of its window at 80 % containment.
BANDS = 40
STEP_SHINGLES = 200_000

MATCH = "array<struct<license:string, containment:double, first_word:int, windows:int>>"

# Notices by which texts state their license (short forms and the usual headers).
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License."
    ),
    "MIT": "Released under the MIT License.",
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions: The above copyright notice and this permission notice shall be included in all "
        "copies or substantial portions of the Software."
    ),
    "BSD-conditions": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met"
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."
    ),
    "LGPL-header": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation"
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
        "was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    ),
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}

# The license that a template states, where it is not its name ...
STATES = {"Apache-2.0-header": "Apache-2.0", "MIT-text": "MIT"}
# ... and templates that several licenses share: how many words from the first word of a copy on tell which one it is,
# the words that tell, and the license without any of them (none: the copy states no certain license).
VARIANTS = {
    "BSD-conditions": (300, {"endorse or promote products derived": "BSD-3-Clause"}, "BSD-2-Clause"),
    "GPL-3.0": (16, {"version 2": "GPL-2.0", "version 3": "GPL-3.0"}, None),
    "GPL-header": (48, {"version 2": "GPL-2.0", "version 3": "GPL-3.0"}, None),
    "LGPL-header": (40, {"version 2.1": "LGPL-2.1", "version 3": "LGPL-3.0"}, None),
}

# Names of licenses as short notices state them, in uniform spelling (see ``uniform``). The short names
# count beside "license", after "licensed under" and the like, or in an SPDX identifier; the full ones anywhere.
SHORT_NAMES = {
    "MIT": ["mit", "expat"], "Apache-2.0": ["apache 2.0"], "ISC": ["isc"], "Zlib": ["zlib"], "Unlicense": ["unlicense"],
    "BSD-2-Clause": ["bsd 2.0 clause", "2.0 clause bsd", "simplified bsd"],
    "BSD-3-Clause": ["bsd 3.0 clause", "3.0 clause bsd", "new bsd", "modified bsd"],
    "GPL-2.0": ["gpl 2.0"], "GPL-3.0": ["gpl 3.0"], "LGPL-2.1": ["lgpl 2.1"], "LGPL-3.0": ["lgpl 3.0"],
    "AGPL-3.0": ["agpl 3.0"], "MPL-1.1": ["mpl 1.1"], "MPL-2.0": ["mpl 2.0"], "EPL-1.0": ["epl 1.0"],
    "EPL-2.0": ["epl 2.0"], "BSL-1.0": ["bsl 1.0", "boost"], "CC0-1.0": ["cc0 1.0", "cc0"],
}
FULL_NAMES = {
    "Apache-2.0": ["apache license 2.0", "apache software license 2.0"],
    "GPL-2.0": ["gnu general public license 2.0", "gnu gpl 2.0"],
    "GPL-3.0": ["gnu general public license 3.0", "gnu gpl 3.0"],
    "LGPL-2.1": ["gnu lesser general public license 2.1", "gnu lgpl 2.1"],
    "LGPL-3.0": ["gnu lesser general public license 3.0", "gnu lgpl 3.0"],
    "AGPL-3.0": ["gnu affero general public license 3.0", "gnu agpl 3.0"],
    "MPL-1.1": ["mozilla public license 1.1"], "MPL-2.0": ["mozilla public license 2.0"],
    "EPL-1.0": ["eclipse public license 1.0"], "EPL-2.0": ["eclipse public license 2.0"],
    "BSL-1.0": ["boost software license"], "CC0-1.0": ["cc0 1.0", "creative commons zero"],
}
for _kind, _names in {
    "BY": ["attribution"], "BY-SA": ["attribution sharealike", "attribution share alike"],
    "BY-ND": ["attribution noderivatives", "attribution noderivs", "attribution no derivatives"],
    "BY-NC": ["attribution noncommercial", "attribution non commercial"],
    "BY-NC-SA": ["attribution noncommercial sharealike", "attribution non commercial share alike"],
    "BY-NC-ND": ["attribution noncommercial noderivatives", "attribution noncommercial noderivs",
                 "attribution non commercial no derivatives"],
}.items():
    for _version in ("1.0", "2.0", "2.5", "3.0", "4.0"):
        _id = f"CC-{_kind}-{_version}"
        SHORT_NAMES[_id] = [f"cc {_kind.lower().replace('-', ' ')} {_version}"]
        FULL_NAMES[_id] = SHORT_NAMES[_id] + [f"creative commons {n} {_version}" for n in _names]
VERBS = ("licensed", "released", "distributed", "available", "published", "provided")
_SPDX = ("spdx", "license", "identifier")
_MARKS = ("licen", "spdx", "gpl", "cc by", "cc-by", "cc0", "creative", *(f"{v} under" for v in VERBS))
_LEFT_OUT = frozenset("the a an version v international unported".split())

_WORD = re.compile(r"[^\W_]+(?:[.-][^\W_]+)*")
_RANDOM = np.random.default_rng(5)
_FACTORS = _RANDOM.integers(1, 2 ** 62, BANDS, np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _RANDOM.integers(0, 2 ** 63, BANDS, np.uint64)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def words(text: str | None) -> list[str]:
    """Lower-case words; punctuation only counts inside them."""
    return _WORD.findall((text or "").lower())


def shingles(tokens: list[str]) -> np.ndarray:
    """A 64-bit hash per run of ``SHINGLE`` words; fewer words are one shingle, none none."""
    codes = np.fromiter((zlib.crc32(t.encode("utf-8", "surrogatepass")) for t in tokens), np.uint64, len(tokens))
    width = min(SHINGLE, len(tokens))
    out = np.zeros(max(0, len(tokens) - width + 1) if tokens else 0, np.uint64)
    for k in range(width):
        out = (out ^ codes[k:k + len(out)]) * _MIX
        out ^= out >> np.uint64(29)
    return out


def uniform(tokens: list[str]) -> tuple[list[str], list[int]]:
    """Words in uniform spelling, and the place in ``tokens`` of each.

    Hyphens part words, ``v2`` and ``gplv2`` are ``2.0`` and ``gpl 2.0``, articles and the word version are left out.
    """
    out, places = [], []
    for i, token in enumerate(tokens):
        for part in token.split("-"):
            numbered = _VERSION.match(part)
            for word in (numbered.groups() if numbered else (part,)):
                if word and word not in _LEFT_OUT:
                    word = f"{word}.0" if word.isascii() and word.isdigit() and len(word) == 1 else word
                    out.append("license" if word == "licence" else word)
                    places.append(i)
    return out, places


_VERSION = re.compile(r"(|gpl|lgpl|agpl|mpl)v(\d(?:\.\d)?)$")


def _phrases(names: dict[str, list[str]], forms: list[str]) -> dict[str, list[tuple[tuple[str, ...], str]]]:
    """Phrases by their first word, the longest first."""
    found: dict[str, list[tuple[tuple[str, ...], str]]] = {}
    for license, own in names.items():
        for phrase in {tuple(form.format(n).split()) for n in own for form in forms}:
            found.setdefault(phrase[0], []).append((phrase, license))
    return {w: sorted(p, key=lambda x: (-len(x[0]), x)) for w, p in found.items()}


_BARE = _phrases(SHORT_NAMES, ["{}"])
_STATED = _phrases(FULL_NAMES, ["{}"])
for _word, _more in _phrases(SHORT_NAMES, ["{} license", "license {}", *(f"{v} under {{}}" for v in VERBS)]).items():
    _STATED[_word] = sorted([*_STATED.get(_word, []), *_more], key=lambda x: (-len(x[0]), x))


def short_notices(text: str | None) -> dict[str, int]:
    """Licenses that a text names in short notices, and the word at which each is first named."""
    lower = " ".join((text or "").lower().split())
    if not any(mark in lower for mark in _MARKS):
        return {}
    line, places = uniform(words(text))
    found: dict[str, int] = {}
    at = listed_until = 0
    while at < len(line):
        if tuple(line[at:at + 3]) == _SPDX:
            at += 3
            listed_until = at + 1
            continue
        for phrase, license in [*(_BARE.get(line[at], []) if at < listed_until else []), *_STATED.get(line[at], [])]:
            if tuple(line[at:at + len(phrase)]) == phrase:
                found.setdefault(license, places[at])
                listed_until = at + len(phrase) + 1 if at < listed_until else 0
                at += len(phrase)
                break
        else:
            # Words that join identifiers.
            listed_until += line[at] in ("and", "or", "with", "only", "later") and at < listed_until
            at += 1
    return found


class Template:
    def __init__(self, name: str, text: str):
        self.name = name
        self.tokens = words(text)
        if len(self.tokens) < SHINGLE:
            raise ValueError(f"template {name} has fewer than {SHINGLE} words")
        hashes = shingles(self.tokens)
        self.size = len(hashes)
        self.set = {tuple(self.tokens[i:i + SHINGLE]) for i in range(self.size)}
        # Any run of this many shingles is inside a window of four segments.
        self.segment = 1 << max(0, math.ceil(math.log2(self.size / 3)))
        self.mins = [((hashes * f + s) >> np.uint64(32)).min() for f, s in zip(_FACTORS, _SHIFTS)]


class Scanner:
    """Finds templates in texts."""

    def __init__(self, templates: dict[str, str], least: float = MIN_CONTAINMENT):
        self.templates = [Template(n, t) for n, t in templates.items()]
        self.least = least
        self.levels = sorted({t.segment for t in self.templates})

    def candidates(self, texts: list[np.ndarray]) -> set[tuple[int, int, int]]:
        """(text, template, window) triples that share a band.

        The shingles of all texts lie in one array. Each text begins at a multiple of the largest
        segment, and what lies between texts is never a minimum, so a text's windows do not depend on its
        neighbours.
        """
        unit = self.levels[-1]
        sizes = np.array([-(-len(h) // unit) * unit for h in texts] + [4 * unit])
        starts = np.concatenate([[0], np.cumsum(sizes)])
        hashes, gap = np.zeros(starts[-1], np.uint64), np.ones(starts[-1], bool)
        for start, own in zip(starts, texts):
            hashes[start:start + len(own)] = own
            gap[start:start + len(own)] = False
        found = set()
        for band, (factor, shift) in enumerate(zip(_FACTORS, _SHIFTS)):
            values = (hashes * factor + shift) >> np.uint64(32)
            values[gap] = np.uint64(1 << 32)
            segment = 1
            for level in self.levels:
                while segment < level:
                    values = np.minimum(values[::2], values[1::2])
                    segment *= 2
                pairs = np.minimum(values[:-1], values[1:])
                window = np.minimum(pairs[:-2], pairs[2:])
                for i, template in enumerate(self.templates):
                    if template.segment == level:
                        for at in (np.flatnonzero(window == template.mins[band]) * level).tolist():
                            self._owned(found, starts, texts, i, at, level)
        return found

    @staticmethod
    def _owned(found: set, starts: np.ndarray, texts: list, template: int, at: int, level: int) -> None:
        """Note a window for every text that it touches; only its part of one text counts for that."""
        first = int(np.searchsorted(starts, at, "right")) - 1
        last = int(np.searchsorted(starts, at + 4 * level - 1, "right")) - 1
        for text in range(first, min(last, len(texts) - 1) + 1):
            if at >= starts[text]:
                found.add((text, template, (at - int(starts[text])) // level))

    def containment(self, tokens: list[str], template: Template, window: int) -> tuple[float, int]:
        """Share of a template's shingles in a window, and where the first of them is (-1: nowhere)."""
        start = window * template.segment
        held = {}
        for i in range(start, min(start + 4 * template.segment, len(tokens) - SHINGLE + 1)):
            shingle = tuple(tokens[i:i + SHINGLE])
            if shingle in template.set:
                held.setdefault(shingle, i)
        return len(held) / len(template.set), min(held.values(), default=-1)

    def scan(self, texts: list[str | None]) -> list[list[tuple[str, float, int, int]]]:
        """Per text, (license, containment, first word, windows) of every template found, by name."""
        out = []
        tokens = [words(t) for t in texts]
        at = 0
        while at < len(texts):
            end, size = at, 0
            while end < len(texts) and (end == at or size + len(tokens[end]) <= STEP_SHINGLES):
                size += len(tokens[end])
                end += 1
            out += self._scan(tokens[at:end])
            at = end
        return out

    def _scan(self, tokens: list[list[str]]) -> list[list[tuple[str, float, int, int]]]:
        best: list[dict[int, tuple[float, int, int]]] = [{} for _ in tokens]
        none = np.zeros(0, np.uint64)
        hashes = [shingles(t) if len(t) >= SHINGLE else none for t in tokens]
        for text, i, window in sorted(self.candidates(hashes)):
            share, first = self.containment(tokens[text], self.templates[i], window)
            if share >= self.least:
                before = best[text].get(i, (0.0, first, 0))
                first = before[1] if before[0] >= share else first
                best[text][i] = (max(share, before[0]), first, before[2] + 1)
        return [sorted((self.templates[i].name, *f) for i, f in found.items()) for found in best]


def copies(tokens: list[str], template: Template, least: float) -> list[tuple[int, float]]:
    """(first word, share) of every copy of a template in a text, one after the other."""
    runs = [tuple(tokens[i:i + SHINGLE]) for i in range(len(tokens) - SHINGLE + 1)]
    held = [i for i, run in enumerate(runs) if run in template.set]
    found, at = [], 0
    while at < len(held):
        seen, end = set(), at
        while end < len(held) and held[end] < held[at] + 4 * template.segment:
            if runs[held[end]] in seen and len(seen) >= least * len(template.set):
                break
            seen.add(runs[held[end]])
            end += 1
        if len(seen) >= least * len(template.set):
            found.append((held[at], len(seen) / len(template.set)))
            at = end
        else:
            at += 1
    return found


def stated(
    text: str | None, matches: list[tuple[str, float, int, int]], templates: dict[str, Template], least: float
) -> list[tuple[str, float, int, int]]:
    """Matches of templates as licenses, one row each by its name: the largest share, of these the first copy.

    Copies of a template that licenses share are told apart by the words that follow, up to the next copy.
    """
    tokens = words(text) if matches else []
    found: dict[str, tuple[float, int, int]] = {}

    def add(license: str, share: float, first: int, windows: int) -> None:
        before = found.get(license, (0.0, first, 0))
        best = (share, first) if (-share, first) < (-before[0], before[1]) else before[:2]
        found[license] = (*best, before[2] + windows)

    for name, share, first, windows in matches:
        if name not in VARIANTS:
            add(STATES.get(name, name), share, first, windows)
            continue
        reach, telling, otherwise = VARIANTS[name]
        places = copies(tokens, templates[name], least) or [(first, share)]
        for (at, own), (following, _) in zip(places, [*places[1:], (len(tokens), 0.0)]):
            stretch = f" {' '.join(tokens[at:min(at + reach, following)])} "
            named = {stretch.find(f" {w} "): license for w, license in telling.items() if f" {w} " in stretch}
            license = named[min(named)] if named else otherwise
            if license:
                add(license, own, at, windows)
    return sorted((license, *f) for license, f in found.items())


def scanned(
    df: DataFrame, text: str = "text", templates: dict[str, str] | None = None, least: float = MIN_CONTAINMENT
) -> DataFrame:
    """``row`` (all columns of ``df``) and ``matches`` (array of ``MATCH``), one row per row of ``df``.

    A match has the share of the template in its best window and the word at which it begins there (the
    first such window on ties). A license has one match, however many templates state it and however often; one that
    is only named in a short notice has the share 1 and no window. Null and empty texts have none, repeated rows are
    rows each, an empty table has none, and columns of any name are kept in ``row``. With ``templates`` of the caller
    only those are searched, under their own names. Templates are few and travel with the task; nothing is shuffled.
    """
    text_batches(df.sparkSession)
    texts = templates or TEMPLATES

    @pandas_udf(MATCH)
    def matches(batch: pd.Series) -> pd.Series:
        names = ("license", "containment", "first_word", "windows")
        scanner = Scanner(texts, least)
        found = scanner.scan(batch.tolist())
        if not templates:
            named = {t.name: t for t in scanner.templates}
            found = [stated(text, own, named, least) for text, own in zip(batch, found)]
            for own, text in zip(found, batch):
                known = {name for name, *_ in own}
                own += [(n, 1.0, first, 0) for n, first in short_notices(text).items() if n not in known]
                own.sort()
        return pd.Series([[dict(zip(names, m)) for m in own] for own in found], dtype=object)

    # Marked as not deterministic, the scan is not repeated in a filter before the matches are unnested.
    return packed(df, matches=matches.asNondeterministic()(df[text]))


def listed(df: DataFrame, id_column: str = "doc_id", **options) -> DataFrame:
    """(doc_id, license, containment, first_word) per document and license found in it; a null id stays null.

    Rows of the same id are documents each. An ``id_column`` called like a result column is no clash.
    """
    found = scanned(df, **options)
    return found.select(F.col(f"row.{id_column}").alias("doc_id"), F.inline("matches")).drop("windows")
