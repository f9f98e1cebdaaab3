"""License scan: MinHash bands over overlapping text windows, then exact containment.

Texts and templates are words (letters and digits, A-Z lower-cased) and shingles
of five words. Templates are grouped by shingle count n into sizes t, the next
power of two. For each size a text's shingles are cut into windows of 2t at every
t-th place, so any t shingles in a row lie whole in some window. A window that
holds a share c of a template has a Jaccard similarity with it of at least
c * n / (2t + (1 - c) * n), where n > t / 2; with bands of ``rows`` hashes the number of
bands is the least that misses such a window with at most ``miss`` probability.
Windows that agree with a template in a band are verified: the distinct shingles
of the template that stand in the window, counted exactly by their words, must be
``contained`` of all. Templates of fewer than five words have no shingle: they are
looked for whole, word by word, at every place. Overlapping finds of one template are
one span.

The templates are parameters; their minima are a few numbers each, sent to every
task. The texts are cut by batches of at most about ``_SPAN`` words, no shuffle.

Defined cases: null or empty texts hold no license, texts of fewer than five words
only those of so few; templates without a word are refused; repeated rows are each
reported; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHINGLE = 5
_SPAN = 1 << 18

# Public license notices, as their owners word them.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0 header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
        "writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, "
        "either express or implied. See the License for the specific language governing permissions and limitations under the License."
    ),
    "MIT": "Released under the MIT License",
    "MIT licensed": "Licensed under the MIT License",
    "MIT text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "
        "\"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, "
        "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to "
        "the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions "
        "of the Software."
    ),
    "BSD text": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions "
        "are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution."
    ),
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "GPL header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published "
        "by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
    "LGPL header": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as "
        "published by the Free Software Foundation"
    ),
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "CC BY-NC 4.0": "Licensed under CC BY-NC 4.0",
    "CC BY 4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "CC0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work",
}

NOTICES = {"All rights reserved": "All rights reserved"}  # of fewer than five words

_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_MUL = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xFF51AFD7ED558CCD)

FOUND = "array<struct<license: string, from_word: int, words: int, containment: double>>"


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_TABLE).split() if text else []


def shingle_hashes(words: list[bytes]) -> np.ndarray:
    n = len(words) - SHINGLE + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    own = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    h = np.zeros(n, np.uint64)
    for j in range(SHINGLE):
        h = h * _MUL + own[j : j + n]
    h ^= h >> np.uint64(31)
    return h * _MIX


def bands_needed(similarity: float, rows: int, miss: float) -> int:
    """The bands of ``rows`` hashes of which at least one agrees with probability 1 - ``miss`` at the similarity."""
    return math.ceil(math.log(miss) / math.log(1 - similarity**rows))


class Templates:
    """Shingles and band minima of the templates, of five words or more each."""

    def __init__(self, texts: dict[str, str], contained: float = 0.8, rows: int = 1, miss: float = 1e-3, seed: int = 7):
        self.names = sorted(texts)
        self.contained, self.rows = contained, rows
        own = [words_of(texts[n]) for n in self.names]
        if short := [n for n, w in zip(self.names, own, strict=True) if len(w) < SHINGLE]:
            raise ValueError(f"templates of fewer than {SHINGLE} words: {short}")
        self.shingles = [{b" ".join(w[i : i + SHINGLE]) for i in range(len(w) - SHINGLE + 1)} for w in own]
        counts = [len(s) for s in self.shingles]
        self.size = [1 << (n - 1).bit_length() for n in counts]
        least = min((contained * n / (2 * t + (1 - contained) * n) for n, t in zip(counts, self.size, strict=True)), default=1.0)
        self.bands = bands_needed(least, rows, miss)
        rng = np.random.default_rng(seed)
        self.a = rng.integers(0, 1 << 63, self.bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.b = rng.integers(0, 1 << 63, self.bands * rows, dtype=np.uint64)
        self.minima = [[self.permuted(shingle_hashes(w), p).min() for p in range(len(self.a))] for w in own]

    def permuted(self, h: np.ndarray, p: int) -> np.ndarray:
        return ((h * self.a[p] + self.b[p]) >> np.uint64(32)).astype(np.uint32)

    def windows(self, h: np.ndarray) -> set[tuple[int, int]]:
        """(template, window) of every band in which a window of the shingles agrees with the template."""
        sizes = sorted(set(self.size))
        hits: set[tuple[int, int]] = set()
        for band in range(self.bands):
            agree: dict[int, np.ndarray] = {}
            for p in range(band * self.rows, (band + 1) * self.rows):
                low, t = self.permuted(h, p), 1
                while sizes and t <= sizes[-1]:
                    if t in sizes:
                        window = np.minimum(low, np.append(low[1:], low[-1:]))
                        for k in (k for k, s in enumerate(self.size) if s == t):
                            same = window == self.minima[k][p]
                            agree[k] = agree[k] & same if k in agree else same
                    low, t = np.minimum(low[::2], np.append(low[1::2], low[-1:]) if len(low) % 2 else low[1::2]), 2 * t
            for k, same in agree.items():
                hits.update((k, int(j)) for j in np.flatnonzero(same))
        return hits

    def scan(self, texts: list[list[bytes]]) -> list[list[tuple[str, int, int, float]]]:
        """For each text (words) the spans found: (license, first word, words, containment)."""
        own = [shingle_hashes(w) for w in texts]
        ends = np.cumsum([len(h) for h in own])
        out: list[list[tuple[str, int, int, float]]] = [[] for _ in texts]
        if not len(ends) or not ends[-1]:
            return out
        stretches = defaultdict(list)
        for k, j in self.windows(np.concatenate(own)):
            t = self.size[k]
            a, b = j * t, min((j + 2) * t, int(ends[-1]))
            d = int(np.searchsorted(ends, a, "right"))
            while d < len(texts) and (start := int(ends[d]) - len(own[d])) < b:
                stretches[d, k].append((max(a - start, 0), min(b - start, len(own[d]))))
                d += 1
        for (d, k), spans in sorted(stretches.items()):
            out[d] += [(self.names[k], *s) for s in self._verified(texts[d], k, sorted(spans))]
        return out

    def _verified(self, words: list[bytes], k: int, spans: list[tuple[int, int]]) -> Iterator[tuple[int, int, float]]:
        best: list[list] = []
        for a, b in spans:
            at = [(i, s) for i in range(a, b) if (s := b" ".join(words[i : i + SHINGLE])) in self.shingles[k]]
            share = len({s for _, s in at}) / len(self.shingles[k])
            if share < self.contained:
                continue
            first, last = at[0][0], at[-1][0] + SHINGLE
            if best and first < best[-1][1]:
                best[-1][1], best[-1][2] = max(best[-1][1], last), max(best[-1][2], share)
            else:
                best.append([first, last, share])
        return ((a, b - a, c) for a, b, c in best)


class Phrases:
    """Templates too short for a shingle, found whole."""

    def __init__(self, texts: dict[str, str]):
        own = {n: words_of(texts[n]) for n in sorted(texts)}
        if empty := [n for n, w in own.items() if not w]:
            raise ValueError(f"templates without a word: {empty}")
        self.known = [(n, len(w), b" %b " % b" ".join(w)) for n, w in own.items()]

    def scan(self, texts: list[list[bytes]]) -> list[list[tuple[str, int, int, float]]]:
        """As ``Templates.scan``."""
        return [[s for known in self.known for s in self._found(joined, *known)] for joined in (b" %b " % b" ".join(w) for w in texts)]

    def _found(self, joined: bytes, name: str, n: int, phrase: bytes) -> Iterator[tuple[str, int, int, float]]:
        spans: list[list[int]] = []
        at, word, seen = joined.find(phrase), 0, 0
        while at >= 0:
            word, seen = word + joined.count(b" ", seen, at), at
            if spans and word < spans[-1][1]:
                spans[-1][1] = word + n
            else:
                spans.append([word, word + n])
            at = joined.find(phrase, at + 1)
        return ((name, a, b - a, 1.0) for a, b in spans)


def license_spans(docs: DataFrame, templates: dict[str, str] | None = None, id_col: str = "doc_id", text_col: str = "text", contained: float = 0.8, rows: int = 1, miss: float = 1e-3) -> DataFrame:
    """One row for each span of a license in a text: id, license, from_word, words, containment."""
    texts = templates or TEMPLATES | NOTICES
    short = {n for n, t in texts.items() if len(words_of(t)) < SHINGLE}
    long = {n: t for n, t in texts.items() if n not in short}
    known = [Templates(long, contained, rows, miss)] if long else []
    known += [Phrases({n: texts[n] for n in short})] if short else []
    shared = docs.sparkSession.sparkContext.broadcast(known)

    def scan(held: list[list[bytes]]) -> list[list[tuple[str, int, int, float]]]:
        return [[s for own in found for s in own] for found in zip(*(k.scan(held) for k in shared.value), strict=True)]

    @F.pandas_udf(FOUND)
    def spans(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            out, held, size = [], [], 0
            for text in part:
                held.append(words_of(text))
                size += len(held[-1])
                if size >= _SPAN:
                    out += scan(held)
                    held, size = [], 0
            out += scan(held)
            yield pd.Series([[{"license": n, "from_word": a, "words": w, "containment": c} for n, a, w, c in own] for own in out])

    rows_ = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    return rows_.select("id", F.explode(spans("text")).alias("s")).select("id", "s.*")
