"""License scans: patience alignment of texts with license templates.

A stretch of a text is aligned with a template by its anchors, the words that occur once in both; the longest increasing
subsequence of their places is kept, and each gap between kept anchors is aligned in the same way, after what is equal
at its two ends. Coverage is the share of the template's words that are aligned. Regions to align are found by the template's
telling words (those outside a short list of common ones), and overlap: the longest ones that hold no telling word more often
than the template, one from each telling word on, and windows of twice the template's length, which may hold more. Of
findings that overlap the one of the highest coverage stays, so that a notice given twice is found twice.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from gridgate.llm.common import ready, with_text
from gridgate.llm.decontaminate import word_runs
from gridgate.llm.kernels import blocks, text_bytes

#: Notices and headers of public licenses.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the '
        "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable "
        'law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES '
        "OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and "
        "limitations under the License."),
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
        "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This "
        "program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
        "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."),
    "MIT": "Released under the MIT License.",
    "MIT-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
        'files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, '
        "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software "
        "is furnished to do so, subject to the following conditions:"),
    "BSD-redistribution": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met:"),
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "MPL-2.0-header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed "
        "with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    "ISC-grant": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies."),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, "
        "sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or "
        "non-commercial, and by any means."),
    "Zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any "
        "damages arising from the use of this software."),
}
#: Words that start no stretch.
COMMON = frozenset("a an and any are as at be but by for from in is it may not of on or see that the this to under version with you your".split())
COVERAGE = 0.75


def matched_pairs(text: list, template: list) -> list[tuple[int, int]]:
    """Aligned places (text, template), ascending in both."""
    out: list[tuple[int, int]] = []
    work = [(0, len(text), 0, len(template))]
    while work:
        a, b, c, d = work.pop()
        while a < b and c < d and text[a] == template[c]:
            out.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and text[b - 1] == template[d - 1]:
            b, d = b - 1, d - 1
            out.append((b, d))
        if a >= b or c >= d:
            continue
        once, other = Counter(text[a:b]), Counter(template[c:d])
        place = {w: k for k, w in enumerate(template[c:d], c) if other[w] == 1 and once.get(w) == 1}
        anchors = _increasing([(k, place[w]) for k, w in enumerate(text[a:b], a) if w in place])
        if anchors:
            for (p, q), (r, s) in zip([(a - 1, c - 1), *anchors], [*anchors, (b, d)]):
                work.append((p + 1, r, q + 1, s))
            out += anchors
    return sorted(out)


def _increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest run of pairs, ascending in the first, that ascends in the second too (patience sorting)."""
    tops: list[int] = []
    at: list[int] = []
    back = [-1] * len(pairs)
    for k, (_, value) in enumerate(pairs):
        pile = bisect_left(tops, value)
        back[k] = at[pile - 1] if pile else -1
        tops[pile:pile + 1], at[pile:pile + 1] = [value], [k]
    out, k = [], at[-1] if at else -1
    while k >= 0:
        out.append(pairs[k])
        k = back[k]
    return out[::-1]


class Template:
    def __init__(self, name: str, words: list[int], common: set[int]):
        self.name, self.words = name, words
        self.telling = Counter(w for w in words if w not in common)
        at = [k for k, w in enumerate(words) if w not in common]
        self.lead, self.trail = (at[0], len(words) - 1 - at[-1]) if at else (0, 0)

    def regions(self, places: list[int], words: list[int], least: int) -> Iterator[tuple[int, int]]:
        """First and last place of each region that holds `least` telling words, none counted more often than in the template."""
        n = len(words)
        for width in (None, 2 * len(self.words)):
            seen: Counter = Counter()
            end = held = reached = 0
            for begin in range(n):
                end = max(end, begin)
                while end < n and (end == begin or places[end] - places[end - 1] <= len(self.words)) and (
                        seen[words[end]] < self.telling[words[end]] if width is None else places[end] - places[begin] < width):
                    held += seen[words[end]] < self.telling[words[end]]
                    seen[words[end]] += 1
                    end += 1
                spare = seen[words[begin]] > self.telling[words[begin]]
                if held >= least and (end > reached if width is None else not spare):
                    yield places[begin], places[end - 1]
                    reached = end
                seen[words[begin]] -= 1
                held -= not spare

    def findings(self, text: np.ndarray, places: list[int], words: list[int], coverage: float) -> list[tuple[str, float, int, int, int]]:
        """(name, coverage, matched words, first word, end word) of each notice that is covered enough."""
        n, telling = len(self.words), sum(self.telling.values())
        least = max(1, math.ceil(coverage * n - 1e-9) - (n - telling))  # with fewer, even every common word would not do
        own = [k for k, w in enumerate(words) if w in self.telling]
        if len(own) < least:
            return []
        found: set[tuple[int, int, int]] = set()
        done: set[tuple[int, int]] = set()
        whole = (-1, -1)
        for first, last in self.regions([places[k] for k in own], [words[k] for k in own], least):
            if (first, last) in done or whole[0] <= first and last < whole[1]:
                continue  # what lies inside a notice that stands word for word cannot be better
            done.add((first, last))
            for before, after in ((self.lead, self.trail), (n - telling + 2, n - telling + 2)):
                low = max(0, first - before)
                pairs = matched_pairs(text[low:last + 1 + after].tolist(), self.words)
                if len(pairs) >= coverage * n:
                    found.add((len(pairs), low + pairs[0][0], low + pairs[-1][0] + 1))
                if len(pairs) == n == pairs[-1][0] + 1 - pairs[0][0]:
                    whole = (low + pairs[0][0], low + pairs[-1][0] + 1)
                    break
        kept: list[tuple[int, int]] = []
        out = []
        for matched, low, high in sorted(found, key=lambda f: (-f[0], f[2] - f[1], f[1])):
            at = bisect_left(kept, (low, high))
            if (at == 0 or kept[at - 1][1] <= low) and (at == len(kept) or high <= kept[at][0]):
                kept.insert(at, (low, high))
                out.append((self.name, matched / n, matched, low, high))
        return out


def _hashes(text: str) -> list[int]:
    data = np.frombuffer(text.encode(), np.uint8)
    return word_runs(data, np.array([0, len(data)]))[2].tolist()


def _scan(texts: dict[str, str], coverage: float):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common = {h for w in COMMON for h in _hashes(w)}
        templates = [Template(name, words, common) for name, text in texts.items() if (words := _hashes(text))]
        known = np.unique(np.array([w for t in templates for w in t.telling], np.uint64))
        for table in blocks(batches):
            data, offsets = text_bytes(table.column("text"))
            starts, ends, hashes = word_runs(data, offsets)
            firsts = np.searchsorted(starts, offsets)
            at = np.minimum(np.searchsorted(known, hashes), max(len(known) - 1, 0))
            telling = np.flatnonzero(known[at] == hashes) if len(known) else np.zeros(0, np.int64)
            cut = np.searchsorted(telling, firsts)
            rows = []
            for d in range(table.num_rows):
                a, b = firsts[d], firsts[d + 1]
                places = telling[cut[d]:cut[d + 1]]
                words = hashes[places].tolist()
                places = (places - a).tolist()
                found = [f for t in templates for f in t.findings(hashes[a:b], places, words, coverage)] if words else []
                rows.append([{"license": n, "coverage": round(c, 6), "n_matched": m, "first_word": int(i), "end_word": int(j),
                              "first_byte": int(starts[a + i] - offsets[d]), "end_byte": int(ends[a + j - 1] - offsets[d])}
                             for n, c, m, i, j in sorted(found, key=lambda f: (f[3], f[0]))])
            yield pa.RecordBatch.from_arrays([table.column("doc_id").combine_chunks(), pa.array(rows, _FOUND)], ["doc_id", "found"])

    return scan


_FOUND = pa.list_(pa.struct([("license", pa.string()), ("coverage", pa.float64()), ("n_matched", pa.int64()), ("first_word", pa.int64()),
                             ("end_word", pa.int64()), ("first_byte", pa.int64()), ("end_byte", pa.int64())]))


def scan(docs: DataFrame, templates: dict[str, str] | None = None, coverage: float = COVERAGE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and `found`, the aligned notices of a document by their place in it.

    Null and empty texts have none; whole texts are scanned; repeated documents one by one; no templates, no findings.
    """
    ready(docs.sparkSession)
    kind = ("doc_id long, found array<struct<license: string, coverage: double, n_matched: bigint, first_word: bigint, "
            "end_word: bigint, first_byte: bigint, end_byte: bigint>>")
    return with_text(docs, id_col, text_col).mapInArrow(_scan(TEMPLATES if templates is None else templates, coverage), kind)
