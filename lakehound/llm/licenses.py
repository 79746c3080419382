"""Op 7: license scans by patience alignment.

Words that are unique in both a stretch of text and a template are anchors;
the longest increasing run of them is kept, and the gaps between anchors are
aligned the same way. A gap without anchors falls back to the longest common
subsequence over equal words. Coverage is the aligned share of the template.

Stretches are windows of three template lengths, one template length apart, so
an occurrence of up to twice the template's length lies in one of them and
several copies in a text are found each. A window is aligned only if enough of
its words occur in the template: an upper bound of the coverage, so no match
is lost.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakehound.llm import words as W

MIN_COVERAGE = 0.8

#: Public license notices and headers, (license, template, text).
TEMPLATES = (
    ("MIT", "notice", "Released under the MIT License."),
    ("Apache-2.0", "notice", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "notice", "This work is licensed under the GNU General Public License, version 3."),
    ("MIT", "permission", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("Apache-2.0", "header", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("GPL-3.0-or-later", "header", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."),
    ("BSD-2-Clause", "conditions", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("ISC", "permission", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("MPL-2.0", "header", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
)


def _increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """A longest run of ``pairs`` (sorted by their first number) that rises in both numbers."""
    ends: list[int] = []
    at: list[int] = []
    before: list[int] = []
    for k, (a, b) in enumerate(pairs):
        spot = bisect_left(ends, b)
        ends[spot:spot + 1] = [b]
        at[spot:spot + 1] = [k]
        before.append(at[spot - 1] if spot else -1)
    out, k = [], at[-1] if at else -1
    while k >= 0:
        out.append(pairs[k])
        k = before[k]
    return out[::-1]


def align(a: Sequence[int], b: Sequence[int]) -> list[tuple[int, int]]:
    """Aligned positions (in a, in b) of equal words, rising in both, by patience alignment."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        if a0 >= a1 or b0 >= b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        where = {w: k for k, w in enumerate(b[b0:b1], b0) if in_b[w] == 1 and in_a[w] == 1}
        anchors = _increasing([(k, where[a[k]]) for k in range(a0, a1) if a[k] in where])
        if not anchors:
            places: dict[int, list[int]] = {}
            for k in range(b1 - 1, b0 - 1, -1):  # falling, so that a word of a takes one place at most
                places.setdefault(b[k], []).append(k)
            out += _increasing([(k, m) for k in range(a0, a1) for m in places.get(a[k], ())])
            continue
        out += anchors
        last = (a0 - 1, b0 - 1)
        for x, y in [*anchors, (a1, b1)]:
            todo.append((last[0] + 1, x, last[1] + 1, y))
            last = (x, y)
    return sorted(out)


class Templates:
    """The templates as word values, and which words any of them has."""

    def __init__(self, templates: Sequence[tuple[str, str, str]]):
        self.names = [(a, b) for a, b, _ in templates]
        text = W.flat(pa.array([t for _, _, t in templates], pa.string()))
        words = W.split(text, W.IS_APART)
        values = W.spans_hash(W.LOWER[text.data], words.starts, words.ends)
        self.words = [values[words.first[i]:words.first[i + 1]] for i in range(text.rows)]
        self.own = [np.unique(w) for w in self.words]
        every = np.unique(values)
        self.seen = np.zeros(1 << 20, dtype=bool)
        self.seen[(every >> np.uint64(44)).astype(np.int64)] = True
        self.every = every

    def matches(self, text: W.Text, min_coverage: float) -> Iterator[tuple[int, int, float, int, int]]:
        """(row, template, coverage, first word, end) of the best window of each overlapping run of windows."""
        words = W.split(text, W.IS_APART)
        values = W.spans_hash(W.LOWER[text.data], words.starts, words.ends)
        hits = np.flatnonzero(self.seen[(values >> np.uint64(44)).astype(np.int64)])
        hits = hits[np.isin(values[hits], self.every)]
        for k, template in enumerate(self.words):
            m = len(template)
            need = int(np.ceil(min_coverage * m))
            own = hits[np.isin(values[hits], self.own[k])]
            for i in np.unique(words.row[own]).tolist() if len(own) >= need else []:
                a, b = words.first[i], words.first[i + 1]
                places = own[np.searchsorted(own, a):np.searchsorted(own, b)] - a
                if len(places) >= need:
                    for found in self._in_row(values[a:b], places, template, need):
                        yield (i, k, *found)

    def _in_row(self, values: np.ndarray, places: np.ndarray, template: np.ndarray, need: int) -> Iterator[tuple[float, int, int]]:
        m, n = len(template), len(values)
        starts = np.unique(np.maximum(np.concatenate([places // m - d for d in range(3)]), 0)) * m
        inside = np.searchsorted(places, starts + 3 * m) - np.searchsorted(places, starts)
        best: tuple[float, int, int] | None = None
        for start in starts[inside >= need].tolist():
            pairs = align(values[start:min(start + 3 * m, n)].tolist(), template.tolist())
            if len(pairs) < need:
                continue
            found = (len(pairs) / m, start + pairs[0][0], start + pairs[-1][0] + 1)
            if best is None or found[1] >= best[2]:
                if best is not None:
                    yield best
                best = found
            elif (found[0], best[2] - best[1]) > (best[0], found[2] - found[1]):
                best = found
        if best is not None:
            yield best


def find_licenses(docs: DataFrame, templates: Sequence[tuple[str, str, str]] = TEMPLATES, min_coverage: float = MIN_COVERAGE) -> DataFrame:
    """License texts in ``docs`` (doc_id, text): one row for each occurrence.

    ``templates`` (license, template, text) is a short stated list. Words are runs without ASCII white
    space or punctuation, A-Z lower-cased. Null and empty texts have no row; repeated rows are scanned
    each; of equally covered overlapping occurrences the tighter, then the first stays.
    Returns doc_id, license, template, coverage, start_word, end_word.
    """
    templates = tuple(templates)

    @F.arrow_udf("array<struct<license: string, template: string, coverage: double, start_word: bigint, end_word: bigint>>")
    def scan(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = Templates(templates)
        for column in texts:
            out: list[list[dict]] = [[] for _ in range(len(column))]
            begin = 0
            for _, text in W.slices([pa.RecordBatch.from_arrays([column], names=["text"])], "text"):
                for i, k, coverage, start, end in known.matches(text, min_coverage):
                    name, kind = known.names[k]
                    out[begin + i].append({"license": name, "template": kind, "coverage": coverage, "start_word": start, "end_word": end})
                begin += text.rows
            yield pa.array(out, pa.list_(pa.struct([("license", pa.string()), ("template", pa.string()), ("coverage", pa.float64()),
                                                    ("start_word", pa.int64()), ("end_word", pa.int64())])))

    return docs.select("doc_id", F.inline(scan("text")))
