"""Operator 2: license texts in documents.

Templates are winnowed into fingerprints, an inverted index of which tells for
every word position of a document which templates may lie there. Around each
candidate a banded local alignment finds the words that match, so reworded or
interrupted copies are reported with their coverage and span. Templates are
few, so the index goes to every task; documents are read once, whole, without a
shuffle.
"""

from __future__ import annotations

import bisect
import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.store import col

# Public license texts and notices, whole.
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
    "conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, "
    "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
    "distribution. "
)
_BSD_NAMES = (
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission. "
)
_BSD_DISCLAIMER = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
    "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR "
    "PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, "
    "INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE "
    "GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF "
    "LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY "
    "OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
TEMPLATES = {
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-notice": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software "
        "distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY "
        "KIND, either express or implied. See the License for the specific language governing permissions and "
        "limitations under the License."
    ),
    "mit-line": "Released under the MIT License.",
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR "
        "IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND "
        "NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
        "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE "
        "SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "bsd-2-clause": _BSD + _BSD_DISCLAIMER,
    "bsd-3-clause": _BSD + _BSD_NAMES + _BSD_DISCLAIMER,
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE "
        "IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED "
        "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
        "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER "
        "IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
        "PERFORMANCE OF THIS SOFTWARE."
    ),
    "gpl-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."
    ),
    "mpl-2.0-notice": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    ),
    "cc-by-nc-4.0-line": "Licensed under CC BY-NC 4.0.",
    "all-rights-reserved": "All rights reserved.",
}

_WORD = re.compile(r"\w+")
GRAM = 3
WINDOW = 4
#: Words by which an alignment may drift from the diagonal of its hits.
BAND = 8


class _Words(dict):
    """Word as written -> hash of its lower-cased form."""

    def __missing__(self, word: str) -> int:
        if len(self) >= 1 << 20:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word.lower().encode("utf-8", "surrogatepass"))
        return value


def grams(words: np.ndarray) -> np.ndarray:
    """Hash of every run of three words; one of all words if there are fewer."""
    width = min(GRAM, len(words))
    out = np.full(len(words) - width + 1, width, dtype=np.uint64)
    for i in range(width):
        out = (out + words[i : i + len(out)]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(31)
    return out


def winnow(hashes: np.ndarray) -> list[int]:
    """Positions of the smallest hash of every window, the rightmost of a tie;
    every position if there is only one window."""
    if len(hashes) <= WINDOW:
        return list(range(len(hashes)))
    return sorted({
        at + WINDOW - 1 - int(hashes[at : at + WINDOW][::-1].argmin()) for at in range(len(hashes) - WINDOW + 1)
    })


def align(doc: np.ndarray, template: np.ndarray, shift: int) -> tuple[int, int, int, int]:
    """(score, words matched, first, beyond last) of the best local alignment
    in the band around ``doc[shift + i] ~ template[i]``, the first of a tie; a
    match is 2, else -1."""
    low, best = shift - BAND, (0, 0, 0, 0)
    width = 2 * BAND + 1
    # Cell: (score, matches, first document word); index = document word - row - low.
    above = [(0, 0, -1)] * (width + 1)
    for row, word in enumerate(template):
        here, left = [], (0, 0, -1)
        for k in range(width):
            at = row + low + k
            if not 0 <= at < len(doc):
                left = (0, 0, -1)
                here.append(left)
                continue
            score, matches, first = above[k]
            if doc[at] == word:
                cell = (score + 2, matches + 1, at if first < 0 else first)
            else:
                cell = (score - 1, matches, first)
            for other in (above[k + 1], left):
                if other[0] - 1 > cell[0]:
                    cell = (other[0] - 1, other[1], other[2])
            left = cell if cell[0] > 0 else (0, 0, -1)
            here.append(left)
            if left[0] > best[0]:
                best = (*left, at + 1)
        above = [*here, (0, 0, -1)]
    return best


class _Free:
    """What of a document's words no place of a template has taken yet."""

    def __init__(self, size: int):
        self.starts, self.ends = [0], [size]

    def gap(self, word: int) -> tuple[int, int] | None:
        at = bisect.bisect_right(self.starts, word) - 1
        return (self.starts[at], self.ends[at]) if at >= 0 and word < self.ends[at] else None

    def take(self, first: int, beyond: int) -> None:
        at = bisect.bisect_right(self.starts, first) - 1
        start, end = self.starts[at], self.ends[at]
        self.starts[at : at + 1], self.ends[at : at + 1] = [start, beyond], [first, end]


def places(
    doc: np.ndarray, template: np.ndarray, hits: dict[int, list[int]], least: float
) -> list[tuple[int, int, int]]:
    """All (matched, first, beyond) of ``template`` in ``doc``, no two of which
    overlap, with ``least`` words matched or more.

    ``hits`` are the words by diagonal at which fingerprints match. The best
    alignment around any diagonal is taken first; those that overlap it are
    aligned again in what is left on either side.
    """
    free, found, queue, tried = _Free(len(doc)), [], [], set()

    def look(shift: int) -> None:
        for word in hits[shift]:
            gap = free.gap(word)
            if gap is None or (shift, gap) in tried:
                continue
            tried.add((shift, gap))
            start, end = gap
            score, matched, first, beyond = align(doc[start:end], template, shift - start)
            if matched and matched >= least:
                heapq.heappush(queue, (-score, start + first, start + beyond, matched, shift))

    for shift in sorted(hits):
        look(shift)
    while queue:
        _, first, beyond, matched, shift = heapq.heappop(queue)
        gap = free.gap(first)
        if gap is not None and beyond <= gap[1]:
            found.append((matched, first, beyond))
            free.take(first, beyond)
        look(shift)
    return found


class Index:
    """Fingerprint -> the templates and positions that have it."""

    def __init__(self, templates: dict[str, str]):
        words = _Words()
        self.names = list(templates)
        self.words = [
            np.fromiter((words[w] for w in _WORD.findall(t)), dtype=np.uint64) for t in templates.values()
        ]
        self.places: dict[int, list[tuple[int, int]]] = {}
        for t, template in enumerate(self.words):
            if len(template):
                hashes = grams(template)
                for at in winnow(hashes):
                    self.places.setdefault(int(hashes[at]), []).append((t, at))
        self.hashes = np.sort(np.fromiter(self.places, dtype=np.uint64, count=len(self.places)))

    def scan(self, text: str, least: float, memory: dict[str, int]) -> Iterator[tuple]:
        """(name, coverage, matched, words, first word, beyond, first character, beyond)."""
        doc = np.fromiter(map(memory.__getitem__, _WORD.findall(text)), dtype=np.uint64)
        if not len(doc) or not len(self.hashes):
            return
        found = grams(doc)
        at = np.searchsorted(self.hashes, found)
        hits = np.flatnonzero(self.hashes[np.minimum(at, len(self.hashes) - 1)] == found)
        if not len(hits):
            return
        by_template: dict[int, dict[int, list[int]]] = {}
        for p in hits.tolist():
            for t, q in self.places[int(found[p])]:
                by_template.setdefault(t, {}).setdefault(p - q, []).append(p)
        kept = [
            (first, t, beyond, matched)
            for t, diagonals in by_template.items()
            for matched, first, beyond in places(doc, self.words[t], diagonals, least * len(self.words[t]))
        ]
        if kept:
            spans = [m.span() for m in _WORD.finditer(text)]
            for first, t, beyond, matched in sorted(kept):
                n = len(self.words[t])
                yield self.names[t], matched / n, matched, n, first, beyond, spans[first][0], spans[beyond - 1][1]


def scan_licenses(
    docs: DataFrame,
    templates: dict[str, str] = TEMPLATES,
    min_coverage: float = 0.8,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row for every place where a document holds a template.

    Returns id, ``license`` (the template's name), ``coverage`` (share of the
    template's words that match, at least ``min_coverage``), ``n_matched``,
    ``n_template_words``, and the span in words and in characters, ends
    exclusive. Words are runs of word characters, compared in lower case. A
    template within another one is reported beside it. Places of one template
    don't overlap: of two that would, the one of the better alignment counts
    (the first of a tie), and what is left of the other if it still reaches
    ``min_coverage``.

    A stretch that shares six words in a row with a template is always a
    candidate. Null, empty and unlicensed texts give no row; repeated rows and
    null ids are rows like any other; without templates the result is empty.
    """
    docs = docs.select(col(id_col).alias("id"), col(text_col).alias("text")).where("text IS NOT NULL")
    shared = docs.sparkSession.sparkContext.broadcast(dict(templates))
    id_type = docs.schema["id"].dataType.simpleString()
    kinds = {
        "license": pa.string(), "coverage": pa.float64(), "n_matched": pa.int64(), "n_template_words": pa.int64(),
        "start_word": pa.int64(), "end_word": pa.int64(), "start_char": pa.int64(), "end_char": pa.int64(),
    }

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, memory = Index(shared.value), _Words()
        for batch in batches:
            rows, found = [], []
            for row, text in enumerate(batch.column(1)):
                for report in index.scan(text.as_py(), min_coverage, memory):
                    rows.append(row)
                    found.append(report)
            columns = [pa.array([f[i] for f in found], kind) for i, kind in enumerate(kinds.values())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), *columns], names=["id", *kinds]
            )

    schema = f"id {id_type}, license string, coverage double, n_matched long, n_template_words long, "
    schema += "start_word long, end_word long, start_char long, end_char long"
    out = docs.mapInArrow(scan, schema)
    return out.select(F.col("id").alias(id_col), *kinds)
