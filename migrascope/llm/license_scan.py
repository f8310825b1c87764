"""License scan: winnowed fingerprints of templates pick candidates, banded alignment measures them.

Templates are cut into words; hashes of ``GRAM`` words running are winnowed over windows of ``SPAN``, and the
selected ones go to an inverted index of template and place. The index holds the templates alone, a
parameter of bounded size (``MAX_TEMPLATE_WORDS``), and reaches every task. A text's fingerprints are selected
by the same rule, so a run of ``GRAM + SPAN - 1`` template words anywhere in a text is always found; runs with
a word that no template has cannot be in the index and are passed over. Anchors are aligned locally inside a band around
their diagonal, those that an alignment covers already with it. Where more words were put in or left out than the band
is wide, a text falls into several alignments: those of one template that follow each other in the text and in the
template are chained, over gaps of at most the template's own length in the text. A chain gives the share of the
template's words that match, each word once, and the outer span in the text.

Defined cases: null and empty texts have no matches; whole texts are scanned, whatever their length; equal
matches of several templates are all reported, a match inside a larger match of another template is not;
repeated rows each report theirs; an empty table gives no rows; other columns are left out.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from migrascope.llm.common import arrow_type, slices, texts

GRAM, SPAN = 3, 2
BAND = 6
MIN_COVERAGE = 0.8
MAX_TEMPLATE_WORDS = 200_000
WORD = re.compile(r"[A-Za-z0-9]+")
MATCH, MISS = 2, -1

# The wording of public licence texts and notices, whole.
BSD_OPENING = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
    "the following conditions are met: Redistributions of source code must retain the above copyright notice, this "
    "list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above "
    "copyright notice, this list of conditions and the following disclaimer in the documentation and/or other "
    "materials provided with the distribution."
)
BSD_THIRD = (
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission."
)
BSD_DISCLAIMER = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES, "
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, "
    "INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF "
    "SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY "
    "THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING "
    "IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
TEMPLATES = {
    "Apache-2.0 line": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0 notice": (
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on "
        "an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for "
        "the specific language governing permissions and limitations under the License."
    ),
    "MIT line": "Released under the MIT License",
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the Software), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, "
        "and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The "
        "above copyright notice and this permission notice shall be included in all copies or substantial portions of "
        "the Software. THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT "
        "NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO "
        "EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN "
        "AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE "
        "OR OTHER DEALINGS IN THE SOFTWARE"
    ),
    "GPL-3.0 line": "This work is licensed under the GNU General Public License, version 3",
    "GPL notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY "
        "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the "
        "GNU General Public License for more details."
    ),
    "AGPL notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
        "your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT "
        "ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See "
        "the GNU Affero General Public License for more details."
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE "
        "IS PROVIDED AS IS AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED "
        "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
        "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
        "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH "
        "THE USE OR PERFORMANCE OF THIS SOFTWARE."
    ),
    "Zlib": (
        "This software is provided as-is, without any express or implied warranty. In no event will the authors be held "
        "liable for any damages arising from the use of this software. Permission is granted to anyone to use this "
        "software for any purpose, including commercial applications, and to alter it and redistribute it freely, "
        "subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not "
        "claim that you wrote the original software. If you use this software in a product, an acknowledgment in the "
        "product documentation would be appreciated but is not required. 2. Altered source versions must be plainly "
        "marked as such, and must not be misrepresented as being the original software. 3. This notice may not be "
        "removed or altered from any source distribution."
    ),
    "CC-BY-NC-4.0 line": "Licensed under CC BY-NC 4.0",
    "BSD-2-Clause": f"{BSD_OPENING} {BSD_DISCLAIMER}",
    "BSD-3-Clause": f"{BSD_OPENING} {BSD_THIRD} {BSD_DISCLAIMER}",
    "MPL-2.0 notice": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
}

FOUND = StructType(
    [
        StructField("doc_id", LongType()),
        StructField("license", StringType()),
        StructField("coverage", DoubleType()),
        StructField("matched_words", IntegerType()),
        StructField("start", LongType()),
        StructField("end", LongType()),
    ]
)


@dataclass(frozen=True)
class Match:
    template: str
    matched: int
    size: int
    first: int  # words of the text, end exclusive
    last: int

    @property
    def coverage(self) -> float:
        return self.matched / self.size


def plain_words(text: str) -> list[str]:
    found = WORD.findall(text)
    return "\n".join(found).lower().split("\n") if found else []


def fingerprints(ids: list[int]) -> list[tuple[int, int]]:
    """Winnowed (hash, place) of a run of word numbers: the least hash of each window, the last of equal ones."""
    hashes = [hash(tuple(ids[i : i + GRAM])) for i in range(len(ids) - GRAM + 1)]
    chosen = set()
    for i in range(len(hashes) - SPAN + 1):
        chosen.add(min(range(i, i + SPAN), key=lambda j: (hashes[j], -j)))
    if len(hashes) < SPAN:
        chosen.update(range(len(hashes)))
    return [(hashes[i], i) for i in sorted(chosen)]


class Index:
    """Vocabulary of the templates and the places of their fingerprints."""

    def __init__(self, templates: dict[str, str]) -> None:
        self.vocabulary: dict[str, int] = {}
        self.templates: dict[str, list[int]] = {}
        self.places: dict[int, list[tuple[str, int]]] = defaultdict(list)
        for name, text in templates.items():
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in plain_words(text)]
            self.templates[name] = ids
            for value, place in fingerprints(ids):
                self.places[value].append((name, place))
        if sum(map(len, self.templates.values())) > MAX_TEMPLATE_WORDS:
            raise ValueError("the templates exceed the bound of the index")

    def matches(self, text_words: list[str], least: float) -> list[Match]:
        ids = [self.vocabulary.get(w, -1) for w in text_words]
        anchors: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for start, end in known_runs(ids):
            for value, place in fingerprints(ids[start:end]):
                for name, at in self.places.get(value, ()):
                    anchors[name].append((start + place - at, start + place))
        found = []
        for name, hits in anchors.items():
            template = self.templates[name]
            for matched, first, last in chained(list(aligned(template, ids, hits)), len(template)):
                if matched >= least * len(template):
                    found.append(Match(name, matched, len(template), first, last))
        return outermost(found)


def known_runs(ids: list[int]) -> Iterator[tuple[int, int]]:
    """Runs of at least ``GRAM`` words that templates have."""
    start = 0
    for i, value in enumerate([*ids, -1]):
        if value < 0:
            if i - start >= GRAM:
                yield start, i
            start = i + 1


Part = tuple[int, int, int, int, int]  # matched words; places in the text, then in the template, ends exclusive


def chained(parts: list[Part], size: int) -> list[tuple[int, int, int]]:
    """Chains (matched, first, last) of alignments, each in one chain, the longest chains first.

    A part follows another if it begins and ends behind it in the text and in the template, at most ``size`` words
    behind its end in the text; words that both cover count once. Parts are at least ``GRAM`` words long, so only so many
    before a part can reach it.
    """
    parts = sorted(parts, key=lambda p: (p[1], p[2]))
    best: list[tuple[int, int]] = []  # matched words of the best chain that ends with a part, and the part before it
    for i, (matched, first, last, low, high) in enumerate(parts):
        top = (matched, -1)
        for j in range(i - 1, -1, -1):
            _, first_j, last_j, low_j, high_j = parts[j]
            if first - first_j > 3 * size + 2 * BAND:
                break
            if first_j < first <= last_j + size and last_j < last and low_j < low and high_j < high:
                gained = matched - max(0, high_j - low, last_j - first)
                if gained > 0 and best[j][0] + gained > top[0]:
                    top = (best[j][0] + gained, j)
        best.append(top)
    out, used = [], set()
    for i in sorted(range(len(parts)), key=lambda i: (-best[i][0], i)):
        chain, at = [], i
        while at >= 0 and at not in used:
            chain.append(at)
            at = best[at][1]
        if chain:
            used.update(chain)
            whole = best[i][0] - (best[at][0] if at >= 0 else 0)
            out.append((whole, parts[chain[-1]][1], parts[i][2]))
    return out


def aligned(template: list[int], ids: list[int], hits: list[tuple[int, int]]) -> Iterator[Part]:
    """Alignments around the anchors (diagonal, place), in the order of places.

    An anchor inside an alignment on a nearby diagonal is part of it; any other gets one of its own, between
    the alignments before and behind it. The best one of a band may lie off the anchor: then it is kept, and the one
    at the anchor is looked for in what is left.
    """
    known: list[tuple[int, int, int]] = []  # (diagonal, first, end) of alignments that end behind the current place
    start = 0
    for diagonal, place in sorted(set(hits), key=lambda h: (h[1], h[0])):
        start = max([start, *(end for _, _, end in known if end <= place)])
        known = [k for k in known if k[2] > place]
        near = [k for k in known if abs(diagonal - k[0]) <= BAND]
        if any(first <= place for _, first, _ in near):
            continue
        low, high = start, min((first for _, first, _ in near), default=len(ids))
        while got := align(template, ids, diagonal, low, high):
            yield got
            known.append((diagonal, got[1], got[2]))
            if place < got[1]:
                high = got[1]
            elif place >= got[2]:
                low = got[2]
            else:
                break


def align(template: list[int], ids: list[int], diagonal: int, start: int = 0, stop: int | None = None) -> Part | None:
    """Best local alignment inside the band: matched words, its places in the text and in the template.

    Places before ``start`` and from ``stop`` on are left out.
    A cell holds (score, matches, first place, first template word); only one row of the band is kept at a time.
    """
    width = 2 * BAND + 1
    stop = len(ids) if stop is None else stop
    none = (0, 0, -1, -1)
    row: list[tuple[int, int, int, int]] = [none] * (width + 1)
    best, best_end, best_word = none, -1, -1
    for t, word in enumerate(template):
        now: list[tuple[int, int, int, int]] = []
        left = none
        for k in range(width):
            place = diagonal + t + k - BAND
            if not start <= place < stop:
                cell = none
            else:
                score, matches, first, at = row[k]
                same = ids[place] == word
                opened = (first, at) if first >= 0 else (place, t)
                cell = (score + (MATCH if same else MISS), matches + same, *opened)
                up = row[k + 1]
                for other in (up, left):
                    if other[2] >= 0 and (other[0] + MISS, other[1]) > cell[:2]:
                        cell = (other[0] + MISS, *other[1:])
                if cell[0] <= 0:
                    cell = none
                elif cell[:2] > best[:2]:
                    best, best_end, best_word = cell, place + 1, t + 1
            now.append(cell)
            left = cell
        row = [*now, none]
    return (best[1], best[2], best_end, best[3], best_word) if best_end >= 0 else None


def outermost(found: list[Match]) -> list[Match]:
    """Matches not inside a larger one, equal ones once, by place."""
    kept: list[Match] = []
    reach: list[tuple[int, int, int]] = []
    for m in sorted(set(found), key=lambda m: (m.first, -m.last, -m.matched, m.template)):
        reach = [r for r in reach if r[1] > m.first]
        if not any(r[1] >= m.last and r[2] > m.matched for r in reach):
            kept.append(m)
            reach.append((m.first, m.last, m.matched))
    return kept


def scan(
    docs: DataFrame, templates: dict[str, str] = TEMPLATES, least: float = MIN_COVERAGE, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, license, coverage, matched_words, start, end): spans are code points, end exclusive."""
    kind = arrow_type(FOUND)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(templates)
        for part in slices(batches, "text"):
            rows = []
            for key, value in zip(part.column("doc_id").to_pylist(), texts(part, "text"), strict=True):
                found = index.matches(plain_words(value), least)
                if not found:
                    continue
                spans = [m.span() for m in WORD.finditer(value)]
                for m in found:
                    place = (spans[m.first][0], spans[m.last - 1][1])
                    rows.append((key, m.template, m.coverage, m.matched, *place))
            yield pa.RecordBatch.from_pylist([dict(zip(FOUND.names, r, strict=True)) for r in rows], schema=kind)

    picked = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return picked.mapInArrow(run, FOUND)
