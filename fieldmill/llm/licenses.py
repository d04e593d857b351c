"""License notices in documents: winnowed fingerprints pick candidates, banded alignment confirms them.

Of every ``WINNOW`` successive hashes of ``GRAM`` template words the smallest is kept as a fingerprint, so any
``GRAM + WINNOW - 1`` words of a template hold one; where a fifth of the words are exchanged, as many are left in a row
somewhere. Of templates below ``SHORT`` words, which may keep two in a row only, every pair of words is one. An inverted
index of the fingerprints, asked for all runs of words of a document, yields templates and the offsets at which they may
lie. Around such offsets the template is aligned with the document's words in a band, and what covers enough of the
template is reported. A match that lies within a closer one is not: a notice is the license it fits best.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice, takewhile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldmill.llm.shipping import ship
from fieldmill.llm.words import ALPHANUMERIC, LOWER, Words, find_words, text_slices

GRAM, WINNOW, BAND, COVERAGE = 3, 2, 6, 0.8
PAIR, SHORT = 2, 16
MOST_TEMPLATE_WORDS = 1_000_000
_FILTER_BITS = 20

# Fixed texts: notices as licenses ask for them, whole, and the openings that often stand alone.
_AS_IS = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING,'
    " BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO"
    " EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR"
    " CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR"
    " PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR"
    " TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE"
    " POSSIBILITY OF SUCH DAMAGE."
)
_BSD_OPENING = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following"
    " conditions are met"
)
_BSD_CONDITIONS = (
    " 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following"
    " disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the"
    " following disclaimer in the documentation and/or other materials provided with the distribution. "
)
_BSD_NAMES = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products"
    " derived from this software without specific prior written permission. "
)
_MIT_OPENING = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation"
    ' files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy,'
    " modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"
)
_MIT_REST = (
    ", and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright"
    " notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS"
    ' PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF'
    " MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE"
    " LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF"
    " OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)


def _gnu(work: str, kind: str) -> tuple[str, str]:
    """Opening and rest of a notice for the GNU ``kind`` public license, version 3 or later."""
    opening = (
        f"This {work} is free software: you can redistribute it and/or modify it under the terms of the GNU {kind} Public License"
        " as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    )
    rest = (
        f" This {work} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty"
        f" of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {kind} Public License for more details. You should"
        f" have received a copy of the GNU {kind} Public License along with this {work}. If not, see"
        " <https://www.gnu.org/licenses/>."
    )
    return opening, rest


_GPL, _LGPL, _AGPL = _gnu("program", "General"), _gnu("library", "Lesser General"), _gnu("program", "Affero General")
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with'
        " the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by"
        ' applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS,'
        " WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language"
        " governing permissions and limitations under the License."
    ),
    "MIT": "Released under the MIT License.",
    "MIT opening": _MIT_OPENING,
    "MIT text": _MIT_OPENING + _MIT_REST,
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL opening": _GPL[0],
    "GPL header": "".join(_GPL),
    "LGPL opening": _LGPL[0],
    "LGPL header": "".join(_LGPL),
    "AGPL opening": _AGPL[0],
    "AGPL header": "".join(_AGPL),
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "BSD opening": _BSD_OPENING,
    "BSD-2-Clause": _BSD_OPENING + ":" + _BSD_CONDITIONS + _AS_IS,
    "BSD-3-Clause": _BSD_OPENING + ":" + _BSD_CONDITIONS + _BSD_NAMES + _AS_IS,
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}


def fingerprints(words: Words, gram: int = GRAM, winnow: int = WINNOW) -> tuple[np.ndarray, np.ndarray]:
    """(first word, hash) of the winnowed word grams; a row with fewer grams than a window keeps its smallest."""
    at, hashes = words.windows(gram)
    if not len(at):
        return at, hashes
    row = words.row_of_word()[at]
    keep = np.zeros(len(at), bool)
    if len(at) >= winnow:
        stacked = np.stack([hashes[j : len(hashes) - winnow + 1 + j] for j in range(winnow)])
        whole = row[winnow - 1 :] == row[: len(row) - winnow + 1]
        # the rightmost of equal smallest hashes, as is usual
        pick = winnow - 1 - stacked[::-1].argmin(0) + np.arange(stacked.shape[1])
        keep[pick[whole]] = True
    first = np.flatnonzero(np.diff(row, prepend=-1))
    for a, b in zip(first, np.append(first[1:], len(row))):
        if b - a < winnow:
            keep[a + int(hashes[a:b].argmin())] = True
    return at[keep], hashes[keep]


@dataclass
class TemplateIndex:
    """The templates' words, and their fingerprints with the places where they lie.

    ``seen`` flags the first bits of the fingerprints, to pass over most words of a document quickly.
    """

    names: list[str]
    words: list[list[int]]
    hashes: dict[int, np.ndarray]
    seen: dict[int, np.ndarray]
    places: dict[int, list[tuple[int, int]]]

    @classmethod
    def of(cls, templates: dict[str, str]) -> TemplateIndex:
        names = list(templates)
        places: dict[int, list[tuple[int, int]]] = {}
        own: list[list[int]] = []
        known: dict[int, set[int]] = {PAIR: set(), GRAM: set()}
        for low, high, data, offsets in text_slices(pa.array([templates[n] for n in names], pa.string())):
            words = find_words(data, offsets, ALPHANUMERIC, LOWER)
            own.extend(words.hashes[words.first[r] : words.first[r + 1]].tolist() for r in range(high - low))
            for gram, (at, hashes) in ((PAIR, words.windows(PAIR)), (GRAM, fingerprints(words))):
                rows = np.searchsorted(words.first, at, side="right") - 1
                fits = (words.counts[rows] < SHORT) == (gram == PAIR)
                for i, h, row in zip(at[fits].tolist(), hashes[fits].tolist(), rows[fits].tolist()):
                    known[gram].add(h)
                    places.setdefault(h, []).append((low + row, i - int(words.first[row])))
        if sum(map(len, own)) > MOST_TEMPLATE_WORDS:
            raise ValueError(f"the templates have more than {MOST_TEMPLATE_WORDS} words")
        if short := [name for name, words in zip(names, own) if len(words) < GRAM]:
            raise ValueError(f"templates of fewer than {GRAM} words: {short}")
        sizes = {gram: np.array(sorted(found), np.uint64) for gram, found in known.items() if found}
        seen = {gram: np.zeros(1 << _FILTER_BITS, bool) for gram in sizes}
        for gram, found in sizes.items():
            seen[gram][found >> np.uint64(64 - _FILTER_BITS)] = True
        return cls(names, own, sizes, seen, places)


def banded_alignment(template: list[int], words: list[int], offset: int, band: int = BAND) -> tuple[int, int, int]:
    """(matched words, start, end) of the best local alignment with ``words`` near the diagonal ``offset``.

    A match scores 2, a mismatch or a gap -1; template word i meets words ``offset + i - band`` to ``offset + i + band``.
    """
    best = (0, 0, 0, 0)  # score, matches, start, end
    before: list[tuple[int, int, int]] = [(0, 0, -1)] * (2 * band + 3)
    for i, wanted in enumerate(template):
        row: list[tuple[int, int, int]] = [(0, 0, -1)] * (2 * band + 3)
        for k in range(1, 2 * band + 2):
            j = offset + i + k - band - 1
            if not 0 <= j < len(words):
                continue
            score, matches, start = before[k]
            same = words[j] == wanted
            options = [(score + (2 if same else -1), matches + same, start if score else j)]
            for other in (before[k + 1], row[k - 1]):
                if other[0] > 1:
                    options.append((other[0] - 1, other[1], other[2]))
            cell = max(options, key=lambda c: (c[0], c[1]))
            if cell[0] > 0:
                row[k] = cell
                if (cell[0], cell[1]) > best[:2]:
                    best = (cell[0], cell[1], cell[2], j + 1)
        before = row
    return best[1:]


def _matches(words: Words, index: TemplateIndex, band: int, coverage: float) -> list[list[dict]]:
    """The accepted matches of each row, by place."""
    offsets: dict[tuple[int, int], set[int]] = {}
    shift = np.uint64(64 - _FILTER_BITS)
    for gram, known in index.hashes.items():
        at, hashes = words.windows(gram)
        hit = np.flatnonzero(index.seen[gram][hashes >> shift])
        place = np.minimum(np.searchsorted(known, hashes[hit]), len(known) - 1)
        hit = hit[known[place] == hashes[hit]]
        rows = np.searchsorted(words.first, at[hit], side="right") - 1
        for i, h, row in zip(at[hit].tolist(), hashes[hit].tolist(), rows.tolist()):
            for template, inside in index.places[h]:
                offsets.setdefault((row, template), set()).add(i - int(words.first[row]) - inside)
    found: list[list[dict]] = [[] for _ in range(words.rows)]
    for (row, template), starts in offsets.items():
        wanted = index.words[template]
        base, top = int(words.first[row]), int(words.first[row + 1])
        # notices that don't overlap begin farther apart than this, and the band reaches the offsets in between
        near = min(band, int(coverage * len(wanted)) - 1)
        last_end, aligned = -1, None
        for start in sorted(starts):
            if aligned is not None and start - aligned <= near:
                continue
            aligned = start
            low, high = base + max(0, start - band, last_end), min(top, base + start + len(wanted) + band)
            if low >= high:
                continue
            matched, a, b = banded_alignment(wanted, words.hashes[low:high].tolist(), base + start - low, band)
            a, b = a + low - base, b + low - base
            if matched >= coverage * len(wanted):
                last_end = b
                found[row].append(
                    {"license": index.names[template], "matched": matched, "coverage": matched / len(wanted), "start": a, "end": b}
                )
    return [_fitting_best(own, band) for own in found]


def _fitting_best(own: list[dict], band: int) -> list[dict]:
    """The matches by place, without those that lie within a closer one, give or take ``band`` words.

    A match is as close as its share of matched words, in the template or in its span, whichever is less.
    """
    close = lambda m: min(m["coverage"], m["matched"] / (m["end"] - m["start"]))
    own.sort(key=lambda m: (m["start"], m["license"]))
    kept = []
    longest = max((m["end"] - m["start"] for m in own), default=0)
    for m in own:
        near = islice(own, bisect_left(own, m["start"] - longest, key=lambda o: o["start"]), None)
        near = takewhile(lambda o: o["start"] - band <= m["start"], near)
        if not any(close(o) > close(m) and m["end"] <= o["end"] + band for o in near):
            kept.append(m)
    return kept


_MATCH = pa.struct(
    [("license", pa.string()), ("matched", pa.int32()), ("coverage", pa.float64()), ("start", pa.int32()), ("end", pa.int32())]
)


def _scan(batches: Iterator[pa.RecordBatch], shipped, band: int, coverage: float) -> Iterator[pa.RecordBatch]:
    index = shipped.value
    for batch in batches:
        n_words, found = [], []
        for _, _, data, offsets in text_slices(batch.column(1)):
            words = find_words(data, offsets, ALPHANUMERIC, LOWER)
            n_words.append(words.counts)
            found.extend(_matches(words, index, band, coverage))
        counts = np.concatenate(n_words) if n_words else np.empty(0, np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(counts, pa.int64()), pa.array(found, pa.list_(_MATCH))], ["doc", "n_words", "matches"]
        )


def scan_licenses(
    docs: DataFrame,
    keep: list[str],
    text_col: str = "text",
    templates: dict[str, str] | None = None,
    band: int = BAND,
    coverage: float = COVERAGE,
) -> DataFrame:
    """The columns ``keep`` as the struct ``doc``, ``n_words`` and ``matches`` of each text.

    A match names the template (``license``), how many of its words are ``matched`` in order, the share of them
    (``coverage``) and the span of words of the text. A match within a closer one is left out. Words are lower-cased runs of letters and digits. Null and empty
    texts match nothing; repeated notices and rows are reported each; columns of ``docs`` may have any names. The
    templates go to every task and are refused beyond a million words, or below three.
    """
    ship(docs.sparkSession)
    index = TemplateIndex.of(TEMPLATES if templates is None else templates)
    shipped = docs.sparkSession.sparkContext.broadcast(index)
    rows = docs.select(F.struct(*[docs[c] for c in keep]).alias("doc"), docs[text_col].alias("text"))
    kind = rows.schema["doc"].dataType.simpleString()
    return rows.mapInArrow(
        lambda batches: _scan(batches, shipped, band, coverage),
        f"doc {kind}, n_words long, matches array<struct<license:string,matched:int,coverage:double,start:int,end:int>>",
    )
