"""Licence scan: Dice coefficient over word bigrams against a set of licence templates.

Words are runs of letters and digits, A-Z lower-cased; a stretch of words is its set of word
bigrams. A template is a match if ``2 |A & B| / (|A| + |B|)`` reaches the threshold for some
stretch of a text: the text, a paragraph (between blank lines), a line, or any other window
of consecutive words, so a licence inside a longer text or a longer line is found as well.

The best window is exact. It needs ``t/(2-t)`` of the template's bigrams, which few texts
have at all; those are cut at gaps with more foreign bigrams than the threshold allows, and
within each piece the best window is the greatest sum over distinct bigrams (``best_window``).

The templates are a constant of the program, some ten thousand bigrams, whatever the input.
The full legal texts among them are files in ``licence_texts``.

Defined results: null and empty texts, and texts of one word, match nothing; a licence that
occurs several times in a text is reported once, with its best segment (the higher score,
then the wider kind, then the earlier start); repeated rows are rows of their own.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from importlib import resources

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanloom.llm.tokens import ALNUM, FOLDED_VALUE, NOT_BLANK, Words, chunks, mixed

_WARRANTY = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED '
    "TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL "
    "THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
    "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
    "DEALINGS IN THE SOFTWARE."
)
_BSD_END = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED '
    "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
    "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY "
    "DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
    "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER "
    "CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR "
    "OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_BSD_START = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
    "the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, "
    "this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above "
    "copyright notice, this list of conditions and the following disclaimer in the documentation and/or other "
    "materials provided with the distribution. "
)


def _gnu(name: str, version: str) -> str:
    return (
        f"This program is free software: you can redistribute it and/or modify it under the terms of the {name} as "
        f"published by the Free Software Foundation, either version {version} of the License, or (at your option) any "
        f"later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; "
        f"without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {name} for "
        f"more details."
    )


def _full(name: str) -> str:
    return (resources.files("spanloom.llm") / "licence_texts" / f"{name}.txt").read_text(encoding="utf-8")


# Public licence texts and notices: fixed values, (licence, kind of template, text).
TEMPLATES: tuple[tuple[str, str, str], ...] = (
    ("MIT", "notice", "Released under the MIT License."),
    ("MIT", "notice", "Licensed under the MIT License."),
    ("MIT", "text",
     "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
     'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
     "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
     "to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
     "copyright notice and this permission notice shall be included in all copies or substantial portions of the "
     "Software. " + _WARRANTY),
    ("ISC", "text",
     "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
     "granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE "
     'IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED '
     "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
     "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
     "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE "
     "USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("BSD-2-Clause", "text", _BSD_START + _BSD_END),
    ("BSD-3-Clause", "text",
     _BSD_START + "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse "
     "or promote products derived from this software without specific prior written permission. " + _BSD_END),
    ("Apache-2.0", "notice", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "text",
     'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
     "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
     "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
     '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the '
     "specific language governing permissions and limitations under the License."),
    ("GPL-3.0", "notice", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "text", _gnu("GNU General Public License", "3")),
    ("GPL-2.0", "text", _gnu("GNU General Public License", "2")),
    ("AGPL-3.0", "text", _gnu("GNU Affero General Public License", "3")),
    ("LGPL-3.0", "text", _gnu("GNU Lesser General Public License", "3")),
    ("MPL-2.0", "text",
     "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
     "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("Zlib", "text",
     "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
     "liable for any damages arising from the use of this software. Permission is granted to anyone to use this software "
     "for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the "
     "following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you "
     "wrote the original software. If you use this software in a product, an acknowledgment in the product documentation "
     "would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not "
     "be misrepresented as being the original software. 3. This notice may not be removed or altered from any source "
     "distribution."),
    ("BSL-1.0", "notice", "Distributed under the Boost Software License, Version 1.0."),
    ("CC0-1.0", "notice", "Released into the public domain under CC0 1.0."),
    ("CC-BY-4.0", "notice", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "text", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "notice", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "text",
     "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "notice", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "text",
     "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    *((n, "full text", _full(n)) for n in ("Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "CC0-1.0")),
)
SEGMENTS = ("text", "paragraph", "line")
WINDOW = "window"
MATCH = T.StructType(
    [
        T.StructField("licence", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("segment", T.StringType()),
        T.StructField("start", T.LongType()),
        T.StructField("end", T.LongType()),
    ]
)


def bigrams(hashes: np.ndarray) -> np.ndarray:
    """One hash for each two consecutive words."""
    return mixed(hashes[:-1] * np.uint64(0x9E3779B97F4A7C15) + hashes[1:])


class Templates:
    """Bigram sets of the templates, joined in one sorted array with the templates of each."""

    def __init__(self, templates: tuple[tuple[str, str, str], ...]) -> None:
        sets = []
        for _, _, text in templates:
            data = np.frombuffer(text.encode(), dtype=np.uint8)
            sets.append(np.unique(bigrams(Words(data, np.array([0, len(data)]), ALNUM, FOLDED_VALUE).hash)))
        self.names = [t[0] for t in templates]
        self.sizes = np.array([len(s) for s in sets])
        self.all = np.unique(np.concatenate(sets))
        self.member = np.stack([np.isin(self.all, s) for s in sets])
        # The templates of each bigram, one after the other.
        self.degree = self.member.sum(axis=0)
        self.begin = np.cumsum(self.degree) - self.degree
        self.of = np.nonzero(self.member.T)[1]

    def least(self, threshold: float) -> np.ndarray:
        """Bigrams of each template that a match must hold, as its set is no smaller than that."""
        return np.ceil(self.sizes * threshold / (2 - threshold) - 1e-9).astype(np.int64)

    def candidates(self, rows: np.ndarray, grams: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
        """(row, template) pairs in which the row holds enough distinct bigrams of the template."""
        least = self.least(threshold)
        key = np.unique(rows * len(self.all) + grams)
        rows, grams = np.divmod(key, len(self.all))
        held, inverse, count = np.unique(rows, return_inverse=True, return_counts=True)
        enough = count[inverse] >= least.min()
        rows, grams = rows[enough], grams[enough]
        n = self.degree[grams]
        inner = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        of = self.of[np.repeat(self.begin[grams], n) + inner]
        pair, count = np.unique(np.repeat(rows, n) * len(self.names) + of, return_counts=True)
        row, template = np.divmod(pair, len(self.names))
        kept = count >= least[template]
        return row[kept], template[kept]

    def matches(self, segment: np.ndarray, threshold: float) -> list[tuple[str, float]]:
        """(licence, Dice) of the templates within the size bounds that reach the threshold."""
        distinct = np.unique(segment)
        n = len(distinct)
        # The score decides; the bounds leave out what cannot reach it.
        fits = (self.sizes + 1e-6 >= n * threshold / (2 - threshold)) & (self.sizes <= n * (2 - threshold) / threshold + 1e-6)
        if not fits.any():
            return []
        at = np.searchsorted(self.all, distinct)
        at = at[self.all[np.minimum(at, len(self.all) - 1)] == distinct]
        found = []
        for i in np.flatnonzero(fits):
            score = 2.0 * int(self.member[i, at].sum()) / (n + int(self.sizes[i]))
            if score >= threshold:
                found.append((self.names[i], score))
        return found


def best_window(ids: np.ndarray, hit: np.ndarray, size: int, threshold: float) -> tuple[float, int, int] | None:
    """(Dice, first, end) of the best window of a sequence of bigrams, if it reaches the threshold.

    A score is at least s if the sum over the window's distinct bigrams of ``2 - s`` (of the
    template) or ``-s`` (others) is at least ``s * size``. Going back from the last start,
    each bigram adds its weight up to where it occurs again, so the greatest sum of each start
    is at hand; s is raised to the score found until none is higher. In whole numbers. A best
    window need begin nowhere but at a bigram of the template that it does not hold again.
    """
    n = len(ids)
    order = np.argsort(ids, kind="stable")
    again = np.full(n, n, dtype=np.int64)
    same = ids[order[1:]] == ids[order[:-1]]
    again[order[:-1][same]] = order[1:][same]
    # The end of each start: as many distinct bigrams as a match may have. It never goes back.
    most = int(size * (2 - threshold) / threshold + 1e-6)
    before = np.full(n, -1, dtype=np.int64)
    before[order[1:][same]] = order[:-1][same]
    end = np.empty(n, dtype=np.int64)
    stop, held, last, nexts = 0, 0, before.tolist(), again.tolist()
    for a in range(n):
        while stop < n and (last[stop] >= a or held < most):
            held += last[stop] < a
            stop += 1
        end[a] = min(stop, nexts[a])
        held -= nexts[a] >= stop
    ends, starts = end.tolist(), hit.tolist()
    s, found = Fraction(threshold).limit_denominator(1 << 20), None
    while True:
        p, q = s.numerator, s.denominator
        sums = np.zeros(n, dtype=np.int64)
        best, where = p * size, None
        for a in range(n - 1, -1, -1):
            part = sums[a : ends[a]]
            if not starts[a]:
                part -= p
                continue
            part += 2 * q - p
            at = int(part.argmax())
            if part[at] >= best:
                best, where = int(part[at]), (a, a + at + 1)
        if where is None:
            break
        inside = np.unique(ids[where[0] : where[1]], return_index=True)[1] + where[0]
        score = Fraction(2 * int(hit[inside].sum()), len(inside) + size)
        found = (score.numerator / score.denominator, *where)
        if score <= s:
            break
        s = score
    return found if found and found[0] >= threshold else None


def _windows(pairs: np.ndarray, hit: np.ndarray, size: int, least: int, threshold: float) -> tuple[float, int, int] | None:
    """The best window of a text: of the pieces between gaps that no match can hold."""
    at = np.flatnonzero(hit)
    most = int(size * (2 / threshold - 2) + 1e-6)
    wide = np.flatnonzero(np.diff(at) - 1 > most)
    cuts = [i + 1 for i in wide.tolist() if len(np.unique(pairs[at[i] + 1 : at[i + 1]])) > most]
    found = None
    for piece in np.split(at, cuts):
        low, high = int(piece[0]), int(piece[-1]) + 1
        if len(np.unique(pairs[piece])) < least:
            continue
        ids = np.unique(pairs[low:high], return_inverse=True)[1].ravel()
        best = best_window(ids, hit[low:high], size, threshold)
        if best and (found is None or best[0] > found[0]):
            found = (best[0], low + best[1], low + best[2])
    return found


def _scan(templates: Templates, threshold: float, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple]:
    """(row, licence, score, kind of segment, start byte, end byte) of a chunk's matches."""
    words = Words(data, offsets, ALNUM, FOLDED_VALUE)
    if len(words.start) < 2:
        return
    pairs = bigrams(words.hash)
    at = np.minimum(np.searchsorted(templates.all, pairs), len(templates.all) - 1)
    rows = np.repeat(np.arange(len(offsets) - 1), np.diff(words.offsets))
    hit = (templates.all[at] == pairs) & (rows[1:] == rows[:-1])
    inside = np.flatnonzero(hit)
    if not len(inside):
        return
    row_of, template_of = templates.candidates(rows[inside], at[inside], threshold)
    if not len(row_of):
        return
    least = templates.least(threshold)
    for row, i in zip(row_of.tolist(), template_of.tolist()):
        low, high = int(words.offsets[row]), int(words.offsets[row + 1]) - 1
        mine = hit[low:high] & templates.member[i, at[low:high]]
        best = _windows(pairs[low:high], mine, int(templates.sizes[i]), int(least[i]), threshold)
        if best:
            score, first, end = best[0], low + best[1], low + best[2]
            base = int(offsets[row])
            yield row, templates.names[i], score, WINDOW, int(words.start[first]) - base, int(words.end[end]) - base
    hit &= np.isin(rows[1:], row_of)
    feeds = np.flatnonzero(data == 10)
    lines = np.searchsorted(feeds, words.start)
    # A paragraph ends at a blank line: nothing but blanks (as of CRLF) between two line feeds.
    filled = np.cumsum(NOT_BLANK[data])[feeds]
    doubles = feeds[1:][filled[1:] == filled[:-1]]
    paragraphs = np.searchsorted(doubles, words.start)
    seen: set[tuple[int, int]] = set()
    for kind, unit in zip(SEGMENTS, (rows, paragraphs, lines)):
        joined = (rows[1:] == rows[:-1]) & (unit[1:] == unit[:-1])
        inside = np.flatnonzero(joined & hit)
        if not len(inside):
            continue
        # Segments are runs of words; number them by their first word.
        first = np.flatnonzero(np.r_[True, ~joined])
        segment = np.searchsorted(first, inside, side="right") - 1
        number, count = np.unique(segment, return_counts=True)
        for s in number[count >= least.min()]:
            low = int(first[s])
            high = int(first[s + 1]) if s + 1 < len(first) else len(rows)
            if (low, high) in seen:
                continue
            seen.add((low, high))
            row = int(rows[low])
            base = int(offsets[row])
            for name, score in templates.matches(pairs[low : high - 1], threshold):
                yield row, name, score, kind, int(words.start[low]) - base, int(words.end[high - 1]) - base


def scan_licences(
    docs: DataFrame,
    *,
    text: str = "text",
    column: str = "licences",
    threshold: float = 0.8,
    templates: tuple[tuple[str, str, str], ...] = TEMPLATES,
) -> DataFrame:
    """``docs`` with an array of matches, best first: licence, score, kind, byte range of the segment."""
    docs = docs.drop(column)
    schema = T.StructType([*docs.schema.fields, T.StructField(column, T.ArrayType(MATCH))])
    model = docs.sparkSession.sparkContext.broadcast(Templates(templates))
    kind_order = {k: i for i, k in enumerate((*SEGMENTS, WINDOW))}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = pa.struct(
            [("licence", pa.string()), ("score", pa.float64()), ("segment", pa.string()), ("start", pa.int64()), ("end", pa.int64())]
        )
        for batch in batches:
            best: list[dict[str, tuple]] = [{} for _ in range(batch.num_rows)]
            for first, data, offsets in chunks(batch.column(text)):
                for row, name, score, kind, start, end in _scan(model.value, threshold, data, offsets):
                    key = (-score, kind_order[kind], start)
                    held = best[first + row].get(name)
                    if held is None or key < held[0]:
                        best[first + row][name] = (key, {"licence": name, "score": score, "segment": kind, "start": start, "end": end})
            out = [[m for _, m in sorted(b.values(), key=lambda x: (x[0], x[1]["licence"]))] for b in best]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(out, pa.list_(arrow))], names=[*batch.schema.names, column]
            )

    return docs.mapInArrow(run, schema)


def licence_report(docs: DataFrame, *, doc_id: str = "doc_id", **options) -> DataFrame:
    """Per row: its id, the number of licences, their names by score, and the best score."""
    found = scan_licences(docs, column="__found", **options)
    return found.select(
        F.col(doc_id).alias("doc_id"),
        F.size("__found").cast("long").alias("n_licences"),
        F.array_join(F.transform("__found", lambda m: m["licence"]), ",").alias("licences"),
        F.coalesce(F.try_element_at("__found", F.lit(1))["score"], F.lit(0.0)).alias("score"),
    )
