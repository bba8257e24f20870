"""License scan: normalised text against license templates by the Dice coefficient of their word bigrams.

Letters are lower-cased, everything but letters, digits and bytes beyond ASCII separates words, and a unit is the set
of its distinct word pairs. Units are the whole text, each of its lines, and all runs of words, wherever their lines
end, that begin and end with a pair of the template and are at most as long as it allows. A coefficient of ``least`` bounds the size
of the other set on both sides, so a unit is compared only with templates of a fitting size, and with none if it
shares no pair with them. Pairs are compared as 64-bit keys.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from gramledger.llm.common import as_bytes, joined, map_texts, mixed, word_keys, word_table

LEAST = 0.8
WORD = word_table([*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])

# Public license notices and short license texts.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
    "except in compliance with the License. You may obtain a copy of the License at "
    "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software "
    "distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY "
    "KIND, either express or implied. See the License for the specific language governing permissions and "
    "limitations under the License.",
    "BSD-2-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted "
    "provided that the following conditions are met: 1. Redistributions of source code must retain the above "
    "copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must "
    "reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation "
    "and/or other materials provided with the distribution.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-4.0-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-notice": "This program is free software: you can redistribute it and/or modify it under the terms of "
    "the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, "
    "or (at your option) any later version.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
    "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "MIT": "Released under the MIT License.",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
    "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
    "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies "
    "of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
    "conditions: The above copyright notice and this permission notice shall be included in all copies or "
    "substantial portions of the Software.",
}

_AS_IS = (
    "PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT "
    "NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN "
    "NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, "
    "EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; "
    "LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER "
    "IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF "
    "THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
#: Whole texts of those licenses whose template ends before the warranty part.
WHOLE = {
    "BSD-2-Clause-whole": TEMPLATES["BSD-2-Clause"] + " THIS SOFTWARE IS " + _AS_IS,
    "GPL-3.0-notice-whole": TEMPLATES["GPL-3.0-notice"] + " This program is distributed in the hope that it will be "
    "useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A "
    "PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a copy of the "
    "GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>.",
    "ISC-whole": TEMPLATES["ISC"] + " THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH "
    "REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE "
    "AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING "
    "FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, "
    "ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    "MIT-text-whole": TEMPLATES["MIT-text"] + " THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, "
    "EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR "
    "PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES "
    "OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION "
    "WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
}

_NEXT = np.uint64(0x9E3779B97F4A7C15)


def _pairs(texts: list[bytes], by_line: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of all word pairs, the unit that each is in, and the text of each unit; units are texts or lines."""
    buffer, at = joined(texts)
    raw = np.frombuffer(buffer.tobytes().lower(), np.uint8)
    starts, _, keys = word_keys(raw, WORD)
    cuts = np.flatnonzero(raw == 10) + 1 if by_line else at[1:]  # every text ends with a line end
    unit = np.searchsorted(cuts, starts, side="right")
    same = unit[1:] == unit[:-1]
    pair = mixed(keys[:-1] * _NEXT + keys[1:])[same]
    firsts = np.concatenate(([0], cuts[:-1])) if by_line else at
    return pair, unit[1:][same], np.searchsorted(at, firsts, side="right") - 1


class Templates:
    """Word pairs of all templates: which pair is in which."""

    def __init__(self, texts: dict[str, str]):
        self.names = sorted(texts)
        pair, owner, _ = _pairs([texts[n].encode() for n in self.names], False)
        both = np.unique(np.stack([pair, owner.astype(np.uint64)]), axis=1)
        self.pair, self.owner = both[0], both[1].astype(np.int64)
        self.size = np.bincount(self.owner, minlength=len(self.names))
        self.known = np.unique(self.pair)
        self.length = np.bincount(owner, minlength=len(self.names))

    def match(self, texts: list[bytes], by_line: bool, least: float) -> tuple[np.ndarray, ...]:
        """Text, template and coefficient of the matches of at least ``least``; and the unit each is in."""
        pair, unit, text_of = _pairs(texts, by_line)
        none = np.zeros(0, np.int64)
        if not len(pair):
            return none, none, np.zeros(0), none
        at = np.minimum(np.searchsorted(self.known, pair), len(self.known) - 1)
        some = np.unique(unit[self.known[at] == pair])  # units that share a pair with a template
        inside = np.isin(unit, some)
        # distinct pairs of those units
        unit, pair = unit[inside], pair[inside]
        order = np.lexsort((pair, unit))
        unit, pair = unit[order], pair[order]
        new = np.ones(len(unit), bool)
        new[1:] = (unit[1:] != unit[:-1]) | (pair[1:] != pair[:-1])
        unit, pair = unit[new], pair[new]
        size = np.bincount(np.searchsorted(some, unit), minlength=len(some))
        first = np.searchsorted(self.pair, pair, "left")
        count = np.searchsorted(self.pair, pair, "right") - first
        where = np.repeat(first - np.concatenate(([0], np.cumsum(count)[:-1])), count) + np.arange(count.sum())
        row = np.repeat(np.searchsorted(some, unit), count)
        owner = self.owner[where]
        # a coefficient of least needs |a| * least / (2 - least) <= |b| <= |a| * (2 - least) / least
        fits = (size[row] * least <= self.size[owner] * (2 - least)) & (
            self.size[owner] * least <= size[row] * (2 - least)
        )
        both, shared = np.unique(row[fits] * len(self.names) + owner[fits], return_counts=True)
        row, owner = both // len(self.names), both % len(self.names)
        score = 2.0 * shared / (size[row] + self.size[owner])
        good = score >= least
        return text_of[some[row[good]]], owner[good], score[good], some[row[good]]


    def runs(self, texts: list[bytes], least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, template and coefficient of the best runs of words of at least ``least``, a row per begin of a run."""
        pair, text_of, _ = _pairs(texts, False)
        found: list[tuple[int, int, float]] = []
        if not len(pair) or not len(self.known):
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        at = np.minimum(np.searchsorted(self.known, pair), len(self.known) - 1)
        some = np.flatnonzero(self.known[at] == pair)
        for k, size in enumerate(self.size.tolist()):
            hits = some[np.isin(pair[some], self.pair[self.owner == k])]
            # a coefficient of least needs so many shared pairs, and they must lie within the longest run
            need = max(1, int(np.ceil(size * least / (2 - least) - 1e-9)))
            longest = int(np.ceil(self.length[k] * (2 - least) / least))
            if not size or len(hits) < need:
                continue
            first, last = hits[: len(hits) - need + 1], hits[need - 1 :]
            near = first[(last - first < longest) & (text_of[first] == text_of[last])]
            ends = np.minimum(near + longest, np.searchsorted(text_of, text_of[near], side="right"))
            for start, end in zip(near.tolist(), ends.tolist()):
                new = np.zeros(end - start, bool)
                new[np.unique(pair[start:end], return_index=True)[1]] = True
                shared = np.zeros(end - start, bool)
                shared[hits[np.searchsorted(hits, start) : np.searchsorted(hits, end)] - start] = True
                score = float((2.0 * np.cumsum(new & shared) / (np.cumsum(new) + size)).max())
                if score >= least:
                    found.append((int(text_of[start]), k, score))
        return tuple(np.array([f[i] for f in found], kind) for i, kind in enumerate((np.int64, np.int64, np.float64)))


def scan(
    docs: DataFrame,
    text: str = "text",
    carry: tuple[str, ...] = ("doc_id",),
    templates: dict[str, str] | None = None,
    least: float = LEAST,
) -> DataFrame:
    """Carried columns with the number of lines that match a template, the best license, and its coefficient.

    The best is that of all units: whole text, lines, and runs of words, which are also compared with ``WHOLE`` unless
    templates are given. Lines are counted that match by themselves.
    Of equal coefficients the first name in alphabetical order wins. Without a match the license is null and the
    coefficient 0; so it is for null and empty texts. Repeated rows get equal results.
    """
    wanted = TEMPLATES if templates is None else templates
    longer = {**TEMPLATES, **WHOLE} if templates is None else templates

    def kernel():
        known, full = Templates(wanted), Templates(longer)
        place = np.array([full.names.index(n) for n in known.names], np.int64)

        def work(texts: pa.Array) -> list[pa.Array]:
            raw = as_bytes(texts)
            lines = known.match(raw, True, least)
            whole = known.match(raw, False, least)
            units = [(m[0], place[m[1]], m[2]) for m in (lines, whole)] + [full.runs(raw, least)]
            owner, name, score = (np.concatenate(x) for x in zip(*units))
            best: dict[int, tuple[float, int]] = {}
            for t, k, s in zip(owner.tolist(), name.tolist(), score.tolist()):
                best[t] = min(best.get(t, (1.0, 0)), (-s, k))
            found = [best.get(i) for i in range(len(raw))]
            licensed = np.unique(np.stack([lines[0], lines[3]]), axis=1)[0]
            return [
                pa.array(np.bincount(licensed, minlength=len(raw)).astype(np.int64)),
                pa.array([None if f is None else full.names[f[1]] for f in found], pa.string()),
                pa.array([0.0 if f is None else -f[0] for f in found], pa.float64()),
            ]

        return work

    return map_texts(docs, kernel, [("n_lines", "long"), ("license", "string"), ("dice", "double")], text, carry)


def scan_sql(least: float = LEAST) -> str:
    """The scan of the table ``documents`` in DuckDB SQL."""
    rows = ", ".join("('{}', '{}')".format(n, t.replace("'", "''")) for n, t in sorted(TEMPLATES.items()))
    lower = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    words = (
        "list_filter(regexp_split_to_array(" + lower + ", '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '')"
    )
    pairs = "list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))"
    return f"""
    WITH t AS (SELECT name, {pairs} AS b FROM (SELECT name, {words.format('txt')} AS w FROM (VALUES {rows}) v(name, txt))),
    units AS (
      SELECT doc_id, true AS is_line, unnest(string_split(text, chr(10))) AS txt, generate_subscripts(string_split(text, chr(10)), 1) AS line FROM documents
      UNION ALL SELECT doc_id, false, text, 0 FROM documents),
    u AS (SELECT doc_id, is_line, line, {pairs} AS b FROM (SELECT *, {words.format('txt')} AS w FROM units)),
    m AS (
      SELECT doc_id, is_line, line, name, 2.0::DOUBLE * len(list_intersect(u.b, t.b)) / (len(u.b) + len(t.b)) AS s
      FROM u JOIN t ON len(u.b) * {least}::DOUBLE <= len(t.b) * (2 - {least}::DOUBLE) AND len(t.b) * {least}::DOUBLE <= len(u.b) * (2 - {least}::DOUBLE)),
    g AS (SELECT * FROM m WHERE s >= {least}::DOUBLE),
    best AS (SELECT doc_id, count(DISTINCT line) FILTER (is_line) AS n, arg_min(name, (-s, name)) AS name, max(s) AS s FROM g GROUP BY doc_id)
    SELECT d.doc_id, coalesce(best.n, 0) AS n_lines, best.name AS license, coalesce(best.s, 0.0::DOUBLE) AS dice
    FROM documents d LEFT JOIN best USING (doc_id)"""
