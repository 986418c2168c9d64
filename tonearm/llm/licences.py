"""Licence scans: normalised text against licence templates by Dice coefficient.

A text, each of its paragraphs (runs of lines that are not blank) and each of its lines
are normalised to lower-case ASCII words; a passage matches a template when the Dice
coefficient of their sets of word bigrams reaches the threshold.  With a and b bigrams
it can only do so if a lies between b t / (2 - t) and b (2 - t) / t, so templates of
other sizes are not compared.

Notices that are not set off by line breaks (several paragraphs, hard-wrapped lines,
inside a sentence) are found by windows over the words of the whole text.  A window
must hold at least b t / (2 - t) of the template's bigrams, so only stretches dense in
them are looked at, and it holds at most (2 - t) / t times the template's bigrams in
words, so the work is linear in the text.

Licences of one family differ in a word or two, which Dice alone cannot tell apart, so a
passage that reaches the threshold must also have the version and variant words of the
licence and none of its neighbours' (``VARIANTS``).  One place in a text counts once for a
licence: a paragraph, text or window that overlaps a passage already matched by it is no
further passage, but may better its coefficient.
"""

from __future__ import annotations

import bisect
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tonearm.llm.common import ship

THRESHOLD = 0.8
_WORD = re.compile(rb"[a-z0-9]+")

# Licence notices and texts as their licensors publish them.
_GNU_LINE = "This work is licensed under the GNU {}General Public License, version {}."
_GNU_NOTICE = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU
    {0}General Public License as published by the Free Software Foundation, either version {1} of the License, or (at
    your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY
    WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU
    {0}General Public License for more details. You should have received a copy of the GNU {0}General Public License
    along with this program. If not, see <https://www.gnu.org/licenses/>."""
_BSD_CONDITIONS = """Redistribution and use in source and binary forms, with or without modification, are permitted
    provided that the following conditions are met: 1. Redistributions of source code must retain the above
    copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must
    reproduce the above copyright notice, this list of conditions and the following disclaimer in the
    documentation and/or other materials provided with the distribution. """
_BSD_NAMES = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse
    or promote products derived from this software without specific prior written permission. """
_BSD_DISCLAIMER = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR
    IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A
    PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT,
    INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF
    SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY
    THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN
    ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_ISC_GRANT = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
    hereby granted"""
_ISC_DISCLAIMER = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS
    SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE
    FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE,
    DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN
    CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_CC_LINE = "This work is licensed under a Creative Commons {} 4.0 International License."
TEMPLATES: list[tuple[str, str]] = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except
        in compliance with the License. You may obtain a copy of the License at
        http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software
        distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND,
        either express or implied. See the License for the specific language governing permissions and limitations
        under the License."""),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
        associated documentation files (the "Software"), to deal in the Software without restriction, including
        without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies
        of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following
        conditions: The above copyright notice and this permission notice shall be included in all copies or
        substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS
        OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE
        AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR
        OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION
        WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("ISC", _ISC_GRANT + """, provided that the above copyright notice and this permission notice appear in all
        copies. """ + _ISC_DISCLAIMER),
    ("0BSD", _ISC_GRANT + ". " + _ISC_DISCLAIMER),
    ("BSD-2-Clause", _BSD_CONDITIONS + _BSD_DISCLAIMER),
    ("BSD-3-Clause", _BSD_CONDITIONS + _BSD_NAMES + _BSD_DISCLAIMER),
    ("Zlib", """This software is provided 'as-is', without any express or implied warranty. In no event will the
        authors be held liable for any damages arising from the use of this software. Permission is granted to anyone
        to use this software for any purpose, including commercial applications, and to alter it and redistribute it
        freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you
        must not claim that you wrote the original software. If you use this software in a product, an acknowledgment
        in the product documentation would be appreciated but is not required. 2. Altered source versions must be
        plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not
        be removed or altered from any source distribution."""),
    ("Unlicense", """This is free and unencumbered software released into the public domain. Anyone is free to copy,
        modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled
        binary, for any purpose, commercial or non-commercial, and by any means."""),
    ("GPL-2.0", _GNU_LINE.format("", "2")),
    ("GPL-2.0", _GNU_NOTICE.format("", "2")),
    ("GPL-3.0", _GNU_LINE.format("", "3")),
    ("GPL-3.0", _GNU_NOTICE.format("", "3")),
    ("LGPL-2.1", _GNU_LINE.format("Lesser ", "2.1")),
    ("LGPL-2.1", _GNU_NOTICE.format("Lesser ", "2.1")),
    ("LGPL-3.0", _GNU_LINE.format("Lesser ", "3")),
    ("LGPL-3.0", _GNU_NOTICE.format("Lesser ", "3")),
    ("AGPL-3.0", _GNU_LINE.format("Affero ", "3")),
    ("AGPL-3.0", _GNU_NOTICE.format("Affero ", "3")),
    ("MPL-2.0", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of
        the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""),
    ("EPL-2.0", """This program and the accompanying materials are made available under the terms of the Eclipse
        Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"""),
    ("CC0-1.0", """To the extent possible under law, the author has waived all copyright and related or neighboring
        rights to this work."""),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", _CC_LINE.format("Attribution")),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", _CC_LINE.format("Attribution-ShareAlike")),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-ND-4.0", _CC_LINE.format("Attribution-NoDerivatives")),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", _CC_LINE.format("Attribution-NonCommercial")),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-NC-SA-4.0", _CC_LINE.format("Attribution-NonCommercial-ShareAlike")),
    ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0."),
    ("CC-BY-NC-ND-4.0", _CC_LINE.format("Attribution-NonCommercial-NoDerivatives")),
]

_NC, _SA = ["nc", "noncommercial", "commercial"], ["sa", "sharealike", "alike"]
_ND = ["nd", "noderivatives", "noderivs", "derivatives"]
_V2, _V3 = ["version 2", "v 2", "v2"], ["version 3", "v 3", "v3"]
#: Licence: lists of words or pairs of words, of each of which a passage must hold one, and those it must not hold.
VARIANTS: dict[str, tuple[list[list[str]], list[str]]] = {
    "Apache-2.0": ([["2 0"]], []),
    "MPL-2.0": ([["2 0"]], []),
    "EPL-2.0": ([["2 0"]], []),
    "ISC": ([["appear"]], []),
    "0BSD": ([], ["appear"]),
    "BSD-2-Clause": ([], ["endorse"]),
    "BSD-3-Clause": ([["endorse"]], []),
    "GPL-2.0": ([_V2], ["lesser", "affero"]),
    "GPL-3.0": ([_V3], ["lesser", "affero"]),
    "LGPL-2.1": ([_V2, ["2 1"], ["lesser"]], []),
    "LGPL-3.0": ([_V3, ["lesser"]], []),
    "AGPL-3.0": ([_V3, ["affero"]], []),
    "CC-BY-4.0": ([["4 0"]], [*_NC, *_SA, *_ND]),
    "CC-BY-SA-4.0": ([["4 0"], _SA], [*_NC, *_ND]),
    "CC-BY-ND-4.0": ([["4 0"], _ND], [*_NC, *_SA]),
    "CC-BY-NC-4.0": ([["4 0"], _NC], [*_SA, *_ND]),
    "CC-BY-NC-SA-4.0": ([["4 0"], _NC, _SA], _ND),
    "CC-BY-NC-ND-4.0": ([["4 0"], _NC, _ND], _SA),
}


def words(text: bytes) -> list[bytes]:
    return _WORD.findall(text.lower())


def bigrams(of: list[bytes]) -> set[tuple[bytes, bytes]]:
    return set(zip(of, of[1:]))


def is_variant(passage: list[bytes], rule: tuple[list[list[str]], list[str]]) -> bool:
    """Whether a passage holds what the rule asks for and nothing that it excludes."""
    held = {w.decode() for w in passage} | {f"{a.decode()} {b.decode()}" for a, b in bigrams(passage)}
    return all(held.intersection(one) for one in rule[0]) and not held.intersection(rule[1])


class Scanner:
    def __init__(self, templates: list[tuple[str, str]], threshold: float,
                 variants: dict[str, tuple[list[list[str]], list[str]]] | None = None) -> None:
        self.variants = VARIANTS if variants is None else variants
        sets = [(name, bigrams(words(text.encode()))) for name, text in templates]
        self.known = sorted((x for x in sets if x[1]), key=lambda x: len(x[1]))
        self.sizes = [len(s) for _, s in self.known]
        self.threshold = threshold
        self.least = threshold / (2 - threshold)
        long = {}  # the bigrams of the longest template of each bigram set, repeats counted
        for _, text in templates:
            of = words(text.encode())
            long[frozenset(bigrams(of))] = max(len(of) - 1, long.get(frozenset(bigrams(of)), 0))
        self.reach = [int(long[frozenset(s)] / self.least * (1 + 1e-12)) for _, s in self.known]
        self.need = [math.ceil(len(s) * self.least * (1 - 1e-12)) for _, s in self.known]
        self.holders: dict[tuple[bytes, bytes], list[int]] = {}
        for t, (_, known) in enumerate(self.known):
            for gram in known:
                self.holders.setdefault(gram, []).append(t)

    def match(self, passage: list[bytes]) -> Iterator[tuple[str, float]]:
        """Licences whose template has a Dice coefficient of at least the threshold with the passage."""
        if not self.sizes or len(passage) - 1 < self.sizes[0] * self.least * (1 - 1e-12):
            return
        grams = bigrams(passage)
        n = len(grams)
        low = bisect.bisect_left(self.sizes, n * self.least * (1 - 1e-12))
        high = bisect.bisect_right(self.sizes, n / self.least * (1 + 1e-12))
        for name, known in self.known[low:high]:
            dice = 2 * len(grams & known) / (n + len(known))
            if dice >= self.threshold:
                yield name, dice

    def windows(self, text: list[bytes]) -> Iterator[tuple[str, float, int, int]]:
        """Licence, Dice coefficient, first and last bigram of windows that reach the threshold.

        Windows of one template do not overlap.  They begin and end with one of its bigrams,
        as others at the ends only lower the coefficient.
        """
        grams = list(zip(text, text[1:]))
        at: dict[int, list[int]] = {}
        for p, gram in enumerate(grams):
            for t in self.holders.get(gram, ()):
                at.setdefault(t, []).append(p)
        for t, places in sorted(at.items()):
            if len(places) < self.need[t] or len({grams[p] for p in places}) < self.need[t]:
                continue
            name, known = self.known[t]
            held: dict[tuple[bytes, bytes], int] = {}  # the template's bigrams from places[k] up to the reach
            end, done = 0, -1
            for start in places:
                while end < len(places) and places[end] < start + self.reach[t]:
                    held[grams[places[end]]] = held.get(grams[places[end]], 0) + 1
                    end += 1
                enough = len(held) >= self.need[t]
                held[grams[start]] -= 1
                if not held[grams[start]]:
                    del held[grams[start]]
                if not enough or start <= done:
                    continue
                i, (dice, j) = start, self._furthest(grams, known, start, 1, done, self.reach[t])
                while dice >= self.threshold:  # move either end in turn until nothing is gained
                    back, first = self._furthest(grams, known, j, -1, done, self.reach[t])
                    ahead, last = self._furthest(grams, known, first, 1, done, self.reach[t])
                    if max(back, ahead) <= dice:
                        break
                    i, j, dice = (first, last, ahead) if ahead >= back else (first, j, back)
                if dice >= self.threshold:
                    yield name, dice, i, j
                    done = j

    @staticmethod
    def _furthest(grams: list, known: set, start: int, step: int, done: int, reach: int) -> tuple[float, int]:
        """The best coefficient of a window from ``start`` in the direction of ``step``, and its other end."""
        stop = min(start + reach, len(grams)) if step > 0 else max(start - reach, done)
        seen: set = set()
        shared, best = 0, (0.0, start)
        for p in range(start, stop, step):
            if grams[p] in seen:
                continue
            seen.add(grams[p])
            if grams[p] in known:
                shared += 1
                dice = 2 * shared / (len(seen) + len(known))
                if dice > best[0]:
                    best = (dice, p)
        return best

    def scan(self, text: bytes) -> dict[str, tuple[float, int]]:
        """Per licence the best coefficient and how many places of the text match."""
        found: dict[str, tuple[float, int]] = {}
        taken: dict[str, list[tuple[int, int]]] = {}

        def count(name: str, dice: float, passage: list[bytes], first: int) -> None:
            if name in self.variants and not is_variant(passage, self.variants[name]):
                return
            best, n = found.get(name, (0.0, 0))
            last, spans = first + len(passage) - 2, taken.setdefault(name, [])
            if any(first <= b and a <= last for a, b in spans):
                found[name] = (max(best, dice), n)
            else:
                found[name] = (max(best, dice), n + 1)
                spans.append((first, last))

        def look(passage: list[bytes], first: int) -> None:
            for name, dice in dict(sorted(self.match(passage), key=lambda x: x[1])).items():
                count(name, dice, passage, first)

        lines = [words(line) for line in text.split(b"\n")]
        paragraph: list[list[bytes]] = []
        several, whole = 0, sum(map(bool, lines))
        place = begin = 0
        for line, raw in zip([*lines, []], [*text.split(b"\n"), b""]):
            look(line, place)
            place += len(line)
            if raw.strip():
                paragraph.append(line)
                continue
            if sum(map(bool, paragraph)) > 1:  # a paragraph of one line is that line
                look([w for part in paragraph for w in part], begin)
            several += any(paragraph)
            paragraph, begin = [], place
        every = [w for line in lines for w in line]
        if several > 1 and whole > 1:  # a text of one paragraph is that paragraph
            look(every, 0)
        for name, dice, first, last in sorted(self.windows(every), key=lambda x: -x[1]):
            count(name, dice, every[first:last + 2], first)
        return found


def scan(docs: DataFrame, templates: list[tuple[str, str]] | None = None, threshold: float = THRESHOLD,
         variants: dict[str, tuple[list[list[str]], list[str]]] | None = None) -> DataFrame:
    """doc_id, licence, dice, n_passages for every licence matched in each row of ``docs``.

    Null and empty texts match nothing; a place that several templates of one licence, or
    a line and its paragraph, match counts once with the best coefficient; repeated rows are scanned alike; an empty table gives
    no rows; extra columns are not read.
    """
    ship(docs.sparkSession)
    scanner = Scanner(TEMPLATES if templates is None else templates, threshold, variants)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [(i, name, dice, n) for i, t in zip(batch.column("doc_id"), batch.column("text").cast(pa.binary()))
                   for name, (dice, n) in scanner.scan(t.as_py() or b"").items()]
            if out:
                ids, names, dices, counts = zip(*out)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i.as_py() for i in ids], pa.int64()), pa.array(names), pa.array(dices, pa.float64()),
                     pa.array(counts, pa.int64())], names=["doc_id", "licence", "dice", "n_passages"])

    schema = T.StructType().add("doc_id", "long").add("licence", "string").add("dice", "double").add("n_passages", "long")
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)


def scan_sql(templates: list[tuple[str, str]] | None = None, threshold: float = THRESHOLD) -> str:
    """The same scan as DuckDB SQL over ``documents``, without the size bounds (they lose nothing)."""
    quoted = ",\n  ".join("('" + n.replace("'", "''") + "', '" + " ".join(t.split()).replace("'", "''") + "')"
                          for n, t in (TEMPLATES if templates is None else templates))
    listed = lambda ws: "[" + ", ".join(f"'{w}'" for w in ws) + "]::VARCHAR[]"
    rules = ",\n  ".join(f"('{name}', [{', '.join(map(listed, must))}]::VARCHAR[][], {listed(ban)})"
                         for name, (must, ban) in VARIANTS.items())
    lower = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    tokens = "regexp_extract_all(" + lower + ", '[a-z0-9]+')"
    grams = ("list_distinct(list_transform(range(1, greatest(len({0}), 1)), "
             "lambda i: {0}[i::BIGINT] || ' ' || {0}[i::BIGINT + 1]))")
    return f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
lines AS (SELECT r, doc_id, unnest(string_split(text, chr(10))) AS line,
                 unnest(range(len(string_split(text, chr(10))))) AS nth FROM docs),
worded AS (SELECT r, doc_id, nth, {tokens.format('line')} AS ws,
                  regexp_matches(line, '[^\\x20\\x09-\\x0D]') AS filled,
                  sum((NOT regexp_matches(line, '[^\\x20\\x09-\\x0D]'))::INT) OVER (PARTITION BY r ORDER BY nth) AS para
           FROM lines),
paras AS (SELECT r, doc_id, para, flatten(list(ws ORDER BY nth)) AS ws, count(*) FILTER (len(ws) > 0) AS n_lines
          FROM worded WHERE filled GROUP BY r, doc_id, para),
texts AS (SELECT r, doc_id, flatten(list(ws ORDER BY para)) AS ws, count(*) FILTER (n_lines > 0) AS n_paras
          FROM paras GROUP BY r, doc_id),
passages AS (
  SELECT r, doc_id, para, 1 AS kind, nth AS p, ws FROM worded
  UNION ALL SELECT r, doc_id, para, 2, 0, ws FROM paras WHERE n_lines > 1
  UNION ALL SELECT r, doc_id, NULL, 3, 0, ws FROM texts WHERE n_paras > 1),
grams AS (SELECT r, doc_id, para, kind, p, ws, {grams.format('ws')} AS g FROM passages WHERE len(ws) > 1),
templates(licence, body) AS (VALUES {quoted}),
known AS (SELECT licence, {grams.format('w')} AS k FROM (SELECT licence, {tokens.format('body')} AS w FROM templates)),
rules(licence, must, ban) AS (VALUES {rules}),
scored AS (SELECT r, doc_id, para, kind, p, licence, list_concat(ws, g) AS held,
                  2.0::DOUBLE * len(list_intersect(g, k)) / (len(g) + len(k)) AS dice
           FROM grams JOIN known ON len(g) BETWEEN {threshold / (2 - threshold) * 0.999} * len(k)
                                              AND {(2 - threshold) / threshold * 1.001} * len(k)),
hits AS (SELECT s.* FROM scored s LEFT JOIN rules USING (licence)
         WHERE dice >= {threshold} AND (must IS NULL OR (
           len(list_filter(must, lambda m: NOT list_has_any(held, m))) = 0 AND NOT list_has_any(held, ban)))),
best AS (SELECT r, doc_id, para, kind, p, licence, max(dice) AS dice FROM hits GROUP BY ALL),
-- A paragraph is a further place if none of its lines matches, the text if nothing in it does.
places AS (SELECT *, min(kind) OVER (PARTITION BY r, licence, para) AS in_para,
                  min(kind) OVER (PARTITION BY r, licence) AS in_text FROM best)
SELECT doc_id, licence, max(dice) AS dice,
       count(*) FILTER (kind = 1 OR (kind = 2 AND in_para = 2) OR (kind = 3 AND in_text = 3))::BIGINT AS n_passages
FROM places GROUP BY r, doc_id, licence
"""
