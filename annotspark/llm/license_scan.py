"""License scans: a set-similarity join of text blocks with license templates.

A template is its set of words.  Words of all templates are ordered by how many documents hold them, rarest first,
counted over the whole corpus.  A block that holds at least ``need`` of a template's m words must hold one of its
``m - need + 1`` rarest (prefix filter); of the next rarest it may lack as many again, so of the first
``m - need + LONGER`` it must hold ``LONGER`` (positional filter, on the places of the words found in the template's
order: a place that is missing is one that can't be made up for); and it must hold ``need`` template words at all
(length filter).  Blocks are all windows of twice a template's length (or the whole text, if shorter) that hold one of
its rarest words; they are slid word by word with running counts, so where a passage stands in its text decides
nothing.  What is broadcast are the templates and their word counts, whose size is that of the template list and never
grows with the data.

Base phrases are found wherever their words stand in a row.

Defined results: null text is the empty text; repeated rows are scanned each on their own; null ids and extra columns
pass; a tie between templates leaves both labels; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annotspark.llm.common import text_or_empty

THRESHOLD = 0.8
#: Fixed phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Places of a template's order behind its prefix that the positional filter looks at.
LONGER = 4
#: Texts of public licenses, their notices, and the lines by which they are named.
TEMPLATES = {
    "mit": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to
permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies
or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER
IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "mit-opening": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
    "mit-line": "released under the mit license",
    "isc": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice
and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES
OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE,
DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "isc-opening": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
    "bsd-2-clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions
of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice,
this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND
CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.
IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO,
PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY,
OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "bsd-opening": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "apache-2.0-notice": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the
License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS"
BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.""",
    "apache-2.0": "licensed under the apache license version 2.0 you may not use this file except in compliance with the license",
    "apache-line": "licensed under the apache license",
    "gpl-notice": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation,
either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied
warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU General Public License
along with this program. If not, see <https://www.gnu.org/licenses/>.""",
    "gpl": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license",
    "mpl-2.0": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at
https://mozilla.org/MPL/2.0/.""",
    "mpl-line": "this source code form is subject to the terms of the mozilla public license",
    "cc-line": "this work is licensed under a creative commons attribution license",
    "unlicense": """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either
in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of
this software dedicate any and all copyright interest in the software to the public domain.""",
    "unlicense-line": "this is free and unencumbered software released into the public domain",
}
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text: str) -> list[bytes]:
    """Words of the text, A-Z lower-cased; on UTF-8 bytes, where all bytes beyond ASCII are word characters."""
    return _WORD.findall(text.encode("utf-8", "replace").lower())


def word_counts(docs: DataFrame, vocabulary: set[bytes], text_col: str = "text") -> dict[bytes, int]:
    """How many documents hold each template word; as many numbers as the templates have words."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        count = dict.fromkeys(vocabulary, 0)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                for w in vocabulary.intersection(words(text)):
                    count[w] += 1
        found = [(w.decode(), n) for w, n in count.items() if n]
        yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in found], pa.string()), pa.array([n for _, n in found], pa.int64())], names=["word", "n"])

    rows = docs.select(text_or_empty(text_col).alias("_text")).mapInArrow(run, "word string, n long")
    return {r["word"].encode(): r["n"] for r in rows.groupBy("word").agg(F.sum("n").alias("n")).collect()}


def most_shared(ws: list[bytes], at: list[int], near: list[tuple[int, int]], rank: dict[bytes, int], width: int, need: int, least: int) -> int:
    """The most different template words in any ``width`` words around one of the places ``at``, as far as it is ``need`` or more.

    ``near`` holds (place, rank) of the words that the positional filter looks at; an area with fewer than ``least`` of
    those ranks is left before its other words are.
    """
    best, k, n, low_near, near_n = 0, 0, len(at), 0, len(near)
    while k < n:
        low = max(at[k] - width + 1, 0)
        high = at[k] + width
        k += 1
        while k < n and at[k] - width < high:  # areas that overlap are one
            high = at[k] + width
            k += 1
        while low_near < near_n and near[low_near][0] < low:
            low_near += 1
        ranks, j = set(), low_near
        while j < near_n and near[j][0] < high and len(ranks) < least:
            ranks.add(near[j][1])
            j += 1
        if len(ranks) < least:
            continue
        found = [(i, w) for i, w in enumerate(ws[low:high], low) if w in rank]
        if len({w for _, w in found}) < need:
            continue
        held: dict[bytes, int] = {}
        tail = 0
        for i, w in found:
            held[w] = held.get(w, 0) + 1
            while found[tail][0] <= i - width:
                old = found[tail][1]
                tail += 1
                if held[old] == 1:
                    del held[old]
                else:
                    held[old] -= 1
            best = max(best, len(held))
    return best


class Scanner:
    def __init__(self, templates: dict[str, str], phrases: dict[str, str], counts: dict[bytes, int], threshold: float):
        self.phrases = [(words(p), label) for p, label in phrases.items()]
        self.first = {p[0] for p, _ in self.phrases}
        self.rules = []
        self.owners: dict[bytes, list[tuple[int, int]]] = {}
        for label, text in templates.items():
            ranked = sorted(set(words(text)), key=lambda w: (counts.get(w, 0), w))
            m = len(ranked)
            need = -(-int(round(threshold * 1000)) * m // 1000)
            prefix = m - need + 1
            cut = min(m, prefix + LONGER - 1)
            for k, w in enumerate(ranked[:cut]):
                self.owners.setdefault(w, []).append((len(self.rules), k))
            self.rules.append((label, m, need, prefix, cut - prefix + 1, {w: k for k, w in enumerate(ranked)}))
        self.wanted = self.first | set(self.owners)

    def scan(self, text: str):
        """(words, places, first, last, base labels, labels, score)"""
        ws = words(text)
        wanted = self.wanted
        hits = [i for i, w in enumerate(ws) if w in wanted]
        places, base, extra, score, near = [], set(), set(), 0.0, {}
        for i in hits:
            if ws[i] in self.first:
                for phrase, label in self.phrases:
                    if ws[i : i + len(phrase)] == phrase:
                        places.append(i)
                        base.add(label)
            for r, k in self.owners.get(ws[i], ()):
                near.setdefault(r, []).append((i, k))
        for r, found in near.items():
            label, m, need, prefix, least, rank = self.rules[r]
            at = [i for i, k in found if k < prefix]
            if len(found) < least or not at:
                continue
            best = most_shared(ws, at, found, rank, 2 * m, need, least)
            if best >= need:
                extra.add(label)
                score = max(score, best / m)
        return len(ws), len(places), min(places, default=None), max(places, default=None), base, base | extra, score


def scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, phrases: dict[str, str] = PHRASES, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    vocabulary = {w for t in templates.values() for w in words(t)}
    counts = word_counts(docs, vocabulary, text_col)
    fields = f"{id_col} {docs.schema[id_col].dataType.simpleString()}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        scanner = Scanner(templates, phrases, counts, threshold)
        for batch in batches:
            found = [scanner.scan(t) for t in batch.column(1).to_pylist()]
            n, places, first, last, base, labels, score = zip(*found) if found else [()] * 7
            join = lambda x: pa.array([",".join(sorted(s)) for s in x], pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(x, pa.int64()) for x in (n, places, first, last)), join(base), join(labels), pa.array(score, pa.float64())],
                names=[x.split()[0] for x in fields.split(", ")],
            )

    return docs.select(F.col(id_col), text_or_empty(text_col).alias("_text")).mapInArrow(run, fields)
