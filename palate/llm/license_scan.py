"""License notices found in documents with token automata compiled from marked-up templates.

A template is license wording with two kinds of markup: ``<<optional>> ... <</optional>>``
may be left out, and ``<<any n>>`` stands for up to ``n`` words of any wording, such as
a holder's name. All other wording must be there word for word, after folding to plain
words. Each template becomes a small non-deterministic automaton over words. A text
holds the notice where some run of its words is accepted from the first mandatory
word to the last; what stands around it does not matter.

``TEXTS`` are whole licenses, or the whole notices that a license asks to be put on each file: with a condition or
a disclaimer left out or changed they do not match. ``REFERENCES`` are openings, and sentences that name a license.
The score tells them apart: 1 for a whole text, 0.75 for a reference, 0.5 for one of the plain phrases, which are
counted besides.

Only places where a template's opening words stand are tried, so a text costs one search
for each template. Null and empty texts have no words and no labels, texts of any length are scanned whole.
Several matches of a label count once, ties do not occur, repeated rows get equal results, an empty table an empty one.
Input columns named like a result column are replaced.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from palate.llm.common import plain_words, quoted, table, with_fields

PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
RESULTS = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
OPENING = 3

# Wording that the licenses themselves prescribe, with our own markup.
#: Whole licenses, and whole notices for files.
TEXTS = (
    ("mit-text",
     "Permission is hereby granted, free of charge, to any person obtaining a copy of this <<any 4>> and associated "
     "documentation files<<optional>> (the Software)<</optional>>, to deal in the <<any 4>> without restriction, including "
     "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
     "<<any 4>>, and to permit persons to whom the <<any 4>> is furnished to do so, subject to the following conditions: "
     "The above copyright notice and this permission notice <<optional>>(including the next paragraph) <</optional>>shall be "
     "included in all copies or substantial portions of the <<any 4>>. "
     "THE <<any 4>> IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
     "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL <<any 12>> BE "
     "LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, "
     "OUT OF OR IN CONNECTION WITH THE <<any 4>> OR THE USE OR OTHER DEALINGS IN THE <<any 4>>"),
    ("isc-text",
     "Permission to use, copy, modify, and<<optional>>/or<</optional>> distribute this software for any purpose with or without "
     "fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. "
     "THE SOFTWARE IS PROVIDED AS IS AND <<any 12>> DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED "
     "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL <<any 12>> BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR "
     "CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF "
     "CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE"),
    ("bsd-2-clause-text",
     "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
     "conditions are met: <<optional>>1. <</optional>>Redistributions of source code must retain the above copyright notice, this "
     "list of conditions and the following disclaimer. <<optional>>2. <</optional>>Redistributions in binary form must reproduce "
     "the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials "
     "provided with the distribution. "
     "THIS SOFTWARE IS PROVIDED BY <<any 12>> AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE "
     "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL <<any 12>> BE "
     "LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
     "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON "
     "ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY "
     "WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE"),
    ("bsd-3-clause-text",
     "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
     "conditions are met: <<optional>>1. <</optional>>Redistributions of source code must retain the above copyright notice, this "
     "list of conditions and the following disclaimer. <<optional>>2. <</optional>>Redistributions in binary form must reproduce "
     "the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials "
     "provided with the distribution. <<optional>>3. <</optional>>Neither the name of <<any 12>> nor the names of <<any 4>> "
     "contributors may be used to endorse or promote products derived from this software without specific prior written permission. "
     "THIS SOFTWARE IS PROVIDED BY <<any 12>> AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE "
     "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL <<any 12>> BE "
     "LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
     "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON "
     "ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY "
     "WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE"),
    ("zlib-text",
     "This software is provided as-is, without any express or implied warranty. In no event will the authors be held liable for any "
     "damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, "
     "including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: "
     "<<optional>>1. <</optional>>The origin of this software must not be misrepresented; you must not claim that you wrote the "
     "original software. If you use this software in a product, an acknowledgment in the product documentation would be "
     "appreciated but is not required. <<optional>>2. <</optional>>Altered source versions must be plainly marked as such, and must "
     "not be misrepresented as being the original software. <<optional>>3. <</optional>>This notice may not be removed or altered "
     "from any source distribution"),
    ("apache-2.0-header",
     "Licensed under the Apache License, Version 2.0 (the License); you may not use this <<any 3>> except in compliance with the "
     "License. You may obtain a copy of the License at <<any 10>> Unless required by applicable law or agreed to in writing, "
     "software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either "
     "express or implied. See the License for the specific language governing permissions and limitations under the License"),
    ("gpl-header",
     "is free software<<any 1>> you can redistribute it and/or modify it under the terms of the GNU "
     "General Public License as published by the Free Software Foundation<<any 1>> either version <<any 1>> of the License, or (at "
     "your option) any later version. <<any 3>> is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; "
     "without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License "
     "for more details. You should have received a copy of the GNU General Public License along with <<any 3>>"),
)
#: Openings of license texts, and sentences that name a license.
REFERENCES = (
    ("mit-grant",
     "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
     "<<any 4>> and associated documentation files<<optional>> (the Software)<</optional>>, to deal in the "
     "<<any 4>> without restriction, including without limitation the rights to use, copy, modify, merge, "
     "publish, distribute, sublicense, and/or sell copies of the <<any 4>>"),
    ("mit-reference",
     "Released under the <<optional>>terms of the <</optional>>MIT License"),
    ("mit-reference",
     "Licensed under the <<optional>>terms of the <</optional>>MIT License"),
    ("apache-2.0-reference",
     "Licensed under the Apache License, Version 2.0<<optional>> (the License); you may not use this "
     "<<any 3>> except in compliance with the License<</optional>>"),
    ("gpl-reference",
     "This program is free software<<any 2>> you can redistribute it and/or modify it under the terms of the "
     "GNU General Public License<<optional>> as published by the <<any 6>><</optional>>"),
    ("gpl-reference",
     "Licensed under the <<optional>>terms of the <</optional>>GNU General Public License"
     "<<optional>>, version <<any 1>><</optional>>"),
    ("cc-reference", "Licensed under <<optional>>the <</optional>>CC BY<<any 2>> 4.0"),
    ("bsd-redistribution",
     "Redistribution and use in source and binary forms, with or without modification, are permitted"
     "<<optional>> provided that the following conditions are met<</optional>>"),
    ("spdx-tag", "SPDX License Identifier <<any 1>>"),
    ("all-rights-reserved", "Copyright <<any 12>> all rights reserved"),
)

_MARK = re.compile(r"<<(optional|/optional|any \d+)>>")


@dataclass(frozen=True)
class Automaton:
    """States in template order. ``steps[i]`` is the word that leads on from state ``i``
    (``None``: any word); ``jumps[i]`` are the states reached from ``i`` without a word."""

    label: str
    steps: tuple[bytes | None, ...]
    jumps: tuple[tuple[int, ...], ...]

    @property
    def accepting(self) -> int:
        return len(self.steps)

    def close(self, states: set[int]) -> set[int]:
        todo = list(states)
        while todo:
            for state in self.jumps[todo.pop()]:
                if state not in states:
                    states.add(state)
                    todo.append(state)
        return states

    def openings(self) -> set[tuple[bytes, ...]]:
        """All ways the words before the first open one can read, ``OPENING`` words at most."""
        done, ways = set(), {((), state) for state in self.close({0})}
        while ways:
            longer = set()
            for words, state in ways:
                if len(words) == OPENING or state == self.accepting or self.steps[state] is None:
                    done.add(words)
                else:
                    longer |= {((*words, self.steps[state]), s) for s in self.close({state + 1})}
            ways = longer
        if () in done:
            raise ValueError(f"{self.label}: a template must open with a fixed word")
        return done

    def accepts(self, words: list[bytes], start: int) -> bool:
        """Whether some run of words from ``start`` on is a whole notice."""
        states = self.close({0})
        for place in range(start, len(words)):
            if self.accepting in states or not states:
                break
            states = self.close({s + 1 for s in states
                                 if self.steps[s] is None or self.steps[s] == words[place]})
        return self.accepting in states


def compile_template(label: str, template: str) -> Automaton:
    steps: list[bytes | None] = []
    jumps: dict[int, set[int]] = {}
    opened: list[int] = []
    for place, piece in enumerate(_MARK.split(template)):
        if place % 2 == 0:
            steps += plain_words(piece.encode())
        elif piece == "optional":
            opened.append(len(steps))
        elif piece == "/optional":
            jumps.setdefault(opened.pop(), set()).add(len(steps))
        else:
            first, count = len(steps), int(piece.split()[1])
            steps += [None] * count
            for state in range(first, first + count):
                jumps.setdefault(state, set()).add(first + count)
    if opened:
        raise ValueError(f"{label}: an optional part is not closed")
    return Automaton(label, tuple(steps), tuple(tuple(sorted(jumps.get(i, ()))) for i in range(len(steps) + 1)))


def places(plain: bytes, phrase: bytes) -> list[int]:
    """Word places where ``phrase`` starts; ``plain`` has one blank before, between and after words."""
    found, key, at, counted, words = [], b" " + phrase + b" ", 0, 0, 0
    while (at := plain.find(key, at)) >= 0:
        words += plain.count(b" ", counted, at)
        counted = at
        found.append(words)
        at += 1
    return found


class Scanner:
    """Templates and phrases ready to be looked for; ``texts`` are whole notices, ``references`` are not."""

    def __init__(self, texts=TEXTS, references=REFERENCES, phrases=PHRASES):
        self.automata = [compile_template(*t) for t in (*texts, *references)]
        self.whole = {label for label, _ in texts}
        self.openings = [[b" ".join(words) for words in a.openings()] for a in self.automata]
        self.phrases = [(b" ".join(plain_words(p.encode())), label) for p, label in phrases]

    def scan(self, text: bytes | None) -> dict:
        words = plain_words(text)
        plain = b" " + b" ".join(words) + b" "
        base, starts = set(), []
        for phrase, label in self.phrases:
            if found := places(plain, phrase):
                base.add(label)
                starts += found
        own = {a.label for a, opening in zip(self.automata, self.openings)
               if any(a.accepts(words, at) for o in opening for at in places(plain, o))}
        return {"n_words": len(words), "n_base": len(starts), "first_word": min(starts, default=None),
                "last_word": max(starts, default=None), "base_labels": ",".join(sorted(base)),
                "labels": ",".join(sorted(base | own)), "score": 1.0 if own & self.whole else 0.75 if own else 0.5 if base else 0.0}


#: What a Python worker has compiled, by the scan's name.
_BUILT: dict[str, Scanner] = {}


def scan_licenses(docs: DataFrame, text: str = "text", texts=TEXTS, references=REFERENCES, phrases=PHRASES) -> DataFrame:
    """``docs`` with ``RESULTS``."""
    name = uuid.uuid4().hex

    def scanned(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        if name not in _BUILT:
            _BUILT.clear()
            _BUILT[name] = Scanner(texts, references, phrases)
        kind = pa.struct([("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()),
                          ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()),
                          ("score", pa.float64())])
        for batch in batches:
            yield pa.array([_BUILT[name].scan(t.as_py()) for t in batch], kind)

    scan = F.arrow_udf(scanned, "struct<n_words: bigint, n_base: bigint, first_word: bigint, last_word: bigint, "
                                "base_labels: string, labels: string, score: double>").asNondeterministic()
    return with_fields(docs, scan(quoted(text).cast("binary")), RESULTS)


def op5_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Every document scanned for the phrases and all templates."""
    return scan_licenses(table(spark, folder, "documents").select("doc_id", "text")).select("doc_id", *RESULTS)


def _pattern(template: str) -> str:
    """A template as a regular expression over words that each end with a blank, for the SQL check."""
    out = ""
    for place, piece in enumerate(_MARK.split(template)):
        if place % 2 == 0:
            out += "".join(w.decode() + " " for w in plain_words(piece.encode()))
        else:
            out += {"optional": "(?:", "/optional": ")?"}.get(piece) or f"(?:[^ ]+ ){{0,{piece.split()[1]}}}"
    return " " + out


def _oracle() -> str:
    most = max(len(p.split()) for p, _ in PHRASES)
    ahead = ", ".join(f"lead(w0, {k}) OVER (PARTITION BY doc_id ORDER BY pos) AS w{k}" for k in range(1, most))
    stands = " UNION ALL ".join(
        f"SELECT doc_id, '{label}' AS label, pos FROM spots WHERE "
        + " AND ".join(f"w{k} = '{w}'" for k, w in enumerate(p.split())) for p, label in PHRASES)
    found = " UNION ".join(f"SELECT doc_id, '{label}' AS label, {score} AS score FROM plain WHERE regexp_matches(s, '{_pattern(t)}')"
                           for group, score in ((TEXTS, 1.0), (REFERENCES, 0.75)) for label, t in group)
    return rf"""
WITH words AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
plain AS (SELECT doc_id, ' ' || array_to_string(w, ' ') || ' ' AS s FROM words),
single AS (SELECT doc_id, unnest(w) AS w0, unnest(range(0, len(w))) AS pos FROM words),
spots AS (SELECT *, {ahead} FROM single),
stands AS ({stands}),
base AS (SELECT doc_id, count(*) AS n, min(pos) AS a, max(pos) AS z FROM stands GROUP BY doc_id),
own AS ({found}),
scores AS (SELECT doc_id, max(score) AS score FROM own GROUP BY doc_id),
listed AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
           FROM (SELECT doc_id, label FROM stands UNION SELECT doc_id, label FROM own) GROUP BY doc_id),
listed_base AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM stands GROUP BY doc_id)
SELECT words.doc_id, len(w)::BIGINT AS n_words, coalesce(base.n, 0)::BIGINT AS n_base, base.a::BIGINT AS first_word,
       base.z::BIGINT AS last_word, coalesce(listed_base.labels, '') AS base_labels, coalesce(listed.labels, '') AS labels,
       coalesce(scores.score, CASE WHEN base.n > 0 THEN 0.5 ELSE 0.0 END)::DOUBLE AS score
FROM words LEFT JOIN scores USING (doc_id) LEFT JOIN base USING (doc_id) LEFT JOIN listed USING (doc_id) LEFT JOIN listed_base USING (doc_id)"""


QUERIES = {"op5_license_scan": op5_license_scan}
ORACLES = {"op5_license_scan": _oracle()}
