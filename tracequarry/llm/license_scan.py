"""License scans: template markup compiled into token automata.

A template is wording with marked regions:

* ``<<optional>> ... <<end>>`` may be left out; regions nest,
* ``<<var:m-n>>`` stands for any m to n words.

Everything else is mandatory and must match word for word.  Each template becomes
an automaton over words, whose states are sets of positions; it is run from every
place where its first words can stand, and accepts where its end is reached.

Words are runs of ASCII letters, digits and any other character that isn't ASCII,
after A-Z are lower-cased: markup, punctuation and line breaks don't count.  Base
phrases are found wherever their words stand next to each other; templates add
labels of their own.  Score: 1 if a template accepts, 0.5 if only base phrases
were found, else 0.

Null and empty texts have no words and no labels; each row is scanned whole and
on its own; repeated rows and null ids give rows; an empty table gives none; other
columns are not read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

from tracequarry.llm.bpe import slices

# Base phrases and their labels.
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)
# License notices and whole license texts, by the label that a match adds.
_BSD = (
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met "
    "<<optional>>1<<end>> redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer "
    "<<optional>>2<<end>> redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer "
    "in the documentation and or other materials provided with the distribution "
)
_BSD_NAMES = (
    "<<optional>>3<<end>> neither the name of <<var:1-12>> nor the names of its contributors may be used to endorse or promote products derived from "
    "this software without specific prior written permission "
)
_BSD_DISCLAIMER = (
    "this software is provided by <<var:1-8>> as is and any express or implied warranties including but not limited to the implied warranties of "
    "merchantability and fitness for a particular purpose are disclaimed in no event shall <<var:1-8>> be liable for any direct indirect incidental "
    "special exemplary or consequential damages including but not limited to procurement of substitute goods or services loss of use data or profits or "
    "business interruption however caused and on any theory of liability whether in contract strict liability or tort including negligence or otherwise "
    "arising in any way out of the use of this software even if advised of the possibility of such damage"
)
_FREE = "free software you can redistribute it and or modify it under the terms of the gnu"
_FSF = "as published by the free software foundation either version"
TEMPLATES = (
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("apache-2.0-notice", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at <<optional>>http<<end>> <<optional>>https<<end>> www apache org licenses license 2 0 unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied see the license for the specific language governing permissions and limitations under the license"),
    ("gpl-3.0", "<<optional>>this work is<<end>> licensed under the gnu general public license version 3 <<optional>>0<<end>>"),
    ("gpl-2.0-or-later", f"{_FREE} general public license {_FSF} 2 of the license or at your option any later version"),
    ("gpl-3.0-or-later", f"{_FREE} general public license {_FSF} 3 of the license or at your option any later version"),
    ("lgpl-2.1-or-later", f"{_FREE} lesser general public license {_FSF} 2 1 of the license or at your option any later version"),
    ("lgpl-3.0-or-later", f"{_FREE} lesser general public license {_FSF} 3 of the license or at your option any later version"),
    ("agpl-3.0-or-later", f"{_FREE} affero general public license {_FSF} 3 of the license or at your option any later version"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this file you can obtain one at <<optional>>http<<end>> <<optional>>https<<end>> mozilla org mpl 2 0"),
    ("cc-by-nc-4.0", "licensed under <<optional>>a creative commons <<var:0-4>><<end>> cc by nc 4 0"),
    ("cc-by-4.0", "licensed under <<optional>>a creative commons <<var:0-4>><<end>> cc by 4 0"),
    ("mit-notice", "released under the <<var:0-2>> mit license"),
    ("mit-text", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files <<optional>>the software<<end>> to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions the above copyright notice and this permission notice <<optional>>including the next paragraph<<end>> shall be included in all copies or substantial portions of the software the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement in no event shall <<var:1-8>> be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software"),
    ("isc-text", "permission to use copy modify and <<optional>>or<<end>> distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies the software is provided as is and <<var:1-8>> disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness in no event shall <<var:1-8>> be liable for any special direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an action of contract negligence or other tortious action arising out of or in connection with the use or performance of this software"),
    ("zlib-text", "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions <<optional>>1<<end>> the origin of this software must not be misrepresented you must not claim that you wrote the original software if you use this software in a product an acknowledgment in the product documentation would be appreciated but is not required <<optional>>2<<end>> altered source versions must be plainly marked as such and must not be misrepresented as being the original software <<optional>>3<<end>> this notice may not be removed or altered from any source distribution"),
    ("bsd-2-clause-text", _BSD + _BSD_DISCLAIMER),
    ("bsd-3-clause-text", _BSD + _BSD_NAMES + _BSD_DISCLAIMER),
)

_MARK = re.compile(r"<<(optional|end|var:(\d+)-(\d+))>>")
_ANY = object()
#: Lower-cases A-Z and blanks every other ASCII character that is no letter or digit.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").translate(_FOLD).split()


@dataclass(frozen=True)
class Automaton:
    """Steps from each state by a word (or by any word), after silent steps were folded in."""

    label: str
    start: frozenset[int]
    end: int
    steps: tuple[tuple[object, frozenset[int]], ...]
    firsts: frozenset[bytes] | None  # None: any word may be the first

    def ends_from(self, words: list[bytes], at: int) -> int:
        """The place behind the shortest match that starts at ``at``; -1 without one."""
        now = self.start
        while True:
            if self.end in now:
                return at
            if at >= len(words) or not now:
                return -1
            word, new = words[at], set()
            for s in now:
                need, to = self.steps[s]
                if need is _ANY or need == word:
                    new |= to
            now, at = frozenset(new), at + 1

    def places(self, words: list[bytes], index: dict[bytes, list[int]]) -> list[int]:
        """Places where a match starts."""
        starts = range(len(words)) if self.firsts is None else sorted(i for f in self.firsts for i in index.get(f, ()))
        return [i for i in starts if self.ends_from(words, i) >= 0]


def compile_template(label: str, template: str) -> Automaton:
    """The automaton of a template; ``ValueError`` for markup that doesn't nest."""
    steps: list[object] = []  # what state i reads before i + 1
    skips: list[tuple[int, int]] = []  # silent steps
    open_at: list[int] = []
    last = 0
    for m in [*_MARK.finditer(template), None]:
        steps += words_of(template[last : m.start() if m else len(template)])
        if m is None:
            break
        last = m.end()
        if m[1] == "optional":
            open_at.append(len(steps))
        elif m[1] == "end":
            if not open_at:
                raise ValueError(f"{label}: <<end>> without <<optional>>")
            skips.append((open_at.pop(), len(steps)))
        else:
            least, most = int(m[2]), int(m[3])
            if least > most:
                raise ValueError(f"{label}: <<{m[1]}>>")
            a = len(steps) + least
            steps += [_ANY] * most
            skips += [(i, len(steps)) for i in range(a, len(steps))]
    if open_at:
        raise ValueError(f"{label}: <<optional>> without <<end>>")

    def silent(state: int) -> frozenset[int]:
        found, todo = {state}, [state]
        while todo:
            s = todo.pop()
            for a, b in skips:
                if a == s and b not in found:
                    found.add(b)
                    todo.append(b)
        return frozenset(found)

    start, end = silent(0), len(steps)
    if end in start:
        raise ValueError(f"{label}: no mandatory word")
    table = tuple((need, silent(i + 1)) for i, need in enumerate(steps)) + ((b"", frozenset()),)
    firsts = None if any(steps[s] is _ANY for s in start) else frozenset(steps[s] for s in start)
    return Automaton(label, start, end, table, firsts)


class Scanner:
    def __init__(self, templates=TEMPLATES, phrases=PHRASES):
        self.automata = [compile_template(*t) for t in templates]
        self.phrases = [compile_template(label, phrase) for phrase, label in phrases]
        #: A text without any of these words has neither phrase nor match.
        self.wanted = None if any(a.firsts is None for a in self.automata) else frozenset().union(*(a.firsts for a in [*self.automata, *self.phrases]))

    def scan(self, text: str | None) -> tuple[int, int, int | None, int | None, str, str, float]:
        """n_words, n_base, first_word, last_word, base_labels, labels, score."""
        words = words_of(text)
        if self.wanted is not None and self.wanted.isdisjoint(words):
            return len(words), 0, None, None, "", "", 0.0
        index: dict[bytes, list[int]] = {}
        for i, w in enumerate(words):
            if self.wanted is None or w in self.wanted:
                index.setdefault(w, []).append(i)
        base, found = [], set()
        for a in self.phrases:
            if at := a.places(words, index):
                base += at
                found.add(a.label)
        own = {a.label for a in self.automata if a.places(words, index)}
        return (
            len(words), len(base), min(base, default=None), max(base, default=None),
            ",".join(sorted(found)), ",".join(sorted(found | own)), 1.0 if own else 0.5 if base else 0.0,
        )


def scan(docs: DataFrame, templates=TEMPLATES, phrases=PHRASES) -> DataFrame:
    """One row per document with its base phrases' places, its labels and a score."""
    sent = docs.sparkSession.sparkContext.broadcast((tuple(templates), tuple(phrases)))  # the templates' size

    def work(batches):
        scanner = Scanner(*sent.value)
        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
        names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
        for batch in batches:
            for part in slices(batch, "text"):
                rows = [scanner.scan(t) for t in part.column("text").to_pylist()]
                columns = [pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *columns], ["doc_id", *names])

    return docs.select("doc_id", "text").mapInArrow(
        work, "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
    )
