"""License scans: template-markup matching.

A template is the wording of a licence or notice with marked regions:
``<<optional>> ... <<end>>`` may be left out, ``<<any:n>>`` stands for up to n
replaceable words.  Each template is compiled to an automaton over words; a
text has the template's label where some run of its words takes the automaton
from start to acceptance, so all mandatory wording must match exactly.

Only texts with a hint of a licence are walked word by word; hints and word
counts are found over the bytes of many texts at once.

Edge cases: null text is empty (no words, score 0); repeated rows each get
their row; an empty table gives no rows; other columns are ignored; whole texts
of any length are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from modelspend.llm.shared import joined_bytes, read_table, text_blocks
from modelspend.llm.words import ALNUM, LOWER, word_bounds

#: Phrases of the contract and their labels.
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
#: Wordings of well-known licences and notices, marked up.
TEMPLATES = {
    "apache-2.0-notice": "licensed under the apache license <<optional>> as <<end>> version 2 0",
    "cc-by-nc-4.0-notice": "licensed under <<optional>> a <<end>> <<optional>> creative commons <<end>> cc by nc 4 0",
    "cc-by-sa-4.0-notice": "licensed under <<optional>> a <<end>> <<optional>> creative commons <<end>> cc by sa 4 0",
    "cc-by-4.0-notice": "licensed under <<optional>> a <<end>> <<optional>> creative commons <<end>> cc by 4 0",
    "mit-notice": "released under the <<optional>> terms of the <<end>> mit license",
    "gpl-3.0-notice": "<<any:3>> is licensed under the <<optional>> terms of the <<end>> gnu general public license "
    "<<optional>> as published by the free software foundation <<end>> version 3",
    "gpl-3.0-or-later": "licensed under the gnu general public license version 3 or <<optional>> at your option <<end>> "
    "any later version",
    "reserved-notice": "copyright <<optional>> c <<end>> <<any:8>> all rights reserved",
    "mit": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
    "documentation files the <<any:3>> to deal in the software without restriction including without limitation the "
    "rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit "
    "persons to whom the software is furnished to do so subject to the following conditions the above copyright notice "
    "and this permission notice <<optional>> including the next paragraph <<end>> shall be included in all copies or "
    "substantial portions of the software the software is provided as is without warranty of any kind express or implied "
    "including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement "
    "in no event shall <<any:8>> be liable for any claim damages or other liability whether in an action of contract tort "
    "or otherwise arising from out of or in connection with the software or the use or other dealings in the software",
    "isc": "permission to use copy modify and <<optional>> or <<end>> distribute this software for any purpose with or "
    "without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies "
    "the software is provided as is and <<any:8>> disclaims all warranties with regard to this software including all "
    "implied warranties of merchantability and fitness in no event shall <<any:8>> be liable for any special direct "
    "indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an "
    "action of contract negligence or other tortious action arising out of or in connection with the use or performance "
    "of this software",
    "0bsd": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
    "granted the software is provided as is and <<any:8>> disclaims all warranties with regard to this software including "
    "all implied warranties of merchantability and fitness in no event shall <<any:8>> be liable for any special direct "
    "indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an "
    "action of contract negligence or other tortious action arising out of or in connection with the use or performance "
    "of this software",
    "bsd-2-clause": "redistribution and use in source and binary forms with or without modification are permitted provided "
    "that the following conditions are met <<any:1>> redistributions of source code must retain the above copyright notice "
    "this list of conditions and the following disclaimer <<any:1>> redistributions in binary form must reproduce the "
    "above copyright notice this list of conditions and the following disclaimer in the documentation and or other "
    "materials provided with the distribution this software is provided by <<any:12>> as is and any express or implied "
    "warranties including but not limited to the implied warranties of merchantability and fitness for a particular "
    "purpose are disclaimed in no event shall <<any:12>> be liable for any direct indirect incidental special exemplary or "
    "consequential damages including but not limited to procurement of substitute goods or services loss of use data or "
    "profits or business interruption however caused and on any theory of liability whether in contract strict liability "
    "or tort including negligence or otherwise arising in any way out of the use of this software even if advised of the "
    "possibility of such damage",
    "bsd-3-clause": "redistribution and use in source and binary forms with or without modification are permitted provided "
    "that the following conditions are met <<any:1>> redistributions of source code must retain the above copyright notice "
    "this list of conditions and the following disclaimer <<any:1>> redistributions in binary form must reproduce the "
    "above copyright notice this list of conditions and the following disclaimer in the documentation and or other "
    "materials provided with the distribution <<any:1>> neither the name of <<any:12>> nor the names of <<any:3>> "
    "contributors may be used to endorse or promote products derived from this software without specific prior written "
    "permission this software is provided by <<any:12>> as is and any express or implied warranties including but not "
    "limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed in no event "
    "shall <<any:12>> be liable for any direct indirect incidental special exemplary or consequential damages including "
    "but not limited to procurement of substitute goods or services loss of use data or profits or business interruption "
    "however caused and on any theory of liability whether in contract strict liability or tort including negligence or "
    "otherwise arising in any way out of the use of this software even if advised of the possibility of such damage",
    "zlib": "this software is provided as is without any express or implied warranty in no event will <<any:4>> be held "
    "liable for any damages arising from the use of this software permission is granted to anyone to use this software for "
    "any purpose including commercial applications and to alter it and redistribute it freely subject to the following "
    "restrictions <<any:1>> the origin of this software must not be misrepresented you must not claim that you wrote the "
    "original software if you use this software in a product an acknowledgment in the product documentation would be "
    "appreciated but is not required <<any:1>> altered source versions must be plainly marked as such and must not be "
    "misrepresented as being the original software <<any:1>> this notice may not be removed or altered from any source "
    "distribution",
    "unlicense": "this is free and unencumbered software released into the public domain anyone is free to copy modify "
    "publish use compile sell or distribute this software either in source code form or as a compiled binary for any "
    "purpose commercial or non commercial and by any means in jurisdictions that recognize copyright laws the author or "
    "authors of this software dedicate any and all copyright interest in the software to the public domain we make this "
    "dedication for the benefit of the public at large and to the detriment of our heirs and successors we intend this "
    "dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under "
    "copyright law the software is provided as is without warranty of any kind express or implied including but not "
    "limited to the warranties of merchantability fitness for a particular purpose and noninfringement in no event shall "
    "the authors be liable for any claim damages or other liability whether in an action of contract tort or otherwise "
    "arising from out of or in connection with the software or the use or other dealings in the software",
    "apache-2.0-header": "licensed under the apache license version 2 0 the license you may not use this file except in "
    "compliance with the license you may obtain a copy of the license at <<any:1>> www apache org licenses license 2 0 "
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an "
    "as is basis without warranties or conditions of any kind either express or implied see the license for the specific "
    "language governing permissions and limitations under the license",
    "mpl-2.0-header": "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the "
    "mpl was not distributed with this file you can obtain one at <<any:1>> mozilla org mpl 2 0",
    "cc0-1.0-waiver": "to the extent possible under law <<any:12>> has waived all copyright and related or neighboring "
    "rights to",
}
#: The licences of the usual file header and the versions that it names.
HEADERS = {
    "gpl": ("gnu general public license", ("2", "3")),
    "lgpl": ("gnu lesser general public license", ("2 1", "3")),
    "agpl": ("gnu affero general public license", ("3",)),
}
#: Fixed value: the wording of that header.
HEADER = (
    "is free software you can redistribute it and or modify it under the terms of the {name} as published by the free "
    "software foundation either version {version} of the license or at your option any later version <<any:8>> is "
    "distributed in the hope that it will be useful but without any warranty without even the implied warranty of "
    "merchantability or fitness for a particular purpose see the {name} for more details"
)
TEMPLATES |= {
    f"{short}-{version.replace(' ', '.')}-or-later-header": HEADER.format(name=name, version=version)
    for short, (name, versions) in HEADERS.items()
    for version in versions
}
LABELS = "doc_id {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"

GAP = rb"[^0-9a-z\x80-\xff]+"
BASE = [(re.compile(GAP.join(w.encode() for w in phrase.split())), label) for phrase, label in PHRASES]
#: Every template holds one of these; found in lower case.
HINT = re.compile(rb"licen[sc]e|permission|all[^0-9a-z\x80-\xff]+rights|redistribution|unencumbered|neighboring")


class Automaton:
    """States 0..n over words: ``step[s]`` maps a word to the next state, ``loose[s]`` takes any word there."""

    def __init__(self, template: str):
        self.word: list[tuple[str | None, int] | None] = []
        self.skip: dict[int, list[int]] = {}
        open_at: list[int] = []
        for token in template.split():
            if token == "<<optional>>":
                open_at.append(len(self.word))
                self.word.append(None)
            elif token == "<<end>>":
                start = open_at.pop()
                self.skip.setdefault(start, []).append(len(self.word))
            elif token.startswith("<<any:"):
                for _ in range(int(token[6:-2])):
                    self.skip.setdefault(len(self.word), []).append(len(self.word) + 1)
                    self.word.append((None, 0))
            else:
                self.word.append((token, 1))
        self.accept = len(self.word)
        self.mandatory, depth = 0, 0
        for token in template.split():
            depth += (token == "<<optional>>") - (token == "<<end>>")
            self.mandatory += depth == 0 and not token.startswith("<<")
        self.start = self.closure({0})
        self.first = {self.word[s][0] for s in self.start if s < self.accept and self.word[s]}

    def closure(self, states: set[int]) -> frozenset[int]:
        """States reached without a word."""
        todo, seen = list(states), set(states)
        while todo:
            s = todo.pop()
            to = list(self.skip.get(s, ()))
            if s < self.accept and self.word[s] is None:
                to.append(s + 1)
            todo += [t for t in to if t not in seen]
            seen.update(to)
        return frozenset(seen)

    def run(self, words: list[str], at: int) -> tuple[bool, int]:
        """Whether the words from ``at`` on are accepted, and how many of them were taken."""
        states, taken = self.start, 0
        while self.accept not in states:
            word = words[at + taken] if at + taken < len(words) else None
            moved = {
                s + 1
                for s in states
                if word is not None and s < self.accept and self.word[s] and self.word[s][0] in (None, word)
            }
            if not moved:
                return False, taken
            states, taken = self.closure(moved), taken + 1
        return True, taken


@cache
def automata() -> dict[str, Automaton]:
    return {label: Automaton(text) for label, text in TEMPLATES.items()}


def match_templates(words: list[str]) -> tuple[set[str], float]:
    """Labels of the accepted templates, and the best share of a template's mandatory wording met in order."""
    labels, best = set(), 0.0
    places: dict[str, list[int]] = {}
    for i, w in enumerate(words):
        places.setdefault(w, []).append(i)
    for label, automaton in automata().items():
        # a replaceable beginning may be left out, so the first fixed word is enough to start from
        for at in sorted(i for w in automaton.first if w is not None for i in places.get(w, ())):
            accepted, taken = automaton.run(words, at)
            best = max(best, 1.0 if accepted else min(0.99, taken / automaton.mandatory))
            if accepted:
                labels.add(label)
                break
    return labels, best


def label_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in text_blocks(batches):
        data, bounds = joined_bytes(block.column("text"))
        lower = LOWER[data]
        starts, ends, index = word_bounds(lower, bounds, ALNUM)
        raw = lower.tobytes()
        n = len(bounds) - 1
        counts, first, last = [0] * n, [None] * n, [None] * n
        base: list[set[str]] = [set() for _ in range(n)]
        for pattern, label in BASE:
            for m in pattern.finditer(raw):
                a, b = m.span()
                doc = int(np.searchsorted(bounds, a, side="right")) - 1
                word = int(np.searchsorted(starts, a))
                end = int(np.searchsorted(ends, b))
                whole = word < len(starts) and starts[word] == a and end < len(ends) and ends[end] == b
                if not whole or b > bounds[doc + 1]:
                    continue
                place = word - int(index[doc])
                counts[doc] += 1
                first[doc] = place if first[doc] is None else min(first[doc], place)
                last[doc] = place if last[doc] is None else max(last[doc], place)
                base[doc].add(label)
        hinted = {int(np.searchsorted(bounds, m.start(), side="right")) - 1 for m in HINT.finditer(raw)}
        labels, scores = [()] * n, [0.0] * n
        for doc in range(n):
            found: set[str] = set()
            if doc in hinted or base[doc]:
                span = slice(int(index[doc]), int(index[doc + 1]))
                words = [raw[a:b].decode() for a, b in zip(starts[span].tolist(), ends[span].tolist(), strict=True)]
                found, scores[doc] = match_templates(words)
            if base[doc]:
                scores[doc] = max(scores[doc], 0.5)
            labels[doc] = base[doc] | found
        joined = lambda sets: pa.array([",".join(sorted(s)) for s in sets], pa.string())
        yield pa.RecordBatch.from_arrays(
            [
                block.column("doc_id"),
                pa.array(np.diff(index)),
                pa.array(counts, pa.int64()),
                pa.array(first, pa.int64()),
                pa.array(last, pa.int64()),
                joined(base),
                joined(labels),
                pa.array(scores, pa.float64()),
            ],
            names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"],
        )


def scan_licenses(docs: DataFrame) -> DataFrame:
    """Phrase places and template labels of every row; one pass, no shuffle."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(label_blocks, LABELS.format(kind=kind))


def op5_license_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Phrases, labels and score of every document."""
    return scan_licenses(read_table(spark, sf_dir, "documents"))
