"""License scans by template-markup matching.

A template is license wording with marked regions: ``[[ ]]`` around optional words and
``{{name:low-high}}`` for a replaceable region of so many words. It is compiled to a token automaton;
a text holds the license where the automaton accepts, that is, where all mandatory words stand
exactly, in order, with nothing else between them. ``TEMPLATES`` are whole license texts and standard
header blocks, from their first mandatory word to their last; ``NOTICES`` are lines that only name a
license. These have labels of their own (``notice:``) and a lower score, and none behind a negation. Texts are cut to words once, as hashed words of
whole Arrow columns; an automaton runs only from words that can begin its template.

Beside the templates, fixed phrases are reported wherever their words stand consecutively.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrybook.llm.common import pieces
from ferrybook.llm.shingles import MARKS, Words

# The phrases of the base scan and their labels.
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

# The wording of the licenses, without punctuation.
_AS_IS = (
    "the software is provided as is without warranty of any kind express or implied including but not limited to the "
    "warranties of merchantability fitness for a particular purpose and noninfringement in no event shall the authors "
    "{holders} be liable for any claim damages or other liability whether in an action of contract tort or otherwise "
    "arising from out of or in connection with the software or the use or other dealings in the software"
)
_BSD = (
    "redistribution and use in source and binary forms with or without modification are permitted provided that the "
    "following conditions are met [[1]] redistributions of source code must retain the above copyright notice this list of "
    "conditions and the following disclaimer [[2]] redistributions in binary form must reproduce the above copyright notice "
    "this list of conditions and the following disclaimer in the documentation and or other materials provided with the "
    "distribution {third} this software is provided by {{{{owner:1-8}}}} as is and any express or implied warranties "
    "including but not limited to the implied warranties of merchantability and fitness for a particular purpose are "
    "disclaimed in no event shall {{{{owner:1-8}}}} be liable for any direct indirect incidental special exemplary or "
    "consequential damages including but not limited to procurement of substitute goods or services loss of use data or "
    "profits or business interruption however caused and on any theory of liability whether in contract strict liability or "
    "tort including negligence or otherwise arising in any way out of the use of this software even if advised of the "
    "possibility of such damage"
)
_GNU = (
    "free software you can redistribute it and or modify it under the terms of the gnu {name} as published by the free "
    "software foundation [[either]] version {version} of the license [[or at your option any later version]] "
    "{{{{program:1-6}}}} is distributed in the hope that it will be useful but without any warranty without even the implied "
    "warranty of merchantability or fitness for a particular purpose see the gnu {name} for more details"
)
_CC = "this work is licensed under [[a]] [[the]] creative commons attribution {terms} {version} [[international]] [[unported]] license"
GNU = {"gpl": "general public license", "lgpl": "lesser general public license", "agpl": "affero general public license"}
CC = {
    "by": "",
    "by-sa": "sharealike",
    "by-nc": "noncommercial",
    "by-nd": "noderivatives",
    "by-nc-sa": "noncommercial sharealike",
    "by-nc-nd": "noncommercial noderivatives",
}

TEMPLATES = {
    "mit": (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction including without limitation "
        "the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit "
        "persons to whom the software is furnished to do so subject to the following conditions the above copyright notice "
        "and this permission notice [[including the next paragraph]] shall be included in all copies or substantial "
        "portions of the software " + _AS_IS.format(holders="or copyright holders"),
    ),
    "isc": (
        "permission to use copy modify and [[or]] distribute this software for any purpose with or without fee is hereby "
        "granted provided that the above copyright notice and this permission notice appear in all copies the software is "
        "provided as is and {{author:1-6}} disclaims all warranties with regard to this software including all implied "
        "warranties of merchantability and fitness in no event shall {{author:1-6}} be liable for any special direct "
        "indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits whether in "
        "an action of contract negligence or other tortious action arising out of or in connection with the use or "
        "performance of this software",
    ),
    "bsd-2-clause": (_BSD.format(third=""),),
    "bsd-3-clause": (
        _BSD.format(
            third="[[3]] neither the name of {{owner:1-12}} nor the names of [[its]] contributors may be used to endorse or "
            "promote products derived from this software without specific prior written permission"
        ),
    ),
    "zlib": (
        "this software is provided as is without any express or implied warranty in no event will the authors be held liable "
        "for any damages arising from the use of this software permission is granted to anyone to use this software for any "
        "purpose including commercial applications and to alter it and redistribute it freely subject to the following "
        "restrictions [[1]] the origin of this software must not be misrepresented you must not claim that you wrote the "
        "original software if you use this software in a product an acknowledgment in the product documentation would be "
        "appreciated but is not required [[2]] altered source versions must be plainly marked as such and must not be "
        "misrepresented as being the original software [[3]] this notice may not be removed or altered from any source "
        "distribution",
    ),
    "unlicense": (
        "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use "
        "compile sell or distribute this software either in source code form or as a compiled binary for any purpose "
        "commercial or non commercial and by any means in jurisdictions that recognize copyright laws the author or authors "
        "of this software dedicate any and all copyright interest in the software to the public domain we make this "
        "dedication for the benefit of the public at large and to the detriment of our heirs and successors we intend this "
        "dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software "
        "under copyright law " + _AS_IS.format(holders=""),
    ),
    "apache-2.0": (
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the "
        "license you may obtain a copy of the license at {{address:1-8}} unless required by applicable law or agreed to in "
        "writing software distributed under the license is distributed on an as is basis without warranties or conditions of "
        "any kind either express or implied see the license for the specific language governing permissions and limitations "
        "under the license",
    ),
    "gpl-2.0": (_GNU.format(name=GNU["gpl"], version="2"),),
    "gpl-3.0": (_GNU.format(name=GNU["gpl"], version="3"),),
    "lgpl-2.1": (_GNU.format(name=GNU["lgpl"], version="2 1"),),
    "lgpl-3.0": (_GNU.format(name=GNU["lgpl"], version="3"),),
    "agpl-3.0": (_GNU.format(name=GNU["agpl"], version="3"),),
    "mpl-2.0": (
        "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not "
        "distributed with this file you can obtain one at {{address:1-8}}",
    ),
    **{f"cc-{code}-{n}.0": (_CC.format(terms=terms, version=f"{n} 0"),) for code, terms in CC.items() for n in (3, 4)},
    "cc0-1.0": ("to the extent possible under law {{owner:1-8}} has waived all copyright and related or neighboring rights to {{work:1-12}}",),
}
NOTICES = {
    "mit": ("released under the [[terms of the]] mit license", "licensed under the [[terms of the]] mit license"),
    "bsd": ("released under the [[terms of the]] {{clauses:0-2}} bsd license", "licensed under the [[terms of the]] {{clauses:0-2}} bsd license"),
    "apache-2.0": ("licensed under the apache license [[version]] 2 0", "released under the apache license [[version]] 2 0"),
    **{
        f"{code}-{label}": (
            f"licensed under the [[terms of the]] [[gnu]] {name} [[as published by the free software foundation]] version {version}",
        )
        for code, label, name, version in (
            ("gpl", "2.0", GNU["gpl"], "2"), ("gpl", "3.0", GNU["gpl"], "3"), ("lgpl", "2.1", GNU["lgpl"], "2 1"),
            ("lgpl", "3.0", GNU["lgpl"], "3"), ("agpl", "3.0", GNU["agpl"], "3"),
        )
    },
    "mpl-2.0": ("subject to the terms of the mozilla public license v 2 0", "licensed under the mozilla public license [[version]] 2 0"),
    **{
        f"cc-{code}-{n}.0": (f"licensed under [[a]] [[creative commons]] cc {code.replace('-', ' ')} {n} 0",)
        for code in CC
        for n in (3, 4)
    },
    "proprietary": ("copyright {{owner:0-8}} all rights reserved",),
    "spdx-tag": ("spdx license identifier {{name:1-4}}",),
}
NEGATIONS = ("not", "never", "nor")  # words before a notice that take it back
NOTICE_SCORE = 0.75  # of the share that a whole text would have
REPLACED = -1  # any word
BASE_SCORE = 0.5


class Automaton:
    """One template over word numbers; states are places in it, ``free`` moves skip optional regions."""

    def __init__(self, template: str, numbers: dict[str, int]):
        self.symbols: list[int] = []
        self.free: list[list[int]] = []
        opened: list[int] = []
        self.mandatory = 0
        for part in re.findall(r"\[\[|\]\]|\{\{[^}]*\}\}|[^\s\[\]{}]+", template):
            if part == "[[":
                opened.append(len(self.symbols))
            elif part == "]]":
                self.free[opened.pop()].append(len(self.symbols))
            elif part.startswith("{{"):
                low, high = map(int, part[2:-2].split(":")[1].split("-"))
                at, end = len(self.symbols), len(self.symbols) + high
                for k in range(high):
                    self._add(REPLACED)
                    if k >= low:
                        self.free[at + k].append(end)
            else:
                self._add(numbers.setdefault(part, len(numbers)))
                self.mandatory += not opened
        self.free.append([])
        self.last = len(self.symbols)

    def _add(self, symbol: int) -> None:
        self.symbols.append(symbol)
        self.free.append([])

    def _closed(self, states: set[int]) -> set[int]:
        todo = list(states)
        while todo:
            for state in self.free[todo.pop()]:
                if state not in states:
                    states.add(state)
                    todo.append(state)
        return states

    def firsts(self) -> set[int]:
        return {self.symbols[s] for s in self._closed({0}) if s < self.last}

    def accepted(self, words: np.ndarray, start: int) -> int:
        """Words of the longest accepted stretch that begins at ``start``; 0 where none does."""
        states, longest = self._closed({0}), 0
        for k in range(start, len(words)):
            word = words[k]
            states = {s + 1 for s in states if s < self.last and (self.symbols[s] == word or self.symbols[s] == REPLACED)}
            if not states:
                break
            if self.last in self._closed(states):
                longest = k - start + 1
        return longest


class Scanner:
    """All templates and phrases over one numbering of their words."""

    def __init__(self, templates: dict[str, tuple[str, ...]] | None = None, notices: dict[str, tuple[str, ...]] | None = None):
        numbers: dict[str, int] = {}
        templates, notices = TEMPLATES if templates is None else templates, NOTICES if notices is None else notices
        self.automata = [(label, Automaton(t, numbers)) for label, many in templates.items() for t in many]
        self.automata += [(f"notice:{label}", Automaton(t, numbers)) for label, many in notices.items() for t in many]
        self.negations = {numbers.setdefault(w, len(numbers)) for w in NEGATIONS}
        self.phrases = [([numbers.setdefault(w, len(numbers)) for w in p.split()], label) for p, label in PHRASES.items()]
        self.starts: dict[int, list[tuple[str, Automaton]]] = {}
        for label, automaton in self.automata:
            for first in automaton.firsts():
                self.starts.setdefault(first, []).append((label, automaton))
        self.spelled = [w.encode() for w in numbers]
        hashes = Words(pa.array(list(numbers)), MARKS).hashes()
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]

    def numbered(self, words: Words) -> np.ndarray:
        """The number of every word, ``len`` of the numbering for others; equal hashes are compared as bytes."""
        hashes = words.hashes()
        near = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        out = np.full(len(hashes), len(self.hashes))
        for i in np.flatnonzero(self.hashes[near] == hashes):
            number = self.order[near[i]]
            if words.data[words.starts[i] : words.ends[i]].tobytes() == self.spelled[number]:
                out[i] = number
        return out

    def places(self, row: np.ndarray) -> list[tuple[int, str]]:
        """(start, label) of every phrase in one row's word numbers."""
        found = []
        for phrase, label in self.phrases:
            at = np.flatnonzero(row[: len(row) - len(phrase) + 1] == phrase[0]) if len(row) >= len(phrase) else []
            found += [(int(i), label) for i in at if row[i : i + len(phrase)].tolist() == phrase]
        return sorted(found)

    def spans(self, row: np.ndarray) -> list[tuple[int, int, str, float]]:
        """(start, end, label, share of mandatory words, less for a notice) of every accepted stretch."""
        found = []
        for i in np.flatnonzero(row < len(self.hashes)):
            negated = i > 0 and int(row[i - 1]) in self.negations
            for label, automaton in self.starts.get(int(row[i]), ()):
                notice = label.startswith("notice:")
                if notice and negated:
                    continue
                if length := automaton.accepted(row, int(i)):
                    share = min(1.0, automaton.mandatory / length)
                    found.append((int(i), int(i) + length, label, share * NOTICE_SCORE if notice else share))
        return found


def scan(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    templates: dict[str, tuple[str, ...]] | None = None,
    notices: dict[str, tuple[str, ...]] | None = None,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, ``phrases`` (start, label) and ``licenses`` (start, end,
    label, share), in words from 0.

    A null or empty text has no words and finds nothing; long texts are read whole, one after the other. Rows are
    independent of each other, repeated ones give repeated results; an empty table gives none. Stretches may
    overlap and all are given. Other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, notices)
        for part in pieces(batches, 1):
            words = Words(part.column(1), MARKS)
            numbers = scanner.numbered(words)
            known = np.concatenate([[0], np.cumsum(numbers < len(scanner.hashes))])
            sizes, phrases, licenses = [], [], []
            for a, b in zip(words.rows[:-1], words.rows[1:]):
                row = numbers[a:b]
                some = known[b] > known[a]
                sizes.append(int(b - a))
                phrases.append([{"start": s, "label": x} for s, x in scanner.places(row)] if some else [])
                licenses.append(
                    [{"start": s, "end": e, "label": x, "share": v} for s, e, x, v in scanner.spans(row)] if some else []
                )
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.array(phrases, pa.list_(pa.struct([("start", pa.int64()), ("label", pa.string())]))),
                    pa.array(
                        licenses,
                        pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("label", pa.string()), ("share", pa.float64())])),
                    ),
                ],
                ["doc_id", "n_words", "phrases", "licenses"],
            )

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(
        run,
        "doc_id long, n_words long, phrases array<struct<start:long,label:string>>, "
        "licenses array<struct<start:long,end:long,label:string,share:double>>",
    )


def digests(found: DataFrame) -> DataFrame:
    """Counts, first and last place and labels of :func:`scan`; score is the best stretch's mandatory share,
    or that of a bare phrase."""
    joined = lambda c: F.array_join(F.array_sort(F.array_distinct(c)), ",")
    bare = F.when(F.size("phrases") > 0, F.lit(BASE_SCORE)).otherwise(F.lit(0.0))
    return found.select(
        "doc_id",
        "n_words",
        F.size("phrases").cast("long").alias("n_base"),
        F.array_min("phrases.start").alias("first_word"),
        F.array_max("phrases.start").alias("last_word"),
        joined(F.col("phrases.label")).alias("base_labels"),
        joined(F.concat("phrases.label", "licenses.label")).alias("labels"),
        F.greatest(bare, F.coalesce(F.array_max("licenses.share"), F.lit(0.0))).alias("score"),
    )
