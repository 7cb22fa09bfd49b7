"""License scan: templates with optional and replaceable regions, compiled into token automata.

Markup: ``<<optional>> ... <<end>>`` may be missing, ``<<any N>>`` stands for 0 to N words of any kind. All
other wording is mandatory and must match word for word; case, punctuation and the spellings in ``SAME`` don't count.
"""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import DataFrame

from .common import ALNUM, scan, utf8

#: Phrase words and label of the base search.
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
#: Spellings that count as the same word.
SAME = {"licence": "license", "licenced": "licensed", "sublicence": "sublicense", "organisation": "organization"}

#: The wording of the licenses' notices and short texts.
TEMPLATES = {
    "apache-2.0": [
        """Licensed under the Apache License, Version 2.0 <<optional>>(the "License"); you may not use this file except in
        compliance with the License. You may obtain a copy of the License at <<any 12>> Unless required by applicable law or
        agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR
        CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and
        limitations under the License.<<end>>""",
    ],
    "mit": [
        "<<optional>>This <<any 3>> is<<end>> released under the <<optional>>terms of the<<end>> MIT License",
        "licensed under the <<optional>>terms of the<<end>> MIT License",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
        rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
        persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and
        this permission notice <<optional>>(including the next paragraph)<<end>> shall be included in all copies or substantial
        portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING
        BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT
        SHALL <<any 20>> BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
        OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    ],
    "isc": [
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS
        PROVIDED "AS IS" AND <<any 20>> DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
        MERCHANTABILITY AND FITNESS.""",
    ],
    "bsd-2-clause": [
        """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
        following conditions are met: <<any 1>> Redistributions of source code must retain the above copyright notice, this list
        of conditions and the following disclaimer. <<any 1>> Redistributions in binary form must reproduce the above copyright
        notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with
        the distribution. THIS SOFTWARE IS PROVIDED BY <<any 20>> "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES""",
    ],
    "bsd-3-clause": [
        """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
        following conditions are met: <<any 1>> Redistributions of source code must retain the above copyright notice, this list
        of conditions and the following disclaimer. <<any 1>> Redistributions in binary form must reproduce the above copyright
        notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with
        the distribution. <<any 1>> Neither the name of <<any 20>> nor the names of its contributors may be used to endorse or
        promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY
        <<any 20>> "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES""",
    ],
    "gpl-2.0": ["licensed under the <<any 2>> General Public License, <<optional>>either<<end>> version 2"],
    "gpl-3.0": [
        """licensed under the <<any 2>> General Public License, <<optional>>either<<end>> version 3
        <<optional>>of the License<<end>> <<optional>>or (at your option) any later version<<end>>""",
        """it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3
        of the License, or (at your option) any later version""",
    ],
    "cc-by-4.0": ["<<optional>>licensed under <<any 3>><<end>> CC BY 4.0", "Creative Commons Attribution 4.0 International License"],
    "cc-by-nc-4.0": [
        "<<optional>>licensed under <<any 3>><<end>> CC BY NC 4.0",
        "Creative Commons Attribution NonCommercial 4.0 International License",
    ],
    "cc-by-sa-4.0": [
        "<<optional>>licensed under <<any 3>><<end>> CC BY SA 4.0",
        "Creative Commons Attribution ShareAlike 4.0 International License",
    ],
    "mpl-2.0": [
        """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. <<optional>>If a copy of the MPL
        was not distributed with this file, You can obtain one at <<any 8>><<end>>""",
    ],
    "unlicense": ["This is free and unencumbered software released into the public domain"],
}


class Automaton(NamedTuple):
    """``words[k]`` leads from state k to k + 1, ``skips[k]`` are states reached from k for nothing,
    ``loops[k]`` is how many words of any kind state k may take. ``mandatory[k]`` counts the mandatory words
    before state k. ``anchor`` is the first run of mandatory words and ``begin`` the state before it."""

    label: str
    words: list[bytes]
    skips: list[list[int]]
    loops: list[int]
    mandatory: list[int]
    anchor: bytes
    begin: int


def tokens(text: bytes) -> list[bytes]:
    return [_SAME.get(w, w) for w in text.translate(ALNUM).split()]


_SAME = {k.encode(): v.encode() for k, v in SAME.items()}


def compile_template(label: str, template: str) -> Automaton:
    words: list[bytes] = []
    skips: dict[int, list[int]] = {}
    loops: dict[int, int] = {}
    optional, opened = [], []
    for part in re.split(r"(<<[^>]*>>)", template):
        if part == "<<optional>>":
            opened.append(len(words))
        elif part == "<<end>>":
            skips.setdefault(opened.pop(), []).append(len(words))
        elif m := re.fullmatch(r"<<any (\d+)>>", part):
            loops[len(words)] = int(m[1])
        else:
            own = tokens(part.encode())
            words += own
            optional += [bool(opened)] * len(own)
    if opened or part == "<<optional>>":
        raise ValueError(f"an optional region of {label} is not closed")
    n = len(words)
    mandatory = [sum(not o for o in optional[:k]) for k in range(n + 1)]
    first = optional.index(False)
    stop = next((k for k in range(first + 1, n) if optional[k] or k in loops), n)
    return Automaton(
        label, words, [skips.get(k, []) for k in range(n + 1)], [loops.get(k, 0) for k in range(n + 1)], mandatory,
        b" " + b" ".join(words[first:stop]) + b" ", first,
    )


AUTOMATA = [compile_template(label, t) for label, ts in TEMPLATES.items() for t in ts]


def run_automaton(a: Automaton, words: list[bytes], at: int) -> tuple[bool, int]:
    """Whether words from ``at`` on are accepted, and how many mandatory words matched at most."""
    accept, best = len(a.words), 0
    states = _closure(a, {a.begin: 0})
    n = at
    while states:
        best = max(best, max(a.mandatory[k] for k in states))
        if accept in states:
            return True, best
        if n == len(words):
            break
        word, after = words[n], {}
        for k, used in states.items():
            if k < accept and a.words[k] == word:
                after[k + 1] = 0
            if used < a.loops[k]:
                after[k] = min(after.get(k, used + 1), used + 1)
        states, n = _closure(a, after), n + 1
    return False, best


def _closure(a: Automaton, states: dict[int, int]) -> dict[int, int]:
    """State -> fewest words its loop has taken."""
    todo = list(states)
    while todo:
        for to in a.skips[todo.pop()]:
            if to not in states:
                states[to] = 0
                todo.append(to)
    return states


def places(line: bytes, phrase: bytes) -> list[int]:
    """Word numbers at which the phrase stands in a line with one space around each word."""
    out, at, word, seen = [], line.find(phrase), 0, 0
    while at >= 0:
        word, seen = word + line.count(b" ", seen, at), at
        out.append(word)
        at = line.find(phrase, at + 1)
    return out


def scan_text(text: str | None, automata: list[Automaton] = AUTOMATA) -> tuple:
    words = utf8(text).translate(ALNUM).split()
    line = b" " + b" ".join(words) + b" "
    found = {label: places(line, b" " + phrase.encode() + b" ") for phrase, label in PHRASES}
    starts = [p for ps in found.values() for p in ps]
    base = sorted(label for label, ps in found.items() if ps)
    accepted, score = set(), 0.0
    if any(k in line for k in _SAME):
        words = [_SAME.get(w, w) for w in words]
        line = b" " + b" ".join(words) + b" "
    for a in automata:
        for at in places(line, a.anchor):
            done, best = run_automaton(a, words, at)
            score = max(score, best / a.mandatory[-1])
            if done:
                accepted.add(a.label)
                break
    return (
        len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(base),
        ",".join(sorted(accepted | set(base))), score,
    )


def find_licenses(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", templates: dict[str, list[str]] | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    ``score`` is the largest share of a template's mandatory words that matched in order from the
    template's first run of mandatory words on; 1 means that some template accepts. A null or wordless text has no
    places, no labels and score 0. Repeated rows get a row each; an empty table gives an empty result.
    ``templates`` replaces the built-in templates. A text is read once, whole.
    """
    automata = AUTOMATA if templates is None else [compile_template(k, t) for k, ts in templates.items() for t in ts]

    def fn(batches):
        for ids, texts in batches:
            yield ids, *(zip(*[scan_text(t, automata) for t in texts]) if ids else [[]] * 7)

    kind = docs.schema[doc_id].dataType.simpleString()
    schema = (
        f"doc_id {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
        "score double"
    )
    return scan(docs, {"doc_id": doc_id, "text": text}, fn, schema)
