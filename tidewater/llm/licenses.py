"""Licence scan with a generalised suffix automaton (operator 7).

The automaton recognises every stretch of words of the templates and names
below. A text's words are streamed through it; after each word it gives the
longest stretch ending there that occurs in some template (matching
statistics). Long maximal stretches are chained per template, in order on both
sides with at most ``GAP`` foreign words between, into covered spans that hold
``COVER`` of a template's words. Templates share passages, so of spans that lie
over the same words the one that covers most adds its label. A name (a
phrase of ``PHRASES``) stands wherever the streamed state has the phrase as a
suffix: every such place counts.

Words: A-Z lower-cased, then runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]``.

Defined results: null and empty texts have no words, no labels, score 0 and
null first and last words; an empty table gives an empty result; null ids and
repeated rows are scanned like any other; other columns are not read.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater._shipping import by_value
from tidewater.llm.common import map_arrow

by_value(__name__)

# Licence names and the labels they give.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Passages of public licences, a label and its text each; the parts of
# a licence stand as passages of their own, so that any of them is recognised.
TEMPLATES = [
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
            "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
            "copies of the Software, and to permit persons to whom the Software is furnished to do so"),
    ("mit", "subject to the following conditions: The above copyright notice and this permission notice shall be included "
            "in all copies or substantial portions of the Software."),
    ("mit", "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT "
            "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO "
            "EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN "
            "AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE "
            "OR OTHER DEALINGS IN THE SOFTWARE."),
    ("apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
               "compliance with the License. You may obtain a copy of the License at"),
    ("apache", "Unless required by applicable law or agreed to in writing, software distributed under the License is "
               "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. "
               "See the License for the specific language governing permissions and limitations under the License."),
    ("apache", "Subject to the terms and conditions of this License, each Contributor hereby grants to You a perpetual, "
               "worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright license to reproduce, prepare "
               "Derivative Works of, publicly display, publicly perform, sublicense, and distribute the Work and such "
               "Derivative Works in Source or Object form."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
            "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
            "(at your option) any later version"),
    ("gpl", "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
            "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License "
            "for more details."),
    ("gpl", "You should have received a copy of the GNU General Public License along with this program."),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
             "General Public License as published by the Free Software Foundation; either version 2.1 of the License, or "
             "(at your option) any later version."),
    ("lgpl", "This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
             "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public "
             "License for more details."),
    ("lgpl", "You should have received a copy of the GNU Lesser General Public License along with this library"),
    ("agpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
             "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
             "(at your option) any later version."),
    ("agpl", "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
             "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero General Public "
             "License for more details."),
    ("agpl", "You should have received a copy of the GNU Affero General Public License along with this program."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
            "that the following conditions are met"),
    ("bsd", "Redistributions of source code must retain the above copyright notice, this list of conditions and the "
            "following disclaimer."),
    ("bsd", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
            "following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("bsd", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
            "products derived from this software without specific prior written permission."),
    ("bsd", "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
            "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
            "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY "
            "DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
            "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER "
            "CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR "
            "OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("isc", "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE "
            "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS."),
    ("zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be "
             "held liable for any damages arising from the use of this software."),
    ("zlib", "Permission is granted to anyone to use this software for any purpose, including commercial applications, and "
             "to alter it and redistribute it freely, subject to the following restrictions"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
            "was not distributed with this file, You can obtain one at"),
    ("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
                  "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled "
                  "binary, for any purpose, commercial or non-commercial, and by any means."),
    ("boost", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software "
              "and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, "
              "distribute, execute, and transmit the Software, and to prepare derivative works of the Software"),
    ("cc0", "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring "
            "rights to this software to the public domain worldwide. This software is distributed without any warranty."),
    ("cc0", "You should have received a copy of the CC0 Public Domain Dedication along with this software."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
]

MIN_STRETCH = 3
GAP = 8
COVER = 0.7
_WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = {i: i + 32 for i in range(65, 91)}


def words_of(text: str | None) -> list[str]:
    return _WORDS.findall(text.translate(_LOWER)) if text else []


class Automaton:
    """Generalised suffix automaton over template words.

    ``step[s]`` maps a word number to a state, ``link[s]`` is the state of the
    longest suffix that occurs elsewhere too, ``length[s]`` its longest
    stretch, ``ends[s]`` the (template, word position) pairs where it ends,
    ``names[s]`` the phrases that are suffixes of its stretches."""

    def __init__(self, templates: list[list[str]], phrases: list[list[str]]):
        self.vocab: dict[str, int] = {}
        self.step, self.link, self.length, self.ends = [{}], [-1], [0], [set()]
        self.sizes = [len(t) for t in templates]
        for t, words in enumerate([*templates, *phrases]):
            last = 0
            for pos, w in enumerate(words):
                last = self._extend(last, self.vocab.setdefault(w, len(self.vocab) + 1))
                if t < len(templates):
                    self.ends[last].add((t, pos))
        for s in sorted(range(1, len(self.step)), key=lambda s: -self.length[s]):
            self.ends[self.link[s]] |= self.ends[s]      # a suffix ends wherever the longer stretch ends
        self.ends[0] = set()
        at = {}
        for p, words in enumerate(phrases):
            s = 0
            for w in words:
                s = self.step[s][self.vocab[w]]
            at[s] = at.get(s, ()) + ((p, len(words)),)
        self.names = [()] * len(self.step)
        for s in sorted(range(1, len(self.step)), key=lambda s: self.length[s]):
            self.names[s] = at.get(s, ()) + self.names[self.link[s]]

    def _state(self, length: int, step: dict, link: int) -> int:
        self.step.append(step)
        self.link.append(link)
        self.length.append(length)
        self.ends.append(set())
        return len(self.step) - 1

    def _extend(self, last: int, w: int) -> int:
        """The state reached from ``last`` by ``w``, added if it is missing."""
        known = self.step[last].get(w)
        if known is not None and self.length[known] == self.length[last] + 1:
            return known
        new = None if known is not None else self._state(self.length[last] + 1, {}, 0)
        p = last
        if new is not None:
            while p >= 0 and w not in self.step[p]:
                self.step[p][w] = new
                p = self.link[p]
            if p < 0:
                return new
        q = self.step[p][w]
        if self.length[q] == self.length[p] + 1:
            target = q
        else:                                            # split q: the short stretches get a state of their own
            target = self._state(self.length[p] + 1, dict(self.step[q]), self.link[q])
            self.link[q] = target
            while p >= 0 and self.step[p].get(w) == q:
                self.step[p][w] = target
                p = self.link[p]
        if new is None:
            return target
        self.link[new] = target
        return new


def scan(auto: Automaton, codes) -> tuple[list, list]:
    """Stream word numbers (0: in no template): phrase places (phrase, start)
    and maximal stretches (start, length, state)."""
    import numpy as np

    places, stretches = [], []
    known = np.flatnonzero(codes)
    if len(known) < 2:
        return places, stretches
    breaks = np.flatnonzero(np.diff(known) > 1)
    begins, stops = np.append(known[0], known[breaks + 1]), np.append(known[breaks], known[-1])
    step, link, length, names = auto.step, auto.link, auto.length, auto.names
    for b, e in zip(begins.tolist(), stops.tolist()):
        if e == b:
            continue
        s = n = 0
        for i, w in enumerate(codes[b:e + 1].tolist(), b):
            t = step[s].get(w)
            if t is None:
                if n >= MIN_STRETCH:
                    stretches.append((i - n, n, s))
                while s and t is None:
                    s = link[s]
                    n = length[s]
                    t = step[s].get(w)
            if t is None:
                s = n = 0
                continue
            s, n = t, n + 1
            for p, k in names[s]:
                if k <= n:
                    places.append((p, i - k + 1))
        if n >= MIN_STRETCH:
            stretches.append((e + 1 - n, n, s))
    return places, stretches


def chain(auto: Automaton, stretches: list) -> list[tuple[int, int, int, int]]:
    """Chains per template: (template, covered words, first word, last word).

    Stretches come in text order; each is placed at its first template position
    after the chain it extends, if the gap in the text is at most ``GAP``.
    Overlaps with what the chain already covers are not counted twice."""
    live: dict[int, list] = {}
    done = []
    for start, n, state in stretches:
        spots: dict[int, list] = {}
        for t, end in auto.ends[state]:
            spots.setdefault(t, []).append(end)
        for t, ends in spots.items():
            c = live.get(t)
            near = c and start <= c[3] + 1 + GAP
            if near:
                after = [x for x in ends if x > c[4]]
                if after:
                    x = min(after)
                    c[1] += min(n, x - c[4], start + n - 1 - c[3])
                    c[3], c[4] = start + n - 1, x
                    continue
            if near and c[1] >= n and (start <= c[3] or c[1] < COVER * auto.sizes[t]):
                continue                                 # the running chain is the better one and not yet whole
            if c:
                done.append((t, *c[1:4]))
            live[t] = [t, n, start, start + n - 1, min(ends)]
    return done + [(t, *c[1:4]) for t, c in live.items()]


def best_spans(spans: list[tuple[str, int, int, float, int]]) -> list:
    """Of (label, first, last, share, words covered) those that no other one beats
    on the same words: spans that share over half the words of the shorter one
    compete, and the one with most words covered stays."""
    out: list = []
    for x in sorted(spans, key=lambda x: (-x[4], -x[3], x[1], x[0])):
        if all(2 * (min(x[2], y[2]) - max(x[1], y[1]) + 1) <= min(x[2] - x[1], y[2] - y[1]) + 1 for y in out):
            out.append(x)
    return sorted(out, key=lambda x: (x[1], x[2], x[0]))


def build() -> tuple:
    labels = [label for label, _ in TEMPLATES]
    phrases = list(PHRASES)
    return Automaton([words_of(text) for _, text in TEMPLATES], [p.split() for p in phrases]), labels, phrases


def scanner(batches):
    import numpy as np
    import pyarrow as pa

    auto, labels, phrases = build()
    get = auto.vocab.get
    span = pa.struct([("label", pa.string()), ("first", pa.int64()), ("last", pa.int64()), ("covered", pa.float64())])
    for batch in batches:
        cols: dict[str, list] = {k: [] for k in ("n_words", "n_base", "first_word", "last_word", "base_labels",
                                                 "labels", "score", "spans")}
        for text in batch.column(1).to_pylist():
            words = words_of(text)
            codes = np.array([get(w, 0) for w in words], np.int64)
            places, stretches = scan(auto, codes)
            chains = [(labels[t], first, last, covered / auto.sizes[t], covered) for t, covered, first, last in chain(auto, stretches)]
            spans = best_spans([x for x in chains if x[3] >= COVER])
            base = {PHRASES[phrases[p]] for p, _ in places}
            more = {x[0] for x in spans}
            cols["n_words"].append(len(words))
            cols["n_base"].append(len(places))
            cols["first_word"].append(min((s for _, s in places), default=None))
            cols["last_word"].append(max((s for _, s in places), default=None))
            cols["base_labels"].append(",".join(sorted(base)))
            cols["labels"].append(",".join(sorted(base | more)))
            cols["score"].append(min(1.0, max([x[3] for x in chains] + [1.0 if base else 0.0])))
            cols["spans"].append([dict(zip(("label", "first", "last", "covered"), x)) for x in spans])
        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.list_(span)]
        yield pa.RecordBatch.from_arrays([batch.column(0)] + [pa.array(v, k) for v, k in zip(cols.values(), kinds)],
                                         names=["doc_id", *cols])


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_words, n_base, first_word, last_word,
    base_labels, labels, score (largest covered share of a template; 1 with a
    name) and the covered template ``spans`` in words."""
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    return map_arrow(source, scanner, f"doc_id {kind}, n_words long, n_base long, first_word long, last_word long, "
                     "base_labels string, labels string, score double, "
                     "spans array<struct<label:string,first:long,last:long,covered:double>>")
