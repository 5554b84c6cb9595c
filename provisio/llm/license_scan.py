"""License scans with a generalised suffix automaton (operator 2).

The automaton holds every run of words of every template. A text is streamed
through it once: at each word it gives the longest run ending there that
occurs in some template (matching statistics). Runs that cannot be extended
and have at least ``MIN_RUN`` words are chained, template by template, in the
order of both text and template and with short gaps; a chain that covers
enough of its template is a span.

The automaton is built from fixed templates, so its size is fixed; it is
built once in each worker.

Templates are notices and openings, which mark a licence by themselves, and
the whole terms of short licences and whole notices, found although they are edited. Where terms
share a passage, each is a template of its own and none is marked by the
passage alone.

Edge cases: a null or empty text has no words, no spans, empty labels and
score 0. A very long text is scanned whole, in one pass. Of chains that cover as
many words the first in the text is taken; spans are sorted by place and label. A text that is one template many times gives one span for each copy.
Repeated rows are scanned alike. An empty table gives no rows. Extra columns
are dropped unless named in ``keep``; a result replaces one of its name.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame

from .common import fresh, kept_fields, map_batches, utf8

# Phrases whose every place is counted, with their labels.
BASE_PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Licence notices and openings by label.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "mit": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions:",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of "
        "the Software.",
    ),
    "apache": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with "
        "the License. You may obtain a copy of the License at",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on "
        "an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
        "version.",
        "You should have received a copy of the GNU General Public License along with this program.",
    ),
    "lgpl": ("under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",),
    "agpl": ("under the terms of the GNU Affero General Public License as published by the Free Software Foundation",),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met:",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
        "derived from this software without specific prior written permission.",
        "Licensed under the BSD License.",
    ),
    "mpl": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",),
    "isc": ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies.",),
    "unlicense": ("This is free and unencumbered software released into the public domain.",),
    "cc-by": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "cc-by-sa": ("Licensed under CC BY-SA 4.0.",
                 "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "cc-by-nc": ("Licensed under CC BY-NC 4.0.",
                 "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "cc-by-nd": ("Licensed under CC BY-ND 4.0.",),
    "cc0": ("Licensed under CC0 1.0 Universal.", "dedicated to the public domain under CC0 1.0 Universal"),
}

# The terms of short licences and the notices of long ones, in full, by label.
BODIES: dict[str, tuple[str, ...]] = {
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions: "
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of "
        "the Software. "
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
        "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
        "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
        "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: "
        "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
        "disclaimer. "
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
        "disclaimer in the documentation and/or other materials provided with the distribution. "
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
        "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
        "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
        "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
        "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
        "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF "
        "THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies. "
        "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL "
        "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
        "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN "
        "ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF "
        "THIS SOFTWARE.",
    ),
    "zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable "
        "for any damages arising from the use of this software. "
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it "
        "and redistribute it freely, subject to the following restrictions: "
        "1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If "
        "you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not "
        "required. "
        "2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original "
        "software. "
        "3. This notice may not be removed or altered from any source distribution.",
    ),
    "boost": (
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and "
        "accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, "
        "and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the "
        "Software is furnished to do so, all subject to the following: "
        "The copyright notices in the Software and this entire statement, including the above license grant, this restriction and "
        "the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works "
        "of the Software, unless such copies or derivative works are solely in the form of machine-executable object code "
        "generated by a source language processor. "
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
        "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE "
        "COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, "
        "TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    "unlicense": (
        "This is free and unencumbered software released into the public domain. "
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or "
        "as a compiled binary, for any purpose, commercial or non-commercial, and by any means. "
        "In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright "
        "interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the "
        "detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of "
        "all present and future rights to this software under copyright law. "
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
        "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE "
        "LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT "
        "OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    "apache": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with "
        "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 "
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on "
        "an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the "
        "specific language governing permissions and limitations under the License.",
    ),
    "gpl": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
        "version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
        "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more "
        "details. You should have received a copy of the GNU General Public License along with this program. If not, see "
        "<https://www.gnu.org/licenses/>.",
    ),
}

ALL_TEMPLATES = {label: TEMPLATES.get(label, ()) + BODIES.get(label, ()) for label in TEMPLATES | BODIES}

MIN_RUN = 3           # shortest run of words that takes part in a chain
MAX_GAP = 12          # words between two runs of a chain, in text and in template
MIN_COVERED = 0.75    # share of a template's words that makes a span

_SEPARATORS = bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
_TO_SPACE = bytes.maketrans(_SEPARATORS, b" " * len(_SEPARATORS))


def words_of(text: bytes) -> list[bytes]:
    """ASCII-lower-cased words: letters a-z, digits and everything beyond ASCII."""
    return text.lower().translate(_TO_SPACE).split()


class SuffixAutomaton:
    """Generalised over several token sequences; every state knows all places
    (template, end) of its runs."""

    def __init__(self, sequences: Sequence[Sequence[int]]) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.places: list[set[tuple[int, int]]] = [set()]
        for t, sequence in enumerate(sequences):
            at = 0
            for end, token in enumerate(sequence, 1):
                at = self._extend(at, token)
                self.places[at].add((t, end))
        for state in sorted(range(1, len(self.link)), key=self.length.__getitem__, reverse=True):
            if self.link[state] > 0:
                self.places[self.link[state]] |= self.places[state]

    def _state(self, length: int, edges: dict[int, int], link: int) -> int:
        self.next.append(edges)
        self.link.append(link)
        self.length.append(length)
        self.places.append(set())
        return len(self.link) - 1

    def _split(self, upper: int, token: int, lower: int) -> int:
        """Copy ``lower`` for the runs that end in ``token`` after ``upper``."""
        copy = self._state(self.length[upper] + 1, dict(self.next[lower]), self.link[lower])
        self.link[lower] = copy
        while upper >= 0 and self.next[upper].get(token) == lower:
            self.next[upper][token] = copy
            upper = self.link[upper]
        return copy

    def _extend(self, at: int, token: int) -> int:
        known = self.next[at].get(token)
        if known is not None:        # an earlier template has this run already
            return known if self.length[known] == self.length[at] + 1 else self._split(at, token, known)
        new = self._state(self.length[at] + 1, {}, 0)
        while at >= 0 and token not in self.next[at]:
            self.next[at][token] = new
            at = self.link[at]
        if at >= 0:
            lower = self.next[at][token]
            self.link[new] = lower if self.length[lower] == self.length[at] + 1 else self._split(at, token, lower)
        return new

    def runs(self, tokens: Sequence[int], least: int) -> list[tuple[int, int, int]]:
        """(end, length, state) of the runs that the next word cannot extend."""
        out, state, n = [], 0, 0
        for i, token in enumerate(tokens):
            before, length = state, n
            while state and token not in self.next[state]:
                state = self.link[state]
                n = self.length[state]
            if token in self.next[state]:
                state, n = self.next[state][token], n + 1
            else:
                state, n = 0, 0
            if n <= length and length >= least:
                out.append((i, length, before))
        if n >= least:
            out.append((len(tokens), n, state))
        return out


class Scanner:
    """The automaton of a template set with its vocabulary."""

    def __init__(self, templates: dict[str, tuple[str, ...]], phrases: dict[str, str]) -> None:
        self.labels, sequences = [], []
        self.vocabulary: dict[bytes, int] = {}
        number = lambda text: [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words_of(text.encode())]
        for label, texts in templates.items():
            for text in texts:
                self.labels.append(label)
                sequences.append(number(text))
        self.phrases = [(number(phrase), label) for phrase, label in phrases.items()]
        self.sizes = [len(s) for s in sequences]
        self.automaton = SuffixAutomaton(sequences)

    def scan(self, text: bytes) -> dict:
        words = words_of(text)
        known = self.vocabulary.get
        codes = np.array([known(w, -1) for w in words], dtype=np.int32)
        starts, base = [], set()
        for phrase, label in self.phrases:
            here = np.flatnonzero(codes[:max(0, len(codes) - len(phrase) + 1)] == phrase[0])
            for k, token in enumerate(phrase[1:], 1):
                here = here[codes[here + k] == token]
            if len(here):
                starts += here.tolist()
                base.add(label)
        spans, best = self._spans(codes)
        return {"n_words": len(words), "n_base": len(starts), "first_word": min(starts, default=None),
                "last_word": max(starts, default=None), "base_labels": ",".join(sorted(base)),
                "labels": ",".join(sorted(base | {s["label"] for s in spans})),
                "score": 1.0 if base else best, "spans": spans}

    def _spans(self, codes: np.ndarray) -> tuple[list[dict], float]:
        """Accepted spans, and the best coverage of any chain."""
        in_template = np.concatenate(([0], (codes >= 0).astype(np.int8), [0]))
        edges = np.flatnonzero(np.diff(in_template))
        pieces: dict[int, list[tuple[int, int, int]]] = {}      # template -> (text start, template start, length)
        for lo, hi in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if hi - lo < MIN_RUN:
                continue
            for end, n, state in self.automaton.runs(codes[lo:hi].tolist(), MIN_RUN):
                for t, t_end in self.automaton.places[state]:
                    pieces.setdefault(t, []).append((lo + end - n, t_end - n, n))
        spans, best = [], 0.0
        for t, found in pieces.items():
            for start, end, covered in self._chains(sorted(found)):
                share = min(1.0, covered / self.sizes[t])
                best = max(best, share)
                if share >= MIN_COVERED:
                    spans.append({"label": self.labels[t], "start": start, "end": end, "covered": share})
        return sorted(spans, key=lambda s: (s["start"], s["end"], s["label"])), best

    @staticmethod
    def _chains(found: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        """(text start, text end, words covered) of maximal chains: each run
        follows the best earlier one that ends before it, within the gap."""
        covered, back = [], []
        window = 0
        longest = max(n for _, _, n in found)
        for i, (text_at, tpl_at, n) in enumerate(found):
            while found[window][0] + longest + MAX_GAP < text_at:
                window += 1
            best, prev = 0, -1
            for j in range(window, i):
                a, b, m = found[j]
                if a + m <= text_at <= a + m + MAX_GAP and b + m <= tpl_at <= b + m + MAX_GAP and covered[j] > best:
                    best, prev = covered[j], j
            covered.append(best + n)
            back.append(prev)
        used, out = set(), []
        for i in sorted(range(len(found)), key=lambda i: (-covered[i], i)):
            if i in used:
                continue
            end, total, at = found[i][0] + found[i][2], covered[i], i
            while True:
                used.add(at)
                if back[at] < 0:
                    break
                if back[at] in used:
                    total -= covered[back[at]]
                    break
                at = back[at]
            out.append((found[at][0], end, total))
        return out


@lru_cache(maxsize=4)
def _scanner(templates: tuple, phrases: tuple) -> Scanner:
    return Scanner(dict(templates), dict(phrases))


RESULT = ("n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
          "spans array<struct<label: string, start: long, end: long, covered: double>>")


def scan_licenses(docs: DataFrame, *, keep: Sequence[str] = ("doc_id",), templates: dict[str, tuple[str, ...]] | None = None,
                  phrases: dict[str, str] | None = None) -> DataFrame:
    """The ``keep`` columns with base phrase places, labels, score and spans."""
    fixed = tuple((templates or ALL_TEMPLATES).items()), tuple((phrases or BASE_PHRASES).items())
    own, schema = kept_fields(docs, keep, RESULT)
    (body,) = fresh(docs.select(*own), "scanned_text")
    names = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans")

    def run(batches):
        scan = _scanner(*fixed).scan
        for b in batches:
            rows = [scan(t) for t in b.pop(body)]
            yield b | {c: [r[c] for r in rows] for c in names}

    return map_batches(docs.select(*own, utf8().alias(body)), run, schema)
