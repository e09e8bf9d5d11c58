"""License scans by conditional compression: templates that make a stretch of words smaller are confirmed by its exact wording."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import deque
from collections.abc import Iterator, Sequence
from difflib import SequenceMatcher
from typing import NamedTuple

import ahocorasick
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import with_columns


class Template(NamedTuple):
    license: str
    #: words without which it is not this license
    must: tuple[str, ...]
    text: str


# Wordings of license statements, notices and whole short licenses.
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. ",
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. ",
    """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
)
_ISC = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
_HOPE = " This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."
_GNU = "This {0} is free software: you can redistribute it and/or modify it under the terms of the GNU {1} as published by the Free Software Foundation, either version {2} of the License, or (at your option) any later version."
TEMPLATES = (
    Template("MIT", ("mit",), "Released under the MIT License."),
    Template("MIT", ("permission", "sublicense", "noninfringement"), """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."""),
    Template("Apache-2.0", ("apache", "2.0"), "Licensed under the Apache License, Version 2.0."),
    Template("Apache-2.0", ("apache", "2.0", "compliance"), """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."""),
    Template("GPL-3.0", ("gnu", "general", "3"), "This work is licensed under the GNU General Public License, version 3."),
    Template("GPL-3.0", ("gnu", "general", "3", "redistribute"), _GNU.format("program", "General Public License", "3")),
    Template("GPL-3.0", ("gnu", "general", "3", "redistribute", "hope"), _GNU.format("program", "General Public License", "3") + _HOPE + " See the GNU General Public License for more details. You should have received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>."),
    Template("GPL-2.0", ("gnu", "general", "2"), "This work is licensed under the GNU General Public License, version 2."),
    Template("GPL-2.0", ("gnu", "general", "2", "redistribute"), _GNU.format("program", "General Public License", "2")),
    Template("GPL-2.0", ("gnu", "general", "2", "redistribute", "hope"), _GNU.format("program", "General Public License", "2") + _HOPE + " See the GNU General Public License for more details."),
    Template("LGPL-2.1", ("gnu", "lesser", "2.1"), "This work is licensed under the GNU Lesser General Public License, version 2.1."),
    Template("LGPL-2.1", ("gnu", "lesser", "2.1", "redistribute"), _GNU.format("library", "Lesser General Public License", "2.1")),
    Template("LGPL-3.0", ("gnu", "lesser", "3"), "This work is licensed under the GNU Lesser General Public License, version 3."),
    Template("LGPL-3.0", ("gnu", "lesser", "3", "redistribute"), _GNU.format("library", "Lesser General Public License", "3")),
    Template("AGPL-3.0", ("gnu", "affero", "3"), "This work is licensed under the GNU Affero General Public License, version 3."),
    Template("AGPL-3.0", ("gnu", "affero", "3", "redistribute"), _GNU.format("program", "Affero General Public License", "3")),
    Template("MPL-2.0", ("mozilla", "2.0"), "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    Template("MPL-2.0", ("mozilla", "2.0", "mpl"), "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    Template("BSD-3-Clause", ("bsd", "3-clause"), "Released under the BSD 3-Clause License."),
    Template("BSD-3-Clause", ("redistribution", "binary", "disclaimer", "endorse"), "".join(_BSD)),
    Template("BSD-2-Clause", ("bsd", "2-clause"), "Released under the BSD 2-Clause License."),
    Template("BSD-2-Clause", ("redistribution", "binary", "disclaimer"), _BSD[0] + _BSD[2]),
    Template("ISC", ("permission", "fee", "notice"), _ISC),
    Template("ISC", ("permission", "fee", "notice", "tortious"), _ISC + """ THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    Template("Zlib", ("permission", "misrepresented", "altered"), "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution."),
    Template("BSL-1.0", ("boost", "1.0"), "Distributed under the Boost Software License, Version 1.0."),
    Template("EPL-2.0", ("eclipse", "2.0"), "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0."),
    Template("CC-BY-4.0", ("cc", "by", "4.0"), "Licensed under CC BY 4.0."),
    Template("CC-BY-4.0", ("creative", "attribution", "4.0"), "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    Template("CC-BY-SA-4.0", ("cc", "by-sa", "4.0"), "Licensed under CC BY-SA 4.0."),
    Template("CC-BY-SA-4.0", ("creative", "attribution-sharealike", "4.0"), "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    Template("CC-BY-NC-4.0", ("cc", "by-nc", "4.0"), "Licensed under CC BY-NC 4.0."),
    Template("CC-BY-NC-4.0", ("creative", "attribution-noncommercial", "4.0"), "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    Template("CC-BY-ND-4.0", ("cc", "by-nd", "4.0"), "Licensed under CC BY-ND 4.0."),
    Template("CC-BY-ND-4.0", ("creative", "attribution-noderivatives", "4.0"), "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
    Template("CC0-1.0", ("cc0",), "Dedicated to the public domain under CC0 1.0."),
    Template("Unlicense", ("public", "domain", "unencumbered"), "This is free and unencumbered software released into the public domain."),
    Template("Unlicense", ("public", "domain", "unencumbered", "compile"), "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
) + tuple(
    Template(f"CC-{kind.upper()}-3.0", must, text)
    for kind, long in (("by", "Attribution"), ("by-sa", "Attribution-ShareAlike"), ("by-nc", "Attribution-NonCommercial"), ("by-nd", "Attribution-NoDerivatives"))
    for must, text in ((("cc", kind, "3.0"), f"Licensed under CC {kind.upper()} 3.0."), (("creative", long.lower(), "3.0"), f"This work is licensed under a Creative Commons {long} 3.0 Unported License."))
) + tuple(Template(name, must, text) for name, must, text in (
    ("Apache-2.0", ("apache", "2.0"), "Licensed under Apache 2.0."), ("MIT", ("mit",), "Licensed under the MIT license."),
    ("GPL-3.0", ("gpl", "v3"), "Licensed under GPL v3."), ("GPL-3.0", ("gplv3",), "Licensed under GPLv3."), ("GPL-2.0", ("gpl", "v2"), "Licensed under GPL v2."), ("GPL-2.0", ("gplv2",), "Licensed under GPLv2."),
)) + tuple(
    Template(name.removesuffix("-only").removesuffix("-or-later"), ("spdx-license-identifier", name.lower()), f"SPDX-License-Identifier: {name}")
    for name in (
        "MIT", "Apache-2.0", "GPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0", "GPL-3.0-only", "GPL-3.0-or-later", "LGPL-2.1", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0", "LGPL-3.0-only", "LGPL-3.0-or-later",
        "AGPL-3.0", "AGPL-3.0-only", "AGPL-3.0-or-later", "MPL-2.0", "BSD-2-Clause", "BSD-3-Clause", "ISC", "Zlib", "BSL-1.0", "EPL-2.0", "Unlicense", "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0", "CC-BY-ND-4.0",
    )
)
# Where one of these stands, a block begins to be looked at.
KEYWORDS = ("licen", "copyright", "permission", "warrant", "redistribut", "public domain", "creative commons", "cc by", "cc0")

#: Keywords nearer than this are one block (code points).
JOIN = 400
#: A block reaches so far before its first and behind its last keyword, whatever lines end there: half as much again as the longest template.
MARGIN = max(len(t.text) for t in TEMPLATES) * 3 // 2
#: What share of a template's words a stretch must have, in order; what share of a template's own reduction it must have to be compared
#: at all; and how near to the greatest reduction of a place others must come to be compared with it.
MIN_SHARE, FLOOR, NEAR = 0.8, 0.25, 0.5
#: Blocks whose licenses a task keeps, and the longest one that it keeps (code points).
KEPT, KEPT_LENGTH = 4096, 8192

#: Keywords of several words, over any white space.
_APART = re.compile("|".join(r"\s+".join(map(re.escape, w.split())) for w in KEYWORDS if " " in w))
_WORD = re.compile(r"[0-9a-z]+(?:[.\-+][0-9a-z]+)*")
_BROKEN = re.compile(r"-[ \t]*\r?\n[ \t]*")


def words_of(text: str) -> list[str]:
    """Words in lower case; one that a line end cuts behind its hyphen is one word."""
    return _WORD.findall(_BROKEN.sub("-", text.lower()))


class Place(NamedTuple):
    """Where a template may stand: words from low on up to high; saved: bytes that it takes off their compressed size."""

    saved: int
    plain: int
    template: int
    low: int
    high: int


def _compressor(text: str | None = None) -> zstandard.ZstdCompressor:
    """Fast matches of four bytes and plain literals: a reduction is then the bytes found in the dictionary, whatever else stands around."""
    how = zstandard.ZstdCompressionParameters(window_log=17, hash_log=14, chain_log=14, search_log=1, min_match=4, target_length=1, strategy=zstandard.STRATEGY_FAST, write_content_size=False)
    given = zstandard.ZstdCompressionDict(text.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT) if text else None
    return zstandard.ZstdCompressor(compression_params=how, dict_data=given)


def _size(compressor: zstandard.ZstdCompressor, words: Sequence[str]) -> int:
    return len(compressor.compress(" ".join(words).encode("utf-8", "surrogatepass")))


class Scanner:
    """Templates as raw dictionaries, and the keyword automaton; made once for each task."""

    def __init__(self, templates: Sequence[Template] = TEMPLATES) -> None:
        self.plain = _compressor()
        self.templates, self.own = [], []
        for t in templates:
            words = words_of(t.text)
            self.templates.append((t, words, _compressor(" ".join(words))))
            self.own.append(_size(self.plain, words) - _size(self.templates[-1][2], words))
        self.musts = frozenset(w for t in templates for w in t.must)
        self.keywords = ahocorasick.Automaton()
        for w in KEYWORDS:
            if " " not in w:
                self.keywords.add_word(w, len(w))
        self.keywords.make_automaton()
        self.known: dict[str, list[tuple]] = {}

    def blocks(self, text: str) -> list[tuple[int, int]]:
        """Stretches around keywords, in code points."""
        low = text.lower()
        if len(low) != len(text):
            low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
        out: list[list[int]] = []
        hits = [(end + 1 - n, end + 1) for end, n in self.keywords.iter(low)]
        hits = sorted(hits + [m.span() for m in _APART.finditer(low)], key=lambda x: (x[1], x[0]))
        for a, b in hits:
            if out and a - out[-1][1] <= JOIN:
                out[-1][1] = max(b, out[-1][1])
            else:
                out.append([a, b])
        spans: list[tuple[int, int]] = []
        for a, b in out:
            a, b = max(a - MARGIN, 0), min(b + MARGIN, len(text))
            if spans and a < spans[-1][1]:  # a notice may lie across both
                spans[-1] = (spans[-1][0], b)
            else:
                spans.append((a, b))
        return spans

    def ranked(self, have: list[str]) -> list[Place]:
        """Every place around a template's rarest `must` word that has its others as well, if the template as a dictionary takes
        off FLOOR of what it takes off itself; greatest reductions first.
        """
        at: dict[str, list[int]] = {}
        for p, w in enumerate(have):
            if w in self.musts:
                at.setdefault(w, []).append(p)
        sizes: dict[tuple[int, int], int] = {}
        out = []
        for i, (t, want, given) in enumerate(self.templates):
            if any(w not in at for w in t.must):
                continue
            rare, far = min(t.must, key=lambda w: len(at[w])), len(want) + max(8, len(want) // 2)
            for p in at[rare]:
                low, high = max(p - far, 0), min(p + far + 1, len(have))
                if any(bisect_left(at[w], high) == bisect_left(at[w], low) for w in t.must):
                    continue
                words = have[low:high]
                if (low, high) not in sizes:
                    sizes[low, high] = _size(self.plain, words)
                if (saved := sizes[low, high] - _size(given, words)) >= FLOOR * self.own[i]:
                    out.append(Place(saved, sizes[low, high], i, low, high))
        return sorted(out, key=lambda x: (-x.saved, x.low, x.template))

    def _aligned(self, words: list[str], place: Place) -> tuple[tuple[float, int, int, str], int, int] | None:
        """(share, missing, extra, differences) of the template's words at a place, and where they begin and end; None: it is not this license."""
        (t, want, _), have = self.templates[place.template], words[place.low : place.high]
        if not frozenset(t.must) <= frozenset(have):
            return None
        same = [m for m in SequenceMatcher(None, want, have, autojunk=False).get_matching_blocks() if m.size]
        held = sum(m.size for m in same)
        if not held or held < MIN_SHARE * len(want) or not set(t.must) <= {w for m in same for w in want[m.a : m.a + m.size]}:
            return None
        first, last = same[0].b, same[-1].b + same[-1].size
        diff, a, b = [], 0, first
        for m in [*same, None]:
            gone = want[a : m.a if m else len(want)]
            come = have[b : m.b] if m else []
            if gone or come:
                diff.append(f"-{' '.join(gone)} +{' '.join(come)}")
            if m:
                a, b = m.a + m.size, m.b + m.size
        return (held / len(want), len(want) - held, last - first - held, "; ".join(diff)), place.low + first, place.low + last

    def verdicts(self, block: str) -> list[tuple]:
        """(license, template, reduction, share, missing, extra, differences) of each confirmed template, greatest reductions first.

        Down the ranking, the wording of a place is compared with its template, and with those of other templates whose reductions at
        words in common come NEAR. The best wording wins, and its words are taken out; a place that shared them is looked at
        again for what is left of it.
        """
        if block in self.known:
            return self.known[block]
        have, out = words_of(block), []
        ranking = self.ranked(have)
        starts = sorted(range(len(ranking)), key=lambda k: ranking[k].low)
        lows, longest, done = [ranking[k].low for k in starts], max((r.high - r.low for r in ranking), default=0), [False] * len(ranking)
        cost = lambda f, r: 2 * f[0][1] + f[0][2] - len(self.templates[r.template][1])
        todo = deque(range(len(ranking)))
        while todo:
            k = todo.popleft()
            if done[k]:
                continue
            r = ranking[k]
            if not (best := self._aligned(have, r)):
                done[k] = True
                continue
            winner = k
            for j in starts[bisect_left(lows, r.low - longest) : bisect_left(lows, best[2])]:
                o = ranking[j]
                if not done[j] and o.template != r.template and o.high > best[1] and o.saved >= NEAR * r.saved and (f := self._aligned(have, o)) and f[1] < best[2] and f[2] > best[1] and (cost(f, o), j) < (cost(best, ranking[winner]), winner):
                    best, winner = f, j
            w = ranking[winner]
            done[winner] = True
            out.append((self.templates[w.template][0].license, w.template, round(w.saved / w.plain, 6), *best[0]))
            have[best[1] : best[2]] = [""] * (best[2] - best[1])  # no word, so nothing is joined over the gap
            if winner != k:
                todo.appendleft(k)
        if len(block) <= KEPT_LENGTH:
            if len(self.known) >= KEPT:  # a cache, for lines that many documents have
                self.known.clear()
            self.known[block] = out
        return out

    def scan(self, text: str | None) -> list[tuple]:
        if not text:
            return []
        return [(a, b, *v) for a, b in self.blocks(text) for v in self.verdicts(text[a:b])]


KIND = "array<struct<start:bigint,end:bigint,license:string,template:int,reduction:double,share:double,missing:int,extra:int,differences:string>>"


def license_blocks(docs: DataFrame, text_col: str = "text", templates: Sequence[Template] = TEMPLATES) -> DataFrame:
    """Every row of docs with licenses, an array of confirmed blocks in their order.

    Keywords mark candidate blocks in whole texts. Around each place of a template's rarest `must` word that has its others as well, the
    block's words are compressed alone and with the template as a raw zstandard dictionary. Places are ranked by how much
    smaller that makes them; those below FLOOR of the template's own reduction are dropped. Down the ranking a place is
    confirmed if it has MIN_SHARE of the template's words in order, its `must` words among them; of several templates whose
    reductions come NEAR at the same words, the one with the fewest words missing (-) and put in (+) wins. Its words are taken
    out. start and end are the block's, `reduction` is the share of the place's compressed size. Work grows with the number of
    places. One pass, no shuffle. Null and empty texts have no blocks, very long ones as many as they have stretches with
    keywords; repeated rows are rows like others, an empty table gives an empty result, and a column `licenses` of docs gives way.
    """

    @F.pandas_udf(KIND)
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scanner = Scanner(templates)
        for texts in batches:
            yield texts.map(lambda t: scanner.scan(t) if isinstance(t, str) else [])

    return with_columns(docs, {"licenses": find(F.col(f"`{text_col}`").cast("string"))})


def license_rows(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row for each confirmed block."""
    return license_blocks(docs).select(F.col(f"`{id_col}`").alias("doc_id"), F.inline("licenses"))
