"""License notices by Dice coefficient over word bigrams.

Text and templates are normalised to lower-case words of letters and digits. A document's
sentences (cut at line ends and after ``. ; ! ?`` before white space) are units; every run of
consecutive units, and then every run of words that these leave free, is compared with every
template whose size allows it: with a threshold ``t`` the sets' sizes may differ by a factor of
``(2 - t) / t`` at most, which bounds the runs that are looked at. A run may say things twice, but
has at most twice the words that this factor allows: a notice repeated any number of times is
that many matches, and the work grows with the text. Of the runs at or over the threshold those stay, as long as they do
not overlap, whose shared bigrams outnumber their others by most, then those with the highest
coefficient, so that a text is not named by the part that it has in common with another. A
run of words inside sentences must hold its template's numbers as well.

A run that reaches the threshold shares at least ``t / (2 - t)`` of a template's bigrams, so it
holds one of any larger share of them: documents without such a bigram of any template are
passed over by a test that misses none.

Defined cases: null and empty texts have no match; very long ones are scanned whole, in one task,
in time that grows with their words; a null id is kept; repeated rows are scanned each; ties go
to the longer run, then to the earlier, then to the template named first; no documents give no
rows; other columns, whatever their names, are not looked at.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import accumulate

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import column

LEAST = 0.8
REPEATS = 2  # a run has at most so many times the words that its template's size allows
SHAPE = "array<struct<license: string, dice: double, start: int, end: int>>"
_WORD = re.compile(r"[^\W_]+")
_UNIT = re.compile(r"(?:[^\n.;!?]|[.;!?](?!\s|$))+[.;!?]*")

_AS_IS = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR '
    "IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND "
    "FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR "
    "CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL "
    "DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, "
    "DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER "
    "IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT "
    "OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted "
    "provided that the following conditions are met: Redistributions of source code must retain the "
    "above copyright notice, this list of conditions and the following disclaimer. Redistributions in "
    "binary form must reproduce the above copyright notice, this list of conditions and the following "
    "disclaimer in the documentation and/or other materials provided with the distribution. "
)
_BSD_NAME = (
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse "
    "or promote products derived from this software without specific prior written permission. "
)
_ISC = " distribute this software for any purpose with or without fee is hereby granted"
_ISC_AS_IS = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS '
    "SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE "
    "AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES "
    "WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, "
    "NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE "
    "OF THIS SOFTWARE."
)


def _gnu(kind: str, version: str, later: bool, mark: str = ",", what: str = "program") -> str:
    """The notice that the GNU licenses propose for files."""
    which = f"either version {version} of the License, or (at your option) any later version."
    return (
        f"This {what} is free software: you can redistribute it and/or modify it under the terms of the "
        f"GNU {kind}General Public License as published by the Free Software Foundation{mark} "
        + (which if later else f"version {version} of the License.")
    )


# Notices that authors put into files, by license.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file '
        "except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0. Unless required by applicable law or agreed to "
        'in writing, software distributed under the License is distributed on an "AS IS" BASIS, '
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License "
        "for the specific language governing permissions and limitations under the License.",
    ),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        'software and associated documentation files (the "Software"), to deal in the Software '
        "without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons "
        "to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial "
        "portions of the Software.",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0-or-later",
        "This program is free software: you can redistribute it and/or modify it under the terms of "
        "the GNU General Public License as published by the Free Software Foundation, either version "
        "3 of the License, or (at your option) any later version.",
    ),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    (
        "GPL-2.0-or-later",
        "This program is free software; you can redistribute it and/or modify it under the terms of "
        "the GNU General Public License as published by the Free Software Foundation; either version "
        "2 of the License, or (at your option) any later version.",
    ),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a "
        "copy of the MPL was not distributed with this file, You can obtain one at "
        "https://mozilla.org/MPL/2.0/.",
    ),
    (
        "BSD-2-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met: Redistributions of source code "
        "must retain the above copyright notice, this list of conditions and the following "
        "disclaimer. Redistributions in binary form must reproduce the above copyright notice, this "
        "list of conditions and the following disclaimer in the documentation and/or other materials "
        "provided with the distribution.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice and this permission "
        "notice appear in all copies.",
    ),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    (
        "CC-BY-NC-4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International "
        "License.",
    ),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    (
        "CC-BY-4.0",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    (
        "CC-BY-SA-4.0",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International "
        "License.",
    ),
    (
        "Unlicense",
        "This is free and unencumbered software released into the public domain.",
    ),
    ("GPL-2.0-only", _gnu("", "2", False)),
    ("GPL-3.0-only", _gnu("", "3", False)),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("AGPL-3.0-only", _gnu("Affero ", "3", False)),
    ("AGPL-3.0-or-later", _gnu("Affero ", "3", True)),
    ("LGPL-2.1", "This work is licensed under the GNU Lesser General Public License, version 2.1."),
    ("LGPL-2.1-only", _gnu("Lesser ", "2.1", False, what="library")),
    ("LGPL-2.1-or-later", _gnu("Lesser ", "2.1", True, ";", "library")),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("LGPL-3.0-only", _gnu("Lesser ", "3", False)),
    ("LGPL-3.0-or-later", _gnu("Lesser ", "3", True)),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-3-Clause", _BSD + _BSD_NAME),
    ("BSD-2-Clause", _BSD + _AS_IS),
    ("BSD-3-Clause", _BSD + _BSD_NAME + _AS_IS),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        'software and associated documentation files (the "Software"), to deal in the Software '
        "without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons "
        "to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial "
        'portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, '
        "EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR "
        "A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE "
        "LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
        "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS "
        "IN THE SOFTWARE.",
    ),
    (
        "ISC",
        f"Permission to use, copy, modify, and/or{_ISC}, provided that the above copyright notice and "
        f"this permission notice appear in all copies. {_ISC_AS_IS}",
    ),
    ("0BSD", f"Permission to use, copy, modify, and/or{_ISC}. {_ISC_AS_IS}"),
    (
        "Zlib",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the "
        "authors be held liable for any damages arising from the use of this software. Permission is "
        "granted to anyone to use this software for any purpose, including commercial applications, and "
        "to alter it and redistribute it freely, subject to the following restrictions: The origin of "
        "this software must not be misrepresented; you must not claim that you wrote the original "
        "software. If you use this software in a product, an acknowledgment in the product documentation "
        "would be appreciated but is not required. Altered source versions must be plainly marked as "
        "such, and must not be misrepresented as being the original software. This notice may not be "
        "removed or altered from any source distribution.",
    ),
    (
        "EPL-2.0",
        "This program and the accompanying materials are made available under the terms of the Eclipse "
        "Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    ),
    (
        "EPL-1.0",
        "All rights reserved. This program and the accompanying materials are made available under the "
        "terms of the Eclipse Public License v1.0 which accompanies this distribution, and is available "
        "at http://www.eclipse.org/legal/epl-v10.html",
    ),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("CC0-1.0", "Licensed under CC0 1.0."),
    ("CC0-1.0", "Licensed under CC0 1.0 Universal."),
    (
        "CC0-1.0",
        "To the extent possible under law, the author(s) have dedicated all copyright and related and "
        "neighboring rights to this software to the public domain worldwide. This software is "
        "distributed without any warranty.",
    ),
    *[
        row
        for short, long in (
            ("BY-ND", "Attribution-NoDerivatives"),
            ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
            ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"),
        )
        for row in (
            (f"CC-{short}-4.0", f"Licensed under CC {short} 4.0."),
            (
                f"CC-{short}-4.0",
                f"This work is licensed under a Creative Commons {long} 4.0 International License.",
            ),
        )
    ],
    # How the texts of the long licenses begin.
    *[
        (
            name,
            f"GNU {kind}GENERAL PUBLIC LICENSE Version {version}, {date} Copyright (C) {years} Free Software "
            "Foundation, Inc. Everyone is permitted to copy and distribute verbatim copies of this license "
            "document, but changing it is not allowed.",
        )
        for name, kind, version, date, years in (
            ("GPL-2.0", "", "2", "June 1991", "1989, 1991"),
            ("GPL-3.0", "", "3", "29 June 2007", "2007"),
            ("AGPL-3.0", "AFFERO ", "3", "19 November 2007", "2007"),
            ("LGPL-2.1", "LESSER ", "2.1", "February 1999", "1991, 1999"),
            ("LGPL-3.0", "LESSER ", "3", "29 June 2007", "2007"),
        )
    ],
    (
        "Apache-2.0",
        "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR "
        "USE, REPRODUCTION, AND DISTRIBUTION",
    ),
    (
        "EPL-2.0",
        "Eclipse Public License - v 2.0 THE ACCOMPANYING PROGRAM IS PROVIDED UNDER THE TERMS OF THIS ECLIPSE "
        'PUBLIC LICENSE ("AGREEMENT"). ANY USE, REPRODUCTION OR DISTRIBUTION OF THE PROGRAM CONSTITUTES '
        "RECIPIENT'S ACCEPTANCE OF THIS AGREEMENT.",
    ),
]
# The short form that names a license by its identifier.
TEMPLATES += [
    (name, f"SPDX-License-Identifier: {name}") for name in sorted({name for name, _ in TEMPLATES})
]


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def bigrams(some: list[str]) -> set[tuple[str, str]]:
    return set(zip(some, some[1:], strict=False))


def dice(a: set, b: set) -> float:
    return 2 * len(a & b) / (len(a) + len(b)) if a or b else 0.0


class Scanner:
    def __init__(self, templates: list[tuple[str, str]] = TEMPLATES, least: float = LEAST):
        self.least = least
        self.share = least / (2 - least)
        self.templates = [(name, bigrams(words(text))) for name, text in templates]
        self.longest = [int(REPEATS * len(words(text)) / self.share) for _, text in templates]
        self.numbers = [
            {word for pair in of for word in pair if not word.isalpha()} for _, of in self.templates
        ]
        self.holders: dict[tuple[str, str], list[int]] = {}
        # Of each template so many bigrams that a match holds one of them; long words are rare.
        self.anchors: dict[str, set[str]] = {}
        for number, (_, of) in enumerate(self.templates):
            for pair in of:
                self.holders.setdefault(pair, []).append(number)
            need = int((1 - self.share) * len(of) + 1e-9) + 1
            for a, b in sorted(of, key=lambda x: (-len(x[0]) - len(x[1]), x))[:need]:
                self.anchors.setdefault(a, set()).add(b)

    def hopeful(self, some: list[str]) -> bool:
        held = set(some)
        return any(not held.isdisjoint(self.anchors[a]) for a in self.anchors.keys() & held)

    def _hits(self, pairs: list[tuple[str, str]], free: list[bool]) -> dict[int, list[int]]:
        """Where a template's bigrams lie, of the templates of which enough different ones do."""
        places: dict[int, list[int]] = {}
        for at, pair in enumerate(pairs):
            if free[at] and free[at + 1]:
                for number in self.holders.get(pair, ()):
                    places.setdefault(number, []).append(at)
        return {
            number: at
            for number, at in places.items()
            if len({pairs[i] for i in at}) >= self.share * len(self.templates[number][1]) - 1e-9
        }

    def _best(self, number: int, pairs: list, some: list[str], begin: int, ends: list[int], free: list[bool], whole: bool):
        """The best run of free words over the threshold from a place to one of the given ends: less
        what it gains (the shared bigrams less the others), less the coefficient, less its words,
        the places, and the template. ``whole``: it holds the template's numbers."""
        of = self.templates[number][1]
        missing = set(self.numbers[number]) if whole else set()
        held: set[tuple[str, str]] = set()
        shared, at, best = 0, begin, None
        for place in range(bisect_left(ends, begin + 2), len(ends)):
            end = ends[place]
            if end - begin > self.longest[number] or not all(free[at:end]):
                break
            for i in range(at, end - 1):
                if pairs[i] not in held:
                    held.add(pairs[i])
                    shared += pairs[i] in of
            if len(held) > len(of) / self.share + 1e-9:
                break
            if missing:
                missing.difference_update(some[at:end])
            at = end - 1
            score = 2 * shared / (len(held) + len(of))
            if score >= self.least and not missing:
                run = (len(held) - 2 * shared, -score, begin - end, begin, end, number)
                best = min(best, run) if best else run
        return best

    def _settled(self, places: dict[int, tuple], pairs: list, some: list[str], free: list[bool], whole: bool):
        """The runs that stay, as coefficient, places and license, in their order; their words are
        no longer free. ``places``: begins and ends by template. A begin whose best run has been
        overlapped comes again with the best of what is left to it, which is never better."""

        def best(number: int, begin: int):
            return self._best(number, pairs, some, begin, places[number][1], free, whole)

        waiting = [run for number, (begins, _) in places.items() for b in begins if (run := best(number, b))]
        heapify(waiting)
        kept = []
        while waiting:
            _, score, _, begin, end, number = heappop(waiting)
            if all(free[begin:end]):
                kept.append((-score, begin, end, self.templates[number][0]))
                free[begin:end] = [False] * (end - begin)
            elif free[begin] and (run := best(number, begin)):
                heappush(waiting, run)
        return sorted(kept, key=lambda m: m[1])

    def scan(self, text: str) -> list[dict]:
        if not self.hopeful(words(text)):
            return []
        units = [(m.start(), m.end(), words(m.group())) for m in _UNIT.finditer(text)]
        units = [u for u in units if u[2]]
        some = [word for _, _, more in units for word in more]
        unit = [i for i, (_, _, more) in enumerate(units) for _ in more]
        firsts = [0, *accumulate(len(more) for _, _, more in units)]
        pairs = list(zip(some, some[1:], strict=False))
        free = [True] * len(some)
        places = {}
        for number, hits in self._hits(pairs, free).items():
            # A run does better without a unit at its end that adds no bigram of the template.
            begins = [firsts[i] for i in sorted({unit[at] for at in hits})]
            places[number] = begins, [firsts[i + 1] for i in sorted({unit[at + 1] for at in hits})]
        matches = []
        for score, begin, end, name in self._settled(places, pairs, some, free, False):
            start, stop = units[unit[begin]][0], units[unit[end - 1]][1]
            matches.append({"license": name, "dice": score, "start": start, "end": stop})
        inside = self._inside(some, pairs, free)
        if inside:
            at = [m.span() for m in _WORD.finditer(text) for _ in words(m.group())]
            for score, begin, end, name in inside:
                matches.append({"license": name, "dice": score, "start": at[begin][0], "end": at[end - 1][1]})
        return sorted(matches, key=lambda m: m["start"])

    def _inside(self, some: list[str], pairs: list[tuple[str, str]], free: list[bool]) -> list[tuple]:
        """Runs of any free words, that hold their template's numbers: a license of another
        version differs by little else, and a run could leave that out."""
        # A run does better without a word at its end that is in no bigram of the template.
        places = {n: (hits, [at + 2 for at in hits]) for n, hits in self._hits(pairs, free).items()}
        return self._settled(places, pairs, some, free, True)


def scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    templates: list[tuple[str, str]] = TEMPLATES,
    least: float = LEAST,
) -> DataFrame:
    """Per row: ``doc_id``, ``n_matches``, the best match's ``license`` and ``dice``, and all
    ``matches`` with the characters they span."""
    scanner = Scanner(templates, least)

    def scanned(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            matches = [scanner.scan(text) for text in frame["text"]]
            best = [max(m, key=lambda x: x["dice"]) if m else {} for m in matches]
            yield pd.DataFrame(
                {
                    "doc_id": frame["doc_id"].astype("Int64"),
                    "n_matches": [len(m) for m in matches],
                    "license": [b.get("license") for b in best],
                    "dice": pd.Series([b.get("dice") for b in best], dtype="Float64"),
                    "matches": matches,
                }
            )

    narrow = docs.select(
        column(docs, id_col).cast("long").alias("doc_id"),
        F.coalesce(column(docs, text_col), F.lit("")).alias("text"),
    )
    schema = f"doc_id long, n_matches int, license string, dice double, matches {SHAPE}"
    return narrow.mapInPandas(scanned, schema)
