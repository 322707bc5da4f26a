"""License scans by patience alignment.

A text is taken in windows of twice a template's length, each half over the next,
so that every occurrence lies in one of them. A window is aligned with the
template if it holds enough of the template's distinct words. Words that stand
once in both are anchors; the longest increasing subsequence of their places is
kept, and the gaps between anchors are aligned in the same way, down to common
beginnings and ends. Coverage is the aligned share of the template's words. Words
that name a license, version or variant must agree.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from termloom.llm.common import LETTERS_AND_DIGITS, add_columns, byte_groups, words
from termloom.llm.decontaminate import word_bytes
from termloom.llm.license_texts import TEXTS

# Share of a template's words that must be aligned.
COVERAGE = 0.8

# Notices of public licenses. Each version and variant is a template of its own.
_LINES = {
    "AGPL-3.0": "the GNU Affero General Public License, version 3",
    "Apache-1.1": "the Apache Software License, Version 1.1",
    "Artistic-2.0": "the Artistic License 2.0",
    "BSD-2-Clause": "the BSD 2-Clause License",
    "BSD-3-Clause": "the BSD 3-Clause License",
    "BSL-1.0": "the Boost Software License, Version 1.0",
    **{
        f"CC-{kind}-{version}": f"CC {kind} {version}"
        for kind in ("BY", "BY-SA", "BY-ND", "BY-NC", "BY-NC-SA", "BY-NC-ND")
        for version in ("2.0", "2.5", "3.0", "4.0")
    },
    **{
        f"CC-{kind}-4.0 name": f"a Creative Commons {name} 4.0 International License"
        for kind, name in (
            ("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-ND", "Attribution-NoDerivatives"),
            ("BY-NC", "Attribution-NonCommercial"), ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
            ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"),
        )
    },
    "EPL-1.0": "the Eclipse Public License, version 1.0",
    "EPL-2.0": "the Eclipse Public License, version 2.0",
    "GPL-1.0": "the GNU General Public License, version 1",
    "GPL-2.0": "the GNU General Public License, version 2",
    "ISC": "the ISC License",
    "LGPL-2.0": "the GNU Library General Public License, version 2",
    "LGPL-2.1": "the GNU Lesser General Public License, version 2.1",
    "LGPL-3.0": "the GNU Lesser General Public License, version 3",
    "MPL-1.1": "the Mozilla Public License, version 1.1",
    "MPL-2.0": "the Mozilla Public License, version 2.0",
}
_SPDX = (
    "0BSD AGPL-3.0-only AGPL-3.0-or-later Apache-2.0 Artistic-2.0 BSD-2-Clause BSD-3-Clause BSL-1.0 CC0-1.0 CC-BY-4.0 "
    "CC-BY-SA-4.0 CC-BY-NC-4.0 CC-BY-ND-4.0 CC-BY-NC-SA-4.0 CC-BY-NC-ND-4.0 EPL-1.0 EPL-2.0 GPL-2.0-only "
    "GPL-2.0-or-later GPL-3.0-only GPL-3.0-or-later ISC LGPL-2.1-only LGPL-2.1-or-later LGPL-3.0-only "
    "LGPL-3.0-or-later MIT MIT-0 MPL-1.1 MPL-2.0 Unlicense WTFPL Zlib"
).split()


def _gnu(name: str, version: str) -> str:
    return (
        f"This program is free software: you can redistribute it and/or modify it under the terms of the GNU {name} "
        f"Public License as published by the Free Software Foundation, either version {version} of the License, or (at "
        "your option) any later version."
    )


_AS_IS = (
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO "
    "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
    "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, "
    "TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE "
    "SOFTWARE."
)
_MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
    "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
    "permit persons to whom the Software is furnished to do so"
)
_ISC = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
    "granted"
)
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
    "the following conditions are met"
)
_BSD_2 = (
    f"{_BSD}: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the "
    "following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of "
    "conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
)

TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 notice": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"
    ),
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MIT permission": _MIT[: _MIT.index(", including")],
    "BSD": _BSD,
    **{name: f"Licensed under {title}." for name, title in _LINES.items()},
    **{f"{name} identifier": f"SPDX-License-Identifier: {name}" for name in _SPDX},
    "AGPL-3.0 notice": _gnu("Affero General", "3"),
    "GPL-2.0 notice": _gnu("General", "2"),
    "GPL-3.0 notice": _gnu("General", "3"),
    "LGPL-2.0 notice": _gnu("Library General", "2"),
    "LGPL-2.1 notice": _gnu("Lesser General", "2.1"),
    "LGPL-3.0 notice": _gnu("Lesser General", "3"),
    "MPL-2.0 notice": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at"
    ),
    "BSD-2-Clause conditions": _BSD_2,
    "BSD-3-Clause conditions": (
        f"{_BSD_2} 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
        "promote products derived from this software without specific prior written permission."
    ),
    "ISC permission": f"{_ISC}, provided that the above copyright notice and this permission notice appear in all copies.",
    "0BSD permission": f"{_ISC}. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES",
    "MIT text": (
        f"{_MIT}, subject to the following conditions: The above copyright notice and this permission notice shall be "
        f"included in all copies or substantial portions of the Software. {_AS_IS}"
    ),
    "MIT-0 text": f"{_MIT}. {_AS_IS}",
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, "
        "use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any "
        "purpose, commercial or non-commercial, and by any means."
    ),
    **TEXTS,
}

# Words that tell licenses, versions and variants apart, besides numbers. A template's own must all be
# aligned, and no other may stand unaligned between aligned words; long templates tell by their wording.
KEYS = (
    "0bsd affero agpl apache artistic attribution boost bsd bsl cc cc0 eclipse epl gpl isc lesser lgpl library mit "
    "mozilla mpl nc nd noncommercial noderivatives noderivs sa sharealike unlicense wtfpl zlib"
).split() + [str(n) for n in range(100)]
# Words from which a template is long.
LONG = 100


def increasing(places: list[int]) -> list[int]:
    """Indices of a longest increasing subsequence."""
    tops, ends, before = [], [], []
    for i, place in enumerate(places):
        k = bisect_left(tops, place)
        tops[k : k + 1] = [place]
        ends[k : k + 1] = [i]
        before.append(ends[k - 1] if k else -1)
    out = []
    i = ends[-1] if ends else -1
    while i >= 0:
        out.append(i)
        i = before[i]
    return out[::-1]


def align(text: list, template: list) -> list[tuple[int, int]]:
    """Pairs of places of equal words, increasing in both."""
    pairs = []
    todo = [(0, len(text), 0, len(template))]
    while todo:
        a, b, c, d = todo.pop()
        while a < b and c < d and text[a] == template[c]:
            pairs.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and text[b - 1] == template[d - 1]:
            b, d = b - 1, d - 1
            pairs.append((b, d))
        if a == b or c == d:
            continue
        one, two = Counter(text[a:b]), Counter(template[c:d])
        where = {w: i for i, w in enumerate(text[a:b], a) if one[w] == 1}
        anchors = [(where[w], j) for j, w in enumerate(template[c:d], c) if two[w] == 1 and w in where]
        if not anchors:
            continue
        kept = [anchors[i] for i in increasing([i for i, _ in anchors])]
        for i, j in kept:
            todo.append((a, i, c, j))
            pairs.append((i, j))
            a, c = i + 1, j + 1
        todo.append((a, b, c, d))
    return sorted(pairs)


def scan(docs: DataFrame, templates: dict[str, str] | None = None, least: float = COVERAGE) -> DataFrame:
    """``docs`` with ``license, coverage, first_word, end_word, n_licenses``.

    The license is the template of largest coverage; of equal ones the one with
    fewest other words in between, then the longest, then the first by name. An
    alignment in which KEYS differ does not count. The words are the first place at which it is reached, end exclusive.
    ``n_licenses`` counts the templates covered by ``least`` or more. Without any,
    license and words are null and coverage is 0; so it is for null and empty
    texts. Templates without words are never found.
    """
    own = {n: word_bytes(t.encode()) for n, t in sorted((templates or TEMPLATES).items())}
    own = {n: w for n, w in own.items() if w}

    def start():
        numbers: dict[int, int] = {}
        coded = {}
        for name, parts in own.items():
            joined = b" ".join(parts)
            hashes, *_ = words(np.frombuffer(joined, np.uint8), np.array([0, len(joined)]), LETTERS_AND_DIGITS)
            coded[name] = [numbers.setdefault(int(h), len(numbers) + 1) for h in hashes]
        joined = " ".join(KEYS).encode()
        hashes, *_ = words(np.frombuffer(joined, np.uint8), np.array([0, len(joined)]), LETTERS_AND_DIGITS)
        keys = {numbers.setdefault(int(h), len(numbers) + 1) for h in hashes}
        known = np.array(sorted(numbers), np.uint64)
        codes = np.array([numbers[int(h)] for h in known], np.int64)
        size = len(numbers) + 1
        # The words of all templates, one template after the other, to see at once which ones a text may hold.
        flat = np.concatenate([np.array(t) for t in coded.values()]) if coded else np.zeros(0, np.int64)
        ends = np.cumsum([len(t) for t in coded.values()])
        wanted, own_keys = {}, {}
        for name, template in coded.items():
            wanted[name] = np.zeros(size, bool)
            wanted[name][template] = True
            # All words of an identifier tell it from others.
            every = name in TEMPLATES and name.endswith(" identifier")
            own_keys[name] = {j for j, w in enumerate(template) if every or w in keys} if len(template) < LONG else None

        def agree(name: str, text: list, pairs: list[tuple[int, int]]) -> bool:
            if own_keys[name] is None:
                return True
            inside = {i for i, _ in pairs}
            return own_keys[name] <= {j for _, j in pairs} and not any(
                text[i] in keys and i not in inside for i in range(pairs[0][0], pairs[-1][0])
            )

        def of_document(hashes: np.ndarray):
            if not len(hashes) or not len(flat):
                return None, 0.0, None, None, 0
            place = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
            text = np.where(known[place] == hashes, codes[place], 0)
            present = np.zeros(size, bool)
            present[text] = True
            held = np.append(0, np.cumsum(present[flat]))[ends]
            held = np.diff(held, prepend=0)
            best, count = ((0.0, 0, 0), None, None, None), 0
            for (name, template), least_words in zip(coded.items(), held.tolist()):
                m = len(template)
                if least_words < least * m:
                    continue
                sums = np.append(0, np.cumsum(wanted[name][text]))
                found = ((0.0, 0, 0), None, None)
                for at in (np.flatnonzero(
                    sums[np.minimum(np.arange(0, len(text), m) + 2 * m, len(text))] - sums[np.arange(0, len(text), m)]
                    >= least * m
                ) * m).tolist():
                    window = text[at : at + 2 * m].tolist()
                    inside = set(window)
                    if sum(w in inside for w in template) < least * m:
                        continue
                    pairs = align(window, template)
                    if not pairs or not agree(name, window, pairs):
                        continue
                    other = pairs[-1][0] + 1 - pairs[0][0] - len(pairs)
                    rank = (len(pairs) / m, -other, m)
                    if rank > found[0]:
                        found = (rank, at + pairs[0][0], at + pairs[-1][0] + 1)
                if found[0][0] >= least:
                    count += 1
                    if found[0] > best[0]:
                        best = (found[0], name, *found[1:])
            return best[1], best[0][0], best[2], best[3], count

        def compute(texts: pa.Array):
            rows = []
            for _, data, ends in byte_groups(texts):
                hashes, first, _ = words(data, ends, LETTERS_AND_DIGITS)
                begin = np.searchsorted(first, ends)
                rows += [of_document(hashes[a:b]) for a, b in zip(begin, begin[1:])]
            return [list(c) for c in zip(*rows)] if rows else [[]] * 5

        return compute

    added = [
        T.StructField("license", T.StringType()),
        T.StructField("coverage", T.DoubleType()),
        T.StructField("first_word", T.LongType()),
        T.StructField("end_word", T.LongType()),
        T.StructField("n_licenses", T.LongType()),
    ]
    return add_columns(docs, ["text"], added, start)
