"""Licence scans by Dice coefficient over word bigrams.

Texts are normalised to lower-case words. A licence template of n bigrams can only reach the threshold
t with a passage of n * t / (2 - t) to n * (2 - t) / t bigrams, and only if it shares at least the
lower bound with it: templates that a text cannot meet are pruned by counting its shared bigrams. What
is left is compared by windows that begin and end at shared bigrams, as the best window always does.

Defined results: null text is empty text and holds no licence. Of overlapping passages the most alike
stays, then the longer, then the first template by name; one that several licences share comes last. Whole texts are scanned.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame

from trueledger.llm.common import add_column, texts_of

THRESHOLD = 0.85

_BSD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"
_BSD_CLAUSES = (
    "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
)
_BSD_NAMES = "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_BSD_DISCLAIMER = "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."

#: Notices by which texts state their licence, and bodies of short licences, with SPDX names.
#: A name with OR is of a passage that several licences have; it yields to what names one of them.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "AGPL-3.0": (
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ),
    "Artistic-2.0": ("This program is free software; you can redistribute it and/or modify it under the terms of the Artistic License 2.0.", "Licensed under the Artistic License 2.0."),
    "BSD-2-Clause": ("Released under the BSD 2-Clause License.", f"{_BSD}: 1. {_BSD_CLAUSES.replace('. Redis', '. 2. Redis')} {_BSD_DISCLAIMER}"),
    "BSD-2-Clause OR BSD-3-Clause": (_BSD,),
    "BSD-3-Clause": (
        _BSD_NAMES,
        "Released under the BSD 3-Clause License.",
        f"{_BSD}: 1. {_BSD_CLAUSES.replace('. Redis', '. 2. Redis')} 3. {_BSD_NAMES} {_BSD_DISCLAIMER}",
    ),
    "BSL-1.0": (
        "Distributed under the Boost Software License, Version 1.0.",
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following",
    ),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "CC0-1.0": (
        "Licensed under CC0 1.0 Universal.",
        "This work is licensed under a Creative Commons Zero 1.0 Universal License.",
        "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide. This software is distributed without any warranty.",
    ),
    "EPL-2.0": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at",
        "Licensed under the Eclipse Public License, version 2.0.",
    ),
    "GPL-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    "ISC": ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",),
    "LGPL-2.1": (
        "This work is licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    ),
    "LGPL-3.0": (
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    "MIT": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",),
    "Unlicense": ("This is free and unencumbered software released into the public domain.",),
    "Zlib": (
        "Released under the zlib License.",
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions",
    ),
}

_WORDS = re.compile(r"\w+")

Match = tuple[str, int, int, float]


def words_of(text: str) -> list[str]:
    return _WORDS.findall(text.lower())


class Scanner:
    """Finds passages like one of the templates."""

    def __init__(self, templates: dict[str, tuple[str, ...]] = TEMPLATES, threshold: float = THRESHOLD):
        self.threshold = threshold
        self.templates: list[tuple[str, Counter, int]] = []
        self.of_bigram: dict[tuple[str, str], list[int]] = {}
        for name, texts in sorted(templates.items()):
            for text in texts:
                w = words_of(text)
                bigrams = Counter(zip(w, w[1:], strict=False))
                for b in bigrams:
                    self.of_bigram.setdefault(b, []).append(len(self.templates))
                self.templates.append((name, bigrams, len(w) - 1))

    def __call__(self, text: str) -> list[Match]:
        """``(licence, first word, words, likeness)`` of each passage, in order."""
        w = words_of(text)
        hits: dict[int, list[int]] = {}
        for i, b in enumerate(zip(w, w[1:], strict=False)):
            for t in self.of_bigram.get(b, ()):
                hits.setdefault(t, []).append(i)
        found: list[Match] = []
        for t, at in hits.items():
            found += self._windows(w, t, at)
        found.sort(key=lambda m: (" OR " in m[0], -m[3], -m[2], m[0], m[1]))
        kept: list[Match] = []
        for m in found:
            if all(m[1] + m[2] <= k[1] or k[1] + k[2] <= m[1] for k in kept):
                kept.append(m)
        return sorted(kept, key=lambda m: m[1])

    def _windows(self, w: list[str], t: int, at: list[int]) -> list[Match]:
        name, bigrams, n = self.templates[t]
        least, most = math.ceil(n * self.threshold / (2 - self.threshold) - 1e-9), math.floor(n * (2 - self.threshold) / self.threshold + 1e-9)
        if len(at) < least:
            return []
        out = []
        for i, first in enumerate(at):
            if i + least > len(at) or at[i + least - 1] - first >= most:
                continue  # too few shared bigrams within the longest passage
            seen: Counter = Counter()
            shared, best = 0, None
            for last in at[i:]:
                size = last - first + 1
                if size > most:
                    break
                b = (w[last], w[last + 1])
                seen[b] += 1
                shared += seen[b] <= bigrams[b]
                if size >= least and 2 * shared >= self.threshold * (n + size) - 1e-9:
                    like = 2 * shared / (n + size)
                    if best is None or like >= best[3]:
                        best = (name, first, size + 1, like)
            if best:
                out.append(best)
        return out


def scan(df: DataFrame, text: str = "text", out: str = "licences", templates: dict[str, tuple[str, ...]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """``df`` with ``out``: the passages found, as ``array<struct<licence, start, words, likeness>>`` in words."""
    kind = pa.list_(pa.struct([("licence", pa.string()), ("start", pa.int32()), ("words", pa.int32()), ("likeness", pa.float64())]))

    def make():
        scanner = Scanner(templates, threshold)
        names = ("licence", "start", "words", "likeness")
        return lambda column: pa.array([[dict(zip(names, m, strict=True)) for m in scanner(t)] for t in texts_of(column)], kind)

    return add_column(df, text, out, "array<struct<licence: string, start: int, words: int, likeness: double>>", make)
