"""Licence scans: a document's lines, its whole text and its passages against licence templates, by Dice coefficient over
word bigrams.

Texts are normalised to lower-case words. Twice the common bigrams over the sum of both numbers can reach the threshold
only if the numbers are near each other, so most units meet no template: those of a size no template is near are not
looked at further. For the others one pass over the unit's bigrams counts the overlap with every template left.

Passages cross line ends: a window of each template's size slides over the bigrams of the whole text, so a wrapped notice in
a longer document and a sentence inside a paragraph are found. Only places that hold enough of a template's bigrams close
together are counted exactly. Passages that name the same words are told apart by the bigrams they explain less those that
they miss, so a notice counts once and for the template that fits it best.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left, insort
from collections import Counter, defaultdict
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from icuflow.llm.common import text_of, without

#: Parts of published licence texts.
_BSD_2 = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."""
_BSD_NAMES = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_BSD_END = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""

#: Licence ids and notices as licensors publish or recommend them, and the full texts of the short licences.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("BSD-2-Clause", f"{_BSD_2}\n{_BSD_END}"),
    ("BSD-3-Clause", f"{_BSD_2}\n{_BSD_NAMES}\n{_BSD_END}"),
)

_words = re.compile("[A-Za-z0-9]+").findall
_KIND = pa.list_(pa.struct([("line", pa.int32()), ("license", pa.string()), ("dice", pa.float64())]))


class Templates:
    def __init__(self, templates: tuple[tuple[str, str], ...], least: float):
        if not 0 < least <= 1:
            raise ValueError("the least Dice coefficient lies above 0 and is 1 at most")
        self.least, self.names = least, [name for name, _ in templates]
        self.bigrams = [self.counted(text) for _, text in templates]
        self.sizes = [sum(b.values()) for b in self.bigrams]
        self.holding: dict[tuple[str, str], list[tuple[int, int]]] = defaultdict(list)
        for number, bigrams in enumerate(self.bigrams):
            for pair, n in bigrams.items():
                self.holding[pair].append((number, n))
        # 2 * common <= 2 * the smaller number, so the smaller is `least / (2 - least)` of the larger or more.
        self.low = [s * least / (2 - least) - 1e-9 for s in self.sizes]
        self.high = [s * (2 - least) / least + 1e-9 for s in self.sizes]
        self.most = max(self.high, default=0)
        near = range(int(self.most) + 1)
        self.near = [frozenset(k for k in range(len(templates)) if self.sizes[k] and self.low[k] <= n <= self.high[k]) for n in near]
        # Words and bigrams of the templates by number; 0 is any other.
        self.word = {w: k for k, w in enumerate(sorted({w for pair in self.holding for w in pair}), 1)}
        self.pair = np.zeros((len(self.word) + 1,) * 2, dtype=np.int32)
        self.there = np.zeros((len(templates), len(self.holding) + 1), dtype=np.int32)
        for k, ((left, right), held) in enumerate(self.holding.items(), 1):
            self.pair[self.word[left], self.word[right]] = k
            for number, n in held:
                self.there[number, k] = n
        #: What a window of a template's size has in common with it at least.
        self.needed = [math.ceil(s * least - 1e-9) for s in self.sizes]

    @staticmethod
    def counted(text: str) -> Counter:
        words = [w.lower() for w in _words(text)]
        return Counter(zip(words, words[1:], strict=False))

    def passages(self, words: list[str]) -> list[tuple[int, int, int, int, int]]:
        """Windows of lower-case words that reach the least: twice the common bigrams less the template's size (negative, so
        that the best come first), template, first and last common bigram, common bigrams."""
        if len(words) < 2:
            return []
        known = np.fromiter(map(self.word.get, words, repeat(0)), dtype=np.int32, count=len(words))
        pair = self.pair[known[:-1], known[1:]]
        at = np.flatnonzero(pair)
        pair, out = pair[at], []
        for number, (size, needed) in enumerate(zip(self.sizes, self.needed, strict=True)):
            # A text shorter than the template is a unit of its own.
            if not 0 < size < len(words) or len(at) < needed:
                continue
            own = self.there[number][pair] > 0
            place = at[own]
            if len(place) < needed or not (place[needed - 1 :] - place[: len(place) - needed + 1] < size).any():
                continue
            place, held, there = place.tolist(), pair[own].tolist(), self.there[number].tolist()
            count, common, end = Counter(), 0, 0
            for k, first in enumerate(place):
                while end < len(place) and place[end] < first + size:
                    count[held[end]] += 1
                    common += count[held[end]] <= there[held[end]]
                    end += 1
                if common >= needed:
                    out.append((size - 2 * common, number, first, place[end - 1], common))
                common -= count[held[k]] <= there[held[k]]
                count[held[k]] -= 1
        return sorted(out)

    def best(self, words: list[str]) -> tuple[int, float] | None:
        """The template of the highest coefficient, if that reaches the least; of equals the first."""
        size = len(words) - 1
        if not 0 < size < len(self.near) or not (near := self.near[size]):
            return None
        words = [w.lower() for w in words]
        holding, common = self.holding, Counter()
        for pair, n in Counter(zip(words, words[1:], strict=False)).items():
            for number, there in holding.get(pair, ()):
                if number in near:
                    common[number] += min(n, there)
        dice = {k: 2 * c / (size + self.sizes[k]) for k, c in common.items()}
        found = min(((-d, k) for k, d in dice.items() if d >= self.least), default=None)
        return None if found is None else (found[1], -found[0])

    def scan(self, text: str) -> list[tuple[int, str, float]]:
        """Line (from 0; -1 for the whole text, if it has several), licence and coefficient of every match. Passages that
        a matched line or the whole text does not already name follow, with the line where they begin."""
        lines = text.split("\n")
        out, every, starts, spans = [], [], [], []
        for number, line in enumerate(lines):
            words = _words(line)
            starts.append(len(every))
            every += words
            if (hit := self.best(words)) is not None:
                out.append((number, self.names[hit[0]], hit[1]))
                common = round(hit[1] * (len(words) - 1 + self.sizes[hit[0]]) / 2)
                spans.append((starts[-1], len(every) - 2, 2 * common - self.sizes[hit[0]], self.names[hit[0]]))
        whole = None
        if len(lines) > 1 and len(every) - 1 <= self.most and (hit := self.best(every)) is not None:
            whole = self.names[hit[0]]
            out.append((-1, whole, hit[1]))
        taken: list[tuple[int, int]] = []
        found = []
        for loss, number, first, last, common in self.passages([w.lower() for w in every]):
            name = self.names[number]
            if _meets(taken, first, last, self.most):
                continue
            near = spans[max(0, bisect_left(spans, (first - self.most,))) : bisect_left(spans, (last + 1,))]
            near = [x for x in near if _shared(x[0], x[1], first, last)]
            if any(score > -loss and other != name for _, _, score, other in near):
                continue
            insort(taken, (first, last))
            if name != whole and all(other != name for *_, other in near):
                found.append((bisect_left(starts, first + 1) - 1, name, common / self.sizes[number]))
        return out + sorted(found)


def _shared(first: int, last: int, other_first: int, other_last: int) -> bool:
    """Whether two runs of bigrams have more than half of the shorter one in common."""
    both = min(last, other_last) - max(first, other_first) + 1
    return 2 * both > min(last - first, other_last - other_first) + 1


def _meets(taken: list[tuple[int, int]], first: int, last: int, most: float) -> bool:
    """Whether a run shares more than half with one of the runs (ascending, none longer than `most`)."""
    return any(_shared(*x, first, last) for x in taken[bisect_left(taken, (first - most,)) : bisect_left(taken, (last + 1,))])


def scan(
    docs: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES, least: float = 0.8, text: str = "text", out: str = "notices"
) -> DataFrame:
    """Add `out`: an array of (line, license, dice), one for each line, and for the whole text (line -1) if it has several
    lines, whose best template reaches `least`; of equal templates the first counts. Then one for each passage of the whole
    text, across line ends and inside lines, of a template's number of bigrams that reaches `least` and that no matched unit
    names with the same licence; its line is the one where it begins.

    Words are runs of ASCII letters and digits in lower case, lines are parted by line feeds. A unit of less than two
    words, so a null or empty text too, has no bigrams and no match. Row by row, without a shuffle: repeated rows give
    repeated results, an empty table an empty one. Other columns stay; one called `out` is replaced.
    """
    own = Templates(templates, least)

    @F.arrow_udf("array<struct<line: int, license: string, dice: double>>")
    def found(texts: pa.Array) -> pa.Array:
        every = [own.scan(t) for t in texts.to_pylist()]
        return pa.array([[{"line": n, "license": name, "dice": d} for n, name, d in x] for x in every], type=_KIND)

    return without(docs, [out]).withColumn(out, found(text_of(text)))
