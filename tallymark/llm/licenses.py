"""License scans: patience alignment of texts with license templates.

Words that occur once in a text and once in a template are anchors. The longest run of anchors in the same order in
both is kept, and the gaps between them are aligned in the same way, those without anchors by a longest common
subsequence; the share of the template's words that find their place is its coverage.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.llm.common import Lists, add_columns

WORD = re.compile(rb"[a-z0-9]+")

#: Fixed texts: the notices by which works name their license, and one full short license.
NOTICES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "BSD-3-Clause": "Use of this source code is governed by a BSD-style license",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3",
    "MIT": "Released under the MIT License",
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial portions of the "
        'Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT '
        "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT "
        "SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION "
        "OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
        "DEALINGS IN THE SOFTWARE."
    ),
}


def words(text: bytes) -> list[bytes]:
    return WORD.findall(text.lower())


def increasing(values: list[int]) -> list[int]:
    """Indices of a longest increasing subsequence, by piles of cards."""
    tops: list[int] = []
    last: list[int] = []
    before = [-1] * len(values)
    for i, v in enumerate(values):
        pile = bisect_left(tops, v)
        before[i] = last[pile - 1] if pile else -1
        tops[pile : pile + 1], last[pile : pile + 1] = [v], [i]
    found, i = [], last[-1] if last else -1
    while i >= 0:
        found.append(i)
        i = before[i]
    return found[::-1]


def _columns(a: Sequence[bytes], b: Sequence[bytes]) -> list[int]:
    """Bit i of the j-th is 0 where a[i] makes the longest common subsequence of a[: i + 1] and b[: j + 1] longer."""
    where: dict[bytes, int] = {}
    for i, w in enumerate(a):
        where[w] = where.get(w, 0) | 1 << i
    full = column = (1 << len(a)) - 1
    out = []
    for w in b:
        same = column & where.get(w, 0)
        column = (column + same | column - same) & full
        out.append(column)
    return out


def common_lengths(a: Sequence[bytes], b: Sequence[bytes]) -> list[int]:
    """Words of the longest common subsequence of ``a`` and each beginning of ``b``."""
    return [len(a) - column.bit_count() for column in _columns(a, b)]


def common(a: Sequence[bytes], b: Sequence[bytes]) -> list[tuple[int, int]]:
    """Position pairs of a longest common subsequence."""
    columns, pairs, i, j = _columns(a, b), [], len(a), len(b)
    while i and j:
        if columns[j - 1] >> (i - 1) & 1:
            i -= 1
            continue
        j -= 1
        if not j or columns[j - 1] >> (i - 1) & 1:
            i -= 1
            pairs.append((i, j))
    return pairs[::-1]


def align(a: list[bytes], b: list[bytes]) -> list[tuple[int, int]]:
    """Position pairs of equal words, rising in both."""
    pairs, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            pairs.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            pairs.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        where = {w: i for i, w in enumerate(b[b0:b1], b0) if in_b[w] == 1}
        anchors = [(i, where[w]) for i, w in enumerate(a[a0:a1], a0) if in_a[w] == 1 and w in where]
        kept = [anchors[i] for i in increasing([y for _, y in anchors])]
        if not kept:
            pairs += [(a0 + i, b0 + j) for i, j in common(a[a0:a1], b[b0:b1])]
            continue
        pairs += kept
        edges = [(a0 - 1, b0 - 1), *kept, (a1, b1)]
        todo += [(x + 1, x2, y + 1, y2) for (x, y), (x2, y2) in zip(edges[:-1], edges[1:], strict=True)]
    return sorted(pairs)


@dataclass(frozen=True)
class Template:
    """A template's words, and words of which every text that covers enough of it must hold one."""

    name: str
    words: tuple[bytes, ...]
    needed: tuple[bytes, ...]
    least: float

    @classmethod
    def of(cls, name: str, text: str, least: float) -> Template:
        own = words(text.encode())
        many = Counter(own)
        spare = len(own) - least * len(own)  # so many places may stay empty; words that fill more cannot all be missing
        needed: list[bytes] = []
        for w in sorted(many, key=lambda w: (-len(w), w)):
            if sum(many[x] for x in needed) > spare:
                break
            needed.append(w)
        return cls(name, tuple(own), tuple(needed), least)

    def find(self, text: list[bytes]) -> list[tuple[int, int, float]]:
        """(first word, end, coverage) of the places in a text that cover the template, none overlapping.

        A place is looked for in the two template lengths behind each word of the template, so that words from all
        over a long text do not add up, and it does not matter where in the text it starts. The next place is looked
        for from the end of a found one.
        """
        size, many = len(self.words), Counter(self.words)
        hits = [i for i, w in enumerate(text) if w in many]
        found: list[tuple[int, int, float]] = []
        held: Counter = Counter()
        both = first = last = 0  # template words in the window, its first hit and the one behind it
        while first < len(hits):
            low = hits[first]
            while last < len(hits) and hits[last] < low + 2 * size:
                w = text[hits[last]]
                held[w] += 1
                both += held[w] <= many[w]
                last += 1
            place = self._place(text, low) if both >= self.least * size else None
            if place:
                found.append(place)
            after = place[1] if place else low + 1
            while first < len(hits) and hits[first] < after:
                if first == last:  # a place may end behind the window
                    last += 1
                else:
                    w = text[hits[first]]
                    both -= held[w] <= many[w]
                    held[w] -= 1
                first += 1
        return found

    def _place(self, text: list[bytes], low: int) -> tuple[int, int, float] | None:
        """The first place in the window from ``low``: the shortest that covers enough, grown while a quarter of what is
        added are words of the template, so that it does not reach into the next copy."""
        size, own = len(self.words), list(self.words)
        need = self.least * size
        ahead = common_lengths(own, text[low : low + 2 * size])
        if ahead[-1] < need:
            return None
        end = low + 1 + next(i for i, n in enumerate(ahead) if n >= need)
        back = common_lengths(own[::-1], text[low:end][::-1])
        start = end - 1 - next(i for i, n in enumerate(back) if n >= need)
        ahead = common_lengths(own, text[start : start + 2 * size])
        end = start + 1 + max(range(end - start - 1, len(ahead)), key=lambda i: (4 * ahead[i] - i, -i))
        back = common_lengths(own[::-1], text[max(low, end - 2 * size) : end][::-1])
        start = end - 1 - max((i for i, n in enumerate(back) if n >= need), key=lambda i: (4 * back[i] - i, -i))
        pairs = align(own, text[start:end])
        if len(pairs) < need:
            return None
        return start + pairs[0][1], start + pairs[-1][1] + 1, len(pairs) / size


def scan(documents: DataFrame, templates: dict[str, str] = NOTICES, least: float = 0.8, text: str = "text") -> DataFrame:
    """All columns of ``documents`` and ``licenses``: name, start, end (in words of letters and digits) and coverage.

    Places are sorted by start, then name. A template counts where at least ``least`` of its words align; templates
    that are much alike may both be found in one place. A null or empty text has none; a column named ``licenses`` is
    replaced; rows are judged one by one, over their whole text, and nothing is shuffled.
    """
    made = [Template.of(name, body, least) for name, body in templates.items()]

    def look(cols: Lists) -> Lists:
        out = []
        for raw in cols[text]:
            low = (raw or b"").lower()
            asked = [t for t in made if any(w in low for w in t.needed)]
            own = words(low) if asked else []
            have = set(own)
            asked = [t for t in asked if sum(w in have for w in t.words) >= least * len(t.words)]
            found = [(s, t.name, e, c) for t in asked for s, e, c in t.find(own)]
            out.append([{"name": n, "start": s, "end": e, "coverage": c} for s, n, e, c in sorted(found)])
        return {"licenses": out}

    return add_columns(documents, [text], look, "licenses array<struct<name:string,start:int,end:int,coverage:double>>")


def best(licenses: str = "licenses") -> list:
    """license and coverage columns: the place of the greatest coverage, the longest and first of equals."""
    order = F.transform(licenses, lambda x: F.struct(x["coverage"], x["end"] - x["start"], -x["start"], x["name"].alias("name")))
    top = F.array_max(order)
    return [top["name"].alias("license"), top["coverage"].alias("coverage")]
