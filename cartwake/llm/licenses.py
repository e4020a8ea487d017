"""Licence texts in documents, by the Dice coefficient of word bigrams.

A passage is a run of whole lines or, for a template that no such run matches, a run of words
that begins and ends with a pair of the template.  A notice that is part of a larger text found
is not reported besides.  Passage and template are compared as sets of pairs of
neighbouring normalised words.  A coefficient of t needs sizes within a factor of (2 - t) / t,
so templates are kept by size and only those in bounds are compared.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwake.llm.common import others, per_text
from cartwake.llm.decontaminate import words_of

LEAST_DICE = 0.8

# Public licence texts and notices.
TEMPLATES = [
    ("all-rights-reserved", "All rights reserved."),
    ("mit-notice", "Released under the MIT License."),
    ("apache-2.0-notice", "Licensed under the Apache License, Version 2.0."),
    ("gpl-3.0-notice", "This work is licensed under the GNU General Public License, version 3."),
    ("cc-by-nc-4.0-notice", "Licensed under CC BY-NC 4.0."),
    ("cc-by-4.0-notice", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("apache-2.0-header", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file
except in compliance with the License. You may obtain a copy of the License at
http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed
on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for
the specific language governing permissions and limitations under the License."""),
    ("gpl-3.0-header", """This program is free software: you can redistribute it and/or modify it under the terms of the
GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.
This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied
warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.
You should have received a copy of the GNU General Public License along with this program. If not, see
<https://www.gnu.org/licenses/>."""),
    ("mit", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including without
limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the
Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of
the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("isc", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE."""),
    ("bsd-2-clause", """Redistribution and use in source and binary forms, with or without modification, are permitted
provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES;
LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN
CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS
SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""),
    ("bsd-3-clause", """Redistribution and use in source and binary forms, with or without modification, are permitted
provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products
derived from this software without specific prior written permission.
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES;
LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN
CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS
SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""),
]


class Templates:
    """Templates by the size of their bigram sets."""

    def __init__(self, templates: list[tuple[str, str]], least: float = LEAST_DICE):
        sets = sorted(((n, frozenset(_pairs(words_of(t)))) for n, t in templates), key=lambda x: (len(x[1]), x[0]))
        self.all = [x for x in sets if x[1]]
        self.sizes = [len(s) for _, s in self.all]
        self.least, self.factor = least, (2 - least) / least
        self.known = frozenset().union(*(s for _, s in self.all))
        self.most = int(self.sizes[-1] * self.factor + 1e-9) if self.sizes else 0

    def in_bounds(self, size: int) -> list[tuple[str, frozenset]]:
        """Templates whose size allows the least coefficient with a set of ``size``."""
        a = bisect_left(self.sizes, size / self.factor - 1e-9)
        b = bisect_right(self.sizes, size * self.factor + 1e-9)
        return self.all[a:b]

    def matches(self, text: str | None) -> list[tuple[str, float, int, int]]:
        """(name, coefficient, first line, last line) of each template's best passage.

        Passages of whole lines come first, then those of words.  Of equally good passages the
        earliest counts, then the shortest.
        """
        lines = [words_of(x) for x in (text or "").split("\n")]
        words = [w for x in lines for w in x]
        hits = {i for i, p in enumerate(_pairs(words)) if p in self.known}
        if not hits:
            return []
        ends, at = [], 0
        for x in lines:
            at += len(x)
            ends.append(at)
        # A line none of whose words is in a known pair only lowers the coefficient.
        useful = sorted({bisect_right(ends, k) for i in hits for k in (i, i + 1)})
        best: dict[str, tuple[float, int, int]] = {}
        for n, a in enumerate(useful):
            start = ends[a - 1] if a else 0
            pairs: set = set()
            shared: set = set()
            done = start
            for b in useful[n:]:
                new = set(_pairs(words[max(start, done - 1) : ends[b]])) - pairs
                pairs |= new
                shared |= new & self.known
                done = ends[b]
                # A match of |P| pairs shares at least |P| / factor of them.
                if len(pairs) > self.most or len(pairs) - len(shared) > self.most * (1 - 1 / self.factor) + 1e-9:
                    break
                if len(shared) < len(pairs) / self.factor - 1e-9:
                    continue
                for name, own in self.in_bounds(len(pairs)):
                    dice = 2 * len(shared & own) / (len(pairs) + len(own))
                    if dice >= self.least and dice > best.get(name, (0,))[0]:
                        best[name] = dice, a, b
        found = [(ends[a - 1] if a else 0, ends[b]) for _, a, b in best.values()]
        for name, own in reversed(self.all):
            if name in best:
                continue
            passage = self._words(words, own, found)
            if passage:
                dice, start, end = passage
                found.append((start, end))
                best[name] = dice, bisect_right(ends, start), bisect_right(ends, end - 1)
        return [(n, *v) for n, v in sorted(best.items())]


    def _words(self, words: list[bytes], own: frozenset, found: list[tuple[int, int]]) -> tuple[float, int, int] | None:
        """(coefficient, first word, word after the last) of the best passage outside ``found``."""
        pairs = list(_pairs(words))
        hits = [i for i, p in enumerate(pairs) if p in own]
        # A match shares at least 1 / factor of the template's pairs.
        if len({pairs[i] for i in hits}) < len(own) / self.factor - 1e-9:
            return None
        most, best = len(own) * self.factor + 1e-9, None
        for n, start in enumerate(hits):
            seen: set = set()
            shared, done = 0, start
            for last in hits[n:]:
                for p in pairs[done : last + 1]:
                    if p not in seen:
                        seen.add(p)
                        shared += p in own
                done = last + 1
                if len(seen) > most:
                    break
                dice = 2 * shared / (len(seen) + len(own))
                if dice < self.least or best and dice <= best[0]:
                    continue
                if not any(a <= start and last + 2 <= b for a, b in found):
                    best = dice, start, last + 2
        return best


def _pairs(words: list[bytes]) -> Iterator[tuple[bytes, bytes]]:
    return zip(words, words[1:])


MATCHES = T.ArrayType(T.StructType([
    T.StructField("license", T.StringType()), T.StructField("dice", T.DoubleType()),
    T.StructField("first_line", T.LongType()), T.StructField("last_line", T.LongType()),
]))
_ARROW = pa.list_(pa.struct([("license", pa.string()), ("dice", pa.float64()), ("first_line", pa.int64()), ("last_line", pa.int64())]))


def scan(
    docs: DataFrame, text: str = "text", keep: list[str] | None = None,
    templates: list[tuple[str, str]] = TEMPLATES, least: float = LEAST_DICE,
) -> DataFrame:
    """The ``keep`` columns (all by default) and ``licenses``, the matches by name.

    Lines are counted from 0.  Null and empty texts, and an empty list of templates, have no
    match; a template of fewer than two words is never matched.  A column named
    ``licenses`` is replaced.  Templates of one name count as one.
    """
    keep = others(docs.columns if keep is None else keep, ["licenses"])
    names = ["license", "dice", "first_line", "last_line"]

    def work():
        own = Templates(templates, least)
        return lambda texts: [pa.array([[dict(zip(names, m)) for m in own.matches(t)] for t in texts], _ARROW)]

    return per_text(docs, text, keep, {"licenses": MATCHES}, work)


def digest(scanned: DataFrame) -> DataFrame:
    """``doc_id``, the names found and the best coefficient."""
    return scanned.select(
        "doc_id",
        F.size("licenses").cast("long").alias("n_licenses"),
        F.array_join(F.transform("licenses", lambda m: m["license"]), ",").alias("names"),
        F.round(F.array_max(F.transform("licenses", lambda m: m["dice"])), 6).alias("best_dice"),
    )
