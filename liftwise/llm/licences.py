"""License scans: Dice coefficient of word bigrams against licence templates.

A document's units are its lines, its blocks (runs of non-empty lines, when of several lines)
and, when it has several blocks, its whole text. A unit is normalised (lower case, words and
version numbers only, copyright notices' names left out) and compared with templates by
2 * common / (bigrams of both). At least DICE is only possible when the smaller of two bigram
sets has at least DICE / (2 - DICE) times the size of the larger: templates are kept sorted
by size and only those within the bounds are compared, and a unit that shares no bigram with
with any template is not compared at all.

Besides, a text's words are searched for windows where a template's bigrams cluster, whatever
lines and blocks they span. A template is only looked for when the text holds enough of its
distinct bigrams. A window starts and ends with a run of them: more of a run never lowers
Dice. Very long texts cost a template-sized look per run. Windows that overlap are settled by most bigrams in common, then by Dice, so a notice
inside a header is the header's.

One row per input row; null or empty text matches nothing. Ties go to the first name. Other
columns stay; result columns replace input columns of the same name.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from liftwise.llm.batches import small_batches
from liftwise.llm.licence_texts import TEXTS

DICE = 0.8
NOTICE = 160  # characters of a copyright line
STARTS = 512  # positions whose windows are looked up together
WORD = re.compile(r"[a-z0-9]+(?:\.[0-9]+)*")
COPYRIGHT = re.compile(r"^[^\w©(]*(?:copyright\s+(?:\(c\)|©|\d{4})|\(c\)\s|©).*$", re.I | re.M)

# Public licence texts and the notices by which works refer to them.
TEMPLATES = {
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0.",
    "MIT notice": "Released under the MIT License.",
    "GPL-3.0 notice": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0 notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0 notice": "Licensed under CC BY 4.0.",
    "CC-BY-4.0 sentence": "This work is licensed under a Creative Commons Attribution 4.0 "
    "International License.",
    "CC0-1.0 sentence": "To the extent possible under law, the author has waived all copyright "
    "and related or neighboring rights to this work.",
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of
this software and associated documentation files (the "Software"), to deal in the Software
without restriction, including without limitation the rights to use, copy, modify, merge,
publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to
whom the Software is furnished to do so, subject to the following conditions: The above
copyright notice and this permission notice shall be included in all copies or substantial
portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND,
EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS
FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT
HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT,
TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER
DEALINGS IN THE SOFTWARE.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose
with or without fee is hereby granted, provided that the above copyright notice and this
permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR
DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA
OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT
OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "Apache-2.0 header": """Licensed under the Apache License, Version 2.0 (the "License"); you
may not use this file except in compliance with the License. You may obtain a copy of the
License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or
agreed to in writing, software distributed under the License is distributed on an "AS IS"
BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License
for the specific language governing permissions and limitations under the License.""",
    "GPL-3.0-or-later header": """This program is free software: you can redistribute it and/or
modify it under the terms of the GNU General Public License as published by the Free Software
Foundation, either version 3 of the License, or (at your option) any later version. This
program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without
even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU
General Public License for more details. You should have received a copy of the GNU General
Public License along with this program. If not, see <https://www.gnu.org/licenses/>.""",
    "LGPL-3.0-or-later header": """This program is free software: you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public License as published by the Free
Software Foundation, either version 3 of the License, or (at your option) any later version.
This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;
without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See
the GNU Lesser General Public License for more details. You should have received a copy of the
GNU Lesser General Public License along with this program. If not, see
<https://www.gnu.org/licenses/>.""",
    "LGPL-2.1-or-later header": """This library is free software; you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public License as published by the Free
Software Foundation; either version 2.1 of the License, or (at your option) any later version.
This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;
without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See
the GNU Lesser General Public License for more details. You should have received a copy of the
GNU Lesser General Public License along with this library; if not, write to the Free Software
Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA""",
    "AGPL-3.0-or-later header": """This program is free software: you can redistribute it and/or
modify it under the terms of the GNU Affero General Public License as published by the Free
Software Foundation, either version 3 of the License, or (at your option) any later version.
This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;
without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See
the GNU Affero General Public License for more details. You should have received a copy of the
GNU Affero General Public License along with this program. If not, see
<https://www.gnu.org/licenses/>.""",
    "GPL-2.0-or-later header": """This program is free software; you can redistribute it and/or
modify it under the terms of the GNU General Public License as published by the Free Software
Foundation; either version 2 of the License, or (at your option) any later version. This program
is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the
implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General
Public License for more details. You should have received a copy of the GNU General Public
License along with this program; if not, write to the Free Software Foundation, Inc., 51
Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA.""",
    "MPL-2.0 header": """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at
https://mozilla.org/MPL/2.0/.""",
    "EPL-2.0 header": """This program and the accompanying materials are made available under the
terms of the Eclipse Public License 2.0 which is available at
https://www.eclipse.org/legal/epl-2.0/""",
    "GPL-2.0 notice": "This work is licensed under the GNU General Public License, version 2.",
    "LGPL-2.1 notice": "Licensed under the GNU Lesser General Public License, version 2.1.",
    "LGPL-3.0 notice": "Licensed under the GNU Lesser General Public License, version 3.",
    "AGPL-3.0 notice": "Licensed under the GNU Affero General Public License, version 3.",
    "MPL-2.0 notice": "Licensed under the Mozilla Public License, version 2.0.",
    "EPL-2.0 notice": "Licensed under the Eclipse Public License, version 2.0.",
    "BSD-2-Clause notice": "Licensed under the BSD 2-Clause License.",
    "BSD-3-Clause notice": "Licensed under the BSD 3-Clause License.",
    "ISC notice": "Released under the ISC License.",
    "Unlicense notice": "Released into the public domain under the Unlicense.",
}

# Creative Commons notices and sentences of all kinds and both versions in use.
_KINDS = {"BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-ND": "Attribution-NoDerivatives",
          "BY-NC": "Attribution-NonCommercial", "BY-NC-SA": "Attribution-NonCommercial-ShareAlike",
          "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives"}
for _kind, _long in _KINDS.items():
    for _version, _where in (("4.0", "International"), ("3.0", "Unported")):
        TEMPLATES.setdefault(
            f"CC-{_kind}-{_version} notice", f"Licensed under CC {_kind} {_version}."
        )
        TEMPLATES.setdefault(
            f"CC-{_kind}-{_version} sentence",
            f"This work is licensed under a Creative Commons {_long} {_version} {_where} License.",
        )
TEMPLATES |= {f"{_name} text": _text for _name, _text in TEXTS.items()}


def bigrams(text: str) -> set[tuple[str, str]]:
    """Word bigrams of a normalised text; a single word is a bigram with nothing."""
    found = WORD.findall(COPYRIGHT.sub(" ", text).lower())
    return set(zip(found, found[1:], strict=False)) or {(w, "") for w in found}


def word_bigrams(text: str) -> list[tuple[str, str]]:
    """Word bigrams of a normalised text in their order. A line longer than any notice may go
    on with the licence itself, so it stays."""
    kept = COPYRIGHT.sub(lambda m: " " if len(m[0]) <= NOTICE else m[0], text)
    found = WORD.findall(kept.lower())
    return list(zip(found, found[1:], strict=False))


def units(text: str) -> list[str]:
    lines = [line for line in text.split("\n") if line.strip()]
    blocks = [b for b in re.split(r"\n[^\S\n]*\n", text) if "\n" in b.strip()]
    whole = [text] if len(lines) > 1 and blocks != [text] else []
    return lines + blocks + whole


def _previous(ids: np.ndarray) -> np.ndarray:
    """Where each value occurred last before its position, -1 for the first time."""
    order = np.argsort(ids, kind="stable")
    same = ids[order[1:]] == ids[order[:-1]]
    before = np.full(len(ids), -1)
    before[order[1:][same]] = order[:-1][same]
    return before


class Scanner:
    def __init__(self, templates: dict[str, str], least: float):
        self.least = least
        grams = sorted((len(b), name, b) for name, b in
                       ((n, bigrams(t)) for n, t in templates.items()) if b)
        self.sizes = [g[0] for g in grams]
        self.grams = [(name, b) for _, name, b in grams]
        self.known = frozenset().union(*(b for _, b in self.grams)) if grams else frozenset()
        self.holders: dict[tuple[str, str], list[int]] = {}
        for i, (_, b) in enumerate(self.grams):
            for g in b:
                self.holders.setdefault(g, []).append(i)

    def best(self, unit: str) -> tuple[float, str] | None:
        """(dice, name) of the best template that reaches the threshold."""
        own = bigrams(unit)
        n, ratio = len(own), self.least / (2 - self.least)
        low, high = bisect_left(self.sizes, n * ratio - 1e-9), bisect_right(self.sizes, n / ratio + 1e-9)
        if not n or low == high or self.known.isdisjoint(own):
            return None
        scored = [(2 * len(own & b) / (n + len(b)), name) for name, b in self.grams[low:high]]
        top = max(s for s, _ in scored)
        return (top, min(name for s, name in scored if s == top)) if top >= self.least else None

    def windows(self, text: str) -> list[tuple[str, float]]:
        """(name, dice) of the windows that reach the threshold and overlap no better one."""
        order = word_bigrams(text)
        counts = Counter(i for g in self.known.intersection(order) for i in self.holders[g])
        ratio = self.least / (2 - self.least)
        likely = [i for i, c in counts.items() if c >= ratio * len(self.grams[i][1]) - 1e-9]
        if not likely:
            return []
        number: dict[tuple[str, str], int] = {}
        ids = np.array([number.setdefault(g, len(number)) for g in order])
        before = _previous(ids)
        found = []
        for i in likely:
            name, own = self.grams[i]
            mine = np.zeros(len(number), bool)
            mine[[number[g] for g in own if g in number]] = True
            spans = self._windows(mine[ids], before, len(own))
            found += [(-n, -dice, name, a, b) for n, dice, a, b in spans]
        out: list[tuple[str, float]] = []
        starts: list[int] = []  # of the windows taken, which are disjoint
        ends: list[int] = []
        for _, dice, name, a, b in sorted(found):
            at = bisect_left(ends, a + 1)  # the first that ends after a
            if at == len(starts) or b <= starts[at]:
                starts.insert(at, a)
                ends.insert(at, b)
                out.append((name, -dice))
        return out

    def _windows(
        self, inside: np.ndarray, before: np.ndarray, size: int
    ) -> list[tuple[int, float, int, int]]:
        """(common, dice, start, end) of the best window from each run of a template's bigrams.

        `inside` marks the text's bigrams that are among the template's `size`, `before` holds
        where each occurred last. A window's distinct bigrams are those whose last occurrence
        lies before its start, and no more than `longest` can reach the threshold: a start looks
        at that many positions however long the text or its repeats are.
        """
        edges = np.flatnonzero(np.diff(np.concatenate(([0], inside.astype(np.int8), [0]))))
        starts, ends = edges[::2], edges[1::2]
        longest = int(size * (2 - self.least) / self.least + 1e-9)
        fewest = self.least / (2 - self.least) * size - 1e-9
        out = []
        for block in range(0, len(inside), STARTS):
            here = starts[np.searchsorted(starts, block) : np.searchsorted(starts, block + STARTS)]
            if not len(here):
                continue
            # First occurrences for any start of the block; at most 2 * STARTS of them are not
            # for a given one.
            enough = longest + 1 + 2 * STARTS
            new = block + np.flatnonzero(before[block:] < block + STARTS)[:enough]
            last, own = before[new], inside[new]
            for start in here.tolist():
                fresh = (new >= start) & (last < start)
                if np.count_nonzero(fresh & own) < fewest:
                    continue
                first = new[fresh][:longest]
                common = first[inside[first]]
                stops = ends[np.searchsorted(ends, common, "right")]
                seen = np.searchsorted(new[fresh], stops)
                shared = np.searchsorted(common, stops)
                dice = np.where(seen <= longest, 2 * shared / (seen + size), 0)
                best = int(dice.argmax())
                if dice[best] >= self.least:
                    out.append((int(shared[best]), float(dice[best]), start, int(stops[best])))
        return out

    def scan(self, text: str | None) -> dict[str, float]:
        """Each licence found, with its best coefficient."""
        found: dict[str, float] = {}
        for unit in units(text) if text else []:
            match = self.best(unit)
            if match and match[0] > found.get(match[1], 0):
                found[match[1]] = match[0]
        for name, dice in self.windows(text) if text else []:
            found[name] = max(dice, found.get(name, 0))
        return found


SCAN = "n_licences long, licence string, dice double, licences array<string>"


def scan_licences(
    docs: DataFrame, templates: dict[str, str] | None = None, least: float = DICE
) -> DataFrame:
    """docs with n_licences, the best match (licence, dice) and all names found, sorted."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(Scanner(templates or TEMPLATES, least))

    @F.pandas_udf(SCAN)
    def scan(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for t in texts:
            found = shared.value.scan(t)
            name = min(found, key=lambda n: (-found[n], n)) if found else None
            rows.append((len(found), name, found.get(name), sorted(found)))
        out = pd.DataFrame(rows, columns=["n_licences", "licence", "dice", "licences"])
        return out.astype({"dice": "float64"})

    names = [f.split()[0] for f in SCAN.split(", ")]
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in names]
    out = docs.select(*rest, scan(F.col("text").cast("string")).alias("_scan_"))
    return out.select(*rest, *[F.col(f"_scan_.{n}").alias(n) for n in names])
