"""Licence scans: stretches of normalised text against licence templates, by the Dice coefficient over word bigrams.

For a template with B distinct bigrams and a threshold t, a stretch can only reach t if it has between t / (2 - t) * B and
(2 - t) / t * B distinct bigrams, and shares t / (2 - t) * B of them with the template. So places where a text's bigrams are
those of a template are counted over the longest stretch that is possible, and most templates drop out there; what is left
is measured exactly, over every stretch that begins and ends in such a place.
"""

from __future__ import annotations

import bisect
import heapq
import math
import re
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import text_batches
from .decontaminate import _WORDS

THRESHOLD = 0.8

_MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
)
_APACHE = (
    "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    "See the License for the specific language governing permissions and limitations under the License.",
)
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
)
_ISC = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
)
_UNLICENSE = (
    "This is free and unencumbered software released into the public domain.",
    "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
)


def _short(*names: str) -> tuple[str, ...]:
    """Of three bigrams the first two would reach the threshold for any name, so names of one word go without the verb."""
    return tuple(f"{verb}under the {name}." for name in names for verb in (("Released ", "Licensed ") if len(name.replace("-", " ").split()) > 1 else ("",)))


def _gnu(short: str, name: str, version: str) -> tuple[str, ...]:
    """The notices of a GNU licence: short ones, the first paragraph, and with the paragraphs on warranty and copies."""
    if not version:
        return (f"This work is licensed under the {name}.", *_short(name, short), f"under the terms of the {name} as published by the Free Software Foundation")
    out = [f"This work is licensed under the {name}, version {version}.", f"{name}, version {version}", f"{name} v{version}"]
    out += [*_short(f"{short}v{version}", f"{short}-{version}" + ("" if "." in version else ".0")), *([] if "." in version else [f"{name} v{version}.0"])]
    mark = ":" if version == "3" else ";"
    for thing in ("program", "library"):
        terms = f"This {thing} is free software{mark} you can redistribute it and/or modify it under the terms of the {name} as published by the Free Software Foundation{mark} "
        later = f"{terms}either version {version} of the License, or (at your option) any later version."
        only = f"{terms}version {version} of the License."
        warranty = f"This {thing} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {name} for more details. You should have received a copy of the {name} along with this {thing}"
        out += [later, only, f"{later} {warranty}. If not, see <https://www.gnu.org/licenses/>.",
                f"{later} {warranty}; if not, write to the Free Software Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA."]
    return tuple(out)


def _creative_commons() -> dict[str, tuple[str, ...]]:
    """Every variant in every version, and without one, by its short and its long name."""
    words = {"BY": "Attribution", "SA": "ShareAlike", "ND": "NoDerivatives", "NC": "NonCommercial"}
    out = {}
    for kind in ("BY-NC", "BY", "BY-SA", "BY-ND", "BY-NC-SA", "BY-NC-ND"):
        for version, port in (("4.0", "International"), ("3.0", "Unported"), ("2.5", "Generic"), ("2.0", "Generic"), ("1.0", "Generic"), ("", "")):
            long = "-".join(words[part] for part in kind.split("-"))
            if version not in ("4.0", ""):
                long = long.replace("NoDerivatives", "NoDerivs")
            name = " ".join(x for x in ("Creative Commons", long, version, port) if x)
            texts = [f"Licensed under CC {kind} {version}".strip() + ".", f"This work is licensed under a {name} License."]
            if version:
                texts += [f"CC {kind} {version}", name]
            out[f"CC-{kind}-{version}" if version else f"CC-{kind}"] = tuple(texts)
    return out


#: Notices as public licences word them. A name without version stands for notices that give none.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "MIT": (*_short("MIT License"), _MIT[0], " ".join(_MIT)),
    "Apache-2.0": ("Licensed under the Apache License, Version 2.0.", *_short("Apache License 2.0", "Apache-2.0 License"), _APACHE[0], " ".join(_APACHE)),
    "Apache-1.1": ("Licensed under the Apache License, Version 1.1.", *_short("Apache License 1.1")),
    "Apache": _short("Apache License"),
    "GPL-3.0": _gnu("GPL", "GNU General Public License", "3"),
    "GPL-2.0": _gnu("GPL", "GNU General Public License", "2"),
    "GPL-1.0": _gnu("GPL", "GNU General Public License", "1"),
    "GPL": _gnu("GPL", "GNU General Public License", ""),
    "LGPL-3.0": _gnu("LGPL", "GNU Lesser General Public License", "3"),
    "LGPL-2.1": _gnu("LGPL", "GNU Lesser General Public License", "2.1"),
    "LGPL-2.0": _gnu("LGPL", "GNU Library General Public License", "2"),
    "LGPL": _gnu("LGPL", "GNU Lesser General Public License", ""),
    "AGPL-3.0": _gnu("AGPL", "GNU Affero General Public License", "3"),
    "AGPL": _gnu("AGPL", "GNU Affero General Public License", ""),
    "BSD": (*_short("BSD License"), _BSD[0]),
    "BSD-2-Clause": (*_short("BSD 2-Clause License"), "BSD 2-Clause License", " ".join((_BSD[0], "1.", _BSD[1])), " ".join((_BSD[0], "1.", _BSD[1], _BSD[3]))),
    "BSD-3-Clause": (*_short("BSD 3-Clause License"), "BSD 3-Clause License", " ".join((_BSD[0], "1.", _BSD[1], _BSD[2])), " ".join((_BSD[0], "1.", *_BSD[1:]))),
    "ISC": (*_short("ISC License"), _ISC[0], " ".join(_ISC)),
    "MPL-2.0": (
        *_short("Mozilla Public License 2.0", "Mozilla Public License, version 2.0", "MPL 2.0"),
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ),
    "MPL-1.1": _short("Mozilla Public License 1.1", "Mozilla Public License, version 1.1", "MPL 1.1"),
    "MPL": _short("Mozilla Public License"),
    **_creative_commons(),
    "CC0-1.0": ("Licensed under CC0 1.0.", "Creative Commons CC0 1.0 Universal", "CC0 1.0 Universal Public Domain Dedication", "This work is licensed under a Creative Commons Zero v1.0 Universal License."),
    "Unlicense": (*_short("Unlicense"), _UNLICENSE[0], " ".join(_UNLICENSE)),
}


#: Names that end in a version: family, major and minor number.
_VERSION = re.compile(r"(.*)-(\d+)\.(\d+)$")


def _digits(word: bytes) -> str:
    """The number of v3, gplv3 or 3."""
    return word.decode().lstrip("abcdefghijklmnopqrstuvwxyz")


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_WORDS).split(b" ")


class Matcher:
    """Templates as sets of pairs of word numbers."""

    def __init__(self, templates: dict[str, tuple[str, ...]], threshold: float):
        self.threshold = threshold
        self.numbers: dict[bytes, int] = {}
        self.templates: list[tuple[str, set[int], set[int], int, int, int]] = []
        versions = {name: _VERSION.match(name) for name in templates}
        self.families = {m[1] for m in versions.values() if m}
        listed = [(name, [w for w in words_of(text.encode()) if w]) for name, texts in templates.items() for text in texts]
        for _, words in listed:
            for word in words:
                self.numbers.setdefault(word, len(self.numbers) + 1)
        self.base = len(self.numbers) + 1
        self.any = np.zeros(self.base ** 2, dtype=bool)
        for name, words in listed:
            ids = [self.numbers[w] for w in words]
            pairs = {a * self.base + b for a, b in zip(ids, ids[1:])}
            low, high = threshold / (2 - threshold) * len(pairs), (2 - threshold) / threshold * len(pairs)
            marks = set()       # the bigrams that name the version
            if m := versions[name]:
                last = [(a, b) for a, b in zip(words, words[1:]) if b.decode() == m[3] and _digits(a) == m[2]] or [
                    (a, b) for a, b in zip(words, words[1:]) if _digits(b) == m[2] and not b.isdigit() or a == b"version" and b.decode() == m[2]]
                marks = {self.numbers[a] * self.base + self.numbers[b] for a, b in last}
            self.templates.append((name, pairs, marks, math.ceil(low - 1e-9), math.floor(high + 1e-9), len(pairs)))
            self.any[list(pairs)] = True

    def __call__(self, text: bytes) -> list[tuple[str, float, int, int]]:
        """Licence, coefficient, first and one past the last word, of the best stretch for each licence that reaches the threshold."""
        best: dict[str, tuple[float, int, int]] = {}
        for name, value, start, end, *_ in self._stretches(text):
            if name not in best or (-value, start, end) < (-best[name][0], best[name][1], best[name][2]):
                best[name] = (value, start, end)
        return [(name, *value) for name, value in best.items()]

    def decided(self, text: bytes) -> tuple[list[tuple[str, float, int, int]], list[tuple[str, float, int, int]]]:
        """Like a call, but each stretch goes to its best licence: those that have one, and those that only reach the threshold.

        The best stretch of all is taken, then the best that does not overlap it, and so on. Of equal ones that of the longer
        template, then the leftmost and shortest, then the first name counts. A licence with a version needs one that names
        it, and comes before its family, which has none.
        """
        queue = []
        best: dict[str, tuple[float, int, int]] = {}
        for name, value, start, end, size, again in self._stretches(text):
            found = again() if again.keywords["marks"] else (value, start, end)
            if found:
                queue.append((name in self.families, -round(found[0], 12), -size, *found[1:], name, len(queue), again))
            if name not in best or (-value, start, end) < (-best[name][0], best[name][1], best[name][2]):
                best[name] = (value, start, end)
        heapq.heapify(queue)
        starts, ends, taken = [], [], {}
        while queue:
            family, value, size, start, end, name, number, again = heapq.heappop(queue)
            at = bisect.bisect_right(starts, start)
            if at and ends[at - 1] > start:
                continue
            if at < len(starts) and starts[at] < end:
                shorter = again(starts[at])
                if shorter:
                    heapq.heappush(queue, (family, -round(shorter[0], 12), size, *shorter[1:], name, number, again))
                continue
            starts.insert(at, start)
            ends.insert(at, end)
            taken.setdefault(name, (name, -value, start, end))
        return list(taken.values()), [(name, *value) for name, value in best.items() if name not in taken]

    def _stretches(self, text: bytes) -> Iterator[tuple]:
        """For each template and place, the best stretch that begins there, and a way to ask for the best with its version, within a bound."""
        words = [w for w in words_of(text) if w]
        if len(words) < 2:
            return
        get = self.numbers.get
        ids = np.array([get(w, 0) for w in words], dtype=np.int64)
        keys = np.where((ids[:-1] > 0) & (ids[1:] > 0), ids[:-1] * self.base + ids[1:], 0)
        at = np.flatnonzero(self.any[keys] & (keys > 0))
        present = set(keys[at].tolist())
        for name, pairs, marks, least, most, size in self.templates:
            total = len(present & pairs)
            if total < least:
                continue
            own = at[np.isin(keys[at], list(pairs))]
            for k in range(len(own) - least + 1):
                stretch = partial(self._best, words, keys, own, k, least, most, size, total)
                found = stretch()
                if found:
                    yield name, *found, size, partial(stretch, marks=marks)

    def _best(self, words, keys, own, k, least, most, size, total, bound=math.inf, marks=frozenset()):
        """Coefficient, first and one past the last word of the best stretch from own[k] that ends by bound and holds one of marks."""
        best = None
        start = position = int(own[k])
        distinct, shared = set(), set()
        for end in own[k:]:
            if end + 2 > bound:
                break
            while position <= end:      # the bigrams of the stretch so far; those outside all templates by their words
                distinct.add(int(keys[position]) or (words[position], words[position + 1]))
                position += 1
            if len(distinct) > most:
                break
            shared.add(int(keys[end]))
            if len(shared) >= least and (not marks or not shared.isdisjoint(marks)):
                value = 2 * len(shared) / (len(distinct) + size)
                if value >= self.threshold - 1e-12 and (best is None or value > best[0] + 1e-12):
                    best = (value, start, int(end) + 2)
            if len(shared) == total:        # all that the text has: what follows only adds to the stretch
                break
        return best


def scanned(docs: DataFrame, templates: dict[str, tuple[str, ...]] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, license, dice, n_licenses, licenses, alternatives of every row of docs(doc_id, text).

    licenses holds, by falling coefficient and name, license, dice, start and end (byte offsets into the UTF-8 text) of the
    best stretch for each licence; license and dice repeat the first, null where there is none. Where stretches overlap, only
    the best counts (see Matcher.decided); licences that are weaker wherever they reach the threshold are in alternatives,
    of the same form. Null and empty texts have none; repeated rows come back repeated; other columns are not read.
    """
    templates = templates or TEMPLATES
    kind = docs.schema["doc_id"].dataType.simpleString()
    entry = pa.struct([("license", pa.string()), ("dice", pa.float64()), ("start", pa.int64()), ("end", pa.int64())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(templates, threshold)
        for batch, texts in text_batches(batches):
            rows, others = [], []
            for text in texts:
                both = [sorted(found, key=lambda x: (-x[1], x[0])) for found in matcher.decided(text)]
                if both[0]:
                    flags = np.frombuffer(text.translate(_WORDS), dtype=np.uint8) != 32
                    edges = np.flatnonzero(np.diff(np.concatenate(([False], flags, [False])).astype(np.int8)))
                    both = [[{"license": n, "dice": d, "start": int(edges[2 * a]), "end": int(edges[2 * b - 1])} for n, d, a, b in found] for found in both]
                rows.append(both[0])
                others.append(both[1])
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array([r[0]["license"] if r else None for r in rows], pa.string()),
                pa.array([r[0]["dice"] if r else None for r in rows], pa.float64()), pa.array([len(r) for r in rows], pa.int64()),
                pa.array(rows, pa.list_(entry)), pa.array(others, pa.list_(entry))],
                names=["doc_id", "license", "dice", "n_licenses", "licenses", "alternatives"])

    found = "array<struct<license: string, dice: double, start: long, end: long>>"
    return docs.select("doc_id", "text").mapInArrow(
        scan, f"doc_id {kind}, license string, dice double, n_licenses long, licenses {found}, alternatives {found}")
