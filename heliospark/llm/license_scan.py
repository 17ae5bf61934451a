"""Licence texts and notices in documents: normalised words against templates by the Dice coefficient over word bigrams.

Every run of consecutive words of a text is compared: with c bigrams in common (as multisets), n in the run and m in the
template, Dice is 2c / (n + m). Three facts leave few runs to look at, and lose none:

- Dice >= t needs m * t / (2 - t) <= n <= m * (2 - t) / t. These size bounds choose the templates of a run.
- A best run starts and ends with a bigram of the template: any other first or last bigram only adds to n.
- It holds at least t * m / (2 - t) bigrams of the template within the largest size, so places where these lie farther
  apart start none. Common word pairs alone never come that close.

A text is read in pieces of ``PIECE`` characters; only its places of template bigrams are kept.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

THRESHOLD = 0.8
PIECE = 1 << 20

_DISCLAIMER = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, '
    "THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS "
    "BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE "
    "GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT "
    "LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
_TWO_CLAUSES = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
    "documentation and/or other materials provided with the distribution.")

# Licences, and the headers and notices that refer to longer ones, as their publishers word them. Names and years are left out.
TEMPLATES = {
    "MIT-notice": "Released under the MIT License.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0-notice": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with "
               "this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "Apache-2.0-header": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
                         "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
                         'writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, '
                         "either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    "GPL-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published "
                      "by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in "
                      "the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR "
                      "PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU General Public License along with "
                      "this program. If not, see <https://www.gnu.org/licenses/>.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above "
           'copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH '
           "REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, "
           "DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, "
           "NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "
           '"Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, '
           "sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
           "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. "
           'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, '
           "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
           "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS "
           "IN THE SOFTWARE.",
    "BSD-2-Clause": f"{_TWO_CLAUSES} {_DISCLAIMER}",
    "BSD-3-Clause": f"{_TWO_CLAUSES} 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
                    f"derived from this software without specific prior written permission. {_DISCLAIMER}",
    "Unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or "
                 "distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    "Zlib": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising "
            "from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to "
            "alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must "
            "not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be "
            "appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original "
            "software. 3. This notice may not be removed or altered from any source distribution.",
}

_WORD = re.compile(r"[a-z0-9]+(?:\.[0-9]+)*")
_BLANK = re.compile(r"\s")


def normalised(text: str) -> list[str]:
    """Lower-case words without punctuation; a number keeps its inner points."""
    return _WORD.findall(text.lower())


def bigrams(words: list[str]) -> Counter[tuple[str, str]]:
    return Counter(zip(words, words[1:]))


def size_bounds(size: int, threshold: float) -> tuple[float, float]:
    """Sizes that a run can reach the threshold with."""
    return size * threshold / (2 - threshold), size * (2 - threshold) / threshold


def pieces(text: str, limit: int) -> Iterator[str]:
    """A text cut at blanks into parts of at least ``limit`` characters; words hold no blank."""
    at = 0
    while at < len(text):
        blank = _BLANK.search(text, at + limit)
        end = blank.start() if blank else len(text)
        yield text[at:end]
        at = end


class Template:
    """Sizes of a template, and how often each of its bigrams (by number) occurs in it."""

    def __init__(self, counts: dict[int, int], threshold: float):
        self.counts = counts
        self.size = sum(counts.values())
        low, high = size_bounds(self.size, threshold)
        self.least, self.most = math.ceil(low - 1e-9), math.floor(high + 1e-9)

    def best(self, at: np.ndarray, gram: np.ndarray, threshold: float) -> tuple[float, int, int] | None:
        """Best run over the places ``at`` of this template's bigrams: Dice, first place, bigrams; ties to the first, then the shortest."""
        if len(at) < self.least:
            return None
        starts = np.flatnonzero(at[self.least - 1:] - at[:len(at) - self.least + 1] < self.most)
        if not len(starts):
            return None
        # a place counts in a run unless the run already holds as many of its bigram as the template has
        seen: dict[int, list[int]] = defaultdict(list)
        full = np.full(len(at), -1, np.int64)
        for i, g in enumerate(gram.tolist()):
            earlier, count = seen[g], self.counts[g]
            if len(earlier) >= count:
                full[i] = earlier[-count]
            earlier.append(i)
        found = None
        stops = np.searchsorted(at, at[starts] + self.most)
        for i, stop in zip(starts.tolist(), stops.tolist()):
            reach = min(self.size, stop - i)
            if found is not None and 2 * reach / (reach + self.size) <= found[0]:
                continue
            common = np.cumsum(full[i:stop] < i)
            n = at[i:stop] - at[i] + 1
            dice = 2 * common / (n + self.size)
            j = int(dice.argmax())
            if dice[j] >= threshold and (found is None or dice[j] > found[0]):
                found = float(dice[j]), int(at[i]), int(n[j])
                if found[0] == 1:
                    break
        return found


class Matcher:
    def __init__(self, templates: dict[str, str], threshold: float):
        self.threshold = threshold
        grams = {name: bigrams(normalised(t)) for name, t in templates.items()}
        self.words: dict[str, int] = {}
        numbers: dict[tuple[str, str], int] = {}
        for counts in grams.values():
            for a, b in counts:
                self.words.setdefault(a, len(self.words) + 1)
                self.words.setdefault(b, len(self.words) + 1)
                numbers.setdefault((a, b), len(numbers))
        # number of each pair of template words, -1 where no template holds it; word 0 is any other
        self.pairs = np.full((len(self.words) + 1) ** 2, -1, np.int32)
        for (a, b), k in numbers.items():
            self.pairs[self.words[a] * (len(self.words) + 1) + self.words[b]] = k
        self.templates = {name: Template({numbers[g]: c for g, c in counts.items()}, threshold) for name, counts in sorted(grams.items()) if counts}
        self.member = {name: np.isin(np.arange(len(numbers)), list(t.counts)) for name, t in self.templates.items()}
        self.least = min((t.least for t in self.templates.values()), default=1)

    def places(self, text: str, limit: int = PIECE) -> tuple[np.ndarray, np.ndarray]:
        """Word positions at which a bigram of any template starts, and its number."""
        get, width = self.words.get, len(self.words) + 1
        at, grams, done, last = [], [], 0, np.zeros(0, np.int64)
        for piece in pieces(text, limit):
            words = normalised(piece)
            if not words:
                continue
            numbers = np.concatenate([last, np.fromiter((get(w, 0) for w in words), np.int64, len(words))])
            pair = self.pairs[numbers[:-1] * width + numbers[1:]]
            hits = np.flatnonzero(pair >= 0)
            at.append(hits + done)
            grams.append(pair[hits])
            done, last = done + len(numbers) - 1, numbers[-1:]
        return (np.concatenate(at), np.concatenate(grams)) if at else (np.zeros(0, np.int64), np.zeros(0, np.int32))

    def scan(self, text: str, limit: int = PIECE) -> dict[str, tuple[float, int, int]]:
        """For each template found the Dice of its best run, the run's first word and its number of words."""
        at, grams = self.places(text, limit)
        found = {}
        if len(at) >= self.least:
            for name, template in self.templates.items():
                own = self.member[name][grams]
                best = template.best(at[own], grams[own], self.threshold)
                if best:
                    found[name] = best[0], best[1], best[2] + 1
        return found


def _scan(templates: dict[str, str], threshold: float):
    def run(batches):
        matcher = Matcher(templates, threshold)
        for batch in batches:
            found = [matcher.scan(t.as_py() or "") for t in batch.column("text")]
            part = lambda k, kind: pa.array([[v[k] for v in f.values()] for f in found], pa.list_(kind))
            best = [min(f, key=lambda n: (-f[n][0], n)) if f else None for f in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([list(f) for f in found], pa.list_(pa.string())), part(0, pa.float64()), pa.array(best, pa.string()),
                 pa.array([f[b][0] if b else None for f, b in zip(found, best)], pa.float64()), part(1, pa.int64()), part(2, pa.int64())],
                names=["doc_id", "licenses", "scores", "best_license", "best_score", "first_words", "n_words"])
    return run


def license_scan(docs: DataFrame, templates: dict[str, str] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """Licences of every whole text: ``doc_id``, ``licenses`` (names in order), ``scores`` (best Dice of each),
    ``best_license`` and ``best_score`` (ties to the name that sorts first), ``first_words`` and ``n_words`` (each
    licence's best run: position of its first word, from 0, and its words; ties to the first run, then the shortest).

    Null, empty and licence-free texts have empty lists and nulls. Each row stands alone: repeated rows are each returned,
    other columns are not read, and an empty table gives an empty result. Templates of fewer than two words match nothing.
    Texts and paragraphs have no length limit.
    """
    return docs.select("doc_id", "text").mapInArrow(
        _scan(TEMPLATES if templates is None else templates, threshold),
        "doc_id long, licenses array<string>, scores array<double>, best_license string, best_score double, first_words array<long>, n_words array<long>")
