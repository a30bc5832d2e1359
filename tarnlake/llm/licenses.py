"""License scan: MinHash bands of overlapping text windows retrieve templates.

A window holds as many shingles as a template; its MinHash values, in bands, are looked up
among those of the templates. Windows and templates that meet in a band are compared by exact
shingles: the share of the template's shingles that the window and its surroundings hold.

Windows step on by a quarter of their size, so some window misses an eighth of a passage at
most. A passage with 0.8 of a template's shingles, in a window of the same number of them, has
a Jaccard similarity of 0.8 / 1.2 = 0.67, and of 0.5 with an eighth cut off. With 20 bands of
2 values such a window is found with a chance of 1 - (1 - 0.25) ** 20 = 0.997 at the least and
of over 0.99999 without a cut. Small templates have windows at every shingle.
"""

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnlake.llm.common import mixed, prepare, text_pieces

SHINGLE_WORDS = 5
CONTAINMENT = 0.8
BANDS, VALUES = 20, 2
#: Windows step on by this part of their size; templates of about the same size share windows.
STEP, ALIKE = 4, 8
#: Shingles that are worked on at a time, few enough for a processor's cache.
STRETCH = 1 << 16
#: Bits of the table that tells most windows from all templates before they are looked up.
FLAG_BITS = 16
#: Distinct words whose hash a worker remembers.
CACHED_WORDS = 500_000

# The texts and notices by which files and pages state the common licenses. The
# long bodies of the GNU, Mozilla and Creative Commons licenses are told by the header or notice
# that they ask to be put on a work; of Apache's, by the header in its appendix.
_AS_IS = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE '
    "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
    "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
    "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_BSD_WARRANTY = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF "
    "THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_GNU = (
    "This {work} is free software: you can redistribute it and/or modify it under the terms of the GNU {name} as published by "
    "the Free Software Foundation, either version {version} of the License, or (at your option) any later version. This {work} "
    "is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
    "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name} for more details."
)
TEMPLATES: dict[str, str | tuple[str, ...]] = {
    "MIT": ("Released under the MIT License.", "Released under the terms of the MIT License.", "Licensed under the MIT License."),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Apache Software License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the '
        "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable "
        'law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES '
        "OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and "
        "limitations under the License.",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        _GNU.format(work="program", name="General Public License", version="3"),
    ),
    "GPL-2.0": _GNU.format(work="program", name="General Public License", version="2"),
    "LGPL-3.0": _GNU.format(work="library", name="Lesser General Public License", version="3"),
    "LGPL-2.1": _GNU.format(work="library", name="Lesser General Public License", version="2.1"),
    "AGPL-3.0": _GNU.format(work="program", name="Affero General Public License", version="3"),
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
    "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
    "provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" "
    "AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND "
    "FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES "
    "WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, "
    "ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "Unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, "
    "use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, "
    "commercial or non-commercial, and by any means.",
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met",
        _BSD_WARRANTY,
    ),
    "MIT-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation '
        'files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, '
        "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
        "Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice "
        "shall be included in all copies or substantial portions of the Software.",
        _AS_IS,
    ),
}

_WORD = re.compile(r"\w+(?:[.'-]\w+)*")


def license_words(text: str | None) -> list[str]:
    """Lower-cased words without the punctuation around them."""
    return _WORD.findall(text.lower()) if text else []


class _Codes(dict):
    """Hashes of words, made on first use; starts anew when it is full."""

    def __missing__(self, word):
        if len(self) >= CACHED_WORDS:
            self.clear()
        self[word] = code = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return code


_codes = _Codes()
_NONE = np.uint64(2**64 - 1)
#: Odd multipliers, one for each MinHash value: hash times multiplier puts shingles in another order.
_FACTORS = mixed(np.arange(BANDS * VALUES, dtype=np.uint64), 7) | np.uint64(1)


def shingle_hashes(tokens: list[str], size: int = SHINGLE_WORDS) -> np.ndarray:
    """A hash per shingle of ``size`` words; fewer words make one shingle, none make none."""
    if not tokens:
        return np.empty(0, np.uint64)
    codes = np.fromiter(map(_codes.__getitem__, tokens), np.uint64, len(tokens))
    count = max(1, len(tokens) - size + 1)
    out = np.zeros(count, np.uint64)
    for i in range(min(size, len(tokens))):
        out = out * _FACTORS[0] + codes[i : i + count]
    return mixed(out, 2)


def _pyramid(hashes: np.ndarray, padding: np.ndarray, number: int, largest: int) -> list[np.ndarray]:
    """The least values of runs of 1, 2, 4, ... shingles in the order of one MinHash value."""
    run = hashes * _FACTORS[number]
    run[padding] = _NONE
    runs, length = [run], 1
    while 2 * length <= largest:
        run = np.minimum(run[:-length], run[length:])
        length *= 2
        runs.append(run)
    return runs


def _least(runs: list[np.ndarray], size: int, step: int, count: int) -> np.ndarray:
    """The least value of each window, from two runs that cover it."""
    run = runs[size.bit_length() - 1]
    shift = size - (1 << (size.bit_length() - 1))
    found = run[: count : step]
    return np.minimum(found, run[shift : shift + count : step]) if shift else found


def _key(first: np.ndarray, second: np.ndarray, band: int) -> np.ndarray:
    return (first * _FACTORS[0] + (second ^ np.uint64(band))) * _FACTORS[1]


class Templates:
    """The templates' shingles and bands; they are a reference list, small by nature."""

    def __init__(self, texts: dict[str, str | tuple[str, ...]]):
        every = [(name, t) for name, own in texts.items() for t in ((own,) if isinstance(own, str) else own)]
        self.names = [name for name, _ in every]
        hashes = [shingle_hashes(license_words(t)) for _, t in every]
        if not all(map(len, hashes)):
            raise ValueError("a template has no words")
        self.shingles = [np.unique(h) for h in hashes]
        self.classes: dict[int, list[int]] = {}
        for i in np.argsort([len(h) for h in hashes], kind="stable").tolist():
            size = next((s for s in self.classes if len(hashes[i]) <= s * (1 + 1 / ALIKE)), len(hashes[i]))
            self.classes.setdefault(size, []).append(i)
        self.largest = max(self.classes, default=1)
        self.all_shingles = np.unique(np.concatenate([*self.shingles, np.empty(0, np.uint64)]))
        self.shingle_flags = np.zeros(1 << FLAG_BITS, bool)
        self.shingle_flags[self.all_shingles >> np.uint64(64 - FLAG_BITS)] = True
        # By class and band: the templates' keys and a table of the keys' top bits.
        self.keys, self.flags = {}, {}
        for size, members in self.classes.items():
            for band in range(BANDS):
                values = [[(self.shingles[i] * _FACTORS[band * VALUES + v]).min() for i in members] for v in range(VALUES)]
                keys = _key(*(np.array(v, dtype=np.uint64) for v in values), band)
                self.keys[size, band] = keys
                self.flags[size, band] = np.zeros(1 << FLAG_BITS, bool)
                self.flags[size, band][keys >> np.uint64(64 - FLAG_BITS)] = True

    def stretches(self, hashes: np.ndarray) -> Iterator[tuple[int, int]]:
        """(first, end) of the starts of all windows that hold a shingle of any template.

        No other window can share a band with a template: its least values are of other shingles.
        """
        at = np.flatnonzero(self.shingle_flags[hashes >> np.uint64(64 - FLAG_BITS)])
        at = at[np.isin(hashes[at], self.all_shingles)]
        if not len(at):
            return
        apart = np.flatnonzero(np.diff(at) > self.largest)
        firsts, lasts = at[np.append(0, apart + 1)], at[np.append(apart, len(at) - 1)]
        for first, last in zip(np.maximum(0, firsts - self.largest + 1).tolist(), lasts.tolist()):
            for start in range(first, last + 1, STRETCH):
                yield start, min(last + 1, start + STRETCH)

    def candidates(self, hashes: np.ndarray, padding: np.ndarray) -> set[tuple[int, int, int]]:
        """(template, start, size) of windows that share a band with a template.

        ``padding`` marks places between documents, which have no shingle; after the last
        document there are as many as the largest window.
        """
        found = set()
        count = max(0, len(hashes) - self.largest + 1)
        top = np.uint64(64 - FLAG_BITS)
        for band in range(BANDS):
            first, second = (_pyramid(hashes, padding, band * VALUES + v, self.largest) for v in range(VALUES))
            for size, members in self.classes.items():
                step = max(1, size // STEP)
                keys = _key(_least(first, size, step, count), _least(second, size, step, count), band)
                for at in np.flatnonzero(self.flags[size, band][keys >> top]).tolist():
                    for k in np.flatnonzero(self.keys[size, band] == keys[at]).tolist():
                        found.add((members[k], at * step, size))
        return found

    def verify(self, template: int, start: int, size: int, hashes: np.ndarray) -> tuple[int, int, float] | None:
        """(first shingle, end shingle, containment) of a template about a window of a document."""
        own, slack = self.shingles[template], -(-size // STEP)
        first, end = max(0, start - slack), min(len(hashes), start + size + slack)
        inside = np.isin(hashes[first:end], own)
        share = len(np.unique(hashes[first:end][inside])) / len(own)
        if share < CONTAINMENT:
            return None
        at = np.flatnonzero(inside)
        return first + int(at[0]), first + int(at[-1]) + 1, share


def passages(texts: list[str | None], templates: Templates) -> list[list[tuple[str, int, int, float]]]:
    """(template, first word, end word, containment) of the passages of each text, in order.

    Overlapping finds of a license are one passage, with the greatest containment of them.
    The texts' shingles stand one after the other with room for a window between.
    """
    room = templates.largest
    docs = [shingle_hashes(license_words(t)) for t in texts]
    lengths = np.array([len(d) + room for d in docs], dtype=np.int64)
    starts = np.cumsum(lengths) - lengths
    gap = np.zeros(room, np.uint64)
    line = np.concatenate([part for d in docs for part in (d, gap)]) if docs else gap
    padding = np.ones(len(line), bool)
    for start, d in zip(starts.tolist(), docs):
        padding[start : start + len(d)] = False
    finds: list[set] = [set() for _ in docs]
    for base, last in templates.stretches(line):
        part = slice(base, last + room)
        # Windows may begin in the room before a document.
        for template, at, size in templates.candidates(line[part], padding[part]):
            middle = base + at
            doc = int(np.searchsorted(starts, middle, "right")) - 1
            if middle - starts[doc] >= len(docs[doc]) and doc + 1 < len(docs):
                doc += 1
            if found := templates.verify(template, int(middle - starts[doc]), size, docs[doc]):
                finds[doc].add((templates.names[template], *found))
    out = []
    for found in finds:
        merged: list[list] = []
        for name, first, end, share in sorted(found):
            if merged and merged[-1][0] == name and first < merged[-1][2]:
                merged[-1][2:] = [max(end, merged[-1][2]), max(share, merged[-1][3])]
            else:
                merged.append([name, first, end, share])
        spans = [(name, first, end + SHINGLE_WORDS - 1, share) for name, first, end, share in merged]
        out.append(sorted(spans, key=lambda p: (p[1], p[0])))
    return out


def license_scan(docs: DataFrame, templates: dict[str, str | tuple[str, ...]] = TEMPLATES, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(``doc_id``, ``license``, ``first_word``, ``end_word``, ``containment``), one row per passage found.

    Passages hold at least ``CONTAINMENT`` of a template's shingles of ``SHINGLE_WORDS`` words.
    A license may have several templates, each a passage of its own kind. A passage that comes near
    the texts of several licenses (the GNU headers differ in a few words) is a row for each, and
    the containment tells them apart. Words are counted from 0, lower-cased and without the punctuation around them. Whole
    texts are scanned, long ones stretch by stretch. Null and empty texts hold nothing.
    Repeated rows and null ids give their own rows; other columns are not read. Documents
    without a passage give no row. Nothing is shuffled; the templates go to every task.
    """
    prepare(docs.sparkSession)
    known = Templates(templates)
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    schema = pa.schema([("doc_id", pa.int64()), ("license", pa.string()), ("first_word", pa.int64()), ("end_word", pa.int64()), ("containment", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_pieces(batches, "text"):
            found = [(i, *p) for i, own in zip(batch.column("doc_id").to_pylist(), passages(texts, known)) for p in own]
            columns = list(zip(*found)) or [[]] * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return rows.mapInArrow(run, "doc_id long, license string, first_word long, end_word long, containment double")
