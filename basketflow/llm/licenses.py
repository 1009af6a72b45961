"""Licence notices found in texts by the Dice coefficient over word bigrams."""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import documents, id_text, worker_state
from .word_bpe import blocks

THRESHOLD = 0.8

# The notices, as their licences word them.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "
        '"Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, '
        "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to "
        "the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of "
        'the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE '
        "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE "
        "LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN "
        "CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may '
        "obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software "
        'distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. '
        "See the License for the specific language governing permissions and limitations under the License.",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    (
        "GPL-3.0-or-later",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
        "the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the "
        "hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR "
        "PURPOSE. See the GNU General Public License for more details.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the "
        "above copyright notice and this permission notice appear in all copies.",
    ),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are "
        "met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution. Neither the name of the copyright holder nor the names of its "
        "contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    ),
    (
        "BSD-2-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are "
        "met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "
        '"AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES ARE DISCLAIMED.',
    ),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("LGPL-2.1", "This work is licensed under the GNU Lesser General Public License, version 2.1."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    *[(f"CC-{kind}-{version}", f"Licensed under CC {kind} {version}.") for version in ("4.0", "3.0") for kind in ("BY", "BY-SA", "BY-ND", "BY-NC", "BY-NC-SA", "BY-NC-ND")],
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Proprietary", "All rights reserved."),
]

_WORD = re.compile(r"[^\W_]+")
# Words that tell sibling licences apart. A notice has those of its template and no other, and all numbers of its template.
SIBLINGS = frozenset(("lesser", "library", "affero", "sa", "nd", "nc"))


def normalised(text: str) -> list[str]:
    """Lower-cased runs of letters and digits; the British spelling of licence as the American."""
    return [w.replace("licence", "license") for w in _WORD.findall(text.lower())]


def bounds(size: int, threshold: float) -> tuple[int, int, int]:
    """For a template of so many different bigrams: least and most different bigrams of a text that can reach the threshold, and the least they must share.

    2 s / (n + size) >= t with s <= n and s <= size.
    """
    low = math.ceil(threshold * size / (2 - threshold) - 1e-9)
    return low, math.floor(size * (2 - threshold) / threshold + 1e-9), low


class _Repeats:
    """For each place of a text where the bigram there stood before, and the next place that is new to a stretch."""

    def __init__(self, words: list[str]):
        last: dict[tuple[str, str], int] = {}
        self.before = []
        for p, pair in enumerate(zip(words, words[1:])):
            self.before.append(last.get(pair, -1))
            last[pair] = p
        # Level by level the least of each 16 places, so that long repetitions are passed in few steps.
        self.least = [self.before]
        while len(self.least[-1]) > 16:
            row = self.least[-1]
            self.least.append([min(row[i : i + 16]) for i in range(0, len(row), 16)])

    def next_new(self, place: int, first: int) -> int | None:
        """The first place from `place` on whose bigram does not stand between `first` and it; None if there is none."""
        level = 0
        while True:
            row = self.least[level]
            if place >= len(row):
                return None
            if row[place] < first:
                if not level:
                    return place
                level, place = level - 1, place * 16
            else:
                place += 1
                while place % 16 == 0 and level + 1 < len(self.least):
                    place, level = place // 16, level + 1


class Scanner:
    """Templates as sets of word bigrams, and the search for stretches of a text that are like one."""

    def __init__(self, templates: list[tuple[str, str]], threshold: float):
        self.threshold = threshold
        self.names = [name for name, _ in templates]
        words = [normalised(text) for _, text in templates]
        self.ids = {w: i + 1 for i, w in enumerate(sorted({w for ws in words for w in ws}))}
        self.ids |= {w.replace("license", "licence"): i for w, i in self.ids.items()}
        self.width = max(self.ids.values()) + 1
        self.sets = [{self.ids[a] * self.width + self.ids[b] for a, b in zip(ws, ws[1:])} for ws in words]
        if not all(self.sets):
            raise ValueError("a template needs two words")
        self.bounds = [bounds(len(s), threshold) for s in self.sets]
        self.named = [SIBLINGS.intersection(ws) for ws in words]
        self.numbers = [frozenset(w for w in ws if w.isdigit()) for ws in words]
        # For each bigram of any template the templates that have it, as bits: 63 templates a column.
        self.member = np.zeros((self.width * self.width, -(-len(words) // 63)), np.int64)
        for i, held in enumerate(self.sets):
            self.member[list(held), i // 63] |= 1 << i % 63

    def scan(self, text: str) -> list[tuple[str, float, int, int]]:
        """(licence, coefficient, start, end in characters) of the best stretches that don't overlap, by place.

        A stretch begins and ends with bigrams of its template: others at its ends would only lower the coefficient. It has the words and
        numbers that decide which of several sibling licences it is. From each first word the best stretch has the greatest coefficient, of
        equal ones the last that brought something new. Of these the best has the greatest coefficient, then the most words, then the first
        place, then the first name.
        """
        lower = text.lower()
        words = _WORD.findall(lower)
        ids = np.fromiter((self.ids.get(w, 0) for w in words), np.int64, len(words))
        if len(ids) < 2:
            return []
        member = self.member[ids[:-1] * self.width + ids[1:]]  # no template has id 0
        if not member.any():
            return []
        found, seen = [], None
        for t, name in enumerate(self.names):
            hits = np.flatnonzero(member[:, t // 63] >> t % 63 & 1).tolist()
            if len(hits) >= self.bounds[t][2]:
                seen = seen or _Repeats(words)
                found += [(-score, first - last, first, name, last) for score, first, last in self._stretches(words, hits, t, seen)]
        if not found:
            return []
        spots = [m.span() for m in _WORD.finditer(lower)]
        shift = None if len(lower) == len(text) else _origins(text)
        out, taken = [], bytearray(len(words))  # a mark on the first and last word of every taken stretch, and on those between
        for score, _, first, name, last in sorted(found):
            if not taken[first] and not taken[last] and not any(taken[first : last + 1]):
                taken[first : last + 1] = b"\1" * (last + 1 - first)
                start, end = spots[first][0], spots[last][1]
                out.append((name, round(-score, 6), *((start, end) if shift is None else (shift[start], shift[end - 1] + 1))))
        return sorted(out, key=lambda m: m[2])

    def _stretches(self, words: list[str], hits: list[int], t: int, seen: _Repeats):
        """(coefficient, first word, last word) of the best stretch from each first word that reaches the threshold.

        Only bigrams that are new to a stretch change its coefficient, so the search goes from one to the next. It ends when all bigrams of the
        template are there, or when there are more others than the largest fitting text can hold beside the shared ones: after a number
        of steps that the template bounds, however often the text repeats itself.
        """
        template, (_, high, need), named, numbers = self.sets[t], self.bounds[t], self.named[t], self.numbers[t]
        size, end = len(template), hits[-1]
        for i, first in enumerate(hits):
            if i + need > len(hits):
                return
            best, shared, other, at, deciding, digits = None, 0, 0, first, set(), set()
            while at is not None and at <= end:
                for word in words[at : at + 2]:
                    if word in SIBLINGS:
                        deciding.add(word)
                    elif word in numbers:
                        digits.add(word)
                if self.ids.get(words[at], 0) * self.width + self.ids.get(words[at + 1], 0) in template:
                    shared += 1
                    score = 2 * shared / (shared + other + size)
                    if score >= self.threshold - 1e-12 and (best is None or score >= best[0]) and deciding == named and digits == numbers:
                        best = (score, first, at + 1)
                    if shared == size:
                        break
                else:
                    other += 1
                    if other > high - need:
                        break
                at = seen.next_new(at + 1, first)
            if best:
                yield best


def _origins(text: str) -> list[int]:
    """For each character of text.lower() the place of the one it came from."""
    return [i for i, c in enumerate(text) for _ in c.lower()]


def scan_licenses(docs: DataFrame, templates: list[tuple[str, str]] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """One row per notice found: doc_id, license, dice, start_char, end_char, notice.

    Whole texts are searched, over line ends. Null, empty and other texts without a notice give no row. Repeated rows and null doc_ids
    give their notices each. No rows give no rows. Other columns are ignored.
    """
    templates = TEMPLATES if templates is None else templates

    def run(batches):
        scanner = worker_state("licenses", f"{hash(tuple(templates))} {threshold}", lambda: Scanner(templates, threshold))
        for batch in blocks(batches):
            rows = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                rows += [(doc, name, dice, a, b, text[a:b]) for name, dice, a, b in scanner.scan(text)]
            if rows:
                kinds = [pa.int64(), pa.string(), pa.float64(), pa.int64(), pa.int64(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["doc_id", "license", "dice", "start_char", "end_char", "notice"])

    return id_text(docs).mapInArrow(run, "doc_id long, license string, dice double, start_char long, end_char long, notice string")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(documents(spark, sf_dir))
