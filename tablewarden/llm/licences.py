"""License scans: texts compared with licence templates by Dice coefficient.

Units of a text are the whole of it, its paragraphs and its lines. A unit is normalised to
lower-case words without punctuation; it matches a template when the Dice coefficient of
their word bigrams (as multisets), 2 |A and B| / (|A| + |B|), is at least ``LEAST``. As
|A and B| is at most the smaller size, a template of size b can only match units of sizes
from b d / (2 - d) to b (2 - d) / d; other templates are not compared. Texts too long to be
a unit of any template skip the comparison without being cut.

Every document is judged in its own row, so nothing is shuffled. Null and empty texts match
nothing; of equal coefficients the first template by name wins; repeated rows repeat.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator, Mapping

import pandas as pd
from pyspark.sql import DataFrame

from tablewarden.llm.common import load

LEAST = 0.75
WORD = re.compile(r"[^\W_]+(?:\.[^\W_]+)*")
BLANK = re.compile(r"\n[ \t\r]*\n")

# fixed values: short licence notices
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance'
        " with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0."
        " Unless required by applicable law or agreed to in writing, software distributed under the License is"
        ' distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.'
        " See the License for the specific language governing permissions and limitations under the License."
    ),
    "BSD-3-Clause": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General"
        " Public License as published by the Free Software Foundation, either version 3 of the License, or (at your"
        " option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY"
        " WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."
    ),
    "MIT": "Released under the MIT License.",
    "MIT-header": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        ' documentation files (the "Software"), to deal in the Software without restriction, including without'
        " limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of"
        " the Software, and to permit persons to whom the Software is furnished to do so."
    ),
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}


def bigrams(text: str) -> Counter:
    words = WORD.findall(text.lower())
    return Counter(zip(words, words[1:], strict=False))


def dice(a: Counter, b: Counter) -> float:
    total = a.total() + b.total()
    return 2 * (a & b).total() / total if total else 0.0


class Scanner:
    """Templates ordered by size, for the bounds."""

    def __init__(self, templates: Mapping[str, str], least: float):
        self.least = least
        self.templates = sorted((b.total(), name, b) for name, text in templates.items() if (b := bigrams(text)))
        self.sizes = [t[0] for t in self.templates]
        self.words = {w for _, _, b in self.templates for pair in b for w in pair}
        self.low = self.sizes[0] * least / (2 - least) if self.sizes else 1
        self.high = self.sizes[-1] * (2 - least) / least if self.sizes else 0

    def best(self, unit: str) -> tuple[str, float] | None:
        words = WORD.findall(unit.lower())
        n = len(words) - 1
        if not self.low <= n <= self.high:
            return None
        # Dice needs n d / (2 - d) common bigrams, so more than half as many known words
        if sum(w in self.words for w in words) < n * self.least / (2 - self.least):
            return None
        own, found = Counter(zip(words, words[1:], strict=False)), None
        first = bisect_left(self.sizes, n * self.least / (2 - self.least))
        last = bisect_right(self.sizes, n * (2 - self.least) / self.least)
        for _, name, template in self.templates[first:last]:
            d = dice(own, template)
            if d >= self.least and (found is None or (-d, name) < (-found[1], found[0])):
                found = (name, d)
        return found

    def scan(self, text: str) -> list[tuple[str, float, int, int]]:
        """(licence, dice, start, stop) of the matching units, in characters; a unit inside a
        matching unit is not listed again."""
        found: list[tuple[str, float, int, int]] = []

        def look(start: int, stop: int) -> bool:
            match = self.best(text[start:stop])
            if match:
                found.append((*match, start, stop))
            return bool(match)

        if look(0, len(text)):
            return found
        start = 0
        for blank in [*BLANK.finditer(text), None]:
            stop = blank.start() if blank else len(text)
            whole = (start, stop) == (0, len(text))
            if start < stop and (whole or not look(start, stop)):
                line = start
                while line < stop:
                    end = text.find("\n", line, stop)
                    end = stop if end < 0 else end
                    if (line, end) != (start, stop):
                        look(line, end)
                    line = end + 1
            start = blank.end() if blank else stop
        return found


def licence_matches(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, least: float = LEAST) -> DataFrame:
    """(doc_id, licence, dice, start, stop): a row per matching unit of the whole texts."""
    templates = dict(templates)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scanner = Scanner(templates, least)
        for batch in batches:
            rows = [
                (doc_id, *match)
                for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True)
                if text
                for match in scanner.scan(text)
            ]
            yield pd.DataFrame(rows, columns=["doc_id", "licence", "dice", "start", "stop"])

    return docs.select("doc_id", "text").mapInPandas(
        run, "doc_id long, licence string, dice double, start int, stop int"
    )


def op4_license_scans(spark, folder: str) -> DataFrame:
    return licence_matches(load(spark, folder, "documents"))
