"""License scans by sentence rules.

A text is cut into sentences. A sentence without punctuation and in lower case is
looked up among the known licence sentences, which gives its identifier; the
sequence of identifiers in a text is then matched against ordered licence rules,
the longest first. Sentences may run over several lines, also with comment marks
before each, and may hold punctuation that ends others: sentences within a line,
lines, sentences over lines and runs of neighbouring pieces of any number are all
tried, and the longest find counts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

# Sentences of public licence texts and notices.
SENTENCES = {
    "apache-licensed": ['Licensed under the Apache License, Version 2.0 (the "License");',
                        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
                        "compliance with the License."],
    "apache-not-use": ["you may not use this file except in compliance with the License."],
    "apache-copy-at": ["You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
                       "You may obtain a copy of the License at https://www.apache.org/licenses/LICENSE-2.0",
                       "You may obtain a copy of the License at"],
    "apache-unless": ["Unless required by applicable law or agreed to in writing, software distributed under the License is "
                      'distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.'],
    "apache-see": ["See the License for the specific language governing permissions and limitations under the License."],
    "apache-reference": ["Licensed under the Apache License, Version 2.0.", "This work is licensed under the Apache License, Version 2.0.",
                         "Released under the Apache License, Version 2.0."],
    "mit-permission": ["Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
                       'documentation files (the "Software"), to deal in the Software without restriction, including without '
                       "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
                       "the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
                       "conditions:"],
    "mit-notice": ["The above copyright notice and this permission notice shall be included in all copies or substantial portions of "
                   "the Software."],
    "mit-as-is": ['THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO '
                  "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."],
    "mit-liability": ["IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER "
                      "IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE "
                      "OR OTHER DEALINGS IN THE SOFTWARE."],
    "mit-reference": ["Released under the MIT License.", "Licensed under the MIT License.", "This work is licensed under the MIT License.",
                      "This project is licensed under the MIT License."],
    "bsd-redistribute": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
                         "the following conditions are met:"],
    "bsd-source": ["Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
                   "disclaimer."],
    "bsd-binary": ["Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
                   "disclaimer in the documentation and/or other materials provided with the distribution."],
    "bsd-endorse": ["Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
                    "derived from this software without specific prior written permission."],
    "bsd-as-is": ['THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
                  "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
                  "DISCLAIMED."],
    "isc-permission": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
                       "granted, provided that the above copyright notice and this permission notice appear in all copies.",
                       "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby "
                       "granted, provided that the above copyright notice and this permission notice appear in all copies."],
    "isc-as-is": ['THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL '
                  "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS."],
    "gpl2-or-later": ["This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
                      "License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any "
                      "later version."],
    "gpl3-or-later": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
                      "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
                      "later version."],
    "gpl-hope": ["This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied "
                 "warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."],
    "gpl-see": ["See the GNU General Public License for more details."],
    "gpl2-reference": ["This work is licensed under the GNU General Public License, version 2.",
                       "Licensed under the GNU General Public License, version 2."],
    "gpl3-reference": ["This work is licensed under the GNU General Public License, version 3.",
                       "Licensed under the GNU General Public License, version 3."],
    "mpl2-subject": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "mpl2-copy": ["If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
                  "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."],
    "unlicense": ["This is free and unencumbered software released into the public domain."],
    "copyright": ["All rights reserved."],
}
# Rules as (licence, kind, ordered sentences).
RULES = [
    ("Apache-2.0", "notice", ("apache-licensed", "apache-not-use", "apache-copy-at", "apache-unless", "apache-see")),
    ("Apache-2.0", "notice", ("apache-licensed", "apache-copy-at", "apache-unless", "apache-see")),
    ("Apache-2.0", "notice", ("apache-licensed", "apache-not-use")),
    ("Apache-2.0", "notice", ("apache-licensed",)),
    ("Apache-2.0", "reference", ("apache-reference",)),
    ("MIT", "text", ("mit-permission", "mit-notice", "mit-as-is", "mit-liability")),
    ("MIT", "reference", ("mit-reference",)),
    ("BSD-3-Clause", "text", ("bsd-redistribute", "bsd-source", "bsd-binary", "bsd-endorse", "bsd-as-is")),
    ("BSD-2-Clause", "text", ("bsd-redistribute", "bsd-source", "bsd-binary", "bsd-as-is")),
    ("ISC", "text", ("isc-permission", "isc-as-is")),
    ("GPL-2.0-or-later", "notice", ("gpl2-or-later", "gpl-hope", "gpl-see")),
    ("GPL-2.0-or-later", "notice", ("gpl2-or-later",)),
    ("GPL-3.0-or-later", "notice", ("gpl3-or-later", "gpl-hope", "gpl-see")),
    ("GPL-3.0-or-later", "notice", ("gpl3-or-later",)),
    ("GPL-2.0-only", "reference", ("gpl2-reference",)),
    ("GPL-3.0-only", "reference", ("gpl3-reference",)),
    ("MPL-2.0", "notice", ("mpl2-subject", "mpl2-copy")),
    ("MPL-2.0", "notice", ("mpl2-subject",)),
    ("Unlicense", "text", ("unlicense",)),
]
# Licences named by a code, for "Licensed under CC BY 4.0." and SPDX lines.
CREATIVE_COMMONS = ["BY", "BY-SA", "BY-ND", "BY-NC", "BY-NC-SA", "BY-NC-ND"]
CREATIVE_COMMONS_VERSIONS = ["1.0", "2.0", "2.5", "3.0", "4.0"]
SPDX = ["Apache-2.0", "MIT", "BSD-2-Clause", "BSD-3-Clause", "ISC", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only",
        "GPL-3.0-or-later", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later", "AGPL-3.0-only",
        "AGPL-3.0-or-later", "MPL-2.0", "Unlicense", "CC0-1.0"]
# Every known sentence holds one of these; each lies within a word, so white space and hyphens cannot part it.
CUES = ["licen", "permission", "copyright", "redistribut", "domain", "warrant", "liable", "mpl", "endorse", "reserved", "cc"]

#: Other sentences that may stand between two sentences of a rule, such as an address or a copyright line.
GAP = 2


def normalise(sentence: str) -> str:
    """Lower-case words of letters and digits, one space apart."""
    return " ".join(re.findall(r"[^\W_]+", sentence.lower()))


def catalogue() -> tuple[dict[str, str], list[tuple[str, str, tuple[str, ...]]]]:
    """Normalised sentences with their identifiers, and all rules, the longest first."""
    known, rules = {normalise(s): name for name, texts in SENTENCES.items() for s in texts}, list(RULES)
    for code in CREATIVE_COMMONS:
        for version in CREATIVE_COMMONS_VERSIONS:
            name = f"CC-{code}-{version}"
            for start in ("Licensed under", "This work is licensed under", "Released under"):
                known[normalise(f"{start} CC {code} {version}")] = f"{name}-reference"
            rules.append((name, "reference", (f"{name}-reference",)))
    for name in [*SPDX, *(f"CC-{c}-{v}" for c in CREATIVE_COMMONS for v in CREATIVE_COMMONS_VERSIONS)]:
        known[normalise(f"SPDX-License-Identifier: {name}")] = f"{name}-spdx"
        rules.append((name, "spdx", (f"{name}-spdx",)))
    return known, sorted(rules, key=lambda rule: -len(rule[2]))


class Scanner:
    """The catalogue, ready for texts."""

    # A sentence ends at closing punctuation before white space; a blank line ends one as well.
    END = re.compile(r"(?<=[.!?;:])[\"')\]]*\s+|\n[ \t#*/;%-]*\n")
    NEWLINE = re.compile(r"\n")
    WORD = re.compile(r"[^\W_]")
    LINE = re.compile(r"(?<=[.!?;:])[\"')\]]*\s+|\n")
    # An SPDX tag may follow anything.
    TAGGED = re.compile(LINE.pattern + r"|(?=\bspdx-license-identifier:)", re.IGNORECASE)
    WORDS = re.compile(r"[^\W_]+")

    def __init__(self) -> None:
        self.known, self.rules = catalogue()
        #: Known sentences word by word; None holds the identifier of a sentence that is whole there.
        self.tree: dict = {}
        for sentence, name in self.known.items():
            node = self.tree
            for word in sentence.split():
                node = node.setdefault(word, {})
            node[None] = name
        self.first: dict[str, list[tuple[str, str, tuple[str, ...]]]] = {}
        for rule in self.rules:
            self.first.setdefault(rule[2][0], []).append(rule)

    @staticmethod
    def spans(text: str, cut: re.Pattern) -> Iterator[tuple[int, int]]:
        at = 0
        for match in cut.finditer(text):
            yield at, match.start()
            at = match.end()
        yield at, len(text)

    def _run(self, text: str, pieces: list[tuple[int, int]], at: int) -> tuple[int, str] | None:
        """Last character and identifier of the longest known sentence that whole pieces from ``at`` on make up."""
        node, longest = self.tree, None
        for place in range(at, len(pieces)):
            any_word = False
            for match in self.WORDS.finditer(text, *pieces[place]):
                node, any_word = node.get(match[0].lower()), True
                if node is None:
                    return longest
            if any_word and None in node:
                longest = (pieces[place][1], node[None])
            elif not any_word and place == at:
                return None
        return longest

    def sentences(self, text: str) -> list[tuple[int, int, str | None]]:
        """First and last character of each sentence, with its identifier if known; finds in lines and over lines."""
        lower = text.lower()
        if not any(cue in lower for cue in CUES):
            return []
        found: dict[int, tuple[int, int, str]] = {}
        cut = self.TAGGED if "spdx" in lower else self.LINE
        lines = [(first, last) for first, last in self.spans(text, cut) if first < last]
        longest = max(map(len, self.known))
        whole_lines = self.spans(text, self.NEWLINE)
        over_lines = ((a, b) for a, b in self.spans(text, self.END) if "\n" in text[a:b])
        for first, last in (*lines, *whole_lines, *over_lines):
            # A known sentence has a few comment marks and spaces more at most.
            if last - first <= 4 * longest:
                name = self.known.get(normalise(text[first:last]))
                if name and (first not in found or last > found[first][1]):
                    found[first] = (first, last, name)
        for place, (first, _) in enumerate(lines):
            run = self._run(text, lines, place)
            if run and (first not in found or run[0] > found[first][1]):
                found[first] = (first, *run)
        out, end = [], -1
        for first, last in lines:
            if first in found and first >= end:
                out.append(found[first])
                end = found[first][1]
            elif first >= end and self.WORD.search(text, first, last):
                out.append((first, last, None))
        return out

    def licences(self, text: str) -> list[tuple[str, str, int, int, list[str]]]:
        """Licences of a text in order: name, kind, first and last character, sentences."""
        sentences = self.sentences(text)
        named = [i for i, s in enumerate(sentences) if s[2]]
        out, at = [], 0
        while at < len(named):
            step = 1
            for name, kind, sequence in self.first.get(sentences[named[at]][2], []):
                places = self._follow(sentences, named, at, sequence)
                if places:
                    used = [sentences[named[p]] for p in places]
                    out.append((name, kind, used[0][0], used[-1][1], [s[2] for s in used]))
                    step = places[-1] - at + 1
                    break
            at += step
        return out

    @staticmethod
    def _follow(sentences: list, named: list[int], at: int, sequence: tuple[str, ...]) -> list[int]:
        """Places in ``named`` of a rule's sentences, in order and at most ``GAP`` others apart; empty if they are not there."""
        places = [at]
        for name in sequence[1:]:
            later = range(places[-1] + 1, len(named))
            near = (p for p in later if named[p] - named[places[-1]] <= GAP + 1)
            place = next((p for p in near if sentences[named[p]][2] == name), None)
            if place is None:
                return []
            places.append(place)
        return places


def licences(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """A row for each licence found in a whole text.

    ``key, license, kind, first_char, last_char, sentences``: ``kind`` is text,
    notice, reference or spdx; ``sentences`` are the identifiers that matched, in
    order. Sentences that begin no rule give no row. Null and empty texts give no
    rows; a licence that stands twice is reported twice. Repeated rows and null
    keys are kept; other columns are not read.
    """

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scanner = Scanner()
        for batch in batches:
            rows = [(k, *found) for k, t in zip(batch["key"].tolist(), batch["text"]) if t for found in scanner.licences(t)]
            frame = pd.DataFrame(rows, columns=["key", "license", "kind", "first_char", "last_char", "sentences"])
            yield frame.astype({"key": object})

    rows = documents.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    out = rows.mapInPandas(work, f"key {kind}, license string, kind string, first_char bigint, last_char bigint, sentences array<string>")
    return out.withColumnRenamed("key", key)
