"""Licence notices in documents, by the Dice coefficient over word bigrams.

Text and templates are normalised to lower-case words. Windows of every length that can reach the threshold
start and end at bigrams the template shares; 2 |common| / (|window| + |template|), bigrams counted with
repeats, must reach it. Size bounds come first: windows have t / (2 - t) to (2 - t) / t of the template's
size, and a start is tried only if the longest window from it shares enough bigrams. Windows of different
templates that hold much the same words compete: the best Dice wins, so that licences whose wordings
differ in a deciding word are told apart.
"""

from __future__ import annotations

import heapq
import re
from collections import Counter
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lakeops.llm.common import inputs, slices

WORD = re.compile(r"\w+")
THRESHOLD = 0.85

# fixed values: wording of public licence notices
TEMPLATES: dict[str, str] = {
    "MIT-notice": "Released under the MIT License.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0-notice": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "all-rights-reserved": "All rights reserved.",
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the '
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice "
        "and this permission notice shall be included in all copies or substantial portions of the Software."
    ),
    "Apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with '
        "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
        'applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, '
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language "
        "governing permissions and limitations under the License."
    ),
    "GPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
        "version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
        "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more "
        "details."
    ),
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
        "distribution."
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
}

# fixed values: wording of further public licence notices, file headers and texts
_CC = "This work is licensed under a Creative Commons Attribution{} 4.0 International License."
_GNU = "This work is licensed under the GNU {}General Public License, version {}."
_GNU_HEADER = (
    "This {what} is free software{mark} you can redistribute it and/or modify it under the terms of the GNU {kind}General Public "
    "License as published by the Free Software Foundation{mark2} either version {version} of the License, or (at your option) any "
    "later version. This {what} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
    "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {kind}General Public License for more details."
)
SPDX = (
    "MIT", "Apache-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later", "LGPL-2.1-only",
    "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later", "AGPL-3.0-only", "AGPL-3.0-or-later", "MPL-2.0", "BSD-2-Clause",
    "BSD-3-Clause", "ISC", "Zlib", "BSL-1.0", "Unlicense", "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0", "EPL-2.0",
)
FURTHER: dict[str, str] = {
    "CC-BY-NC-4.0-long-notice": _CC.format("-NonCommercial"),
    "CC-BY-ND-4.0-notice": _CC.format("-NoDerivatives"),
    "CC-BY-NC-SA-4.0-notice": _CC.format("-NonCommercial-ShareAlike"),
    "CC-BY-NC-ND-4.0-notice": _CC.format("-NonCommercial-NoDerivatives"),
    "GPL-2.0-notice": _GNU.format("", "2"),
    "LGPL-2.1-notice": _GNU.format("Lesser ", "2.1"),
    "LGPL-3.0-notice": _GNU.format("Lesser ", "3"),
    "AGPL-3.0-notice": _GNU.format("Affero ", "3"),
    "GPL-2.0-header": _GNU_HEADER.format(what="program", kind="", version="2", mark=";", mark2=";"),
    "LGPL-2.1-header": _GNU_HEADER.format(what="library", kind="Lesser ", version="2.1", mark=";", mark2=";"),
    "LGPL-3.0-header": _GNU_HEADER.format(what="program", kind="Lesser ", version="3", mark=":", mark2=","),
    "AGPL-3.0-header": _GNU_HEADER.format(what="program", kind="Affero ", version="3", mark=":", mark2=","),
    "MPL-2.0-header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
        "distribution. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
        "promote products derived from this software without specific prior written permission."
    ),
    "Zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable "
        "for any damages arising from the use of this software. Permission is granted to anyone to use this software for any "
        "purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following "
        "restrictions: The origin of this software must not be misrepresented; you must not claim that you wrote the original "
        "software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but "
        "is not required. Altered source versions must be plainly marked as such, and must not be misrepresented as being the "
        "original software. This notice may not be removed or altered from any source distribution."
    ),
    "BSL-1.0": (
        'Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and '
        'accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and '
        "transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software "
        "is furnished to do so, all subject to the following"
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, "
        "compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, "
        "commercial or non-commercial, and by any means."
    ),
    "CC0-1.0-notice": (
        "To the extent possible under law, the person who associated CC0 with this work has waived all copyright and related or "
        "neighboring rights to this work."
    ),
    "EPL-2.0-header": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which "
        "is available at http://www.eclipse.org/legal/epl-2.0."
    ),
} | {f"SPDX:{name}": f"SPDX-License-Identifier: {name}" for name in SPDX}
ALL = TEMPLATES | FURTHER


def words(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def dice(a: list[str], b: list[str]) -> float:
    """Dice coefficient of the word bigrams of two word lists, with repeats; 0 if neither has any."""
    x, y = Counter(zip(a, a[1:])), Counter(zip(b, b[1:]))
    total = sum(x.values()) + sum(y.values())
    return 2 * sum((x & y).values()) / total if total else 0.0


class Scanner:
    """The templates' bigrams as numbers; bigrams of a document are looked up in one step."""

    def __init__(self, templates: Mapping[str, str], threshold: float) -> None:
        self.threshold = threshold
        lists = {name: words(text) for name, text in templates.items()}
        self.ids = {w: k + 1 for k, w in enumerate(sorted({w for ws in lists.values() for w in ws}))}
        pairs = sorted({p for ws in lists.values() for p in zip(ws, ws[1:])})
        self.number = np.zeros((len(self.ids) + 1, len(self.ids) + 1), np.int32)
        for k, (a, b) in enumerate(pairs):
            self.number[self.ids[a], self.ids[b]] = k + 1
        at = {p: k + 1 for k, p in enumerate(pairs)}
        self.templates = []
        for name, ws in lists.items():
            counts = np.bincount([at[p] for p in zip(ws, ws[1:])], minlength=len(pairs) + 1)
            if counts.sum():
                self.templates.append((name, int(counts.sum()), counts))

    def scan(self, text: str | None) -> Iterator[tuple[str, float, int, int]]:
        """(template, dice, first word, words) of the windows that reach the threshold.

        Windows of one template do not overlap: of all starts and lengths the best goes first, ties to the
        earlier, then to the shorter. Of windows of different templates that share more than half of the longer
        one, the best Dice stays; ties go to the longer, then to the lesser name. A short notice within a long
        text is its own find.
        """
        yield from compete(list(self.windows(text)))

    def windows(self, text: str | None) -> Iterator[tuple[str, float, int, int]]:
        """The best windows of every template for itself."""
        get = self.ids.get
        ids = np.array([get(w, 0) for w in words(text)], np.int64)
        grams = self.number[ids[:-1], ids[1:]]
        if not grams.any():
            return
        t = self.threshold
        for name, size, counts in self.templates:
            fewest, longest = t / (2 - t) * size - 1e-9, int((2 - t) / t * size + 1e-9)
            if len(grams) < fewest:
                continue
            at = np.flatnonzero((counts[grams] > 0) & (grams > 0))
            if len(at) < fewest:
                continue
            # windows that start at a hit; those with too few hits in the longest cannot reach the threshold
            after = np.searchsorted(at, at + longest)
            starts = np.flatnonzero(after - np.arange(len(at)) >= fewest)
            if not len(starts):
                continue
            spent = _spent(grams[at], at, counts)

            def best(k: int, stop: int) -> tuple[float, int, int, int] | None:
                """The best window from the k-th hit that ends at ``stop`` or before; ties to the shorter."""
                first, until = int(at[k]), min(int(after[k]), int(np.searchsorted(at, stop)))
                ends = at[k:until] + 1
                scores = 2 * np.cumsum(spent[k:until] < first) / (ends - first + size)
                n = int(np.argmax(scores)) if len(scores) else 0
                return (-float(scores[n]), first, int(ends[n]), k) if len(scores) and scores[n] >= t else None

            heap = [w for k in starts.tolist() if (w := best(k, len(grams)))]
            heapq.heapify(heap)
            taken = bytearray(len(grams))
            while heap:
                score, a, b, k = heapq.heappop(heap)
                block = taken.find(1, a, b)
                if block < 0:
                    taken[a:b] = b"\1" * (b - a)
                    yield name, -score, a, b - a + 1
                elif block > a and (w := best(k, block)):
                    heapq.heappush(heap, w)


def compete(found: list[tuple[str, float, int, int]]) -> list[tuple[str, float, int, int]]:
    """The windows that win against every better one that holds much the same words, in the order given."""
    kept: list[tuple[str, float, int, int]] = []
    for hit in sorted(found, key=lambda x: (-x[1], -x[3], x[2], x[0])):
        _, _, at, size = hit
        shared = (min(at + size, a + n) - max(at, a) for name, _, a, n in kept if name != hit[0])
        if all(2 * s <= max(size, n) for s, (_, _, _, n) in zip(shared, (k for k in kept if k[0] != hit[0]))):
            kept.append(hit)
    return [hit for hit in found if hit in kept]


def _spent(grams: np.ndarray, at: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """For each hit, the place of the hit that must lie before the window for this one to be common; -1 if none.

    A bigram that the template has c times is common in a window for its first c occurrences.
    """
    order = np.argsort(grams, kind="stable")
    ranked, places = grams[order], at[order]
    back = np.arange(len(order)) - counts[ranked]
    same = (back >= 0) & (ranked[back] == ranked)
    out = np.empty(len(order), np.int64)
    out[order] = np.where(same, places[back], -1)
    return out


def notices(
    docs: DataFrame,
    templates: Mapping[str, str] = ALL,
    threshold: float = THRESHOLD,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, licence, dice, at_word, n_words`` of every notice found in every row's whole text.

    Null and empty texts hold none; rows of one id are each scanned. The templates go to the tasks: their
    number and size are the caller's.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, threshold)
        for batch in slices(batches):
            found = [(k, *hit) for k, text in enumerate(batch.column("text").to_pylist()) for hit in scanner.scan(text)]
            if found:
                at, name, score, first, size = zip(*found)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(pa.array(at)), pa.array(name), pa.array(score, pa.float64()),
                        pa.array(first, pa.int32()), pa.array(size, pa.int32()),
                    ],
                    ["doc_id", "licence", "dice", "at_word", "n_words"],
                )

    rows = inputs(docs, doc_id=id_col, text=text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, licence string, dice double, at_word int, n_words int")
