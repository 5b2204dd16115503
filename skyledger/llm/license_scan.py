"""License scans: fingerprints of templates pick candidates, banded alignment reports coverage and spans.

Words are runs of letters, digits and bytes beyond ASCII, lower-cased in A-Z. The inverted index maps the hash of consecutive template
words to (template, place). A template's gram length is ``GRAM`` or less, so that every match of ``COVERAGE`` with at most a band of
inserted words has that many template words in a row. Every gram of a text is looked up; each stretch around hits that has enough of the
template's words is aligned with it in a band around its diagonal. Of overlapping matches of a template the fullest is reported.
Templates are a short list that the caller gives, at most ``MAX_TEMPLATES``.

One row for each template and place whose matched words are at least ``COVERAGE`` of the template. Null, empty and unmatched texts give no rows.
Repeated rows are reported each. Very long texts are read whole, in chunks of whole texts.
"""

from __future__ import annotations

from bisect import bisect
from collections import defaultdict
from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .wordhash import Words, shingle_hashes

GRAM = 3
COVERAGE = 0.8
MAX_TEMPLATES = 2_000
#: Notices by which texts name their license, and the texts or headers of common ones.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "all-rights-reserved": "All rights reserved.",
    "MIT-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "BSD-conditions": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "GPL-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    "GPL-2.0-or-later": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    "GPL-3.0-or-later": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    "LGPL-2.1-or-later": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version. This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details.",
    "AGPL-3.0-or-later": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero General Public License for more details.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "BSD-disclaimer": "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "Zlib": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions",
    "Unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    "BSL-1.0": "Distributed under the Boost Software License, Version 1.0.",
    "CC0-1.0": "To the extent possible under law, the author has dedicated all copyright and related and neighboring rights to this work to the public domain worldwide.",
}


class LicenseWords(Words):
    def __init__(self) -> None:
        super().__init__()
        self.space[:128] = True
        self.space[[*range(48, 58), *range(65, 91), *range(97, 123)]] = False


def align(template: np.ndarray, text: np.ndarray, band: int) -> tuple[int, int, int]:
    """(matched words, first and last matched place in the text) of the best alignment of the whole template.

    ``text`` begins ``band`` words before the template's diagonal. A match counts 2, a difference or gap -1; words of the
    text before and after the template are free. Of equal alignments the one with more matches and the later start wins.
    """
    none = (-(1 << 30), 0, 0, 0)
    row = [(0, 0, 0, 0)] * (len(text) + 1)  # score, matches, start + 1, end + 1
    for i, w in enumerate(template):
        new = [none] * (len(text) + 1)
        for j in range(max(0, i), min(len(text), i + 2 * band + 1) + 1):
            s, m, a, z = row[j]
            best = (s - 1, m, a, z)
            if j:
                s, m, a, z = row[j - 1]
                best = max(best, (s + 2, m + 1, a or j, j) if text[j - 1] == w else (s - 1, m, a, z))
                s, m, a, z = new[j - 1]
                best = max(best, (s - 1, m, a, z))
            new[j] = best
        row = new
    _, matched, first, last = max(row)
    return matched, first - 1, last - 1


def band_of(size: int) -> int:
    """Words by which a match of a template of so many words may leave its diagonal; fewer than the template has."""
    return min(max(2, size // 8), size - 1)


def gram_length(size: int) -> int:
    """A run of template words that no reportable match lacks: it is broken by missing words and by a band of inserted ones."""
    least = ceil(COVERAGE * size - 1e-9)
    return min(GRAM, ceil(least / (size - least + 1 + band_of(size))))


class Index:
    def __init__(self, templates: dict[str, str]):
        if len(templates) > MAX_TEMPLATES:
            raise ValueError("too many templates for an index in memory")
        self.names, self.words = list(templates), []
        reader = LicenseWords()
        places: dict[int, dict[int, list[tuple[int, int]]]] = defaultdict(lambda: defaultdict(list))
        for t, (_, _, hashes) in enumerate(c for name in self.names for c in reader.chunks(pa.array([templates[name]]))):
            self.words.append(hashes)
            if len(hashes):
                k = gram_length(len(hashes))
                for p, g in enumerate(shingle_hashes(hashes, k)):
                    places[k][int(g)].append((t, p))
        self.places = {k: dict(found) for k, found in places.items()}
        self.keys = {k: np.array(sorted(found), np.uint64) for k, found in places.items()}

    def scan(self, words: np.ndarray, bounds: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """(document, template, matched words, first and last word) of each report in a chunk."""
        around = defaultdict(set)
        for k, keys in self.keys.items():
            if len(words) < k:
                continue
            grams = shingle_hashes(words, k)
            hits = np.flatnonzero(keys[np.minimum(np.searchsorted(keys, grams), len(keys) - 1)] == grams)
            docs = np.searchsorted(bounds, hits, "right") - 1
            inside = hits + k <= bounds[docs + 1]
            for p, d in zip(hits[inside].tolist(), docs[inside].tolist(), strict=True):
                for t, q in self.places[k][int(grams[p])]:
                    around[d, t].add(p - q)
        out = []
        for (d, t), starts in sorted(around.items()):
            size = len(self.words[t])
            band = band_of(size)
            low, high = int(bounds[d]), int(bounds[d + 1])
            found = set()
            for start in starts:
                begin = max(low, start - band)
                pad = band - (start - begin)
                text = words[begin : min(high, start + size + band)]
                if np.isin(self.words[t], text).sum() < COVERAGE * size:
                    continue
                matched, first, last = align(self.words[t], np.concatenate([np.zeros(pad, np.uint64), text]), band)
                if matched >= COVERAGE * size:
                    found.add((-matched, last - first, begin - pad + first))
            taken: list[tuple[int, int, int]] = []
            for less, span, first in sorted(found):
                at = bisect(taken, (first,))
                if (not at or taken[at - 1][1] < first) and (at == len(taken) or first + span < taken[at][0]):
                    taken.insert(at, (first, first + span, -less))
            out.extend((d, t, matched, first, last) for first, last, matched in taken)
        return out


def scan_licenses(docs: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """(doc_id, license, matched_words, coverage, start_word, end_word, start_byte, end_byte) of each match; ends are exclusive."""
    shared = docs.sparkSession.sparkContext.broadcast(TEMPLATES if templates is None else templates)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, reader = Index(shared.value), LicenseWords()
        for batch in batches:
            rows = []
            strings = batch.column(1).cast(pa.large_string()).fill_null("")
            offsets = np.frombuffer(strings.buffers()[1], np.int64)[strings.offset : strings.offset + len(strings) + 1]
            for first, bounds, words, _, starts, ends in reader.chunks(strings, with_bytes=True):
                for d, t, matched, a, z in index.scan(words, bounds):
                    origin = offsets[first + d] - offsets[first]
                    rows.append((first + d, index.names[t], matched, matched / len(index.words[t]), a - bounds[d], z + 1 - bounds[d], starts[a] - origin, ends[z] - origin))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 8
            kinds = [pa.string(), pa.int32(), pa.float64(), *[pa.int64()] * 4]
            ids = batch.column(0).take(pa.array(np.array(columns[0], np.int64)))
            yield pa.RecordBatch.from_arrays([ids, *(pa.array([x if isinstance(x, str) else k.to_pandas_dtype()(x) for x in c], k) for c, k in zip(columns[1:], kinds, strict=True))], names=["doc_id", "license", "matched_words", "coverage", "start_word", "end_word", "start_byte", "end_byte"])

    schema = "doc_id long, license string, matched_words int, coverage double, start_word long, end_word long, start_byte long, end_byte long"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)
