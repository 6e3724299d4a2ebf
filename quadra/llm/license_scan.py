"""License scan: winnowed template fingerprints pick candidates, banded alignment measures them.

Templates are cut into words (runs of letters and digits, A-Z lowered) and ``GRAM``-word hashes; of
each ``WINDOW`` neighbouring hashes the least is kept, so that any shared run of ``GRAM + WINDOW - 1``
words shares a fingerprint.  The inverted index of these (a parameter's size, never the data's) is
broadcast.  A text is hashed whole; hits of one template whose diagonals lie within ``BAND`` words form
a candidate, which is aligned with the template in a band around its diagonal (match 1, mismatch or
gap -1, local).  Reported are the coverage - matched words over the template's words - and the matched
spans, if the coverage is at least ``MIN_COVERAGE``; of overlapping reports the one with more matched
words stays (ties: the longer template, then the name).

One narrow pass without a shuffle; texts without a hit cost their hashing only.

Defined results: null and empty texts report nothing; repeated rows report alike; a text that repeats a
license reports each place.
"""
from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quadra.llm.shared import mix, runs, span_hash, text_bytes, words

GRAM = 3
WINDOW = 2
BAND = 8
MIN_COVERAGE = 0.8
CHUNK = 1 << 20

# FIXED VALUES: public license notices and the standard headers of the licenses
TEMPLATES = {
    "MIT": "Released under the MIT License.",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    "BSD-2-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
}

GAP = np.ones(256, bool)
for _first, _last in (("0", "9"), ("A", "Z"), ("a", "z")):
    GAP[ord(_first):ord(_last) + 1] = False
GAP[128:] = False


def _grams(word: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` words."""
    n = max(len(word) - k + 1, 0)
    acc = np.full(n, k, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(k):
            acc = mix(acc * np.uint64(0x9E3779B97F4A7C15) + word[j:j + n])
    return acc


def winnow(h: np.ndarray, window: int) -> np.ndarray:
    """Positions of the least hash of every ``window`` neighbours (the last of equals)."""
    if len(h) <= window:
        return np.array([len(h) - 1 - int(np.argmin(h[::-1]))]) if len(h) else np.zeros(0, np.int64)
    view = np.lib.stride_tricks.sliding_window_view(h, window)[:, ::-1]
    return np.unique(np.arange(len(view)) + window - 1 - view.argmin(1))


class Index:
    """Fingerprint -> (template, word position), sorted by fingerprint."""

    def __init__(self, templates: dict[str, str]):
        self.names, self.words = list(templates), []
        print_, owner, place = [], [], []
        for i, text in enumerate(templates.values()):
            raw = text.encode()
            data = np.frombuffer(raw, np.uint8)
            start, stop, _ = words(data, np.array([0, len(data)]), GAP)
            word = span_hash(data, start, stop)
            self.words.append(word)
            h = _grams(word, GRAM)
            at = winnow(h, WINDOW)
            print_.append(h[at])
            owner.append(np.full(len(at), i))
            place.append(at)
        h, owner, place = np.concatenate(print_), np.concatenate(owner), np.concatenate(place)
        order = np.argsort(h, kind="stable")
        self.print, self.owner, self.place = h[order], owner[order], place[order]

    def hits(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(position in h, template, position in the template) of every posting met."""
        lo, hi = np.searchsorted(self.print, h, "left"), np.searchsorted(self.print, h, "right")
        found = np.flatnonzero(hi > lo)
        many = (hi - lo)[found]
        at = np.repeat(found, many)
        posting = np.repeat(lo[found], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        return at, self.owner[posting], self.place[posting]


def align(template: np.ndarray, text: np.ndarray, diagonal: int, band: int) -> list[int]:
    """Text positions matched with the template, -1 where a template word has none.

    Local alignment in the cells with ``diagonal - band <= text position - template position <= diagonal + band``.
    """
    width = 2 * band + 1
    score = np.zeros((len(template) + 1, width + 2), np.int32)
    step = np.zeros((len(template) + 1, width + 2), np.int8)  # 0 start, 1 pair, 2 template word alone, 3 text word alone
    for i in range(1, len(template) + 1):
        for b in range(1, width + 1):
            j = i - 1 + diagonal - band + b - 1
            if not 0 <= j < len(text):
                continue
            pair = score[i - 1, b] + (1 if text[j] == template[i - 1] else -1)
            best, how = max((0, 0), (int(pair), 1), (int(score[i - 1, b + 1]) - 1, 2), (int(score[i, b - 1]) - 1, 3), key=lambda x: x[0])
            score[i, b], step[i, b] = best, how
    i, b = np.unravel_index(int(score.argmax()), score.shape)
    out = [-1] * len(template)
    while score[i, b] > 0:
        j, how = i - 1 + diagonal - band + b - 1, step[i, b]
        if how == 1:
            if text[j] == template[i - 1]:
                out[i - 1] = int(j)
            i -= 1
        elif how == 2:
            i, b = i - 1, b + 1
        else:
            b -= 1
    return out


def _report(index: Index, word: np.ndarray, at: np.ndarray, owner: np.ndarray, place: np.ndarray, least: float) -> list[tuple]:
    """(template, coverage, matched text positions) of one text, without overlaps."""
    found = []
    by: dict[int, list[int]] = defaultdict(list)
    for a, o, p in zip(at.tolist(), owner.tolist(), place.tolist(), strict=True):
        by[o].append(a - p)
    for o, diagonals in by.items():
        template = index.words[o]
        band = min(BAND, max(1, len(template) // 2))  # two copies of a short template are two candidates
        diagonals.sort()
        first = last = diagonals[0]
        for d in [*diagonals[1:], None]:
            if d is not None and d - last <= band:
                last = d
                continue
            for middle in range(first, last + 1, band):
                middle = min(middle + band // 2, last) if last > first else first
                lo = max(0, middle - band)
                hi = min(len(word), middle + len(template) + band)
                pairs = [j + lo if j >= 0 else -1 for j in align(template, word[lo:hi], middle - lo, band)]
                hit = [j for j in pairs if j >= 0]
                if hit and len(hit) / len(template) >= least:
                    found.append((-len(hit), -len(template), index.names[o], hit))
            if d is not None:
                first = last = d
    out, taken = [], []
    for n, size, name, hit in sorted(set((a, b, c, tuple(h)) for a, b, c, h in found)):
        if all(hit[-1] < a or hit[0] > b for a, b in taken):
            taken.append((hit[0], hit[-1]))
            out.append((name, n / size, hit))
    return sorted(out, key=lambda x: x[2][0])


RESULT = [T.StructField("license", T.StringType()), T.StructField("coverage", T.DoubleType()), T.StructField("n_matched", T.LongType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("spans", T.StringType())]


def scan(docs: DataFrame, text: str = "text", key: str = "doc_id", templates: dict[str, str] | None = None, least: float = MIN_COVERAGE) -> DataFrame:
    """(key, license, coverage, n_matched, start, end, spans): a row per reported place; positions in code points."""
    index = docs.sparkSession.sparkContext.broadcast(Index(templates or TEMPLATES))
    schema = T.StructType([docs.schema[key], *RESULT])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = index.value
        for batch in batches:
            data, at = text_bytes(batch.column(1))
            rows: list[int] = []
            out: tuple[list, ...] = ([], [], [], [], [], [])
            for lo, hi in runs(at, CHUNK):
                start, stop, row = words(data, at[lo:hi + 1], GAP)
                word = span_hash(data, start, stop)
                where, owner, place = known.hits(_grams(word, GRAM))
                doc = np.searchsorted(row, where, "right") - 1
                inside = where + GRAM <= row[doc + 1]
                where, owner, place, doc = where[inside], owner[inside], place[inside], doc[inside]
                for i in np.unique(doc):
                    mine, base = doc == i, row[i]
                    begin, end = start[base:row[i + 1]], stop[base:row[i + 1]]
                    first = int(at[lo + i])
                    points = np.concatenate([[0], np.cumsum((data[first:int(at[lo + i + 1])] & 0xC0) != 0x80)])
                    for name, coverage, hit in _report(known, word[base:row[i + 1]], where[mine] - base, owner[mine], place[mine], least):
                        spans, h = [], np.array(hit)
                        for run_ in np.split(h, np.flatnonzero(np.diff(h) != 1) + 1):
                            spans.append(f"{points[begin[run_[0]] - first]}:{points[end[run_[-1]] - first]}")
                        rows.append(lo + int(i))
                        for column, v in zip(out, (name, coverage, len(hit), int(points[begin[hit[0]] - first]), int(points[end[hit[-1]] - first]), ",".join(spans)), strict=True):
                            column.append(v)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int32())), *(pa.array(v, t) for v, t in zip(out, (pa.string(), pa.float64(), pa.int64(), pa.int64(), pa.int64(), pa.string()), strict=True))], schema.names)

    return docs.select(F.col(f"`{key}`").alias(key), F.col(f"`{text}`").cast("string").alias("t")).mapInArrow(run, schema)
