"""License scans: winnowed template fingerprints, then banded alignment.

Templates are sequences of words.  Of every ``WINNOW`` word grams in a row the one with
the smallest hash is a fingerprint; an inverted index leads from fingerprints to places
in templates.  A document's grams are looked up in it; hits near one diagonal of a
template make a candidate, and an alignment inside a band around that diagonal counts the
template words that occur in order and finds where they begin and end.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

GRAM, WINNOW = 3, 3
TOKEN = re.compile(rb"[a-z0-9]+")
MATCH, MISS = 2, -1

#: Public license notices.
TEMPLATES = {
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use
        this file except in compliance with the License. You may obtain a copy of the License at
        http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in
        writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT
        WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the
        specific language governing permissions and limitations under the License.""",
    "mit-line": "Released under the MIT License.",
    "mit": """Permission is hereby granted, free of charge, to any person obtaining a copy of this
        software and associated documentation files (the "Software"), to deal in the Software without
        restriction, including without limitation the rights to use, copy, modify, merge, publish,
        distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the
        Software is furnished to do so, subject to the following conditions: The above copyright notice
        and this permission notice shall be included in all copies or substantial portions of the
        Software.""",
    "gpl-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0": """This program is free software: you can redistribute it and/or modify it under the
        terms of the GNU General Public License as published by the Free Software Foundation, either
        version 3 of the License, or (at your option) any later version. This program is distributed in
        the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
        MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more
        details.""",
    "cc-by-nc-4.0-line": "Licensed under CC BY-NC 4.0.",
    "bsd-2-clause": """Redistribution and use in source and binary forms, with or without modification,
        are permitted provided that the following conditions are met: Redistributions of source code
        must retain the above copyright notice, this list of conditions and the following disclaimer.
        Redistributions in binary form must reproduce the above copyright notice, this list of
        conditions and the following disclaimer in the documentation and/or other materials provided
        with the distribution.""",
    "isc": """Permission to use, copy, modify, and/or distribute this software for any purpose with or
        without fee is hereby granted, provided that the above copyright notice and this permission
        notice appear in all copies.""",
}


def _tokens(data: bytes) -> list[bytes]:
    """Words of ASCII letters and digits, in lower case."""
    return TOKEN.findall(data.lower())


def _mixed(codes: np.ndarray) -> np.ndarray:
    return (codes.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)


class TemplateIndex:
    """Inverted index of template fingerprints; its size is that of the templates."""

    def __init__(self, templates: Mapping[str, str]):
        words = {n: _tokens(t.encode()) for n, t in templates.items()}
        if short := [n for n, w in words.items() if len(w) < GRAM]:
            raise ValueError(f"templates need {GRAM} words: {short}")
        self.names = list(words)
        vocabulary = sorted(set().union(*words.values())) if words else []
        self.ids = {w: i + 1 for i, w in enumerate(vocabulary)}
        self.base = len(vocabulary) + 1
        self.words = [np.array([self.ids[w] for w in words[n]]) for n in self.names]
        entries = set()
        for t, own in enumerate(self.words):
            codes = self.codes(own)
            mixed = _mixed(codes)
            for at in range(max(1, len(codes) - WINNOW + 1)):
                q = at + int(np.argmin(mixed[at : at + WINNOW]))
                entries.add((int(codes[q]), t, q))
        table = np.array(sorted(entries), np.int64).reshape(-1, 3)
        self.keys, self.starts = np.unique(table[:, 0], return_index=True)
        self.stops = np.append(self.starts[1:], len(table))
        self.places = table[:, 1:]

    def codes(self, ids: np.ndarray) -> np.ndarray:
        """One number per gram; grams with a word that no template has are -1."""
        n = len(ids) - GRAM + 1
        codes = np.zeros(n, np.int64)
        known = np.ones(n, bool)
        for k in range(GRAM):
            part = ids[k : k + n]
            codes = codes * self.base + part
            known &= part > 0
        return np.where(known, codes, -1)

    def scan(self, data: bytes, min_coverage: float) -> list[tuple[str, float, int, int]]:
        """(template, share of its words matched, first word, last word) in a text."""
        get = self.ids.get
        found = _tokens(data)
        ids = np.fromiter((get(w, 0) for w in found), np.int64, len(found))
        if len(ids) < GRAM or not len(self.keys):
            return []
        codes = self.codes(ids)
        at = np.searchsorted(self.keys, codes)
        hits = np.flatnonzero(self.keys[np.minimum(at, len(self.keys) - 1)] == codes)
        diagonals: dict[int, set[int]] = {}
        for p in hits.tolist():
            for t, q in self.places[self.starts[at[p]] : self.stops[at[p]]].tolist():
                diagonals.setdefault(t, set()).add(p - q)
        matches = []
        for t, own in sorted(diagonals.items()):
            matches += self._aligned(t, sorted(own), ids, min_coverage)
        return matches

    def _aligned(self, t, diagonals, ids, min_coverage):
        """Matches of one template that do not overlap, the best first."""
        template = self.words[t]
        band = max(4, len(template) // 8)
        tried, done = [], None
        for d in diagonals:
            if done is not None and d - done <= band // 2:
                continue  # inside the band of the diagonal before
            done = d
            matched, first, last = _align(template, ids, d, band)
            if matched >= min_coverage * len(template):
                tried.append((-matched, first, last))
        chosen = []
        for matched, first, last in sorted(set(tried)):
            if all(last < f or first > l for _, f, l in chosen):
                chosen.append((-matched, first, last))
        return [
            (self.names[t], m / len(template), f, l) for m, f, l in sorted(chosen, key=lambda c: c[1])
        ]


def _align(template: np.ndarray, ids: np.ndarray, diagonal: int, band: int):
    """(matched words, first, last) of the best local alignment in the band.

    Cells hold (score, matched, -first word); row i has the columns i + diagonal +- band.
    """
    best = (0, 0, 0, 0)
    width = 2 * band + 1
    above = [(0, 0, 0)] * (width + 1)
    for i, word in enumerate(template.tolist()):
        row, left = [], (0, 0, 0)
        for k in range(width):
            j = i + diagonal - band + k
            if not 0 <= j < len(ids):
                cell = (0, 0, 0)
            else:
                score, matched, start = above[k]
                if ids[j] == word:
                    cell = (score + MATCH, matched + 1, start if matched else -j)
                else:
                    cell = (score + MISS, matched, start)
                up = above[k + 1]
                cell = max(
                    cell, (up[0] + MISS, up[1], up[2]), (left[0] + MISS, left[1], left[2]), (0, 0, 0)
                )
                if (cell[0], cell[1]) > best[:2]:
                    best = (*cell, j)
            row.append(cell)
            left = cell
        above = [*row, (0, 0, 0)]
    return best[1], -best[2], best[3]


def scan_licenses(
    docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, min_coverage: float = 0.8
) -> DataFrame:
    """(doc_id, license, coverage, first_word, last_word), one row per match in ``docs``.

    Words are counted from 0 over the runs of ASCII letters and digits of the whole text.
    Documents without a match, and null or empty texts, have no row; rows that repeat are
    reported each; a null doc_id stays null.  Matches of one template do not overlap.
    """
    # the templates alone, whatever the input
    shared = docs.sparkSession.sparkContext.broadcast(TemplateIndex(templates))
    rows = docs.select("doc_id", F.col("text").cast("binary").alias("text")).filter(
        F.col("text").isNotNull()
    )
    schema = docs.select("doc_id").schema
    for name, kind in (("license", "string"), ("coverage", "double"), ("first_word", "long"), ("last_word", "long")):
        schema = schema.add(name, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            owner, matches = [], []
            for i, text in enumerate(batch.column(1)):
                found = index.scan(text.as_py(), min_coverage)
                owner += [i] * len(found)
                matches += found
            columns = list(zip(*matches)) or [()] * 4
            kinds = [pa.string(), pa.float64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(owner, pa.int64()))]
                + [pa.array(c, k) for c, k in zip(columns, kinds)],
                names=schema.names,
            )

    return rows.mapInArrow(run, schema)
