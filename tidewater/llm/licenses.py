"""License scan: winnowed fingerprints in an inverted index, then banded alignment.

Texts become lower-cased words (runs of ASCII letters and digits). A template's fingerprints are the hashes of
its ``GRAM``-word windows, thinned by winnowing: the least hash of every ``WINDOW`` neighbours. The inverted index
(fingerprint -> template, place) is built from the templates alone, a short parameter, so it goes to every
executor. Every window of a document is looked up, so any shared passage of ``GRAM + WINDOW - 1`` words is hit.
Hits on neighbouring diagonals make a candidate, which is aligned word by word inside a band of ``BAND`` diagonals
to both sides: a match counts 2, a difference or gap -1; the best local path that ends on each diagonal is looked at.

A template shorter than a gram plus window is looked up by all its grams, never thinned.

Output: one row for every document, template and place where at least ``min_coverage`` of the template's words
match, with the covered share and the span in words [start, stop) of the document. Of overlapping findings the one
with more matching words is kept, then the one that covers more of its template.

Nulls, empties, ties: null or empty texts match nothing; repeated rows are reported once per row; null ids stay
null. Equal findings keep the earlier. Empty tables give empty results. Extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from tidewater.llm.shared import pick, texts

GRAM = 3
WINDOW = 3
BAND = 8
MIN_COVERAGE = 0.7

#: Short notices by which texts state their licence.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    "MIT": "Released under the MIT License.",
    "MIT notice": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "All rights reserved": "Copyright. All rights reserved. No part of this publication may be reproduced without permission.",
}

_WORD = re.compile(rb"[a-z0-9]+")


def words_of(text: bytes) -> list[bytes]:
    return _WORD.findall(text.lower())


def numbers(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def grams(h: np.ndarray) -> np.ndarray:
    """Hash of every window of GRAM words."""
    if len(h) < GRAM:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(h) - GRAM + 1, np.uint64)
    for i in range(GRAM):
        out = (out ^ h[i:len(h) - GRAM + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(31)
    return out


def winnow(g: np.ndarray) -> np.ndarray:
    """Places of the fingerprints: the last least hash of every WINDOW neighbours."""
    if len(g) <= WINDOW:
        return np.arange(len(g))
    views = np.lib.stride_tricks.sliding_window_view(g, WINDOW)[:, ::-1]
    return np.unique(np.arange(len(views)) + WINDOW - 1 - views.argmin(axis=1))


class Index:
    """Inverted index over templates: sorted fingerprints with (template, place)."""

    def __init__(self, templates: dict[str, str]):
        self.names = list(templates)
        self.words = [numbers(words_of(templates[n].encode())) for n in self.names]
        held = defaultdict(list)
        for t, own in enumerate(self.words):
            g = grams(own)
            for p in (np.arange(len(g)) if len(own) < GRAM + 2 * WINDOW else winnow(g)):
                held[int(g[p])].append((t, int(p)))
        self.keys = np.array(sorted(held), np.uint64)
        self.places = [held[int(key)] for key in self.keys]

    def candidates(self, h: np.ndarray) -> list[tuple[int, int]]:
        """(template, shift) for the hits of a document; a shift stands for those that its band covers well."""
        g = grams(h)
        if not len(g) or not len(self.keys):
            return []
        at = np.minimum(np.searchsorted(self.keys, g), len(self.keys) - 1)
        found = np.flatnonzero(self.keys[at] == g)
        kept: list[tuple[int, int]] = []
        for t, shift in sorted({(t, int(f) - p) for f in found for t, p in self.places[at[f]]}):
            if not kept or kept[-1][0] != t or shift - kept[-1][1] > BAND // 2:
                kept.append((t, shift))
        return kept


def align(template: np.ndarray, doc: np.ndarray, shift: int) -> set[tuple[int, int, int]]:
    """(matches, start, stop) of the best local alignments within the band around ``shift``, one for each diagonal that they end on;
    start and stop in the document."""
    n, width = len(template), 2 * BAND + 1
    score, match, start = [0] * (width + 1), [0] * (width + 1), [0] * (width + 1)
    best, out = [0] * width, [(0, 0, 0)] * width
    for i in range(n):
        old_score, old_match, old_start = score[:], match[:], start[:]
        left, left_match, left_start = 0, 0, 0
        for b in range(width):
            j = i + shift + b - BAND
            if j < 0 or j >= len(doc):
                left, score[b] = 0, 0
                continue
            same = template[i] == doc[j]
            base = old_score[b]
            s, m, f = base + (2 if same else -1), old_match[b] + int(same), old_start[b] if base > 0 else j
            if not base:
                m = int(same)
            if old_score[b + 1] - 1 > s:
                s, m, f = old_score[b + 1] - 1, old_match[b + 1], old_start[b + 1]
            if left - 1 > s:
                s, m, f = left - 1, left_match, left_start
            s = max(s, 0)
            score[b], match[b], start[b] = s, m if s else 0, f
            left, left_match, left_start = s, match[b], f
            if s > best[b]:
                best[b], out[b] = s, (match[b], f, j + 1)
    return set(out)


def scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, doc_id: str = "doc_id", text: str = "text", min_coverage: float = MIN_COVERAGE) -> DataFrame:
    """(doc_id, license, coverage, matched, start, stop): where documents state a licence."""
    base = pick(docs, doc_id=doc_id, text=text)
    index = docs.sparkSession.sparkContext.broadcast(Index(templates))
    id_type = base.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = index.value
        for batch in batches:
            row, out = [], []
            for i, body in enumerate(texts(batch)):
                h = numbers(words_of(body))
                found = set()
                for t, shift in own.candidates(h):
                    for matched, start, stop in align(own.words[t], h, shift):
                        if matched and matched >= min_coverage * len(own.words[t]):
                            found.add((-matched, -matched / len(own.words[t]), start, stop, t))
                taken: list[tuple[int, int]] = []
                for lost, share, start, stop, t in sorted(found):
                    if all(stop <= a or start >= b for a, b in taken):
                        taken.append((start, stop))
                        row.append(i)
                        out.append((own.names[t], -share, -lost, start, stop))
            columns = list(zip(*out, strict=True)) or [[], [], [], [], []]
            kinds = (pa.string(), pa.float64(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(row, pa.int64())), *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]],
                                             ["doc_id", "license", "coverage", "matched", "start", "stop"])

    return base.mapInArrow(run, f"doc_id {id_type}, license string, coverage double, matched long, start long, stop long")
