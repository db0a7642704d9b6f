"""License notices in texts: MinHash bands retrieve templates, shingles verify them.

Words lose their ASCII punctuation and capitals. A text's shingles of five words are cut
into windows that overlap by half, of twice the template's length rounded up to a power
of two, so that every run as long as the template lies in one window. A window and a
template that share a band are compared: the template matches if at least 0.8 of its
shingles are in the window.

One row per band and ``BANDS`` bands: where a template is contained to 0.8, its Jaccard
similarity with the window is at least 0.8 n / (2 m + 0.2 n) > 0.19 (n shingles, m the
next power of two), and all bands miss with a probability below 0.81**64 < 2e-6. A window
without any shingle of a template has no band in common with one and is not hashed.

A template of fewer than five words is one shingle of its own length: it is looked up
among all runs of so many words and matches where all its words are there, in order.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stridecast.llm.textbatch import Spans, Texts, Words, mix, texts_of

SHINGLE, LIKENESS, BANDS = 5, 0.8, 64

# Standard wording of public licenses and notices (fixed values).
TEMPLATES = {
    "all-rights-reserved-line": "All rights reserved.",
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-notice": (
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at"
    ),
    "bsd-conditions": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met"
    ),
    "cc-by-4.0-line": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-nc-4.0-line": "Licensed under CC BY-NC 4.0.",
    "gpl-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, "
        "or (at your option) any later version."
    ),
    "mit-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the Software), to deal in the Software without restriction"
    ),
    "mit-line": "Released under the MIT License.",
    "mpl-2.0-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "spdx-apache-2.0": "SPDX-License-Identifier: Apache-2.0",
    "spdx-bsd-3-clause": "SPDX-License-Identifier: BSD-3-Clause",
    "spdx-cc-by-4.0": "SPDX-License-Identifier: CC-BY-4.0",
    "spdx-cc-by-nc-4.0": "SPDX-License-Identifier: CC-BY-NC-4.0",
    "spdx-gpl-3.0-only": "SPDX-License-Identifier: GPL-3.0-only",
    "spdx-gpl-3.0-or-later": "SPDX-License-Identifier: GPL-3.0-or-later",
    "spdx-mit": "SPDX-License-Identifier: MIT",
    "spdx-mpl-2.0": "SPDX-License-Identifier: MPL-2.0",
    "spdx-tag": "SPDX-License-Identifier:",  # of any license, also of those above
    "warranty": (
        "THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT "
        "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT"
    ),
}

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_KEPT = np.ones(256, bool)
_KEPT[[c for c in range(0x21, 0x7F) if not chr(c).isalnum()]] = False

_MULTIPLIERS = mix(np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03)) | np.uint64(1)


def folded(texts: Texts) -> Texts:
    kept = _KEPT[texts.data]
    before = np.append(0, np.cumsum(kept))
    return Texts(_FOLD[texts.data[kept]], before[texts.bounds], texts.first)


def runs(words: Words, hashes: Spans, length: int) -> tuple[np.ndarray, np.ndarray]:
    """First words of all runs of ``length`` words that stay in one text, and their hashes."""
    start = words.runs(length)
    return start, hashes(start, start + length)


def shingles(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all shingles, and where each text's begin; below five words none."""
    words = texts.words()
    return _shingles(words, Spans(words.hashes()))


def _shingles(words: Words, hashes: Spans) -> tuple[np.ndarray, np.ndarray]:
    start, found = runs(words, hashes, SHINGLE)
    return found, np.searchsorted(words.text[start], np.arange(len(words.count) + 1))


def signature(hashes: np.ndarray) -> np.ndarray:
    return (hashes * _MULTIPLIERS[:, None]).min(axis=1)


class Templates:
    """Templates by size class (a power of two), with their shingles and bands; those of
    fewer words than a shingle by their number of words, with the hash of all words."""

    def __init__(self, texts: Mapping[str, str]):
        self.names: list[str] = []
        self.short: dict[int, dict[int, list[str]]] = defaultdict(lambda: defaultdict(list))
        self.shingles: list[np.ndarray] = []
        self.bands: dict[int, dict[tuple[int, int], list[int]]] = defaultdict(lambda: defaultdict(list))
        for name in sorted(texts):
            (text,) = texts_of(pa.array([texts[name]]))
            words = folded(text).words()
            hashes = Spans(words.hashes())
            n = len(words.start)
            if not n:
                raise ValueError(f"template {name} has no words")
            if n < SHINGLE:
                self.short[n][int(runs(words, hashes, n)[1][0])].append(name)
                continue
            i = len(self.names)
            self.names.append(name)
            own = np.unique(_shingles(words, hashes)[0])
            self.shingles.append(own)
            size = 1 << (len(own) - 1).bit_length()
            for band, value in enumerate(signature(own).tolist()):
                self.bands[size][band, value].append(i)
        self.bands = {size: dict(bands) for size, bands in self.bands.items()}
        self.short = {n: dict(sorted(names.items())) for n, names in self.short.items()}
        self.all = np.unique(np.concatenate(self.shingles)) if self.shingles else np.zeros(0, np.uint64)

    def matches(self, own: np.ndarray) -> dict[int, tuple[float, int, int]]:
        """Of one text's shingles: template -> containment, first and last shingle of it."""
        if not len(self.all):
            return {}
        known = self.all[np.minimum(np.searchsorted(self.all, own), len(self.all) - 1)] == own
        hits = np.flatnonzero(known)
        found: dict[int, tuple[float, int, int]] = {}
        for size, bands in self.bands.items() if len(hits) else ():
            # Window k holds the shingles from k * size to (k + 2) * size.
            windows = np.unique(np.concatenate([hits // size, np.maximum(hits // size - 1, 0)]))
            for k in windows.tolist():
                window = own[k * size : (k + 2) * size]
                values = signature(window).tolist()
                drawn = {t for band, value in enumerate(values) for t in bands.get((band, value), ())}
                for t in drawn:
                    inside = np.isin(window, self.shingles[t])
                    share = len(np.unique(window[inside])) / len(self.shingles[t])
                    if share >= LIKENESS and share > found.get(t, (0.0,))[0]:
                        at = np.flatnonzero(inside) + k * size
                        found[t] = (share, int(at[0]), int(at[-1]))
        return found

    def found(self, texts: Texts) -> list[tuple[int, str, float, int, int]]:
        """Of folded texts: text, template, containment, first and last word, in order."""
        words = texts.words()
        spans = Spans(words.hashes())
        hashes, bounds = _shingles(words, spans)
        out = []
        for i in range(len(texts)):
            for t, (share, a, b) in self.matches(hashes[bounds[i] : bounds[i + 1]]).items():
                out.append((i, self.names[t], share, a, b + SHINGLE - 1))
        for n, names in self.short.items():
            start, hashes = runs(words, spans, n)
            known = np.fromiter(names, np.uint64, len(names))
            at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
            hits = np.flatnonzero(known[at] == hashes)
            text = words.text[start[hits]]
            _, once = np.unique(text * len(known) + at[hits], return_index=True)
            for i, k, word in zip(text[once], at[hits][once], start[hits][once], strict=True):
                first = int(word - words.bounds[i])
                out += [(int(i), name, 1.0, first, first + n - 1) for name in names[int(known[k])]]
        return sorted(out)


def licenses(
    docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """One row per document and license found in it: ``doc_id, license, containment,
    first_word, last_word``.

    The words, counted from 0, are those from the first to the last matching shingle of
    the best window; of equal windows the first counts. A template of fewer than five
    words matches as a whole, and its first place counts. Null and empty texts match
    nothing. Repeated rows are reported each.
    """
    prepared = Templates(templates)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, names, shares, first, last = [], [], [], [], []
            for texts in texts_of(batch.column(1)):
                for i, name, share, a, b in prepared.found(folded(texts)):
                    rows.append(texts.first + i)
                    names.append(name)
                    shares.append(share)
                    first.append(a)
                    last.append(b)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(rows, pa.int64())),
                    pa.array(names, pa.string()),
                    pa.array(shares, pa.float64()),
                    pa.array(first, pa.int64()),
                    pa.array(last, pa.int64()),
                ],
                ["doc_id", "license", "containment", "first_word", "last_word"],
            )

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(
        run, "doc_id bigint, license string, containment double, first_word bigint, last_word bigint"
    )
