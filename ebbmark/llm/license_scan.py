"""Licence notices in texts, retrieved by MinHash bands over overlapping windows.

Every template is a set of word shingles. A text is cut into windows of a few
fixed sizes, each half overlapping the next, so that a notice of up to half a
window's places lies whole in one. ``BANDS`` MinHash values are kept per window
and template, each a band of its own; a window and a template that agree in any
band are a candidate. Every template is looked for in windows of at most four
times its shingles, and where these are short also in wider ones, with room for
words put in. A whole notice so fills a quarter of a window and is retrieved
with probability 1 - 0.75 ** 64, about 1 - 1e-8. Exact containment of the template's
shingles in the window decides. A band's value is that of one shingle, so a window
that agrees holds a shingle of the template: minima are only worked out for windows
that hold a shingle of some template.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbmark.llm.arrays import Words, mix, shingles, slices, texts_of
from ebbmark.llm.columns import others

SHINGLE = 5
CONTAINMENT = 0.8
BANDS = 64
# Smallest window in shingle places, and the smallest of the wider ones; each size doubles the one before.
LEAST_WINDOW = 4
LEAST_WIDE = 16

# Notices of public licences.
TEMPLATES: dict[str, str] = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License."
    ),
    "MIT": "Released under the MIT License.",
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
        "the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software."
    ),
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."
    ),
    "LGPL-header": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation; either version 2.1 of the License, or "
        "(at your option) any later version."
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
        "was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    ),
    "BSD-text": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met:"
    ),
    "ISC-text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
}

_FOUND = T.StructType(
    [
        T.StructField("license", T.StringType()),
        T.StructField("first_word", T.LongType()),
        T.StructField("n_windows", T.LongType()),
        T.StructField("containment", T.DoubleType()),
    ]
)
_WORD = re.compile(r"\w(?:\S*\w)?")


def _hashed(texts: list[str]) -> tuple[Words, np.ndarray, np.ndarray, np.ndarray]:
    """Words in lower case without the marks around them; shingle hashes, their rows and places, in order."""
    plain = [" ".join(_WORD.findall(text.lower())) for text in texts]
    words = Words(pa.array(plain, pa.string()))
    hashes, rows, places = shingles(words, words.hashes(), SHINGLE)
    order = np.lexsort((places, rows))
    return words, hashes[order], rows[order], places[order]


@dataclass(frozen=True)
class Templates:
    """Templates with their shingle sets and band values."""

    names: list[str]
    sets: list[np.ndarray]
    lengths: list[int]
    # Sorted (band value, template) pairs.
    bands: np.ndarray
    owners: np.ndarray
    # Shingles of all templates, in order.
    every: np.ndarray

    @classmethod
    def of(cls, texts: Mapping[str, str]) -> Templates:
        names = [*texts]
        words, hashes, rows, _ = _hashed([*texts.values()])
        sets = [np.unique(hashes[rows == i]) for i in range(len(names))]
        used = [i for i in range(len(names)) if len(sets[i])]
        bands = np.array([[mix(mix(sets[i], band + 1).min()[None], band)[0] for band in range(BANDS)] for i in used], np.uint64)
        owners = np.repeat(used, BANDS)
        order = np.argsort(bands.ravel(), kind="stable")
        return cls(names, sets, words.counts.tolist(), bands.ravel()[order], owners[order], np.unique(hashes))

    def window_sizes(self) -> list[int]:
        """Window sizes of all templates."""
        return sorted({size for n in self.lengths if n for size in self.sizes_for(n)})

    @staticmethod
    def sizes_for(n: int) -> set[int]:
        """Powers of two for a template of ``n`` words: at most four times its shingles, and twice its words or more."""
        wide, near, places = LEAST_WIDE, LEAST_WINDOW, max(n - SHINGLE + 1, 1)
        while wide < 2 * n:
            wide *= 2
        while 2 * near <= min(4 * places, wide):
            near *= 2
        return {near, wide}


class _Windows:
    """Windows of one size over the shingles of some texts: every two halves that follow one another.

    Only those are kept that hold a marked shingle; the halves of these alone are
    looked at again.
    """

    def __init__(self, rows: np.ndarray, places: np.ndarray, marked: np.ndarray, size: int):
        half = places // (size // 2)
        fresh = np.append(True, (rows[1:] != rows[:-1]) | (half[1:] != half[:-1]))
        self.size = size
        begins = np.flatnonzero(fresh)
        ends = np.append(begins[1:], len(rows))
        own_rows, own_halves = rows[begins], half[begins]
        joined = np.zeros(len(begins), bool)
        joined[:-1] = (own_rows[1:] == own_rows[:-1]) & (own_halves[1:] == own_halves[:-1] + 1)
        held = np.logical_or.reduceat(marked, begins)
        after = np.append(held[1:], False) & joined
        kept = np.flatnonzero(held | after)
        self.begins, self.joined = begins[kept], joined[kept]
        self.ends = np.where(self.joined, ends[np.minimum(kept + 1, len(ends) - 1)], ends[kept])
        # The halves of the windows that are kept, end to end, and each window's first among them.
        needed = np.unique(np.concatenate([kept, kept[self.joined] + 1]))
        lengths = ends[needed] - begins[needed]
        self.starts = np.cumsum(lengths) - lengths
        self.shingles = np.repeat(begins[needed] - self.starts, lengths) + np.arange(lengths.sum())
        self.first = np.searchsorted(needed, kept)

    def minima(self, hashes: np.ndarray, salt: int) -> np.ndarray:
        lows = np.minimum.reduceat(mix(hashes[self.shingles], salt), self.starts)
        after = lows[np.minimum(self.first + 1, len(lows) - 1)]
        return np.where(self.joined, np.minimum(lows[self.first], after), lows[self.first])


def find(texts: list[str], templates: Templates) -> list[list[tuple[str, int, int, float]]]:
    """Per text the notices found: name, first word, windows that hold it, largest containment."""
    _, hashes, rows, places = _hashed(texts)
    best: list[dict[str, tuple[int, int, float]]] = [{} for _ in texts]
    marked = np.isin(hashes, templates.every)
    if not marked.any():
        return [[] for _ in texts]
    windows = [_Windows(rows, places, marked, size) for size in templates.window_sizes()]
    candidates: set[tuple[int, int, int]] = set()
    for band in range(BANDS):
        for k, cut in enumerate(windows):
            values = mix(cut.minima(hashes, band + 1), band)
            at = np.searchsorted(templates.bands, values)
            hits = np.flatnonzero(templates.bands[np.minimum(at, len(templates.bands) - 1)] == values)
            for window, place in zip(hits.tolist(), at[hits].tolist()):
                while place < len(templates.bands) and templates.bands[place] == values[window]:
                    owner = int(templates.owners[place])
                    if cut.size in templates.sizes_for(templates.lengths[owner]):
                        candidates.add((k, window, owner))
                    place += 1
    for k, window, owner in sorted(candidates):
        first, last = windows[k].begins[window], windows[k].ends[window]
        held = np.isin(hashes[first:last], templates.sets[owner])
        share = len(np.unique(hashes[first:last][held])) / len(templates.sets[owner])
        if share >= CONTAINMENT:
            found, name = best[rows[first]], templates.names[owner]
            place = int(places[first + np.flatnonzero(held)[0]])
            at, n, most = found.get(name, (place, 0, 0.0))
            found[name] = (min(at, place), n + 1, max(most, share))
    return [[(name, *values) for name, values in sorted(found.items())] for found in best]


def scan(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES) -> DataFrame:
    """One row per document and licence found, with the columns of ``docs`` but its text.

    ``first_word`` is where the first matching shingle begins, among the words
    of the text; ``n_windows`` the windows of its sizes that hold the notice; ``containment``
    the largest share of the template's shingles in a window. A template of
    fewer than five words is one shingle and found in texts of just those words.

    Null and empty texts hold nothing; repeated rows are scanned one by one;
    columns named like a result, in any case, are replaced; an empty table gives no rows.
    Templates are few and go to every task.
    """
    kept = others(docs, [*_FOUND.names, "text"])
    rows = docs.select(*kept, F.col("text").cast("string").alias("text"))
    place = len(kept)
    out = T.StructType([*(f for f in rows.schema.fields if f.name != "text"), *_FOUND.fields])
    prepared = Templates.of(templates)

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch.column(place))
            for first, last in slices(texts):
                found = find(texts.slice(first, last - first).to_pylist(), prepared)
                source = [first + i for i, hits in enumerate(found) for _ in hits]
                if not source:
                    continue
                part = batch.take(pa.array(source))
                hits = [hit for hits in found for hit in hits]
                columns = [pa.array([h[k] for h in hits], t) for k, t in enumerate((pa.string(), pa.int64(), pa.int64(), pa.float64()))]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *columns], names=out.names)

    return rows.mapInArrow(scanned, out)
