"""License texts in documents: MinHash bands over overlapping windows, verified by exact shingle containment.

Words are runs of ASCII letters and digits and of characters beyond ASCII, so marks around and within words make no difference.
Templates are grouped by the power of two q of their shingle count. For each group a text is cut into windows of 4q shingles,
each overlapping the next by half. Windows only retrieve: 64 bands of one row each; the shingles that a template and a text share
agree with some window in a coordinate with a chance that depends on their number, not on how windows cut them, and three quarters of
a template meet with probability 0.9999 or more. Templates of fewer than eight shingles are looked up shingle by shingle.

A retrieved template is verified on the whole text, wherever its shingles stand: it is found where a stretch of at most four times its
length holds 75 % of its distinct shingles.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rodovia.llm.decontamination import COORDINATES, SMALLEST, _base, _coordinate_keys, _Keys, _minima
from rodovia.llm.lexical_search import _TERMS
from rodovia.llm.shingles import WIDTH, sequences

CONTAINMENT = 75  # percent
STRETCH = 4       # times the template's number of shingles

#: Notices as their licenses word them, by license.
NOTICES: Mapping[str, tuple[str, ...]] = {
    "MIT": ("Released under the MIT License.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction"),
    "Apache-2.0": ("Licensed under the Apache License, Version 2.0.",
                   "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0"),
    "GPL-3.0": ("This work is licensed under the GNU General Public License, version 3.",
                "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
                "option) any later version."),
    "GPL-2.0": ("This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
                "option) any later version.",),
    "LGPL-2.1": ("This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
                 "General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at "
                 "your option) any later version.",),
    "AGPL-3.0": ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
                 "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
                 "your option) any later version.",),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
                "not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",),
    "BSD": ("Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",),
    "CC-BY-4.0": ("This work is licensed under a Creative Commons Attribution 4.0 International License.",),
    "CC-BY-SA-4.0": ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.",
                     "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
}
_LEADS = ("Released under the", "Licensed under the", "Distributed under the", "Available under the", "is licensed under the")
_TITLES: Mapping[str, tuple[str, ...]] = {
    "MIT": ("MIT License",), "Apache-2.0": ("Apache License, Version 2.0", "Apache License 2.0"), "ISC": ("ISC License",),
    "BSD-3-Clause": ("3-Clause BSD License", "BSD 3-Clause License"),
    "BSD-2-Clause": ("2-Clause BSD License", "BSD 2-Clause License"),
    "MPL-2.0": ("Mozilla Public License 2.0", "Mozilla Public License, Version 2.0"),
    "GPL-3.0": ("GNU General Public License v3.0", "GNU General Public License, version 3"),
    "GPL-2.0": ("GNU General Public License v2.0", "GNU General Public License, version 2"),
    "LGPL-2.1": ("GNU Lesser General Public License, version 2.1",), "LGPL-3.0": ("GNU Lesser General Public License, version 3",),
    "AGPL-3.0": ("GNU Affero General Public License, version 3",),
    "CC-BY-4.0": ("CC BY 4.0 license",), "CC-BY-SA-4.0": ("CC BY-SA 4.0 license",), "CC-BY-NC-4.0": ("CC BY-NC 4.0 license",),
}
#: Whole texts in the folder ``licenses`` whose file is not named as their license is above.
_FILES: Mapping[str, str] = {"BSD": "BSD-3-Clause", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL-3": "LGPL-3.0"}


def _templates() -> dict[str, tuple[str, ...]]:
    """License -> its notices, usual wordings of its name, and its whole text."""
    out = {name: list(texts) for name, texts in NOTICES.items()}
    for name, titles in _TITLES.items():
        out.setdefault(name, []).extend(f"{lead} {title}" for title in titles for lead in _LEADS)
    for file in sorted((Path(__file__).parent / "licenses").glob("*.txt")):
        out.setdefault(_FILES.get(file.stem, file.stem), []).append(file.read_text())
    return {name: tuple(dict.fromkeys(texts)) for name, texts in sorted(out.items())}


TEMPLATES: Mapping[str, tuple[str, ...]] = _templates()


def _template_sets(templates: Mapping[str, Sequence[str]]) -> tuple[list[str], list[np.ndarray]]:
    """The license and the sorted distinct shingles of every template that has words, each set once a license."""
    names, sets, seen = [], [], set()
    for name, texts in templates.items():
        for text in texts:
            raw = np.frombuffer(text.encode(), np.uint8)
            own = np.unique(sequences(*_TERMS.words(raw, np.array([0, len(raw)])))[0])
            if len(own) and (name, own.tobytes()) not in seen:
                seen.add((name, own.tobytes()))
                names.append(name)
                sets.append(own)
    return names, sets


class _Index:
    """Templates by band: single shingles of the small ones, coordinates of the others by the power of two of their size."""

    def __init__(self, sets: list[np.ndarray]):
        size = np.array([len(s) for s in sets])
        small = np.flatnonzero(size < SMALLEST)
        self.small = _Keys(np.concatenate([sets[i] for i in small]), np.repeat(small, size[small])) if len(small) else None
        self.classes: dict[int, _Keys] = {}
        for q in sorted({1 << (int(n).bit_length() - 1) for n in size if n >= SMALLEST}):
            own = np.flatnonzero((size >= q) & (size < 2 * q))
            minima = np.concatenate([_minima(_base(sets[i]), len(sets[i])) for i in own], axis=1)
            self.classes[q] = _Keys(_coordinate_keys(minima).ravel(), np.tile(own, COORDINATES))

    def retrieve(self, seq: np.ndarray) -> np.ndarray:
        """Templates that some window of a text's shingles may hold."""
        found = [self.small.find(seq)[1]] if self.small else []
        width = minima = None
        for q, keys in self.classes.items():
            if minima is None:
                width, minima = 2 * q, _minima(_base(seq), 2 * q)
            while width < 2 * q and minima.shape[1] > 1:
                if minima.shape[1] % 2:
                    minima = np.concatenate([minima, minima[:, -1:]], axis=1)
                minima = np.minimum(minima[:, 0::2], minima[:, 1::2])
                width *= 2
            windows = np.minimum(minima[:, :-1], minima[:, 1:]) if minima.shape[1] > 1 else minima
            found.append(keys.find(_coordinate_keys(windows).ravel())[1])
        return np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)


def passages(seq: np.ndarray, template: np.ndarray) -> list[tuple[int, int, int]]:
    """(first shingle, last shingle, most distinct ones) of the stretches of a text that hold a template; overlapping ones united."""
    at = np.minimum(np.searchsorted(template, seq), len(template) - 1)
    place = np.flatnonzero(template[at] == seq)
    which = at[place]
    if 100 * len(np.unique(which)) < CONTAINMENT * len(template):
        return []
    reach = STRETCH * len(template)
    held = np.zeros(len(template), np.int64)
    distinct, end = 0, 0
    out: list[list[int]] = []
    for begin, p in enumerate(place.tolist()):
        while end < len(place) and place[end] < p + reach:
            distinct += held[which[end]] == 0
            held[which[end]] += 1
            end += 1
        if 100 * distinct >= CONTAINMENT * len(template):
            last = int(place[end - 1])
            if out and p <= out[-1][1]:
                out[-1][1], out[-1][2] = max(out[-1][1], last), max(out[-1][2], int(distinct))
            else:
                out.append([p, last, int(distinct)])
        held[which[begin]] -= 1
        distinct -= held[which[begin]] == 0
    return [tuple(o) for o in out]


def _scan(names: list[str], sets: list[np.ndarray]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = _Index(sets)
        for batch in batches:
            out: list[tuple] = []
            for row, hashed, first in _rows(batch.column(1)):
                seq, begin = sequences(hashed, first)
                for k in np.flatnonzero(np.diff(begin) > 0):
                    own = seq[begin[k]:begin[k + 1]]
                    found: dict[str, list] = {}
                    for i in index.retrieve(own).tolist():
                        for b, e, n in passages(own, sets[i]):
                            found.setdefault(names[i], []).append((b, min(e + WIDTH, int(first[k + 1] - first[k])), n, len(sets[i])))
                    out += [(row + k, name, spans) for name, spans in sorted(found.items())]
            if out:
                best = [max(spans, key=lambda s: (s[2] / s[3], s[3])) for _, _, spans in out]
                places = [_united(spans) for _, _, spans in out]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array([o[0] for o in out])), pa.array([o[1] for o in out]),
                     pa.array([[p[0] for p in own] for own in places], pa.list_(pa.int64())),
                     pa.array([[p[1] for p in own] for own in places], pa.list_(pa.int64())),
                     pa.array([s[2] for s in best], pa.int64()), pa.array([s[3] for s in best], pa.int64())],
                    ["doc_id", "license", "begins", "ends", "n_common", "n_shingles"])
    return run


def _rows(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, word hashes, each row's first word), the pieces of a long text put together again."""
    last, parts = -1, []
    for row, raw, offs in _TERMS.slices(column):
        hashed, first = _TERMS.words(raw, offs)
        if len(offs) == 2:
            if row != last and parts:
                whole = np.concatenate(parts)
                yield last, whole, np.array([0, len(whole)])
                parts = []
            last = row
            parts.append(hashed)
            continue
        if parts:
            whole = np.concatenate(parts)
            yield last, whole, np.array([0, len(whole)])
            parts = []
        yield row, hashed, first
    if parts:
        whole = np.concatenate(parts)
        yield last, whole, np.array([0, len(whole)])


def _united(spans: list[tuple]) -> list[list[int]]:
    out: list[list[int]] = []
    for b, e, *_ in sorted(spans):
        if out and b < out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([b, e])
    return out


def find_licenses(docs: DataFrame, templates: Mapping[str, Sequence[str]] = TEMPLATES, doc_id: str = "doc_id",
                  text: str = "text") -> DataFrame:
    """(doc_id, license, begins, ends, n_common, n_shingles) for each document row and license found in it.

    A license is found where one of its templates is: a stretch of at most four times the template's length holds at least 75 % of
    its distinct five-word shingles. begins and ends are the word places of all such passages, overlapping ones united; n_common
    and n_shingles are those of the template that is there to the greatest part. The templates are a parameter of the caller
    and are shipped to all tasks. Null texts and texts without words hold nothing; templates without words are ignored; ids may be
    null or repeated, each row is judged by itself. Other columns are ignored. An empty table gives an empty table.
    """
    names, sets = _template_sets(templates)
    docs = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    schema = "doc_id bigint, license string, begins array<bigint>, ends array<bigint>, n_common bigint, n_shingles bigint"
    return docs.mapInArrow(_scan(names, sets), schema) if sets else docs.sparkSession.createDataFrame([], schema)
