"""Licence statements found by a trained classifier of lines and of windows inside lines.

Units are lines of at most ``LONG`` words and, in any line with more words, overlapping windows of 12 and of
``LONG`` words that cover it whole. The words of a unit, without case and outer punctuation, give n-grams of one to
three words, of which those in training statements have weights; a softmax regression over them tells licence families from each other, from
statements of no known family, and from other text. It is trained on variants of the templates below
(words dropped and replaced, holders and years put in), alone and amid other text, on statements of made-up licences for the
unknown class, and for the rest on units of the corpus: at most ``FIT_LINES`` lines and as many windows, from ``FIT_DOCS``
documents of lowest hash. A third of all examples is held back: on them the softmax is given a
temperature, and the least probability at which a family is named, so that it is right in ``PRECISION`` of
the cases; a statement below it is ``unknown``.

A unit is found if it is so by its n-grams and also by its different n-grams, so that one repeated word is no statement.
Units found in a line are taken by falling probability, named families first; those of the same family that
overlap are one statement, and what else overlaps it is no finding of its own.

A family is ``confirmed`` if the statement also resembles one of its templates: most word pairs of the
template occur in it, or most of its word pairs occur in the template. What resembles no template is
reported as unknown and not confirmed.

Only ids, training units and the weights are gathered, all of bounded size; texts are scanned whole in
one pass without a shuffle. Sums are of integers, so equal units have equal probabilities wherever they stand.

Defined cases: null, empty and wordless texts have no unit; equal texts give equal findings;
equal lines of a text are findings of their own; an empty table gives an empty table (the templates
alone train the model); other columns are ignored; a very long line is scored by its windows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .repetition_rules import line_spans
from .words import roll, slices, span_hashes, split_words

_U = np.uint64
FIT_DOCS = 2_000
FIT_LINES = 3_000
LONG = 48  # words; longer lines are scored by windows only
WINDOWS = ((12, 6), (LONG, 24))  # words of a window, and from one to the next
VARIANTS = 60
STEPS, RATE, RIDGE = 120, 0.5, 1e-5
PRECISION = 0.99
ALIKE = 0.6
POINT = 20  # bits behind the point of the weights that are summed
SLICE_BYTES = 1 << 20

# Common wording of public licences and notices.
TEMPLATES = {
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT license. See LICENSE in the project root.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ],
    "Apache": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "This project is distributed under the Apache 2.0 license.",
    ],
    "GPL": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
        "You should have received a copy of the GNU General Public License along with this program.",
        "Released under the GNU GPL v2 or later.",
        "Licensed under the GPLv3.",
    ],
    "LGPL": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License",
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "Released under the LGPL.",
    ],
    "AGPL": [
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "You should have received a copy of the GNU Affero General Public License along with this program.",
        "Licensed under the AGPLv3.",
    ],
    "BSD": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Released under the 3-clause BSD License.",
        "Licensed under the BSD 2-Clause License.",
    ],
    "MPL": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
        "If a copy of the MPL was not distributed with this file, you can obtain one at https://mozilla.org/MPL/2.0/",
    ],
    "CC-BY": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Released under a CC-BY 3.0 license.",
    ],
    "CC-BY-SA": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Text is available under the Creative Commons Attribution-ShareAlike License.",
    ],
    "CC-BY-NC": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Released under CC BY-NC 3.0 for noncommercial use.",
    ],
    "Public-Domain": [
        "This work has been dedicated to the public domain.",
        "This is free and unencumbered software released into the public domain.",
        "To the extent possible under law, the author has waived all copyright and related rights under CC0 1.0.",
    ],
    "Proprietary": [
        "All rights reserved.",
        "Copyright 2020 The Author. All rights reserved.",
        "No part of this publication may be reproduced without the prior written permission of the publisher.",
        "Confidential and proprietary. Unauthorized copying of this file is strictly prohibited.",
    ],
}
# Forms of statements of licences that are in no family above.
UNKNOWN_FORMS = [
    "Licensed under the {} License, version {}.",
    "This work is licensed under the {} Public License.",
    "Released under the terms of the {} licence.",
    "Distributed under the {} Software License Agreement, see the file COPYING.",
    "You may use and redistribute this file under the {} License.",
    "Use of this material is governed by the {} community license.",
]
_MADE_UP = "Aster Borealis Cobalt Dunmore Ember Fjord Garnet Harbor Indigo Juniper Kestrel Lumen Marlow Nimbus Orchid Pelican Quartz Rowan Sable Tundra".split()

FAMILIES = list(TEMPLATES)
CLASSES = [*FAMILIES, "unknown", "none"]
UNKNOWN, NONE = len(FAMILIES), len(FAMILIES) + 1

_SOLID = np.zeros(256, bool)
_SOLID[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def features(column: pa.Array) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """(number of lines; line, hash and value of every feature)."""
    words = split_words(column)
    start, _, _ = line_spans(words.data, words.bounds)
    solid = np.flatnonzero(_SOLID[words.data])
    first, last = np.searchsorted(solid, words.start), np.searchsorted(solid, words.end)
    full = last > first
    a, b = solid[first[full]], solid[last[full] - 1] + 1
    line = np.searchsorted(start, a, side="right") - 1
    keys = span_hashes(words.data, a, b, lower=True)
    lines, found = [], []
    for _, at, hashes in roll(keys, line, (1, 2, 3)):
        lines.append(line[at])
        found.append(hashes)
    line, found = np.concatenate(lines), np.concatenate(found)
    order = np.argsort(line, kind="stable")
    line, found = line[order], found[order]
    value = 1 / np.sqrt(np.bincount(line, minlength=len(start)))[line] if len(line) else np.zeros(0)
    return len(start), line, found, value


def places(known: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Places of the hashes in the sorted ``known``; its length for others."""
    place = np.searchsorted(known, hashes)
    return np.where(known[np.minimum(place, len(known) - 1)] == hashes, place, len(known))


def units(column: pa.Array) -> tuple:
    """(words, start, end and text of the lines; line, first word and number of words of every unit; start and end and hash of words)."""
    words = split_words(column)
    start, end, doc = line_spans(words.data, words.bounds)
    solid = np.flatnonzero(_SOLID[words.data])
    first, last = np.searchsorted(solid, words.start), np.searchsorted(solid, words.end)
    full = last > first
    keys = span_hashes(words.data, solid[first[full]], solid[last[full] - 1] + 1, lower=True)
    a, b = words.start[full], words.end[full]
    count = np.bincount(np.searchsorted(start, a, side="right") - 1, minlength=len(start))
    begin = np.cumsum(count) - count
    whole = np.flatnonzero((count > 0) & (count <= LONG))
    lines, firsts, sizes = [whole], [begin[whole]], [count[whole]]
    for size, step in WINDOWS:
        cut = np.flatnonzero(count > size)
        n = -(-(count[cut] - size) // step) + 1
        line = np.repeat(cut, n)
        place = np.arange(len(line)) - np.repeat(np.cumsum(n) - n, n)
        lines.append(line)
        firsts.append(begin[line] + np.minimum(place * step, count[line] - size))  # the last one ends with the line
        sizes.append(np.full(len(line), size))
    line, first, size = np.concatenate(lines), np.concatenate(firsts), np.concatenate(sizes)
    # Whole lines span all their bytes, windows those of their words.
    alone = np.arange(len(line)) < len(whole)
    spans = (np.where(alone, start[line], a[first]), np.where(alone, end[line], b[first + size - 1])) if len(line) else (line, line)
    return words, start, end, doc, line, first, size, *spans, keys


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


@dataclass(frozen=True)
class Model:
    known: np.ndarray  # sorted hashes of the features with weights
    weights: np.ndarray  # place x class, float32; the last row is the constant
    temperature: float
    least: float  # probability from which a family is named

    def probabilities(self, n: int, line: np.ndarray, place: np.ndarray, value: np.ndarray) -> np.ndarray:
        z = np.repeat(self.weights[-1:].astype(np.float64), n, axis=0)
        if len(line):
            starts = np.flatnonzero(np.concatenate([[True], line[1:] != line[:-1]]))
            z[line[starts]] += np.add.reduceat(self.weights[place] * value[:, None].astype(np.float32), starts, axis=0)
        return softmax(z / self.temperature)

    def of_units(self, keys: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Probabilities of units of ``size`` words from ``first``, by running sums over all words."""
        table = np.rint(self.weights * float(1 << POINT)).astype(np.int64)
        constant, table[-1] = table[-1].copy(), 0  # other features count for the length only
        total, n_features = np.zeros((len(first), len(CLASSES)), np.int64), np.zeros(len(first), np.int64)
        for n, at, hashes in roll(keys, np.zeros(len(keys), np.int64), (1, 2, 3)):
            sums = np.zeros((len(at) + 1, len(CLASSES)), np.int64)
            np.cumsum(table[places(self.known, hashes)], axis=0, out=sums[1:])
            held = size >= n
            total[held] += sums[first[held] + size[held] - n + 1] - sums[first[held]]
            n_features += np.maximum(size - n + 1, 0)
        z = total / np.sqrt(np.maximum(n_features, 1))[:, None] + constant
        return softmax(z / (1 << POINT) / self.temperature)

    def of_different(self, keys: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Probabilities of units by their different n-grams."""
        table = np.rint(self.weights * float(1 << POINT)).astype(np.int64)
        z = np.repeat(table[-1:].astype(np.float64), len(first), axis=0)
        for i, (a, n) in enumerate(zip(first, size)):
            hashes = [h for _, _, h in roll(keys[a : a + n], np.zeros(n, np.int64), (1, 2, 3))]
            place = places(self.known, np.unique(np.concatenate(hashes)))
            z[i] += table[place[place < len(self.known)]].sum(axis=0) / np.sqrt(sum(map(len, hashes)))
        return softmax(z / (1 << POINT) / self.temperature)


def variants(seed: int = 7) -> list[tuple[str, int]]:
    """Training statements: (text, class), the same in every run."""
    draw, out = np.random.default_rng(seed), []
    for c, family in enumerate(FAMILIES):
        for i in range(VARIANTS * 3):
            words = TEMPLATES[family][i % len(TEMPLATES[family])].split()
            changed = i % 3 > 0
            kept = [w for w in words if draw.random() > 0.06] if len(words) > 5 and changed else words
            if changed and draw.random() < 0.2:
                kept = f"Copyright (c) {draw.integers(1990, 2030)} {draw.choice(_MADE_UP)}.".split() + kept
            out.append((" ".join(kept), c))
    for i in range(VARIANTS * 6):
        name = " ".join(draw.choice(_MADE_UP, int(draw.integers(1, 3)), replace=False))
        out.append((UNKNOWN_FORMS[i % len(UNKNOWN_FORMS)].format(name, f"{draw.integers(1, 5)}.{draw.integers(0, 4)}"), UNKNOWN))
    return out


def _pairs(text: str) -> set[tuple[str, str]]:
    words = re.findall(r"[0-9a-z\u0080-￿][0-9a-z.\-\u0080-￿]*", text.lower())
    words = [w.strip(".-") for w in words]
    return set(zip(words, words[1:]))


_TEMPLATE_PAIRS = {family: [_pairs(t) for t in texts] for family, texts in TEMPLATES.items()}
_TEMPLATE_PAIRS["unknown"] = [_pairs(form.replace("{}", "")) for form in UNKNOWN_FORMS] + [t for same in list(_TEMPLATE_PAIRS.values()) for t in same]


def likeness(text: str, family: str) -> float:
    """Largest share of word pairs of a template that the text has, or of the text that a template has."""
    own = _pairs(text)
    return max((len(own & t) / min(len(own), len(t)) for t in _TEMPLATE_PAIRS.get(family, ()) if own), default=0.0)


def amid(statements: list[tuple[str, int]], others: list[str], seed: int = 11) -> list[tuple[str, int]]:
    """The statements in windows whose other words are from other text."""
    draw, out = np.random.default_rng(seed), []
    around = " ".join(others).split()
    for text, c in statements if around else []:
        words = text.split()
        size = next((n for n, _ in WINDOWS if n >= len(words)), len(words))
        at, lead = int(draw.integers(0, len(around))), int(draw.integers(0, size - len(words) + 1))
        more = [around[(at + i) % len(around)] for i in range(size - len(words))]
        out.append((" ".join(more[:lead] + words + more[lead:]), c))
    return out


def fit_model(others: list[str]) -> Model:
    """Softmax regression on the variants, alone and amid other text, and on units of other text, with temperature and threshold."""
    others = [t for t in others if all(likeness(t, f) < 0.5 for f in FAMILIES)]
    said = variants()
    _, _, known, _ = features(pa.array([t for t, _ in said]))
    known = np.unique(known)
    examples = said + [(t, NONE) for t in others] + amid(said, others)
    label = np.array([c for _, c in examples])
    _, line, hashes, value = features(pa.array([re.sub(r"\s+", " ", t) or "-" for t, _ in examples]))
    place = places(known, hashes)
    line, place, value = (x[place < len(known)] for x in (line, place, value))
    held = np.arange(len(label)) % 3 == 2
    n, w, seen = len(label), np.zeros((len(known) + 1, len(CLASSES))), np.full((len(known) + 1, len(CLASSES)), 1e-8)
    target = np.eye(len(CLASSES))[label]
    weight = np.where(held, 0.0, 1 / np.bincount(label, minlength=len(CLASSES))[label])
    weight *= np.where(label == NONE, 10.0, 1.0)  # most units are none
    weight /= weight.sum()
    used, back = np.unique(place, return_inverse=True)
    starts = np.flatnonzero(np.concatenate([[True], line[1:] != line[:-1]]))
    order = np.argsort(back, kind="stable")
    edges = np.flatnonzero(np.concatenate([[True], back[order][1:] != back[order][:-1]]))
    for _ in range(STEPS):
        z = np.repeat(w[-1:], n, axis=0)
        z[line[starts]] += np.add.reduceat(w[place] * value[:, None], starts, axis=0)
        wrong = (softmax(z) - target) * weight[:, None]
        grad = np.add.reduceat((wrong[line] * value[:, None])[order], edges, axis=0) + RIDGE * w[used]
        seen[used] += grad**2
        w[used] -= RATE * grad / np.sqrt(seen[used])
        all_of = wrong.sum(axis=0)
        seen[-1] += all_of**2
        w[-1] -= RATE * all_of / np.sqrt(seen[-1])
    w = w.astype(np.float32)
    best = min(np.geomspace(0.1, 5, 40), key=lambda t: _loss(Model(known, w, float(t), 0.0), n, line, place, value, label, held))
    p = Model(known, w, float(best), 0.0).probabilities(n, line, place, value)[held][:, : UNKNOWN]
    named, right = p.max(axis=1), p.argmax(axis=1) == label[held]
    order = np.argsort(-named)
    share = np.cumsum(right[order]) / np.arange(1, len(order) + 1)
    good = np.flatnonzero(share >= PRECISION)
    least = float(np.clip(named[order][good[-1]], 0.5, 0.95)) if len(good) else 0.95
    return Model(known, w, float(best), least)


def _loss(model: Model, n: int, line: np.ndarray, place: np.ndarray, value: np.ndarray, label: np.ndarray, held: np.ndarray) -> float:
    p = model.probabilities(n, line, place, value)
    return float(-np.log(np.maximum(p[np.arange(n), label], 1e-12))[held].mean())


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """A model whose other text comes from ``docs``."""
    chosen = docs.select(F.col(f"`{id_col}`").alias("_id")).distinct().orderBy(F.xxhash64("_id"), "_id").limit(FIT_DOCS)
    texts = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("text")).join(F.broadcast(chosen), "_id", "left_semi").select("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, n in slices(batch.column(0), SLICE_BYTES):
                words, start, end, _, line, _, _, low, high, _ = units(batch.column(0).slice(first, n))
                cut = (low != start[line]) | (high != end[line])
                found = [words.data[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(low, high)]
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array(cut)], names=["unit", "cut"])

    found = materialize(texts.mapInArrow(run, "unit string, cut boolean").distinct())
    out = []
    for cut in (False, True):
        out += found.filter(F.col("cut") == cut).orderBy(F.xxhash64("unit"), "unit").limit(FIT_LINES).toArrow().column("unit").to_pylist()
    return fit_model(out)


def merged(low: np.ndarray, high: np.ndarray, named: np.ndarray, best: np.ndarray, sure: np.ndarray) -> list[tuple[int, int, int, list[int]]]:
    """(best unit, start, end, units) of the statements among the units found in one line."""
    out, left = [], sorted(range(len(low)), key=lambda i: (not named[i], -sure[i], low[i], high[i]))
    while left:
        top = left[0]
        a, b, own = low[top], high[top], [top]
        same = [i for i in left[1:] if named[i] == named[top] and (not named[top] or best[i] == best[top])]
        while near := [i for i in same if low[i] < b and a < high[i]]:
            a, b, own = min(a, *(low[i] for i in near)), max(b, *(high[i] for i in near)), own + near
            same = [i for i in same if i not in set(near)]
        out.append((top, int(a), int(b), own))
        taken = set(own)
        left = [i for i in left if i not in taken and not (low[i] < b and a < high[i])]
    return sorted(out, key=lambda x: x[1])


def statements(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per licence statement: id, ``line`` (from 0, of those with a character), ``start`` and ``end`` (bytes of the text), ``family``, ``probability``, ``likeness``, ``confirmed``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    id_type = docs.schema[id_col].dataType.simpleString()
    names = [id_col, "line", "start", "end", "family", "probability", "likeness", "confirmed"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for first, n in slices(batch.column(1), SLICE_BYTES):
                words, start, end, doc, line, begin, size, low, high, keys = units(batch.column(1).slice(first, n))
                p = m.of_units(keys, begin, size)
                hit = np.flatnonzero(p[:, NONE] < 0.5)
                p[hit] = m.of_different(keys, begin[hit], size[hit])
                hit = hit[p[hit, NONE] < 0.5]
                if not len(hit):
                    continue
                hit = hit[np.argsort(line[hit], kind="stable")]
                best = p[hit, :UNKNOWN].argmax(axis=1)
                named = p[hit, best] >= m.least
                sure = np.where(named, p[hit, best], 1 - p[hit, NONE])
                text = lambda a, b: words.data[a:b].tobytes().decode("utf-8", "replace")
                rows = []
                for part in np.split(np.arange(len(hit)), np.flatnonzero(np.diff(line[hit])) + 1):
                    of = hit[part]
                    for top, a, b, own in merged(low[of], high[of], named[part], best[part], sure[part]):
                        family = FAMILIES[best[part[top]]] if named[part[top]] else "unknown"
                        spans = {(a, b), *((int(low[of[i]]), int(high[of[i]])) for i in own)}
                        rows.append((int(line[of[0]]), a, b, family, float(sure[part[top]]), max(likeness(text(*x), family) for x in spans)))
                at, a, b, family, probability, alike = map(list, zip(*rows))
                at, alike = np.array(at), np.array(alike)
                base = words.bounds[doc[at]]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, n).take(pa.array(doc[at])), pa.array(at - np.searchsorted(doc, doc[at])), pa.array(np.array(a) - base), pa.array(np.array(b) - base),
                     pa.array(family, pa.string()), pa.array(probability, pa.float64()), pa.array(alike, pa.float64()), pa.array(alike >= ALIKE)],
                    names=names)

    schema = f"`{id_col}` {id_type}, line long, start long, end long, family string, probability double, likeness double, confirmed boolean"
    return docs.select(id_col, text_col).mapInArrow(run, schema)
