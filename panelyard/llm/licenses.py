"""License scans: a trained paragraph classifier, confirmed by comparison with templates.

A paragraph is a run of lines that hold words; it is read in overlapping windows of several lengths (WINDOWS words), across its line
ends, and so is each of its lines. Features are hashed one- and two-word n-grams of lower-cased letters and digits. A multinomial
logistic regression (MLlib) learns the families from variants of the fixed notices below, and the class `unknown` from fixed
sentences (notices of other licences among them) and from the sample. Every third notice of a family, or the last of fewer, is left out of a first fit, and the temperature of the
probabilities is fitted on those, so it is calibrated on wordings that were not trained on; the second fit has them all.

Every window of every text is scored; nothing is left out beforehand. A window is of a family if the calibrated
probability is at least CONFIDENCE and a notice of the family confirms it: a share of at least OVERLAP of the two-word
n-grams of the shorter of the two, where an n-gram that several families have counts for its part only; what a short notice shares must hold a word of the family's name
if the notice does (a word of its titles that neither other licences nor plain sentences have, such as `mozilla` or `gnu`); and no notice of another family or of another licence shares more with the window. Of findings that overlap
in their shared words the one that shares most counts, so a whole notice goes before a line of it.

The sample is the bound of the fit: at most SAMPLE_DOCS documents (smallest hashes of id and text), of each the SAMPLE_LINES lines
with the smallest hashes, and of all their windows the NEGATIVES with the smallest hashes that no notice would confirm.

A single word is no notice (`GPLv3` alone on a line isn't found; `License: GPLv3` is). Other licences have no family, whether listed here or not.

Defined cases: null, empty and blank texts have no paragraphs. Repeated rows give equal rows. Extra columns are not read. If the
documents give no lines, the fixed sentences alone are the unknown class.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import U64, hashed_words, mix, passes, table

#: Words of a window, by scale; windows of a scale begin every half window. The first is the longest.
WINDOWS = (64, 32, 16)
WINDOW, STRIDE = WINDOWS[0], WINDOWS[0] // 2
DIMENSIONS = 1 << 13
ITERATIONS = 25
SAMPLE_DOCS, SAMPLE_LINES, NEGATIVES = 400, 200, 2000
CONFIDENCE = 0.6
OVERLAP = 0.6
#: Most n-grams of a notice that must share a word of its family's name.
SHORT = 16
UNKNOWN = "unknown"

# Notices of licence families, in the wording that their publishers give or that files commonly carry.
NOTICES = {
    "MIT": [
        "Released under the MIT License.", "Licensed under the MIT license.", "This project is licensed under the terms of the MIT license.", "SPDX-License-Identifier: MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.", "Released under the Apache License 2.0.", "SPDX-License-Identifier: Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ],
    "GPL": [
        "This work is licensed under the GNU General Public License, version 3.", "Licensed under the GNU General Public License, version 2.", "SPDX-License-Identifier: GPL-3.0-or-later", "Released under the GNU GPL v3.",
        "Licensed under GPL.", "Licensed under GPLv3.", "Licensed under the GPLv2.", "Released under the GPL v3.", "Released under the GPLv3.", "License: GPLv3",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "LGPL": [
        "Licensed under the GNU Lesser General Public License, version 3.", "SPDX-License-Identifier: LGPL-2.1-or-later", "Licensed under LGPLv3.", "Licensed under the LGPL.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
    ],
    "AGPL": ["Licensed under the GNU Affero General Public License, version 3.", "SPDX-License-Identifier: AGPL-3.0-only", "Licensed under AGPLv3.", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation"],
    "BSD": [
        "Released under the BSD 3-Clause License.", "Licensed under the BSD 2-Clause License.", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.", "SPDX-License-Identifier: BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    ],
    "MPL-2.0": ["Licensed under the Mozilla Public License, Version 2.0.", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "SPDX-License-Identifier: MPL-2.0"],
    "ISC": ["Released under the ISC License.", "SPDX-License-Identifier: ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."],
    "CC-BY": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License.", "This article is distributed under the terms of the Creative Commons Attribution License."],
    "CC-BY-SA": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "Text is available under the Creative Commons Attribution-ShareAlike License."],
    "CC-BY-NC": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", "Licensed under CC BY-NC-SA 4.0."],
    "CC0": ["Released under CC0 1.0.", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.", "Dedicated to the public domain under the Creative Commons Zero license."],
    "Unlicense": ["This is free and unencumbered software released into the public domain.", "Released under the Unlicense."],
    "Proprietary": ["All rights reserved.", "Unauthorized copying of this file, via any medium, is strictly prohibited.", "This software is proprietary and confidential."],
}
# Titles of the families.
TITLES = {
    "MIT": ["MIT License", "The MIT License (MIT)"],
    "Apache-2.0": ["Apache License", "Apache License, Version 2.0"],
    "GPL": ["GNU General Public License", "GNU GPL"],
    "LGPL": ["GNU Lesser General Public License", "GNU LGPL"],
    "AGPL": ["GNU Affero General Public License", "GNU AGPL"],
    "BSD": ["BSD License", "BSD 3-Clause License", "BSD 2-Clause License"],
    "MPL-2.0": ["Mozilla Public License", "Mozilla Public License Version 2.0"],
    "ISC": ["ISC License"],
    "CC-BY": ["Creative Commons Attribution 4.0 International", "CC BY 4.0"],
    "CC-BY-SA": ["Creative Commons Attribution-ShareAlike 4.0 International", "CC BY-SA 4.0"],
    "CC-BY-NC": ["Creative Commons Attribution-NonCommercial 4.0 International", "CC BY-NC 4.0"],
    "CC0": ["CC0 1.0 Universal", "Creative Commons Zero"],
    "Unlicense": ["The Unlicense"],
    "Proprietary": ["All rights reserved", "Proprietary and confidential"],
}
# Notices of other licences, which are of the unknown class.
OTHERS = [
    "Eclipse Public License - v 2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0", "Licensed under the EUPL, Version 1.2.",
    "European Union Public Licence", "Distributed under the Boost Software License, Version 1.0.", "This file is released under the zlib license.", "Do What The Fuck You Want To Public License, Version 2",
    "Common Development and Distribution License (CDDL) Version 1.0", "Licensed under the Artistic License 2.0.", "Python Software Foundation License Version 2", "SPDX-License-Identifier: EPL-2.0", "SPDX-License-Identifier: Zlib",
]
# Sentences with words of licences that grant nothing.
PLAIN = [
    "The driver must show a valid license at the gate.", "Her fishing license was renewed in the spring.", "He read the public notice and the terms of the offer.", "The version of the story that was released last year is longer.",
    "This work is under way and will be finished in the summer.", "You may not use this door except in an emergency.", "The general public was free to enter.", "All copies of the map were sold.", "The software was slow, and nobody knew why.",
    "They licensed the song to a film studio.", "Unless required by the teacher, no homework is due.", "The commons were open to any person of the village.", "Released under pressure, the steam filled the hall.", "His rights were reserved for later.",
]

_TO_WORDS = np.full(256, 32, np.uint8)
for _c in b"abcdefghijklmnopqrstuvwxyz0123456789\n":
    _TO_WORDS[_c] = _c
for _c in b"ABCDEFGHIJKLMNOPQRSTUVWXYZ":
    _TO_WORDS[_c] = _c + 32
_TO_WORDS[128:] = np.arange(128, 256)


def _plain(lines: pa.Array) -> pa.Array:
    """lines with ASCII letters lower-cased and other ASCII characters but digits as spaces."""
    lines = lines.cast(pa.large_string())
    offsets = np.frombuffer(lines.buffers()[1], np.int64)[lines.offset : lines.offset + len(lines) + 1]
    data = np.frombuffer(lines.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]] if len(lines) else np.zeros(0, np.uint8)
    return pa.LargeStringArray.from_buffers(len(lines), pa.py_buffer(np.ascontiguousarray(offsets - offsets[0])), pa.py_buffer(_TO_WORDS[data].tobytes()))


def line_grams(lines: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word hashes, hashes of each word and the next in its line (0 at a line's end), end offset of each line)."""
    words, ends = hashed_words(_plain(lines))
    pairs = np.zeros(len(words), U64)
    if len(words) > 1:
        pairs[:-1] = mix(words[:-1] * U64(3) + mix(words[1:]))
        last = ends[ends > 0] - 1
        pairs[last] = 0
    return words, pairs, ends


def _features(words: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashed features, their values): counts over the root of their sum."""
    at, n = np.unique(np.concatenate([words, pairs[pairs != 0]]) % U64(DIMENSIONS), return_counts=True)
    return at.astype(np.int64), n / np.sqrt(max(1, n.sum()))


def spans_of(begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Windows of all scales over spans of words; a span that fits in a window of a scale is one, and has none of the longer scales but the longest."""
    first, last = [], []
    for size in WINDOWS:
        some = (ends - begins > size) | (size == WINDOWS[0])
        a, z = begins[some], ends[some]
        n = np.maximum(1, -(-(z - a - size) // (size // 2)) + 1)
        nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        first.append(np.repeat(a, n) + size // 2 * nth)
        last.append(np.minimum(first[-1] + size, np.repeat(z, n)))
    return np.concatenate(first), np.concatenate(last)


@dataclass
class Model:
    families: list[str]
    weights: np.ndarray
    bias: np.ndarray
    temperature: float
    #: (family, n-grams, their first and second words) of each notice; other licences have the number of the unknown class.
    notices: list[tuple[int, np.ndarray]]
    named: list[np.ndarray]

    def __post_init__(self) -> None:
        grams = np.concatenate([np.zeros(0, U64), *[np.unique(np.concatenate([g for f, g in self.notices if f == k])) for k in {f for f, _ in self.notices}]])
        self.grams, count = np.unique(grams, return_counts=True)
        self.shares = 1.0 / count
        # all notices' n-grams in one sorted list, so that a window is compared with all of them at once
        self.family_of = np.array([f for f, _ in self.notices], np.int64)
        sizes = np.array([len(g) for _, g in self.notices], np.int64)
        flat = np.concatenate([np.zeros(0, U64), *[g for _, g in self.notices]])
        of = np.repeat(np.arange(len(sizes)), sizes)
        order = np.argsort(flat, kind="stable")
        naming = np.concatenate([np.zeros(0, bool), *[np.isin(g, self.named[f]) if f < len(self.named) else np.zeros(len(g), bool) for f, g in self.notices]])
        self.flat, self.of, self.naming = flat[order], of[order], naming[order]
        self.totals = np.bincount(of, self.weight(flat), len(sizes))
        self.free = (sizes > SHORT) | (np.bincount(of, naming, len(sizes)) == 0)  # notices that need no word of the name

    def weight(self, grams: np.ndarray) -> np.ndarray:
        """For each n-gram one over the families that have it; 1 if none has."""
        if not len(self.grams):
            return np.ones(len(grams))
        at = np.minimum(np.searchsorted(self.grams, grams), len(self.grams) - 1)
        return np.where(self.grams[at] == grams, self.shares[at], 1.0)

    def probabilities(self, words: np.ndarray, pairs: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Calibrated class probabilities of windows [first, last) of words, by running sums of their features' weights."""
        ones, twos = (np.concatenate([np.zeros((1, len(self.bias))), np.cumsum(w, axis=0)]) for w in
                      (self.weights.T[(words % U64(DIMENSIONS)).astype(np.int64)], np.where((pairs != 0)[:, None], self.weights.T[(pairs % U64(DIMENSIONS)).astype(np.int64)], 0)))
        some = np.concatenate([[0], np.cumsum(pairs != 0)])
        n = last - first + some[last - 1] - some[first]
        z = (ones[last] - ones[first] + twos[last - 1] - twos[first]) / np.sqrt(n)[:, None] + self.bias
        z = (z - z.max(axis=1, keepdims=True)) / self.temperature
        e = np.exp(z)
        return e / e.sum(axis=1, keepdims=True)

    def compared(self, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(weight of the n-grams that a window shares with each notice, whether the notice confirms its family)."""
        own = np.unique(pairs[pairs != 0])
        low, high = np.searchsorted(self.flat, own, "left"), np.searchsorted(self.flat, own, "right")
        n = high - low
        at = np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        weight = self.weight(own)
        common = np.bincount(self.of[at], np.repeat(weight, n), len(self.notices))
        named = np.bincount(self.of[at], self.naming[at], len(self.notices)) > 0
        return common, (common > 0) & (common >= OVERLAP * np.minimum(weight.sum(), self.totals) - 1e-9) & (self.free | named)

    def confirmed(self, pairs: np.ndarray, family: int) -> np.ndarray | None:
        """Positions of the n-grams that the family's closest notice shares with a window; None if none confirms it."""
        common, good = self.compared(pairs)
        mine = self.family_of == family
        shared = np.where(mine & good, common, -1.0)
        best = int(shared.argmax())
        return np.flatnonzero(np.isin(pairs, self.notices[best][1])) if shared[best] > 0 and shared[best] >= common[~mine].max(initial=0.0) - 1e-9 else None

    def confirms_any(self, pairs: np.ndarray) -> bool:
        """Whether some family is confirmed by a window: the closest notice of all confirms its own."""
        common, good = self.compared(pairs)
        closest = common >= common.max(initial=0.0) - 1e-9
        return bool((closest & good & (self.family_of < len(self.named))).any())

    def find(self, words: np.ndarray, pairs: np.ndarray, first: np.ndarray, last: np.ndarray) -> list[tuple[int, int, int, int]]:
        """(first and last shared word, family, shared n-grams) of confirmed windows that do not overlap, in text order."""
        if not len(first):
            return []
        p = self.probabilities(words, pairs, first, last)
        best = p.argmax(1)
        found = []
        for u in np.flatnonzero((best != len(self.families) - 1) & (p.max(1) >= CONFIDENCE)).tolist():
            a, z = int(first[u]), int(last[u])
            hit = self.confirmed(pairs[a : z - 1], int(best[u]))
            if hit is not None:
                found.append((a + int(hit[0]), a + int(hit[-1]) + 1, int(best[u]), len(hit)))
        out: list[tuple[int, int, int, int]] = []
        taken = np.zeros(len(words), bool)
        for x in sorted(found, key=lambda x: (-x[3], x)):
            if not taken[x[0] : x[1] + 1].any():
                taken[x[0] : x[1] + 1] = True
                out.append(x)
        return sorted(out)

    def family(self, text: str) -> str:
        """Family of a text as one window."""
        words, pairs, _ = line_grams(pa.array([text]))
        found = self.find(words, pairs, np.array([0]), np.array([len(words)])) if len(words) else []
        return self.families[found[0][2]] if found else UNKNOWN


def _variants(sentence: str, rng: np.random.Generator, n: int, around: list[str]) -> list[str]:
    """The sentence, and n forms of it: words dropped, cut at the end, words or other text around it."""
    words = sentence.split()
    out = [sentence]
    for _ in range(n):
        w = [x for x in words if rng.random() > 0.08] or words
        if len(w) > 12 and rng.random() < 0.5:
            w = w[: int(rng.integers(8, len(w) + 1))]
        if rng.random() < 0.3:
            w = [*(["Copyright", "2020", "the", "authors."] if rng.random() < 0.5 else ["Note:"]), *w]
        if around and rng.random() < 0.5:
            more = around[int(rng.integers(len(around)))].split()[: int(rng.integers(max(0, WINDOW - len(w)) + 1))]
            at = int(rng.integers(len(more) + 1))
            w = [*more[:at], *w, *more[at:]]
        out.append(" ".join(w))
    return out


def _sample(docs: DataFrame, doc_id: str, text: str, sample_docs: int, sample_lines: int) -> list[str]:
    """Lines of the sample's documents. Hashes of id and text order them, so rows that tie are equal."""
    hashed = docs.where(F.col(text).isNotNull()).select(F.xxhash64(F.col(doc_id), F.col(text)).alias("h"), F.col(text).alias("t"))
    cut = hashed.select("h").orderBy("h").limit(sample_docs).agg(F.max("h")).first()[0]
    if cut is None:
        return []
    by_hash = F.array_sort(F.transform(F.split("t", "\n"), lambda x: F.struct(F.xxhash64(x).alias("h"), x.alias("x"))))
    rows = hashed.where(F.col("h") <= cut).limit(sample_docs).select(F.slice(by_hash, 1, sample_lines)["x"].alias("lines")).collect()
    return [x for r in rows for x in r["lines"] if x.strip()]


def _templates(sentences: list[tuple[int, str, bool]], unknown: int) -> tuple[list[tuple[int, np.ndarray]], list[np.ndarray]]:
    """(family and n-grams of each notice, for each family the n-grams of its notices that hold a word of its name)."""
    notices, grams_of, words_of = [], [[] for _ in range(unknown)], [set() for _ in range(unknown)]
    for k, sentence in [*[(k, s) for k, s, _ in sentences], *[(unknown, s) for s in OTHERS]]:
        words, pairs, _ = line_grams(pa.array([sentence]))
        notices.append((k, np.unique(pairs[pairs != 0])))
        if k < unknown:
            grams_of[k] += [(g, {int(x), int(y)}) for g, x, y in zip(pairs.tolist(), words.tolist(), words[1:].tolist()) if g]
    for k, name in enumerate(NOTICES):
        short = [s for f, s, _ in sentences if f == k and len(s.split()) <= 6]
        for title in [*TITLES[name], *short]:
            words_of[k] |= {int(x) for x in line_grams(pa.array([title]))[0]}
    common = {int(x) for s in [*PLAIN, *OTHERS] for x in line_grams(pa.array([s]))[0]}
    return notices, [np.unique(np.array([g for g, both in grams_of[k] if both & (words_of[k] - common)], U64)) for k in range(unknown)]


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", sample_docs: int = SAMPLE_DOCS, sample_lines: int = SAMPLE_LINES, negatives: int = NEGATIVES, seed: int = 1) -> Model:
    """The classifier, its temperature and the notices. Reads at most sample_docs x sample_lines lines to the driver and learns from at most `negatives` windows of them."""
    spark = docs.sparkSession
    families = [*NOTICES, UNKNOWN]
    unknown = len(NOTICES)
    rng = np.random.default_rng(seed)
    last = lambda name, i: i % 3 == 2 or (len(NOTICES[name]) < 3 and i == len(NOTICES[name]) - 1)
    sentences = [(k, s, last(name, i)) for k, name in enumerate(NOTICES) for i, s in enumerate(NOTICES[name])] + [(k, s, False) for k, name in enumerate(NOTICES) for s in TITLES[name]]
    model = Model(families, np.zeros((unknown + 1, DIMENSIONS)), np.zeros(unknown + 1), 1.0, *_templates(sentences, unknown))
    found = set()
    for line in sorted(set(_sample(docs, doc_id, text, sample_docs, sample_lines))):
        w = line.split()
        found |= {" ".join(w[i : i + WINDOW]) for i in range(0, max(1, len(w) - STRIDE), STRIDE)}
    plain = []
    for piece in sorted(found, key=lambda x: (hash_of(x), x)):
        _, pairs, _ = line_grams(pa.array([piece]))
        if len(plain) < negatives and not model.confirms_any(pairs):
            plain.append(piece)
    examples = [(v, k, held) for k, s, held in sentences for v in _variants(s, rng, 23, plain)]
    examples += [(v, unknown, i % 3 == 2) for s in PLAIN for i, v in enumerate(_variants(s, rng, 11, []))]
    examples += [(v, unknown, i % 3 == 2) for s in OTHERS for i, v in enumerate(_variants(s, rng, 23, plain))]
    examples += [(v, unknown, i % 3 == 2) for i, v in enumerate(plain)]
    feats = [_features(*line_grams(pa.array([v]))[:2]) for v, _, _ in examples]

    def train(wanted: Callable[[bool], bool]) -> None:
        rows = [(float(k), Vectors.sparse(DIMENSIONS, f.tolist(), x.tolist())) for (f, x), (_, k, held) in zip(feats, examples) if wanted(held)]
        estimator = LogisticRegression(family="multinomial", regParam=1e-4, maxIter=ITERATIONS, standardization=False)
        trained = estimator.fit(spark.createDataFrame(rows, ["label", "features"]).coalesce(2))
        model.weights, model.bias = trained.coefficientMatrix.toArray(), trained.interceptVector.toArray()

    train(lambda held: not held)
    held = [(model.weights[:, f] @ x + model.bias, k) for (f, x), (_, k, h) in zip(feats, examples) if h]
    z, y = np.array([x for x, _ in held]), np.array([k for _, k in held])

    def loss(t: float) -> float:
        s = z / t
        s -= s.max(1, keepdims=True)
        return float(np.mean(np.log(np.exp(s).sum(1)) - s[np.arange(len(y)), y]))

    model.temperature = min(np.geomspace(0.25, 8, 61), key=loss)
    train(lambda held: True)
    return model


def hash_of(text: str) -> int:
    """A hash that does not change from one process to the next."""
    import xxhash

    return xxhash.xxh64_intdigest(text)


def scan_texts(model: Model, texts: pa.Array) -> list[tuple[int, int, list[tuple[int, int]]]]:
    """For each text: paragraphs, paragraphs with a family, and (line number from 0, family) of what was found."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    lists = pc.split_pattern(texts, "\n")
    doc_begins = np.concatenate([[0], np.cumsum(np.asarray(pc.list_value_length(lists)))]).astype(np.int64)
    words, pairs, ends = line_grams(lists.flatten())
    begins = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    if not len(words):
        return [(0, 0, []) for _ in range(len(texts))]
    filled = ends > begins
    opens = filled.copy()
    opens[1:] &= ~filled[:-1]
    starts = np.zeros(len(filled) + 1, bool)
    starts[doc_begins] = True
    opens |= filled & starts[:-1]
    paragraph = np.cumsum(opens) - 1  # of each line with words
    first = begins[opens]
    last = np.append(first[1:], len(words))
    # pairs go on over a line's end, up to the end of the paragraph
    inner = np.flatnonzero(pairs[:-1] == 0)
    inner = inner[~np.isin(inner + 1, first)]
    pairs[inner] = mix(words[inner] * U64(3) + mix(words[inner + 1]))
    lines_in = np.bincount(paragraph[filled], minlength=len(first))
    many = filled & (lines_in[np.maximum(paragraph, 0)] > 1)
    a, z = spans_of(np.concatenate([first, begins[many]]), np.concatenate([last, ends[many]]))
    out: list[tuple[set[int], list[tuple[int, int]]]] = [(set(), []) for _ in range(len(texts))]
    for word, _, family, _ in model.find(words, pairs, a, z):
        line = int(np.searchsorted(ends, word, "right"))
        doc = int(np.searchsorted(doc_begins, line, "right")) - 1
        out[doc][0].add(int(paragraph[line]))
        out[doc][1].append((line - int(doc_begins[doc]), family))
    n = np.concatenate([[0], np.cumsum(opens)])
    return [(int(n[doc_begins[d + 1]] - n[doc_begins[d]]), len(p), f) for d, (p, f) in enumerate(out)]


def find_licenses(docs: DataFrame, model: Model | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_paragraphs, n_licensed (paragraphs with a family), families (names by first line), places (line:family, comma-joined)."""
    model = model or fit(docs, doc_id, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j in passes(b.column(1)):
                got = scan_texts(model, b.column(1).slice(i, j - i))
                named = [[(line, model.families[f]) for line, f in x] for _, _, x in got]
                cols = [
                    b.column(0).slice(i, j - i), pa.array([n for n, _, _ in got], pa.int64()), pa.array([n for _, n, _ in got], pa.int64()),
                    pa.array([",".join(dict.fromkeys(f for _, f in x)) for x in named], pa.string()), pa.array([",".join(f"{line}:{f}" for line, f in x) for x in named], pa.string()),
                ]
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "n_paragraphs", "n_licensed", "families", "places"])

    return docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, "doc_id bigint, n_paragraphs bigint, n_licensed bigint, families string, places string")


def op7_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"))
