"""License scans: a trained paragraph classifier with a calibrated unknown class, confirmed against templates.

Model: multinomial logistic regression over sparse word n-grams (one to three words) for the licence families and an
unknown class, fitted by the driver on paragraphs drawn from public licence notices (TEMPLATES, perturbed) and on
unlicensed prose, including near misses such as "licensed plumber". A temperature fitted on held-out draws calibrates the
probabilities. A paragraph is reported for a family only if its calibrated probability reaches `min_probability` and
enough of the words' trigrams of the paragraph's best template, or of the paragraph itself, are shared (`min_overlap`).

Paragraphs are lines; lines of over LONG_PARAGRAPH words are taken sentence by sentence in groups of at most that many.
Every paragraph of every text is scanned; one without any n-gram that speaks for a family is unknown by the model's own
weights and needs no arithmetic.

Edge cases: null and empty texts have no paragraphs; documents without findings have no rows in `scan`, nor has an empty
table; repeated rows and ids repeat, null ids stay null; of equally probable families the first by name is taken; other
columns are ignored, whatever their names; a very long line is taken in groups of sentences, so no step holds more than
one text.
"""

from __future__ import annotations

import functools
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, slices, text_of
from .spans import sentences

LONG_PARAGRAPH = 80
#: Paragraphs drawn for the fit, a bound on the driver's work.
TRAINING_PARAGRAPHS = 4000

# Notices of public licences.
TEMPLATES = {
    "apache": [
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "mit": [
        "Released under the MIT License.",
        "This project is licensed under the MIT License.",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction.',
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.',
        "SPDX-License-Identifier: MIT",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        "Use of this source code is governed by a BSD-style license.",
        "Licensed under the BSD 3-Clause License.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>.",
        "Released under the GPL, version 2 or later.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "lgpl": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License.",
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
    ],
    "mpl": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
        "Licensed under the Mozilla Public License 2.0.",
    ],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Except where otherwise noted, content on this site is licensed under a Creative Commons Attribution-NonCommercial license.",
    ],
    "cc-by": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Content is available under CC BY-SA 4.0 unless otherwise noted.",
        "Text is available under the Creative Commons Attribution-ShareAlike License.",
    ],
    "cc0": [
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
        "This work has been dedicated to the public domain under CC0 1.0 Universal.",
        "This is free and unencumbered software released into the public domain.",
    ],
    "reserved": [
        "Copyright 2020 Example Corp. All rights reserved.",
        "All rights reserved. No part of this publication may be reproduced, distributed, or transmitted in any form or by any means without the prior written permission of the publisher.",
    ],
}
# Prose that only resembles a notice.
NEAR_MISSES = [
    "She is a licensed plumber and works under the general manager.", "The driver lost his license after version two of the test.", "The story was released under public pressure in 2019.",
    "Permission was granted by the council to build the library.", "He studied at MIT and worked on free software for years.", "The apache helicopter flew over the general public.",
    "A copy of the report can be obtained from the office.", "The work is distributed among three people without conditions.", "This program on the radio is about the law and about warranties.",
    "The common attribution of the painting to the master is wrong.", "You may use the kitchen in the morning.", "International flights are subject to the terms of the airline.", "The public domain of the king reached the sea.",
]

FAMILIES = sorted(TEMPLATES)
UNKNOWN = "unknown"
_WORDS = re.compile(r"[a-z0-9]+(?:\.[0-9]+)*")


def words_of(paragraph: str) -> list[str]:
    return _WORDS.findall(paragraph.lower())


def paragraphs(text: str) -> list[str]:
    out = []
    for line in text.split("\n"):
        if line.count(" ") < LONG_PARAGRAPH:
            out.append(line)
            continue
        group, n = [], 0
        for s in sentences(line):
            k = s.count(" ") + 1
            if group and n + k > LONG_PARAGRAPH:
                out.append("".join(group))
                group, n = [], 0
            group.append(s)
            n += k
        out.append("".join(group))
    return out


def grams(words: list[str]) -> list[str]:
    return [*words, *[f"{a} {b}" for a, b in zip(words, words[1:])], *[f"{a} {b} {c}" for a, b, c in zip(words, words[1:], words[2:])]]


def drawn(n: int, seed: int, changed: float = 0.1) -> list[tuple[str, int]]:
    """Labelled paragraphs: perturbed notices of each family and unlicensed prose (class len(FAMILIES)).

    changed: the largest share of a notice's words that are replaced.
    """
    r = random.Random(seed)
    syllables = "an the er tion ou re in ed st nd ha ti on ly wh ea de la os ci ung ver le que ment".split()
    word = lambda: "".join(r.choice(syllables) for _ in range(r.randint(1, 4)))
    common = sorted({w for ts in TEMPLATES.values() for t in ts for w in words_of(t)})
    out = []
    for i in range(n):
        if i % 2:
            k = r.randrange(len(FAMILIES))
            w = r.choice(TEMPLATES[FAMILIES[k]]).split()
            if len(w) > 6:
                for _ in range(r.randint(0, int(len(w) * changed))):
                    w[r.randrange(len(w))] = word()
            if r.random() < 0.4:
                w = ["Copyright", str(r.randint(1990, 2026)), word().capitalize(), *w]
            if r.random() < 0.3:
                w = [*w, word().capitalize(), *[word() for _ in range(r.randint(1, 12))]]
            out.append((" ".join(w), k))
        else:
            x = r.random()
            if x < 0.3:
                w = r.choice(NEAR_MISSES).split()
                w = [y for y in w if r.random() > 0.1] + [word() for _ in range(r.randint(0, 6))]
            elif x < 0.6:  # the notices' own words, out of order
                w = [r.choice(common) if r.random() < 0.5 else word() for _ in range(r.randint(3, 40))]
            else:
                w = [word() for _ in range(r.randint(1, 60))]
            out.append((" ".join(w), len(FAMILIES)))
    return out


class Classifier:
    def __init__(self, n: int = TRAINING_PARAGRAPHS, seed: int = 3, rounds: int = 150):
        # The temperature is fitted on harder draws than the weights: notices with up to half of their words replaced.
        train, held, hard = drawn(n, seed), drawn(n // 4, seed + 1), drawn(n // 4, seed + 2, 0.5)
        counts: dict[str, int] = {}
        for p, _ in train:
            for g in set(grams(words_of(p))):
                counts[g] = counts.get(g, 0) + 1
        self.vocab = {g: i for i, g in enumerate(sorted(g for g, c in counts.items() if c >= 4))}
        x, y = self._matrix(train)
        self.w = np.zeros((len(self.vocab) + 1, len(FAMILIES) + 1), np.float32)
        momentum = np.zeros_like(self.w)
        for _ in range(rounds):
            p = _softmax(x @ self.w)
            p[np.arange(len(y)), y] -= 1
            momentum = 0.9 * momentum + x.T @ p / len(y) + 1e-4 * self.w
            self.w -= 2.0 * momentum
        hx, hy = self._matrix(held)
        z = hx @ self.w
        self.accuracy = float((z.argmax(1) == hy).mean())
        hx, hy = self._matrix(hard)
        z = hx @ self.w
        loss = lambda t: -np.log(_softmax(z / t)[np.arange(len(hy)), hy] + 1e-9).mean()
        self.temperature = min((2.0 ** (k / 2) for k in range(-12, 9)), key=loss)
        lead = (self.w[:, :-1] - self.w[:, -1:]).max(axis=1)
        self.speaks = {g for g, i in self.vocab.items() if lead[i] > 0}
        self.first_words = {g.split(" ")[0] for g in self.speaks}
        self.templates = [(f, {tuple(w[i : i + 3]) for i in range(max(1, len(w) - 2))}) for f in FAMILIES for t in TEMPLATES[f] for w in [words_of(t)]]

    def _vector(self, paragraph: str) -> np.ndarray:
        ids = sorted({self.vocab[g] for g in grams(words_of(paragraph)) if g in self.vocab})
        v = np.zeros(len(self.vocab) + 1, np.float32)
        v[ids] = 1 / max(1.0, len(ids)) ** 0.5
        v[-1] = 1
        return v

    def _matrix(self, rows: list[tuple[str, int]]) -> tuple[np.ndarray, np.ndarray]:
        return np.stack([self._vector(p) for p, _ in rows]), np.array([k for _, k in rows])

    def judge(self, paragraph: str) -> tuple[str, float, float]:
        """(family or unknown, calibrated probability, overlap with the family's best template)."""
        words = words_of(paragraph)
        if self.first_words.isdisjoint(words):
            return UNKNOWN, 1.0, 0.0
        ids = sorted({self.vocab[g] for g in grams(words) if g in self.vocab})
        z = self.w[ids].sum(axis=0) / max(1.0, len(ids)) ** 0.5 + self.w[-1]
        p = _softmax(z[None] / self.temperature)[0]
        k = int(p.argmax())
        if k == len(FAMILIES):
            return UNKNOWN, float(p[k]), 0.0
        own = {tuple(words[i : i + 3]) for i in range(max(1, len(words) - 2))}
        best = max(len(own & t) / min(len(own), len(t)) for f, t in self.templates if f == FAMILIES[k])
        return FAMILIES[k], float(p[k]), best


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


@functools.lru_cache(maxsize=1)
def trained() -> Classifier:
    return Classifier()


def scan(docs: DataFrame, min_probability: float = 0.6, min_overlap: float = 0.6, id_col: str = "doc_id") -> DataFrame:
    """(id, paragraph, family, probability, overlap, text): the paragraphs confirmed as licence notices."""
    model = trained()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for i, p in enumerate(paragraphs(text)):
                    family, probability, overlap = model.judge(p)
                    if family != UNKNOWN and probability >= min_probability and overlap >= min_overlap:
                        rows.append((doc, i, family, probability, overlap, p.strip()))
            cols = list(zip(*rows, strict=True)) or [()] * 6
            kinds = (pa.int64(), pa.int32(), pa.string(), pa.float64(), pa.float64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["id", "paragraph", "family", "probability", "overlap", "text"])

    return map_arrow(docs.select(F.col(id_col).cast("long").alias("id"), text_of()), run, "id long, paragraph int, family string, probability double, overlap double, text string").withColumnRenamed("id", id_col)
