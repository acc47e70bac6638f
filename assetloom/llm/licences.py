"""Licence scans with a trained paragraph classifier (operator 7).

Texts are cut into paragraphs (lines and sentences; long ones into overlapping windows). A multinomial
logistic regression over hashed word uni- and bigrams names a licence family, none, or, when no family is
sure enough, unknown. It is trained on variants of notice templates against paragraphs sampled from the
corpus; its temperature and the bound of unknown come from rows left out of the fit. A prediction counts
once the paragraph also resembles a template of that family.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import output_names, text_blocks, words

# Notices and paragraphs of the texts of licence families.
TEMPLATES = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "MIT": (
        "Released under the MIT License.",
        "This project is licensed under the MIT License, see the LICENSE file for details.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
        "SPDX-License-Identifier: MIT",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "GPL-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        "it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or any later version.",
        "SPDX-License-Identifier: GPL-2.0-only",
    ),
    "LGPL": (
        "This library is licensed under the GNU Lesser General Public License, version 2.1 or later.",
        "it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or any later version.",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
    ),
    "BSD": (
        "Released under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "CC-BY": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-SA": ("Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "CC-BY-NC": ("Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "CC0": ("Released into the public domain under CC0 1.0 Universal.", "To the extent possible under law, the author has waived all copyright and related rights to this work under CC0."),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.",
        "SPDX-License-Identifier: ISC",
    ),
    "AGPL-3.0": (
        "This program is licensed under the GNU Affero General Public License, version 3.",
        "it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version.",
        "SPDX-License-Identifier: AGPL-3.0-or-later",
    ),
    "EPL-2.0": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
        "Licensed under the Eclipse Public License, version 2.0.",
        "SPDX-License-Identifier: EPL-2.0",
    ),
    "BSL-1.0": (
        "Distributed under the Boost Software License, Version 1.0.",
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software",
        "SPDX-License-Identifier: BSL-1.0",
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
        "SPDX-License-Identifier: Unlicense",
    ),
    "Zlib": (
        "This software is provided 'as-is', without any express or implied warranty.",
        "In no event will the authors be held liable for any damages arising from the use of this software.",
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:",
        "SPDX-License-Identifier: Zlib",
    ),
}
#: Sentences that speak of licences and rights without granting any.
OTHER = (
    "He lost his driving license on the way to the office.", "The restaurant was granted a license to sell wine.", "A license plate was found near the road.",
    "All rights reserved.", "The software was released in version 3 last week.", "The general public was not admitted.", "This work is a version of an older book.",
    "Permission to enter was granted by the guard.", "The foundation published a free report.", "The Apache helicopter landed at noon.", "Students at MIT built a robot.",
    "The creative community shared its work without charge.", "Copies of the notice were sent to any person who asked.", "The common law was applied.", "She works under the public works office.",
)
NONE, UNKNOWN = "none", "unknown"


@dataclass(frozen=True)
class Settings:
    max_negatives: int = 4000  #: paragraphs sampled from the corpus, at most
    variants: int = 60  #: of each template
    buckets: int = 1 << 14
    window: int = 24
    steps: int = 100
    rate: float = 20.0
    momentum: float = 0.9
    decay: float = 1e-5
    likeness: float = 0.6  #: to a template, for a family to be confirmed
    trace: float = 0.3  #: to any template, for an unknown notice
    seed: int = 5


@dataclass
class Model:
    families: list[str]  #: the last is none
    weights: np.ndarray  #: (buckets + 1, families); the last row is the bias
    temperature: float
    bound: float


_EDGE = re.compile(r"^[^0-9a-z]+|[^0-9a-z]+$")


def _plain(word: str) -> str:
    return _EDGE.sub("", word.lower()) or "."


def _hashes(distinct: list[str]) -> np.ndarray:
    import xxhash

    return np.array([xxhash.xxh3_64_intdigest(_plain(w).encode()) for w in distinct], np.uint64)


def _positions(h: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each word, and of each word with its predecessor (the first has none)."""
    pair = np.zeros(len(h), np.uint64)
    pair[1:] = (h[:-1] * np.uint64(0x9E3779B97F4A7C15)) ^ (h[1:] + np.uint64(0x632BE59BD9B4E019))
    return (h % np.uint64(buckets)).astype(np.int64), ((pair >> np.uint64(17)) % np.uint64(buckets)).astype(np.int64)


def _spread(starts: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word ranges of all paragraphs, long ones in windows that overlap by half, and each range's paragraph."""
    n = np.diff(starts)
    step = window // 2
    k = np.where(n <= window, np.minimum(n, 1), -(-(n - step) // step))
    owner = np.repeat(np.arange(len(n)), k)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(k) - k, k)
    a = starts[owner] + nth * step
    return a, np.minimum(a + window, starts[owner + 1]), owner


def logits(h: np.ndarray, a: np.ndarray, b: np.ndarray, model_weights: np.ndarray) -> np.ndarray:
    """Scores of each family for each word range."""
    buckets = len(model_weights) - 1
    one, two = _positions(h, buckets)
    sums = np.zeros((2, len(h) + 1, model_weights.shape[1]))
    np.cumsum(model_weights[one], axis=0, out=sums[0, 1:])
    np.cumsum(model_weights[two], axis=0, out=sums[1, 1:])
    n = np.maximum(1, 2 * (b - a) - 1)[:, None]
    return (sums[0, b] - sums[0, a] + sums[1, b] - sums[1, np.minimum(a + 1, b)]) / np.sqrt(n) + model_weights[-1]


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(1, keepdims=True))
    return x / x.sum(1, keepdims=True)


def variants(settings: Settings) -> list[tuple[str, str]]:
    """(paragraph, family) of changed templates, and of the other sentences."""
    rng = random.Random(settings.seed)
    filler = "the a of in project file note see please our code text data author 2020 2024 copyright team page".split()

    def noise() -> list[str]:
        return [w if rng.random() < 0.5 else f"{w}{rng.randrange(10**6)}" for w in rng.choices(filler, k=rng.randrange(1, 9))]

    out = []
    for family, texts in [*TEMPLATES.items(), (NONE, OTHER)]:
        for text in texts:
            out.append((text, family))
            for _ in range(settings.variants if family != NONE else 8):
                own = text.split()
                if len(own) > 6:
                    own = [w for w in own if rng.random() > 0.08]
                if len(own) > 12 and rng.random() < 0.3:
                    cut = rng.randrange(len(own) // 2)
                    own = own[cut : cut + max(8, len(own) // 2)]
                if rng.random() < 0.5:
                    own = noise() + own
                if rng.random() < 0.5:
                    own = own + noise()
                if rng.random() < 0.2:
                    own = [w.upper() for w in own]
                out.append((" ".join(own), family))
    return out


def fit(paragraphs: list[tuple[str, str]], settings: Settings) -> Model:
    families = [*TEMPLATES, NONE]
    rng = np.random.default_rng(settings.seed)
    order = rng.permutation(len(paragraphs))
    numbers, starts, distinct = words(pa.array([paragraphs[i][0] for i in order]))
    h = _hashes(distinct)[numbers]
    y = np.array([families.index(paragraphs[i][1]) for i in order])
    one, two = _positions(h, settings.buckets)
    n = np.diff(starts)
    row = np.repeat(np.arange(len(n)), n)
    inner = np.arange(len(h)) > starts[:-1][row]
    column = np.concatenate([one, two[inner]])
    row = np.concatenate([row, row[inner]])
    value = 1 / np.sqrt(np.maximum(1, 2 * n - 1))[row]
    held = np.arange(len(n)) % 5 == 0
    weight = np.where(held, 0.0, 1.0 / np.bincount(y, minlength=len(families))[y])
    weight[y == len(families) - 1] *= 2
    weight /= weight.sum()
    used, inverse = np.unique(column, return_inverse=True)
    x, bias = np.zeros((len(used), len(families)), np.float32), np.zeros(len(families), np.float32)
    pace, bias_pace = np.zeros_like(x), np.zeros_like(bias)
    value, weight, target = value.astype(np.float32)[:, None], weight.astype(np.float32)[:, None], np.eye(len(families), dtype=np.float32)[y]
    by_row, by_column = np.argsort(row, kind="stable"), np.argsort(inverse, kind="stable")
    filled, row_cuts = np.unique(row[by_row], return_index=True)
    _, column_cuts = np.unique(inverse[by_column], return_index=True)
    row_columns, row_values, column_rows, column_values = inverse[by_row], value[by_row], row[by_column], value[by_column]
    for _ in range(settings.steps):
        ahead, bias_ahead = x + settings.momentum * pace, bias + settings.momentum * bias_pace
        z = np.tile(bias_ahead, (len(n), 1))
        z[filled] += np.add.reduceat(ahead[row_columns] * row_values, row_cuts)
        off = (target - _softmax(z)) * weight
        pace = settings.momentum * pace + settings.rate * (np.add.reduceat(off[column_rows] * column_values, column_cuts) - settings.decay * ahead)
        bias_pace = settings.momentum * bias_pace + 0.1 * settings.rate * off.sum(0)
        x, bias = x + pace, bias + bias_pace
    weights = np.zeros((settings.buckets + 1, len(families)), np.float32)
    weights[used], weights[-1] = x, bias
    z = logits(h, starts[:-1], starts[1:], weights.astype(np.float64))[held]
    temperature = min(np.geomspace(0.1, 10, 41), key=lambda t: -np.log(np.maximum(1e-12, _softmax(z / t)[np.arange(held.sum()), y[held]])).mean())
    sure = _softmax(z / temperature)[:, :-1].max(1)
    right = y[held] < len(families) - 1
    # what the least sure hundredth of the left-out notices reaches, but above almost all other paragraphs
    bound = max(np.quantile(sure[right], 0.01), np.quantile(sure[~right], 0.999) if (~right).any() else 0.0)
    return Model(families, weights, float(temperature), float(min(bound, 0.9)))


def _range_hashes(h: np.ndarray, a: np.ndarray, b: np.ndarray, seed: int) -> np.ndarray:
    """A hash of the words of each range, in their order, as signed numbers."""
    base = 0x9E3779B97F4A7C15
    powers, inverse = np.full((2, len(h) + 1), 1, np.uint64)
    powers[1:], inverse[1:] = base, pow(base, -1, 2**64)
    powers, inverse = np.cumprod(powers), np.cumprod(inverse)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * powers[:-1], dtype=np.uint64)])
    out = (sums[b] - sums[a]) * inverse[a] + np.uint64(seed)
    for _ in range(2):
        out = (out ^ (out >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (out ^ (out >> np.uint64(32))).view(np.int64)


def _lines(texts: pa.Array) -> pa.Array:
    """Lists of the lines and sentences of texts."""
    return pc.split_pattern(pc.replace_substring(texts, ". ", ".\n"), "\n")


def paragraphs(docs: DataFrame, settings: Settings = Settings(), text_col: str = "text", below: int = 2**63 - 1) -> DataFrame:
    """(h, p): paragraphs of at most 2,000 characters, long ones in the windows that scan cuts, whose hash is not above a bound.

    Paragraphs of the same normalised words have the same hash; a task names it once a block.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in text_blocks(batches, max_bytes=4_000_000):
            lines = _lines(block.column("text")).flatten()
            numbers, starts, distinct = words(lines)
            a, b, owner = _spread(starts, settings.window)
            if not len(a):
                continue
            h = _range_hashes(_hashes(distinct)[numbers], a, b, settings.seed)
            low = np.flatnonzero(h <= below)
            chosen = np.sort(low[np.unique(h[low], return_index=True)[1]])
            out, line, own = [], -1, []
            for r in chosen.tolist():
                if owner[r] != line:
                    line = int(owner[r])
                    own = _WORD.findall(lines[line].as_py())
                out.append(" ".join(own[a[r] - starts[line] : b[r] - starts[line]]))
            short = [len(p) <= 2000 for p in out]
            yield pa.RecordBatch.from_arrays([pa.array(h[chosen]), pa.array(out, pa.string())], ["h", "p"]).filter(pa.array(short, pa.bool_()))

    return docs.select(F.col(text_col).alias("text")).mapInArrow(run, "h bigint, p string")


def sample(docs: DataFrame, settings: Settings = Settings(), text_col: str = "text") -> list[str]:
    """The max_negatives distinct paragraphs of the smallest hashes; all, if there are fewer.

    A first bound on hashes follows the corpus' characters, so that few rows leave the tasks; if it leaves too few,
    it is widened until it doesn't or all rows are below it. So the bound never changes the result.
    """
    chars = docs.agg(F.sum(F.length(text_col))).first()[0] or 0
    share = 400 * settings.max_negatives / max(1, chars)
    while True:
        rows = paragraphs(docs, settings, text_col, int(share * 2**64) - 2**63 if share < 1 else 2**63 - 1)
        found = rows.groupBy("h").agg(F.min("p").alias("p")).orderBy("h").limit(settings.max_negatives).collect()
        if len(found) == settings.max_negatives or share >= 1:
            return [r.p for r in found]
        share *= 16


def train(docs: DataFrame, settings: Settings = Settings(), text_col: str = "text") -> Model:
    """Fit on template variants and on a sample of corpus paragraphs, at most max_negatives of them.

    Those that resemble a template are left out. Null and empty texts have no paragraph, repeated ones count once;
    without any, the other sentences alone stand for none.
    """
    negatives = [p for p in sample(docs, settings, text_col) if max(likenesses(p).values()) < 0.4]
    return fit(variants(settings) + [(p, NONE) for p in negatives], settings)


def _grams(text: str) -> set[tuple[str, str]]:
    own = [_plain(w) for w in text.split()]
    return set(zip(own, own[1:], strict=False)) or {(w, "") for w in own}


_TEMPLATE_GRAMS = {f: [_grams(t) for t in texts] for f, texts in TEMPLATES.items()}


def likenesses(paragraph: str) -> dict[str, float]:
    """By family, the largest share of a template's word pairs that the paragraph holds, or of its own if they are fewer."""
    own = _grams(paragraph)
    size = max(len(own), 4)
    return {f: max(len(own & t) / min(len(t), size) for t in grams) for f, grams in _TEMPLATE_GRAMS.items()}


def scan(docs: DataFrame, model: Model, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """id, n_paragraphs, n_licences, n_unknown, families (sorted, comma-joined), spans (family:start:end in code points) and the columns of keep.

    Unknown spans are paragraphs that the model takes for a notice and that share some wording with a template,
    but of no family surely.
    Null and empty texts have no paragraph. Rows are treated one by one: repeated rows and ids get equal results,
    long texts are read whole, an empty table gives an empty result. Of families that tie the first in
    alphabetical order of the templates counts. A column of keep may not have the name of another result (ValueError).
    """
    keep = list(keep or [])
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a fixed number of buckets

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for block in text_blocks(batches, max_bytes=4_000_000):
            texts = block.column("text")
            cut = _lines(texts)
            edges = cut.offsets.to_numpy().astype(np.int64)
            edges -= edges[0]
            numbers, starts, distinct = words(cut.flatten())
            a, b, owner = _spread(starts, settings.window)
            z = logits(_hashes(distinct)[numbers] if len(numbers) else np.zeros(0, np.uint64), a, b, own.weights) if len(a) else np.zeros((0, len(own.families)))
            p = _softmax(z / own.temperature) if len(z) else z
            maybe = np.flatnonzero(p[:, -1] < 0.5)
            spans: list[list[tuple[int, int, str]]] = [[] for _ in range(len(block))]
            doc_of = np.searchsorted(edges, owner[maybe], side="right") - 1
            for r, doc in zip(maybe.tolist(), doc_of.tolist(), strict=True):
                line = int(owner[r])
                at, text = _place(texts[doc].as_py(), line - int(edges[doc]), int(a[r] - starts[line]), int(b[r] - starts[line]))
                k = int(np.argmax(p[r, :-1]))
                like = likenesses(text)
                sure = p[r, k] >= own.bound and like[own.families[k]] >= settings.likeness
                if sure or max(like.values()) >= settings.trace:
                    spans[doc].append((at, at + len(text), own.families[k] if sure else UNKNOWN))
            found = [_joined(s) for s in spans]
            n_paragraphs = np.add.reduceat(np.append(np.diff(starts) > 0, False).astype(np.int64), edges[:-1]) if len(block) else np.zeros(0, np.int64)
            families = [sorted({f for *_, f in s} - {UNKNOWN}) for s in found]
            out = [n_paragraphs, [sum(f != UNKNOWN for *_, f in s) for s in found], [sum(f == UNKNOWN for *_, f in s) for s in found]]
            yield pa.RecordBatch.from_arrays(
                [block.column(0), *[pa.array(c, pa.int64()) for c in out], pa.array([",".join(f) for f in families], pa.string()), pa.array([",".join(f"{f}:{x}:{y}" for x, y, f in s) for s in found], pa.string()), *block.columns[2:]], names
            )

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), *[F.col(c).alias(f"keep_{i}") for i, c in enumerate(keep)])
    kinds = [t for _, t in rows.dtypes]
    names = output_names([id_col, "n_paragraphs", "n_licences", "n_unknown", "families", "spans"], keep)
    types = [kinds[0], "bigint", "bigint", "bigint", "string", "string", *kinds[2:]]
    return rows.mapInArrow(run, ", ".join(f"`{a}` {b}" for a, b in zip(names, types, strict=True)))


_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _place(text: str, line: int, first: int, end: int) -> tuple[int, str]:
    """Where words first to end of a paragraph of a text begin, and their text."""
    lines = text.replace(". ", ".\n").split("\n")
    at = sum(map(len, lines[:line])) + line
    found = [m.span() for m in _WORD.finditer(lines[line])][first:end]
    return at + found[0][0], lines[line][found[0][0] : found[-1][1]]


def _joined(spans: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Overlapping windows of one family as one span; unknown gives way to a family."""
    out: list[tuple[int, int, str]] = []
    for a, b, f in sorted(spans):
        if out and a < out[-1][1] and (f == out[-1][2] or UNKNOWN in (f, out[-1][2])):
            out[-1] = (out[-1][0], max(b, out[-1][1]), f if out[-1][2] == UNKNOWN else out[-1][2])
        else:
            out.append((a, b, f))
    return out
