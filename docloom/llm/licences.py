"""Licence notices found by a trained paragraph classifier.

Paragraphs are the lines of a text. A logistic regression over the presence of words and word pairs tells the family of a
line's licence, or that it has none. It is trained in numpy on variants of the templates below (words left out, put in
and cut off) against lines of the corpus. A temperature fitted on variants kept apart makes its probabilities
calibrated, and the bound below which a line counts as unknown is the one that keeps corpus lines out. A
prediction counts only if the line also agrees with a template of that family.

The model knows the words and pairs of the templates. A line without any pair of a template is unknown at once; all
lines of all texts are looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import table, uniform
from docloom.llm.toxicity import present
from docloom.llm.words import Words, in_pieces, mixed

# fixed values: short notices as licence stewards recommend them, and forms in common use
TEMPLATES = {
    "AGPL": [
        "Licensed under the GNU Affero General Public License, version 3",
        "You can redistribute it and/or modify it under the terms of the GNU Affero General Public License",
        "SPDX-License-Identifier: AGPL-3.0-or-later",
    ],
    "Apache": [
        "Licensed under the Apache License, Version 2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License',
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "BSD": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file",
        "Released under the BSD 3-Clause License",
        "Licensed under the BSD License",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "CC-BY": [
        "Licensed under CC BY 4.0",
        "This work is licensed under a Creative Commons Attribution 4.0 International License",
    ],
    "CC-BY-NC": [
        "Licensed under CC BY-NC 4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    ],
    "CC-BY-SA": [
        "Licensed under CC BY-SA 4.0",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    ],
    "CC0": [
        "Released under CC0 1.0 Universal",
        "To the extent possible under law, the author has waived all copyright and related rights to this work",
        "Dedicated to the public domain under the CC0 1.0 Universal Public Domain Dedication",
    ],
    "GPL": [
        "This work is licensed under the GNU General Public License, version 3",
        "You can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
        "Released under the GNU GPL version 2 or later",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "LGPL": [
        "Licensed under the GNU Lesser General Public License, version 2.1",
        "You can redistribute it and/or modify it under the terms of the GNU Lesser General Public License",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
    ],
    "MIT": [
        "Released under the MIT License",
        "Licensed under the MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        'The software is provided "as is", without warranty of any kind, express or implied',
        "SPDX-License-Identifier: MIT",
    ],
    "MPL": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
        "Licensed under the Mozilla Public License, version 2.0",
        "SPDX-License-Identifier: MPL-2.0",
    ],
}
#: Lines with words of licences that grant none.
OTHERWISE = [
    "the driver showed a license and the license plate was noted",
    "the work of the public is under way in the general version of the plan",
    "a copy of the letter was released under pressure to the press",
    "you can use the software and modify the source of the file",
    "the free university of the creative commons met in the public domain of the city",
    "the terms of the agreement are subject to law",
]
FAMILIES = sorted(TEMPLATES)
#: Letters in lower case and digits are kept, bytes beyond ASCII too; all else parts words.
PLAIN = np.arange(256, dtype=np.uint8)
PLAIN[[i for i in range(128) if not chr(i).isalnum() and i != 10]] = 32
PLAIN[65:91] += 32


def line_features(data: np.ndarray, offsets: np.ndarray):
    """Of texts: number of the line of every word, its hash, and the hash of it and the next word of the line (0: none).

    Also where each text's lines begin in that numbering.
    """
    plain = PLAIN[data]
    words = Words(plain, offsets)
    hashes = words.hashes()
    text = np.repeat(np.arange(len(offsets) - 1), words.counts())
    newlines = np.concatenate([[0], np.cumsum(plain == 10)])
    # a text has one line more than it has newlines
    begin = newlines[offsets] + np.arange(len(offsets))
    line = newlines[words.starts] + text
    pairs = np.zeros(len(hashes), np.uint64)
    if len(hashes) > 1:
        pairs[:-1] = np.where(line[1:] == line[:-1], mixed(hashes[:-1] * np.uint64(3) + hashes[1:]), np.uint64(0))
    return line, hashes, pairs, begin


def features_of(lines: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Different words and pairs of each line."""
    raw = [x.replace("\n", " ").encode() for x in lines]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    line, hashes, pairs, _ = line_features(np.frombuffer(b"".join(raw), np.uint8), offsets)
    cut = np.searchsorted(line, np.arange(len(lines) + 1))
    return [(np.unique(hashes[a:b]), np.unique(pairs[a:b][pairs[a:b] > 0])) for a, b in zip(cut, cut[1:], strict=False)]


@dataclass(frozen=True)
class Model:
    keys: np.ndarray  # sorted hashes of words and pairs
    pairs: np.ndarray  # those of them that are pairs, sorted
    weights: np.ndarray  # a row per key, a column per family, the last one for none
    bias: np.ndarray
    temperature: float
    least: float
    templates: list  # family, its template's pairs, their weights

    def probabilities(self, line: np.ndarray, key: np.ndarray, n: int) -> np.ndarray:
        """Of ``n`` lines that have the keys at places ``key``."""
        total = np.tile(self.bias, (n, 1))
        np.add.at(total, line, self.weights[key])
        return softmax(total / self.temperature)

    def agrees(self, family: int, pairs: np.ndarray) -> bool:
        """Whether a line shares half of a template of the family, or has little else than it, by pairs that mostly no other family has.

        A pair weighs one over the square of the number of families that have it: the words that all licences share say nothing.
        """
        for f, template, weight in self.templates:
            if f != family:
                continue
            _, _, at = np.intersect1d(pairs, template, assume_unique=True, return_indices=True)
            own = (weight[at] == 1).any()
            if own and (weight[at].sum() >= 0.6 * weight.sum() or len(at) >= 3 and len(at) >= 0.8 * len(pairs)):
                return True
        return False


def weighed(known: list[tuple[int, np.ndarray]]) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """Family, pairs and their weights of each template."""
    families: dict[int, set[int]] = {}
    for f, pairs in known:
        for p in pairs.tolist():
            families.setdefault(p, set()).add(f)
    return [(f, pairs, np.array([1 / len(families[p]) ** 2 for p in pairs.tolist()])) for f, pairs in known]


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def variants(rng: np.random.Generator, corpus: list[list[str]], per_template: int) -> tuple[list[str], list[int]]:
    """Templates with words left out, cut off at the ends, and corpus words put in or around."""
    lines, families = [], []
    for f, name in enumerate(FAMILIES):
        for template in TEMPLATES[name]:
            words = template.split()
            for _ in range(per_template):
                keep = [w for w in words if rng.random() > 0.08] or words
                start = rng.integers(0, max(1, len(keep) // 5)) if len(keep) > 8 else 0
                keep = keep[start:]
                other = corpus[rng.integers(len(corpus))] if corpus else []
                if rng.random() < 0.3:
                    keep = other[: rng.integers(1, 6)] + keep
                if rng.random() < 0.3:
                    keep = keep + other[: rng.integers(1, 6)]
                lines.append(" ".join(keep))
                families.append(f)
    return lines, families


def train(corpus: list[str], seed: int = 11, per_template: int = 40, rounds: int = 300) -> Model:
    """Fit on template variants and on ``corpus`` lines as such without a licence.

    Corpus lines that agree with a template are notices themselves and aren't used.
    """
    rng = np.random.default_rng(seed)
    known = [(f, features_of([t])[0]) for f, name in enumerate(FAMILIES) for t in TEMPLATES[name]]
    pairs = np.unique(np.concatenate([p for _, (_, p) in known]))
    keys = np.unique(np.concatenate([pairs, *[w for _, (w, _) in known]]))
    templates = weighed([(f, p) for f, (_, p) in known])
    blank = Model(keys, pairs, np.zeros((len(keys), len(FAMILIES) + 1)), np.zeros(len(FAMILIES) + 1), 1.0, 0.5, templates)
    clean = [x for x, (_, p) in zip(corpus, features_of(corpus), strict=True) if not any(blank.agrees(f, p) for f in range(len(FAMILIES)))] if corpus else []
    mixed_in, family = variants(rng, [x.split() for x in clean], per_template)
    none = clean + [" ".join(rng.permutation(x.split())) for x in OTHERWISE for _ in range(per_template)] + OTHERWISE * per_template
    lines = mixed_in + none
    target = np.array(family + [len(FAMILIES)] * len(none))
    line, key = places(features_of(lines), keys)
    line, key, target, fitting, times = alike(line, key, target, rng.random(len(lines)) < 0.8)
    classes = np.eye(len(FAMILIES) + 1)[target]
    weights, bias = np.zeros_like(blank.weights), np.zeros_like(blank.bias)
    mean, square = np.zeros((len(keys) + 1, len(bias))), np.zeros((len(keys) + 1, len(bias)))
    use = fitting[line]
    for step in range(1, rounds + 1):
        total = np.tile(bias, (len(target), 1))
        np.add.at(total, line, weights[key])
        error = (softmax(total) - classes) * (fitting * times / (fitting * times).sum())[:, None]
        gradient = np.zeros_like(mean)
        np.add.at(gradient, key[use], error[line[use]])
        gradient[-1] = error.sum(0)
        gradient[:-1] += 1e-5 * weights
        mean, square = 0.9 * mean + 0.1 * gradient, 0.999 * square + 0.001 * gradient**2
        move = 0.1 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
        weights, bias = weights - move[:-1], bias - move[-1]
    total = np.tile(bias, (len(target), 1))
    np.add.at(total, line, weights[key])
    apart = ~fitting
    truth, often = target[apart], times[apart]
    loss = {t: -np.log(softmax(total[apart] / t)[np.arange(len(truth)), truth] + 1e-12) @ often for t in np.arange(0.25, 5, 0.25)}
    temperature = float(min(loss, key=loss.get))
    p = softmax(total[apart] / temperature)[:, :-1].max(1)
    without = np.repeat(p[truth == len(FAMILIES)], often[truth == len(FAMILIES)])
    least = min(0.9, max(0.5, float(np.quantile(without, 0.999)))) if len(without) else 0.5
    return Model(keys, pairs, weights, bias, temperature, least, templates)


def alike(line, key, target, fitting):
    """Lines with equal keys, family and use as one, and how often each stands."""
    cut = np.searchsorted(line, np.arange(len(target) + 1))
    number, times, first = {}, [], []
    for i, (a, b) in enumerate(zip(cut.tolist(), cut[1:].tolist(), strict=False)):
        at = number.setdefault((key[a:b].tobytes(), int(target[i]), bool(fitting[i])), len(first))
        if at == len(first):
            first.append(i)
            times.append(0)
        times[at] += 1
    keys = [key[cut[i] : cut[i + 1]] for i in first]
    rows = np.repeat(np.arange(len(first)), [len(k) for k in keys])
    return rows, np.concatenate([np.empty(0, np.int64), *keys]).astype(np.int64), target[first], fitting[first], np.array(times)


def places(features, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Line and place in ``keys`` of every feature that is a key."""
    every = [np.concatenate([w, p]) for w, p in features]
    line = np.repeat(np.arange(len(every)), [len(x) for x in every])
    return present(line, np.concatenate([np.empty(0, np.uint64), *every]), keys)


def sample_lines(docs: DataFrame, key: str, text: str, n: int, seed: int = 13) -> list[str]:
    """About ``n`` lines for training, one of each document drawn, both by hashes; at most ``n`` reach the driver."""
    total = docs.count()
    lines = F.split(F.coalesce(F.col(text), F.lit("")), "\n")
    place = F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.size(lines)).cast("int")
    drawn = docs.where(uniform(F.col(key), seed) < n / max(total, 1)).select(F.get(lines, place).alias("line"))
    return [r[0] for r in drawn.where("length(line) > 0 AND length(line) < 2000").orderBy(F.xxhash64("line"), "line").limit(n).collect()]


def scan(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: key, n_lines, notices (line from 0, family, probability), confirmed ones only.

    Null and empty texts have one empty line and no notice. Repeated rows give a row each, null keys stay null. An empty
    table gives an empty result. Other columns are ignored.
    """
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    notice = pa.struct([("line", pa.int64()), ("family", pa.string()), ("probability", pa.float64())])

    def run(batches):
        for batch in batches:
            for rows_, data, offsets in in_pieces(batch, "text"):
                line, hashes, pairs, begin = line_features(data, offsets)
                hit, _ = present(line, pairs, model.pairs)
                candidates = np.unique(hit)
                mine = np.isin(line, candidates)
                number = np.searchsorted(candidates, line[mine])
                h, p = hashes[mine], pairs[mine]
                at, place = present(np.concatenate([number, number]), np.concatenate([h, p]), model.keys)
                probability = model.probabilities(at, place, len(candidates))
                found = [[] for _ in range(rows_.num_rows)]
                cut = np.searchsorted(number, np.arange(len(candidates) + 1))
                for i in np.flatnonzero((probability[:, :-1].max(1) >= model.least) & (probability.argmax(1) < len(FAMILIES))).tolist():
                    family = int(probability[i].argmax())
                    own = np.unique(p[cut[i] : cut[i + 1]])
                    if model.agrees(family, own[own > 0]):
                        doc = int(np.searchsorted(begin, candidates[i], "right")) - 1
                        found[doc].append({"line": int(candidates[i] - begin[doc]), "family": FAMILIES[family], "probability": float(probability[i, family])})
                columns = [rows_.column("key"), pa.array(np.diff(begin)), pa.array(found, pa.list_(notice))]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "n_lines", "notices"])

    kind = dict(rows.dtypes)["key"]
    schema = f"key {kind}, n_lines bigint, notices array<struct<line: bigint, family: string, probability: double>>"
    return rows.mapInArrow(run, schema).withColumnRenamed("key", key)


def licences(docs: DataFrame, key: str = "doc_id", text: str = "text", lines: int = 20_000) -> DataFrame:
    """Train against at most ``lines`` lines of the corpus, then scan all texts."""
    return scan(docs, train(sample_lines(docs, key, text, lines)), key, text)


def query(spark, sf_dir: str) -> DataFrame:
    found = licences(table(spark, sf_dir, "documents"))
    families = F.array_sort(F.array_distinct(F.col("notices.family")))
    return found.select(
        "doc_id",
        "n_lines",
        F.size("notices").cast("bigint").alias("n_notices"),
        F.array_join(families, ",").alias("families"),
        F.coalesce(F.array_max("notices.probability"), F.lit(0.0)).alias("probability"),
    )
