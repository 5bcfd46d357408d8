"""Licence scans: a sparse word n-gram logistic regression over paragraphs, with a calibrated unknown class and template comparison.

The model is fitted on the driver from the templates below and a bounded sample
of the corpus; every paragraph of every document is then scored by built-in
functions inside one scan, without a shuffle.
"""

from __future__ import annotations

import json
import random
import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.shared import documents, least_hashes

UNKNOWN = "unknown"

# Wordings of public licence notices, by family.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "mit": (
        "Released under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "The software is provided as is, without warranty of any kind, express or implied, including but not limited to the warranties of merchantability, fitness for a particular purpose and noninfringement.",
    ),
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an as is basis, without warranties or conditions of any kind, either express or implied.",
        "See the Apache License 2.0 for the specific language governing permissions and limitations under the License.",
    ),
    "gpl-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version.",
        "Licensed under the GPLv3. See the GNU General Public License v3.0 or later.",
    ),
    "gpl-2.0": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or any later version.",
        "This work is licensed under the GNU General Public License, version 2.",
        "Licensed under the GPLv2.",
    ),
    "lgpl": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License.",
        "Licensed under the GNU Lesser General Public License, version 3. LGPL.",
    ),
    "agpl": (
        "Licensed under the GNU Affero General Public License, version 3. AGPL.",
        "You can redistribute it and/or modify it under the terms of the GNU Affero General Public License.",
    ),
    "bsd": (
        "Released under the BSD 3-Clause License.",
        "Use of this source code is governed by a BSD-style license.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    ),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0. MPL.",
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "Released under the ISC License.",
    ),
    "public-domain": (
        "This is free and unencumbered software released into the public domain.",
        "This work is dedicated to the public domain under CC0 1.0 Universal.",
        "To the extent possible under law, the author has waived all copyright and related rights to this work.",
    ),
    "cc-by": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "cc-by-sa": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "cc-by-nc": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "cc-by-nd": (
        "Licensed under CC BY-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    ),
    "all-rights-reserved": (
        "All rights reserved.",
        "Copyright 2020 The Authors. All rights reserved.",
        "No part of this publication may be reproduced, distributed, or transmitted in any form without the prior written permission of the publisher.",
    ),
}

#: Sentences that share words with licences and are none.
OTHERS = (
    "You need a driving licence to rent a car in this country.", "The version 3 of the program was released last week.", "All rights and duties of the tenants are listed below.",
    "The public was invited to the general meeting of the foundation.", "Permission to enter the building was granted to any person with a badge.", "The software is free for students and can be copied to any computer.",
    "She reserved a table for four under her name.", "He works under the terms of a contract, version two.", "The license plate of the car was red.", "Apache helicopters flew over the city.",
    "The common people created works of art.", "The author has published four works in the public library.", "Their license was revoked by the general council.", "This work is hard and the terms are short.",
    "A copy of the notice was included in the letter.", "Conditions of use of the library are posted at the door.",
)


def words_of(text: str) -> list[str]:
    return [w for w in re.split("[^a-z0-9]+", text.lower()) if w]


def grams_of(words: list[str]) -> list[str]:
    """Distinct word 1-, 2- and 3-grams."""
    return list(dict.fromkeys(" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)))


def shingles_of(words: list[str]) -> list[str]:
    """Distinct word 3-grams; of fewer words the whole."""
    return list(dict.fromkeys(" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2)))) if words else []


@dataclass
class Model:
    classes: list[str]
    features: dict[str, list[float]]
    bias: list[float]
    temperature: float
    threshold: float
    anchors: list[str]

    def scores(self, words: list[str]) -> np.ndarray:
        """Calibrated class probabilities; for tests."""
        logits = np.array(self.bias)
        for g in grams_of(words):
            if g in self.features:
                logits = logits + self.features[g]
        x = np.exp((logits - logits.max()) / self.temperature)
        return x / x.sum()


def _fit(x: np.ndarray, y: np.ndarray, classes: int, rounds: int = 300, rate: float = 2.0, l1: float = 1e-4) -> tuple[np.ndarray, np.ndarray]:
    """Softmax regression by proximal gradient steps: L1 sets most weights to 0."""
    w, b, target = np.zeros((x.shape[1], classes)), np.zeros(classes), np.eye(classes)[y]
    for _ in range(rounds):
        z = x @ w + b
        p = np.exp(z - z.max(axis=1, keepdims=True))
        g = (p / p.sum(axis=1, keepdims=True) - target) / len(x)
        w -= rate * (x.T @ g)
        b -= rate * g.sum(axis=0)
        w = np.sign(w) * np.maximum(np.abs(w) - rate * l1, 0)
    return w, b


def train(negatives: list[str], features: int = 600, copies: int = 12, seed: int = 1, false_share: float = 0.01) -> Model:
    """Fit on noisy copies of the templates against ``negatives`` and OTHERS; a fifth, held out, sets temperature and threshold.

    A feature holds a word that is rare among the negatives (an anchor), so a
    paragraph without anchors has no feature and is unknown. Bounds of the fit
    alone: ``features`` features, ``copies`` noisy copies a template, 1500
    negative paragraphs, and 4000 words of theirs as surroundings of the copies.
    """
    rng = random.Random(seed)
    classes = [*TEMPLATES, UNKNOWN]
    known = {s for ts in TEMPLATES.values() for t in ts for s in shingles_of(words_of(t))}
    clean = [w for w in map(words_of, negatives) if w and not known & set(shingles_of(w))]
    common: dict[str, int] = {}
    for w in clean:
        for x in set(w):
            common[x] = common.get(x, 0) + 1
    often = {x for x, n in common.items() if n > max(3, len(clean) // 200)} | {"the", "of", "and", "to", "a", "in", "is", "this", "for", "that", "with", "any", "or", "as", "by", "on", "be", "it", "no", "you", "can", "all", "may"}
    filler = [x for w in clean for x in w[:20]][:4000] or ["some", "words"]
    rows: list[tuple[list[str], int]] = []
    for at, family in enumerate(TEMPLATES):
        for template in TEMPLATES[family]:
            own = words_of(template)
            for copy in range(copies):
                w = list(own)
                if copy and len(w) > 5:
                    for _ in range(rng.randint(0, max(1, len(w) // 10))):
                        w.pop(rng.randrange(len(w)))
                if copy > 1 and len(w) > 14:
                    cut = rng.randint(0, len(w) // 2)
                    w = w[cut : cut + rng.randint(10, len(w))]
                around = [rng.choice(filler) for _ in range(rng.choice((0, 0, 3, 8)))]
                rows.append((around + w if copy % 2 else w + around, at))
    rows += [(w, len(TEMPLATES)) for w in clean[:1500]] + [(words_of(t), len(TEMPLATES)) for t in OTHERS for _ in range(copies // 2)]
    rng.shuffle(rows)
    anchored = lambda g: any(x not in often for x in g.split())
    counts: dict[str, int] = {}
    for w, label in rows:
        if label < len(TEMPLATES):
            for g in grams_of(w):
                counts[g] = counts.get(g, 0) + 1
    vocabulary = [g for g, n in sorted(counts.items(), key=lambda x: (-x[1], x[0])) if n >= 3 and anchored(g)][: 4 * features]
    place = {g: i for i, g in enumerate(vocabulary)}
    x, y = np.zeros((len(rows), len(vocabulary)), dtype=np.float32), np.array([label for _, label in rows])
    for i, (w, _) in enumerate(rows):
        x[i, [place[g] for g in grams_of(w) if g in place]] = 1
    held = np.arange(len(rows)) % 5 == 0
    w, b = _fit(x[~held], y[~held], len(classes))
    kept = np.argsort(-np.abs(w).max(axis=1), kind="stable")[:features]
    kept = kept[np.abs(w[kept]).max(axis=1) > 1e-6]
    z = x[held][:, kept] @ w[kept] + b
    best, temperature = np.inf, 1.0
    for t in np.geomspace(0.1, 4, 40):
        s = z / t
        loss = float((np.log(np.exp(s - s.max(axis=1, keepdims=True)).sum(axis=1)) + s.max(axis=1) - s[np.arange(len(s)), y[held]]).mean())
        if loss < best:
            best, temperature = loss, float(t)
    p = np.exp(z / temperature - (z / temperature).max(axis=1, keepdims=True))
    p /= p.sum(axis=1, keepdims=True)
    wrong = np.sort(p[y[held] == len(TEMPLATES)][:, :-1].max(axis=1)) if (y[held] == len(TEMPLATES)).any() else np.array([0.0])
    threshold = float(min(0.9, max(0.5, wrong[min(len(wrong) - 1, int((1 - false_share) * len(wrong)))])))
    table = {vocabulary[i]: [round(float(v), 5) for v in w[i]] for i in kept}
    anchors = sorted({x for g in table for x in g.split() if x not in often})
    return Model(classes, table, [round(float(v), 5) for v in b], temperature, threshold, anchors)


def sample_paragraphs(docs: DataFrame, rows: int = 400, lines: int = 20, chars: int = 2000) -> list[str]:
    """Paragraphs of ``rows`` documents, the bounded sample that stands for the unknown class.

    The documents of the least hashes of (doc_id, text), so the sample depends
    on the table's rows alone, not on their layout. Of each the first ``lines``
    lines, of each line ``chars`` characters, within the first lines * chars
    characters, cut before they leave their task: what reaches the driver is
    rows * lines * chars characters at most (16 MB).
    """
    near = least_hashes(docs.select("doc_id", F.col("text").cast("string").alias("text")), rows)
    found = near.select("_mr_order", F.left("text", F.lit(lines * chars)).alias("_mr_text")).orderBy("_mr_order", "_mr_text").limit(rows)
    return [p[:chars] for r in found.collect() for p in (r["_mr_text"] or "").split("\n")[:lines] if p.strip()]


def scan(docs: DataFrame, model: Model | None = None, confirm: float = 0.6) -> DataFrame:
    """Add n_paragraphs, n_suspect and licences to ``docs``; own columns of these names are replaced.

    Paragraphs are the non-blank lines. licences: per confirmed paragraph its
    index, family, probability and similarity. A prediction is confirmed if the
    probability reaches the calibrated threshold and one of the family's
    templates shares ``confirm`` of the smaller side's word 3-grams; paragraphs
    predicted but not confirmed count in n_suspect. Of families of equal
    probability the first in the order of TEMPLATES is predicted. Null texts
    have none; rows stay as they are, repeated ones too; an empty table gives an
    empty result.
    """
    model = model or train(sample_paragraphs(docs))
    anchors, names = (F.from_json(F.lit(json.dumps(x)), "array<string>") for x in (model.anchors or ["-"], list(model.features)))
    weights = F.from_json(F.lit(json.dumps(model.features)), "map<string,array<double>>")
    bias = F.from_json(F.lit(json.dumps(model.bias)), "array<double>")
    classes = F.from_json(F.lit(json.dumps(model.classes)), "array<string>")
    templates = F.from_json(F.lit(json.dumps({f: [shingles_of(words_of(t)) for t in ts] for f, ts in TEMPLATES.items()})), "map<string,array<array<string>>>")
    split = lambda x: F.filter(F.split(F.lower(x), "[^a-z0-9]+"), lambda w: w != "")

    def joined(w, n):
        return F.when(F.size(w) >= n, F.transform(F.sequence(F.lit(0), F.size(w) - n), lambda i: F.concat_ws(" ", *(w[i + k] for k in range(n))))).otherwise(F.array().cast("array<string>"))

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda p: p.rlike(r"\S"))
    docs = docs.drop("n_paragraphs", "n_suspect", "licences").withColumn("n_paragraphs", F.size(lines).cast("long"))
    docs = docs.withColumn("_mr_seen", F.arrays_overlap(F.split(F.lower(text), "[^a-z0-9]+"), anchors))
    numbered = F.transform(lines, lambda p, i: F.struct(i.cast("long").alias("i"), split(p).alias("w")))
    docs = docs.withColumn("_mr_p", F.when(F.col("_mr_seen"), F.filter(numbered, lambda p: F.arrays_overlap(p.w, anchors))).otherwise(F.array().cast("array<struct<i:bigint,w:array<string>>>")))
    docs = docs.withColumn("_mr_z", F.transform("_mr_p", lambda p: F.aggregate(F.array_intersect(F.concat(p.w, joined(p.w, 2), joined(p.w, 3)), names), bias, lambda acc, g: F.zip_with(acc, F.element_at(weights, g), lambda a, b: a + b))))
    best = lambda z: F.element_at(classes, F.array_position(z, F.array_max(z)).cast("int"))
    share = lambda z: 1 / F.aggregate(z, F.lit(0.0), lambda acc, v: acc + F.exp((v - F.array_max(z)) / model.temperature))
    docs = docs.withColumn("_mr_c", F.filter(F.transform("_mr_z", lambda z, k: F.struct(F.element_at("_mr_p", k + 1).alias("p"), best(z).alias("family"), share(z).alias("probability"))), lambda c: (c.family != UNKNOWN) & (c.probability >= model.threshold)))
    own = lambda w: F.when(F.size(w) < 3, F.array(F.concat_ws(" ", w))).otherwise(F.array_distinct(joined(w, 3)))
    likeness = lambda c: F.array_max(F.transform(F.element_at(templates, c.family), lambda t: F.size(F.array_intersect(own(c.p.w), t)) / F.least(F.size(own(c.p.w)), F.size(t))))
    docs = docs.withColumn("_mr_c", F.transform("_mr_c", lambda c: F.struct(c.p.i.alias("paragraph"), c.family.alias("family"), F.round(c.probability, 6).alias("probability"), F.round(likeness(c), 6).alias("similarity"))))
    return (
        docs.withColumn("licences", F.filter("_mr_c", lambda c: c.similarity >= confirm))
        .withColumn("n_suspect", (F.size("_mr_c") - F.size("licences")).cast("long"))
        .drop("_mr_seen", "_mr_p", "_mr_z", "_mr_c")
    )


def op1_licences(spark, sf_dir: str) -> DataFrame:
    """Every document with the families its paragraphs name (sorted, joined by a comma; null: none)."""
    found = scan(documents(spark, sf_dir).select("doc_id", "text"))
    names = F.array_sort(F.array_distinct(F.transform("licences", lambda x: x.family)))
    return found.select("doc_id", "n_paragraphs", F.size("licences").cast("long").alias("n_licences"), "n_suspect", F.when(F.size(names) > 0, F.array_join(names, ",")).alias("families"), F.col("licences"))
