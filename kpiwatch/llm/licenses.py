"""Licence scans: a trained paragraph classifier, confirmed by template comparison.

A paragraph is a line that isn't blank. Word unigrams and bigrams of the templates are the sparse
features of a softmax regression over licence families and `unknown`, trained in numpy on altered
templates and on a bounded sample of the corpus' own paragraphs as unknown. A temperature, fitted on
held-out examples, calibrates the probabilities. A family is reported where its calibrated
probability is SURE or more and a template of the family confirms it: the share of common bigrams,
of the shorter side, is CONFIRMED or more, and they are at least LEAST_COMMON. Other paragraphs are unknown.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UNKNOWN = "unknown"
SURE = 0.5
CONFIRMED = 0.6
LEAST_COMMON = 2
#: Documents whose paragraphs are taken as unknown examples, and the most paragraphs of each.
MOST_DOCUMENTS = 400
MOST_PARAGRAPHS = 20
EXAMPLES = 60
STEPS = 300

#: Customary notices of licences, by family.
TEMPLATES = {
    "apache": (
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "Licensed under the Apache License, Version 2.0.",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "cc-by": (
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
    ),
    "cc-by-nc": (
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Licensed under CC BY-NC 4.0.",
    ),
    "cc-by-sa": (
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Licensed under CC BY-SA 4.0.",
    ),
    "cc0": (
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
        "Released under CC0 1.0 Universal public domain dedication.",
    ),
    "gpl": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version.",
        "This work is licensed under the GNU General Public License, version 3.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction.",
        "Released under the MIT License.",
        "SPDX-License-Identifier: MIT",
    ),
    "mpl": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",),
    "reserved": ("Copyright. All rights reserved. No part of this work may be reproduced without permission.", "All rights reserved."),
}

_WORD = re.compile(r"[a-z0-9]+")


def words(paragraph: str) -> list[str]:
    return _WORD.findall(paragraph.lower())


def _grams(ws: list[str]) -> set:
    return {*ws, *zip(ws, ws[1:])}


def _pairs(ws: list[str]) -> set[tuple[str, str]]:
    return set(zip(ws, ws[1:]))


def paragraphs(text: str) -> list[str]:
    return [p for p in text.split("\n") if p.strip()]


@dataclass
class Classifier:
    families: list[str]  # the first is UNKNOWN
    features: dict  # gram -> column; the last column is the share of words that no template has
    weights: np.ndarray
    temperature: float
    templates: dict[str, list[set[tuple[str, str]]]]

    def vector(self, ws: list[str]) -> np.ndarray:
        x = np.zeros(len(self.features) + 2)
        for g in _grams(ws):
            if g in self.features:
                x[self.features[g]] = 1
        x[-2] = sum(w not in self.features for w in ws) / max(len(ws), 1)
        x[-1] = 1
        norm = np.linalg.norm(x[:-2])
        if norm:
            x[:-2] *= 3 / norm
        return x

    def confirmed(self, family: str, ws: list[str]) -> bool:
        own = _pairs(ws)
        return any(len(own & t) >= max(LEAST_COMMON, CONFIRMED * min(len(own), len(t))) for t in self.templates.get(family, ()))

    def predict(self, ws: list[str]) -> tuple[str, float, bool]:
        """Family, calibrated probability, confirmed."""
        z = self.vector(ws) @ self.weights / self.temperature
        p = np.exp(z - z.max())
        p /= p.sum()
        best = int(p.argmax())
        family = self.families[best]
        return family, float(p[best]), best > 0 and p[best] >= SURE and self.confirmed(family, ws)


def _altered(ws: list[str], rng: np.random.Generator, other: list[list[str]]) -> list[str]:
    """A template's words as they are found: some left out, others of the corpus around them."""
    kept = [w for w in ws if rng.random() > 0.08] or ws
    extra = other[rng.integers(len(other))][: rng.integers(0, 4)] if other else []
    return [*extra, *kept] if rng.random() < 0.5 else [*kept, *extra]


def train(unknown: list[str], templates: dict[str, tuple[str, ...]] = TEMPLATES, seed: int = 0) -> Classifier:
    """A classifier from templates and paragraphs of no licence; those that a template confirms are left out."""
    rng = np.random.default_rng(seed)
    families = [UNKNOWN, *sorted(templates)]
    made = {f: [_pairs(words(t)) for t in ts] for f, ts in templates.items()}
    grams = sorted({g for ts in templates.values() for t in ts for g in _grams(words(t))}, key=str)
    model = Classifier(families, {g: i for i, g in enumerate(grams)}, np.zeros((len(grams) + 2, len(families))), 1.0, made)
    other = [w for w in map(words, unknown) if w and not any(model.confirmed(f, w) for f in templates)]
    x, y = [], []
    for i, f in enumerate(families[1:], 1):
        for t in templates[f]:
            ws = words(t)
            for _ in range(EXAMPLES):
                x.append(model.vector(_altered(ws, rng, other)))
                y.append(i)
    common = [w for ts in templates.values() for t in ts for w in words(t)]
    for n in range(max(len(other), 20 * EXAMPLES)):
        ws = other[n % len(other)] if other else []
        # Stray licence words don't make a licence.
        stray = [common[i] for i in rng.integers(len(common), size=rng.integers(0, 4))]
        x.append(model.vector([*ws, *stray]))
        y.append(0)
    x, y = np.array(x), np.array(y)
    test = rng.random(len(y)) < 0.25
    xt, goal = x[~test], np.eye(len(families))[y[~test]]
    w = model.weights
    for _ in range(STEPS):
        z = xt @ w
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        w -= 1.0 * (xt.T @ (p - goal) / len(xt) + 1e-4 * w)

    def loss(t: float) -> float:
        z = x[test] @ w / t
        top = z.max(axis=1)
        return float((top + np.log(np.exp(z - top[:, None]).sum(axis=1)) - z[np.arange(test.sum()), y[test]]).mean())

    model.temperature = min(np.geomspace(0.2, 5, 41), key=loss)
    return model


def fitted(docs: DataFrame) -> Classifier:
    """A classifier whose unknown examples come from at most about MOST_DOCUMENTS documents, chosen by hash."""
    n = docs.count()
    share = min(1.0, MOST_DOCUMENTS / max(n, 1))
    picked = docs.filter(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) < int(share * (1 << 30)))
    lines = F.slice(F.filter(F.split(F.coalesce(F.col("text").cast("string"), F.lit("")), "\n"), lambda p: F.length(F.trim(p)) > 0), 1, MOST_PARAGRAPHS)
    # An example is a few words; a paragraph's first thousand characters are enough of one.
    rows = picked.select(F.transform(lines, lambda p: F.substring(p, 1, 1000)).alias("ps")).limit(4 * MOST_DOCUMENTS).collect()
    return train(sorted(p for r in rows for p in r.ps))


_FOUND = "doc_id long, n_paragraphs long, n_license long, n_unconfirmed long, families string, paragraphs string, score double"


def scan(docs: DataFrame, model: Classifier | None = None) -> DataFrame:
    """doc_id, n_paragraphs, n_license, n_unconfirmed, families, paragraphs, score: one row per row of `docs`.

    families: those found, sorted, comma-joined; paragraphs: number:family of each, in order; score:
    the highest probability of a confirmed one, else 0; n_unconfirmed: paragraphs the classifier takes
    for a licence that no template confirms. Null texts have no paragraphs. A paragraph that shares no
    bigram with any template can't be confirmed and is unknown. No documents: no rows.
    """
    model = model or fitted(docs)
    telling = {p for ts in model.templates.values() for t in ts for p in t}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column("doc_id"), batch.column("text")):
                ps = paragraphs(text.as_py() or "")
                found, loose, best = [], 0, 0.0
                for i, p in enumerate(ps):
                    ws = words(p)
                    if telling.isdisjoint(zip(ws, ws[1:])):
                        continue
                    family, prob, sure = model.predict(ws)
                    if sure:
                        found.append((i, family))
                        best = max(best, prob)
                    elif family != UNKNOWN:
                        loose += 1
                rows.append((doc.as_py(), len(ps), len(found), loose, ",".join(sorted({f for _, f in found})), ",".join(f"{i}:{f}" for i, f in found), best))
            types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
            names = ["doc_id", "n_paragraphs", "n_license", "n_unconfirmed", "families", "paragraphs", "score"]
            columns = list(zip(*rows)) if rows else [()] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, _FOUND)
