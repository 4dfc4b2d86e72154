"""License scan by a trained paragraph classifier.

Paragraphs are bags of hashed word 1-grams and 2-grams. A multinomial logistic regression tells license families and a
class of everything else apart; it learns from the notices below, thinned and padded at random, and from a bounded
sample of the corpus' own paragraphs. Its probabilities are calibrated on paragraphs held back: a temperature is chosen by their
likelihood, and the least probability for a family so that hardly any other paragraph reaches it. A predicted
family is confirmed if the paragraph has most words of one of the family's notices.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .byte_hashes import Rolling, mixed, text_bytes, word_hashes
from .common import in_batches, unused, worker_cached

#: Common wordings of license notices by family (fixed values).
NOTICES = {
    "apache": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "SPDX-License-Identifier: Apache-2.0"],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Released under the BSD 3-Clause License.", "SPDX-License-Identifier: BSD-3-Clause"],
    "cc": [
        "Licensed under CC BY 4.0.", "Licensed under CC BY-NC 4.0.", "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "To view a copy of this license, visit http://creativecommons.org/licenses/by/4.0/"],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation.",
        "Released under the GNU Lesser General Public License, version 2.1.",
        "SPDX-License-Identifier: GPL-3.0-or-later"],
    "mit": [
        "Released under the MIT License.", "Licensed under the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction.",
        "SPDX-License-Identifier: MIT"],
    "mpl": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
        "SPDX-License-Identifier: MPL-2.0"],
    "public_domain": [
        "This is free and unencumbered software released into the public domain.",
        "To the extent possible under law, the author has waived all copyright and related rights to this work.",
        "Released under CC0 1.0 Universal.", "SPDX-License-Identifier: Unlicense"],
}
FEATURES = 1 << 14
#: Paragraphs of the corpus (expected number) that the classifier learns from as the class of everything else.
SAMPLE = 6000
VARIANTS = 60
#: Share of held-back other paragraphs that may pass the least probability; words of a notice that confirm it.
PASSING, CONFIRM = 0.0005, 0.6
PIECE = 1 << 20


def plain(text: Column) -> Column:
    """Lines of lower-case runs of letters and digits parted by single blanks."""
    return F.regexp_replace(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}\n]+", " "), r" ?\n ?", "\n")


def plain_words(text: str) -> list[str]:
    return "".join(c if c.isalnum() else " " for c in text.lower()).split()


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed 1-grams and 2-grams of texts, and the text of each."""
    rolling = worker_cached(("rolling", 31), lambda: Rolling(2 * PIECE, 31))
    words, begins = word_hashes(data, offsets, rolling, PIECE)
    owner = np.repeat(np.arange(len(begins) - 1), np.diff(begins))
    pair = owner[1:] == owner[:-1]
    two = mixed(words[:-1] * np.uint64(3) + words[1:])[pair]
    grams = np.concatenate([words, two]) & np.uint64(FEATURES - 1)
    home = np.concatenate([owner, owner[1:][pair]])
    order = np.argsort(home, kind="stable")
    return grams[order].astype(np.int64), home[order]


def sums_by(values: np.ndarray, home: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros((n, values.shape[1]), np.float32)
    if len(home):
        at = np.flatnonzero(np.append(True, home[1:] != home[:-1]))
        out[home[at]] = np.add.reduceat(values, at, axis=0)
    return out


@dataclass
class LicenseModel:
    families: list[str]  # the last class, without a name, is everything else
    weights: np.ndarray  # FEATURES + 1 (the bias) by classes
    temperature: float
    least: float
    notices: dict[str, list[frozenset]]

    def probabilities(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        grams, home = features(data, offsets)
        return self.of(grams, home, len(offsets) - 1)

    def of(self, grams: np.ndarray, home: np.ndarray, n: int) -> np.ndarray:
        size = np.maximum(np.bincount(home, minlength=n), 1)[:, None] ** 0.5
        return softmax((sums_by(self.weights[grams], home, n) / size + self.weights[FEATURES]) / self.temperature)

    def likeness(self, family: str, words: frozenset) -> float:
        """Greatest share of a notice's words that a paragraph has."""
        return max(len(words & notice) / len(notice) for notice in self.notices[family])


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _bytes_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    return text_bytes(pa.array([" ".join(plain_words(t)) for t in texts], pa.string()))


def fit(docs: DataFrame, text_col: str = "text", sample: int = SAMPLE, seed: int = 5) -> LicenseModel:
    """Learn from NOTICES and about ``sample`` paragraphs of ``docs`` dealt by a hash; works on an empty table too."""
    lines = docs.select(F.explode(F.split(F.coalesce(F.col(text_col), F.lit("")), "\n")).alias("line")).filter("length(line) between 1 and 2000")
    total = lines.count()
    rate = min(1.0, sample / max(total, 1))
    dealt = F.pmod(F.xxhash64("line", F.lit(seed)), F.lit(1_000_000)) < int(rate * 1_000_000) + 1
    # Equal lines are dealt alike, so they count once; what is collected has the size of the sample.
    other = sorted(r.line for r in lines.filter(dealt).distinct().collect())
    notices = {f: [frozenset(plain_words(n)) for n in texts] for f, texts in NOTICES.items()}
    families = sorted(NOTICES)

    def near_notice(line: str) -> bool:
        words = frozenset(plain_words(line))
        return any(len(words & n) / len(n) >= CONFIRM for texts in notices.values() for n in texts)

    other = [x for x in other if not near_notice(x)]
    rng = np.random.default_rng(seed)
    filler = [w for x in other[:500] for w in plain_words(x)] or ["the"]
    texts, labels = list(other), [len(families)] * len(other)
    for k, family in enumerate(families):
        for notice in NOTICES[family]:
            words = plain_words(notice)
            for _ in range(VARIANTS):
                kept = [w for w in words if rng.random() > 0.1] or words
                pad = [filler[i] for i in rng.integers(0, len(filler), rng.integers(0, 6))]
                at = int(rng.integers(0, 2)) * len(kept)
                texts.append(" ".join(kept[:at] + pad + kept[at:]))
                labels.append(k)
    texts += ["license", "copyright", "all rights reserved", "under the", "version 3"]  # words of notices alone tell nothing
    labels += [len(families)] * 5
    labels = np.array(labels)
    grams, home = features(*_bytes_of(texts))
    n, classes = len(texts), len(families) + 1
    held = rng.random(n) < 0.25
    weights = np.zeros((FEATURES + 1, classes), np.float32)
    scale = (np.maximum(np.bincount(home, minlength=n), 1) ** 0.5).astype(np.float32)
    train = ~held
    goal = np.eye(classes, dtype=np.float32)[labels]
    balance = (1 / np.maximum(np.bincount(labels[train], minlength=classes), 1))[labels] * train
    balance = (balance / balance.sum()).astype(np.float32)[:, None]
    speed = np.zeros_like(weights)
    for _ in range(150):  # full-batch descent with momentum and a small penalty
        z = sums_by(weights[grams], home, n) / scale[:, None] + weights[FEATURES]
        error = (softmax(z) - goal) * balance
        step = 1e-5 * weights
        np.add.at(step, grams, error[home] / scale[home][:, None])
        step[FEATURES] += error.sum(axis=0)
        speed = 0.9 * speed - 8.0 * step
        weights += speed
    model = LicenseModel(families, weights, 1.0, 0.5, notices)
    z = sums_by(weights[grams], home, n) / scale[:, None] + weights[FEATURES]
    trial = np.geomspace(0.25, 8, 21)
    loss = [-np.log(np.maximum(softmax(z[held] / t)[np.arange(held.sum()), labels[held]], 1e-12)).mean() if held.any() else 0 for t in trial]
    model.temperature = float(trial[int(np.argmin(loss))])
    unknown = held & (labels == len(families))
    if unknown.any():
        best = softmax(z[unknown] / model.temperature)[:, :-1].max(axis=1)
        model.least = float(max(0.5, np.quantile(best, 1 - PASSING)))
    return model


MATCH = T.StructType([T.StructField("paragraph", T.IntegerType()), T.StructField("family", T.StringType()),
                      T.StructField("probability", T.DoubleType()), T.StructField("likeness", T.DoubleType())])


def scan(docs: DataFrame, model: LicenseModel, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with n_paragraphs (lines) and ``matches``: number from 0, family, calibrated
    probability and likeness to the nearest notice of each paragraph whose family is confirmed.

    All of every text is read. Missing and empty texts have no paragraphs. Repeated rows get equal results; columns with
    the two names are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # FEATURES by families
    in_batches(docs.sparkSession)
    new = {"n_paragraphs": T.IntegerType(), "matches": T.ArrayType(MATCH)}
    keep = [c for c in (docs.columns if keep is None else keep) if c not in new]
    source = unused(docs, "_plain")
    schema = T.StructType([*docs.select(*keep).schema.fields, *(T.StructField(n, t) for n, t in new.items())])
    kind = pa.list_(pa.struct([("paragraph", pa.int32()), ("family", pa.string()), ("probability", pa.float64()),
                               ("likeness", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            data, offsets = text_bytes(batch.column(source))
            breaks = np.flatnonzero(data == 10)
            owner = np.searchsorted(offsets, breaks, side="right") - 1
            filled = np.diff(offsets) > 0
            counts = np.bincount(owner, minlength=batch.num_rows) + filled
            bounds = np.unique(np.concatenate([offsets, breaks + 1]))
            # Paragraphs are cut after their line breaks, which are blanks from here on.
            text = data.copy()
            text[breaks] = 32
            matches: list[list] = [[] for _ in range(batch.num_rows)]
            for i in range(0, len(bounds) - 1, 4096):
                part = bounds[i:i + 4097]
                p = model.probabilities(text[part[0]:part[-1]], part - part[0])
                best = p[:, :-1].argmax(axis=1)
                sure = p[np.arange(len(p)), best]
                for j in np.flatnonzero((sure >= model.least) & (p.argmax(axis=1) < len(model.families))):
                    begin, end = int(part[j]), int(part[j + 1])
                    family = model.families[best[j]]
                    likeness = model.likeness(family, frozenset(text[begin:end].tobytes().decode().split()))
                    if likeness >= CONFIRM:
                        row = int(np.searchsorted(offsets, begin, side="right")) - 1
                        number = int(((breaks >= offsets[row]) & (breaks < begin)).sum())
                        matches[row].append({"paragraph": number, "family": family, "probability": float(sure[j]), "likeness": likeness})
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(counts.astype(np.int32)), pa.array(matches, kind)],
                                             [*keep, *new])

    return docs.select(*keep, F.coalesce(plain(F.col(text_col)), F.lit("")).alias(source)).mapInArrow(run, schema)
