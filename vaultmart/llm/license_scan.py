"""Licence scan: a trained classifier of word windows, confirmed against templates.

Paragraphs are runs of lines with a word; lines without one (blank, or comment signs only) part them.  In a
paragraph every word of a template begins a window of the template's length and a quarter, SLACK words more at
least, across line ends and inside long lines alike; an exact bound on the words it shares with the template
comes before the comparison.  A window ends with its last agreeing word.  Features are the hashed word 1- and 2-grams that occur in
the templates and the near notices (a sparse vector: other n-grams only add to the count of unknown ones).  A softmax regression
over the licence families and a class `unknown` is trained on the driver, on generated variants of the
templates (words dropped, case and stops changed, text around them) and, as unknown, on like variants of notices of
other licences that are near to a template (they agree with it often enough, so only the model rejects them) and at most
SAMPLE_PARAGRAPHS paragraphs of the corpus, taken by the smallest hash so that the choice does not depend on
partitioning or on the corpus size.  This is the operator's one bounded sample.

The unknown class is calibrated: on a held-out part of the training set a temperature is fitted and
then, on held-out unknown paragraphs, the smallest probability a licence must have so that at most one in
CALIBRATION of them passes (within THRESHOLDS).  A window is found if it agrees with a template, at least AGREE
of the template's words (their longest common subsequence) and, where the template has a version or variant
word, that word, and is predicted as the template's family.  Of windows that overlap the one with most agreeing
words stays (then the highest share, the shortest, the first).  A line that no found window touches is also
tried whole, so that words put in beyond a window's length do not hide a notice on one line.

A paragraph that lacks all witness words (of each template its longest words, more than an agreeing
paragraph can lack) cannot be confirmed and is not scored; all others of all texts are.

Defined results: null, empty and blank texts have no licence; repeated rows and repeated paragraphs each
count; very long paragraphs are searched whole; pieces of a template (lines of a wrapped notice) are not taught as
unknown; an empty table gives an empty result; other columns pass by.
"""

from __future__ import annotations

import math
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vaultmart.llm.common import small_batches

# Short notices of common licence families, the templates of the scan.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
                   "except in compliance with the License."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files, to deal in the Software without restriction."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation, either version 3 of the License, "
                "or any later version."),
    ("GPL-2.0", "This program is free software; you can redistribute it under the terms of the GNU General Public "
                "License, version 2."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                     "provided that the following conditions are met."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright under CC0 1.0."),
    ("proprietary", "Copyright. All rights reserved."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                 "Affero General Public License as published by the Free Software Foundation, either version 3 of the "
                 "License, or any later version."),
    ("LGPL-3.0", "This library is free software: you can redistribute it and/or modify it under the terms of the GNU "
                 "Lesser General Public License as published by the Free Software Foundation, either version 3 of the "
                 "License, or any later version."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU "
                 "Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the "
                 "License, or any later version."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("ISC", "Released under the ISC License."),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public "
                "License 2.0."),
    *((family, f"SPDX-License-Identifier: {name}") for family, name in [
        ("Apache-2.0", "Apache-2.0"), ("MIT", "MIT"), ("GPL-3.0", "GPL-3.0-only"), ("GPL-3.0", "GPL-3.0-or-later"),
        ("GPL-2.0", "GPL-2.0-only"), ("GPL-2.0", "GPL-2.0-or-later"), ("AGPL-3.0", "AGPL-3.0-only"), ("AGPL-3.0", "AGPL-3.0-or-later"),
        ("LGPL-3.0", "LGPL-3.0-only"), ("LGPL-2.1", "LGPL-2.1-or-later"), ("BSD-3-Clause", "BSD-3-Clause"), ("MPL-2.0", "MPL-2.0"),
        ("ISC", "ISC"), ("BSL-1.0", "BSL-1.0"), ("EPL-2.0", "EPL-2.0"), ("CC0-1.0", "CC0-1.0"), ("CC-BY-4.0", "CC-BY-4.0")]),
]
# Notices of licences outside the families, near to their templates; taught as unknown.
NEAR = [
    "This work is licensed under the GNU Free Documentation License, version 1.3.",
    "Permission is granted to copy, distribute and/or modify this document under the terms of the GNU Free Documentation "
    "License, Version 1.3 or any later version published by the Free Software Foundation.",
    "Licensed under the Academic Free License, Version 3.0.",
    "Licensed under the Open Software License, Version 3.0.",
    "Licensed under the Educational Community License, Version 2.0.",
    "Licensed under the European Union Public Licence, Version 1.2.",
    "Released under the Artistic License 2.0.",
    "Released under the zlib License.",
    "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    "This software is provided under the terms of a commercial License, version 3, and may not be redistributed.",
    "Permission is hereby denied to any person obtaining a copy of this software to deal in the Software without a contract.",
]
# Words that tell members of a family group apart; a template's own must all be in the paragraph.
VARIANT = re.compile(r"\d+(?:\.\d+)?|by(?:-[a-z]+)*|lesser|affero|mit|isc|boost|eclipse|apache|bsd|mozilla|"
                     r"noncommercial|attribution-noncommercial|(?:a|l)?gpl-.*|bsd-.*|mpl-.*|bsl-.*|epl-.*|cc0-.*|cc-by-.*|apache-.*")
UNKNOWN = "unknown"
SAMPLE_PARAGRAPHS, SAMPLE_CHARS = 4000, 1000
CALIBRATION = 100
THRESHOLDS = (0.5, 0.9)
AGREE = 0.8
SLACK = 8  # words put in that a window has room for, at least
SEED = 11
_WORD = re.compile(r"[^\W_]+(?:[.\-'][^\W_]+)*")
_BREAK = re.compile(r"\n[\W_]*\n")


def normal_words(paragraph: str) -> list[str]:
    return [w.lower() for w in _WORD.findall(paragraph)]


def ngrams(words: list[str]) -> list[str]:
    return words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def common_subsequence(a: list[str], b: list[str]) -> int:
    """Length of the longest common subsequence, by bit vectors over `a`."""
    places: dict[str, int] = {}
    for i, w in enumerate(a):
        places[w] = places.get(w, 0) | 1 << i
    full = row = (1 << len(a)) - 1
    for w in b:
        hit = row & places.get(w, 0)
        row = (row + hit | row - hit) & full
    return len(a) - row.bit_count()


def last_agreeing(a: list[int], b: list[int]) -> tuple[int, int]:
    """Length of the longest common subsequence, and the shortest prefix of `b` that has it."""
    places: dict[int, int] = {}
    for i, w in enumerate(a):
        places[w] = places.get(w, 0) | 1 << i
    full = row = (1 << len(a)) - 1
    length = end = 0
    for k, w in enumerate(b, 1):
        hit = row & places.get(w, 0)
        if hit:
            row = (row + hit | row - hit) & full
            if len(a) - row.bit_count() > length:
                length, end = length + 1, k
    return length, end


def paragraphs_of(text: str):
    """(start, end) of the runs of lines with a word."""
    at = 0
    for m in _BREAK.finditer(text):
        yield at, m.start()
        at = m.end()
    yield at, len(text)


class Model:
    """Sparse softmax regression over template n-grams, with a temperature and a threshold."""

    def __init__(self, templates=TEMPLATES) -> None:
        self.templates = [(family, normal_words(text)) for family, text in templates]
        self.families = [*dict.fromkeys(f for f, _ in templates), UNKNOWN]
        taught = [words for _, words in self.templates] + [normal_words(text) for text in NEAR]
        grams = dict.fromkeys(g for words in taught for g in ngrams(words))
        self.features = {g: k for k, g in enumerate(grams)}
        self.weights = np.zeros((len(self.features) + 2, len(self.families)))  # + unknown share, bias
        self.temperature, self.threshold = 1.0, 0.5
        self._witnesses = self.witnesses()
        self.terms = {w: k for k, w in enumerate(dict.fromkeys(w for _, words in self.templates for w in words))}
        self._ids = [[self.terms[w] for w in words] for _, words in self.templates]
        self._variants = [[self.terms[w] for w in dict.fromkeys(words) if VARIANT.fullmatch(w)]
                          for _, words in self.templates]

    def vector(self, words: list[str]) -> tuple[list[int], float]:
        """(feature ids, share of n-grams that no template has)."""
        grams = ngrams(words)
        known = [self.features[g] for g in grams if g in self.features]
        return sorted(set(known)), 1 - len(known) / max(1, len(grams))

    def matrix(self, paragraphs: list[list[str]]) -> np.ndarray:
        x = np.zeros((len(paragraphs), len(self.weights)))
        for k, words in enumerate(paragraphs):
            known, share = self.vector(words)
            x[k, known] = 1 / max(1, len(known)) ** 0.5
            x[k, -2], x[k, -1] = share, 1
        return x

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        z = x @ self.weights / self.temperature
        z = np.exp(z - z.max(1, keepdims=True))
        return z / z.sum(1, keepdims=True)

    def fit(self, unknown: list[str], rounds: int = 300, rate: float = 2.0, decay: float = 1e-4) -> Model:
        rng = np.random.default_rng(SEED)
        texts, labels = [], []
        others = [normal_words(p) for p in unknown]
        fill = [w for p in others[:200] for w in p[:20]] or ["text"]
        for family, words in self.templates:
            for k in range(40):
                stay = [w for w in words if k < 4 or VARIANT.fullmatch(w) or rng.random() > 0.08]
                around = [fill[i] for i in rng.integers(0, len(fill), rng.integers(0, 9) if k % 2 else 0)]
                cut = int(rng.integers(0, len(around) + 1))
                texts.append(around[:cut] + stay + around[cut:])
                labels.append(self.families.index(family))
        # unknown paragraphs: the corpus's own, and near misses that share common words of the templates
        for words in map(normal_words, NEAR):
            for k in range(40):
                stay = [w for w in words if k < 4 or rng.random() > 0.08]
                around = [fill[i] for i in rng.integers(0, len(fill), rng.integers(0, 9) if k % 2 else 0)]
                texts.append(stay + around)
                labels.append(len(self.families) - 1)
        grams = [w for _, words in self.templates for w in words]
        for p in others:
            if not self.matches(p) and not self.piece(p):
                texts.append(p)
                labels.append(len(self.families) - 1)
        for _ in range(800):
            n = int(rng.integers(1, 12))
            mixed = [(grams if rng.random() < 0.4 else fill)[i] for i in rng.integers(0, min(len(grams), len(fill)), n)]
            if not self.matches(mixed):
                texts.append(mixed)
                labels.append(len(self.families) - 1)
        x, y = self.matrix(texts), np.array(labels)
        held = rng.random(len(y)) < 0.25
        a, b = x[~held], np.eye(len(self.families))[y[~held]]
        weight = 1 / np.bincount(y[~held], minlength=len(self.families))[y[~held]]
        weight = (weight / weight.sum())[:, None]
        for _ in range(rounds):
            p = self.probabilities(a)
            self.weights -= rate * (a.T @ (weight * (p - b)) + decay * self.weights) * len(self.families)
        self._calibrate(x[held], y[held])
        return self

    def _calibrate(self, x: np.ndarray, y: np.ndarray) -> None:
        def loss(t):
            self.temperature = t
            return -np.log(self.probabilities(x)[np.arange(len(y)), y] + 1e-12).mean()
        self.temperature = min(np.geomspace(0.05, 5, 60), key=loss) if len(y) else 1.0
        none = self.probabilities(x[y == len(self.families) - 1])[:, :-1].max(1, initial=0)
        allowed = len(none) // CALIBRATION
        found = float(np.sort(none)[::-1][allowed]) + 1e-6 if len(none) else 0.0
        self.threshold = min(max(found, THRESHOLDS[0]), THRESHOLDS[1])

    def matches(self, words: list[str], families=None) -> tuple[str, float] | None:
        """The best agreeing template: (family, share of its words found in order)."""
        best = None
        for family, template in self.templates:
            if families is not None and family not in families:
                continue
            have = set(words)
            if not all(w in have for w in template if VARIANT.fullmatch(w)):
                continue
            share = common_subsequence(template, words) / len(template)
            if share >= AGREE and (best is None or share > best[1]):
                best = (family, share)
        return best

    def piece(self, words: list[str]) -> bool:
        """Is a line of some words a part of a template, as in a wrapped notice?"""
        return len(words) > 3 and any(common_subsequence(t, words) >= AGREE * len(words) for _, t in self.templates)

    def windows(self, ids: np.ndarray) -> list[tuple[int, int, int, int]]:
        """(template, agreeing words, first word, end) of all agreeing windows of a paragraph's term ids."""
        out, n = [], len(ids)
        for k, template in enumerate(self._ids):
            size = len(template) + max(SLACK, len(template) // 4)
            need = math.ceil(AGREE * len(template) - 1e-9)
            starts = np.flatnonzero(np.isin(ids, template))
            if len(starts) < need:
                continue
            ends = np.minimum(starts + size, n)
            # no more words agree than the window and the template have in common in any order
            common, has = np.zeros(len(starts), np.int64), np.ones(len(starts), bool)
            for term in set(template):
                upto = np.concatenate([[0], np.cumsum(ids == term)])
                inside = upto[ends] - upto[starts]
                common += np.minimum(inside, template.count(term))
                if term in self._variants[k]:
                    has &= inside > 0
            for a, b in zip(*(x[has & (common >= need)].tolist() for x in (starts, ends))):
                window = ids[a:b].tolist()
                length, end = last_agreeing(template, window)
                if length >= need:
                    out.append((k, length, a, a + max([end, *(window.index(v) + 1 for v in self._variants[k])])))
        return out

    def find(self, text: str) -> list[dict]:
        """The licence notices of a text in order, none overlapping: lines, characters, family, probability, agreement."""
        found: list[dict] = []
        if not self.may_agree(text):
            return found
        for first, last in paragraphs_of(text):
            part = text[first:last]
            if self.may_agree(part):
                found += self._find(part, first, text.count("\n", 0, first))
        return found

    def _find(self, part: str, offset: int, line: int) -> list[dict]:
        places = np.array([(self.terms.get(m[0].lower(), -1), m.start(), m.end()) for m in _WORD.finditer(part)],
                          np.int64).reshape(-1, 3)
        windows = self.windows(places[:, 0])
        windows.sort(key=lambda x: (-x[1], -x[1] / len(self._ids[x[0]]), x[3] - x[2], x[2], x[0]))
        taken, out = np.zeros(len(places), bool), []

        def add(a, b, family, probability, agreement):
            out.append({"paragraph": line + part.count("\n", 0, a), "last_line": line + part.count("\n", 0, b),
                        "start": offset + a, "end": offset + b, "family": family, "probability": probability,
                        "agreement": agreement})

        for at in range(0, len(windows), 512):
            some = windows[at:at + 512]
            rows = self.probabilities(self.matrix([normal_words(part[places[a, 1]:places[b - 1, 2]]) for _, _, a, b in some]))
            for (k, length, a, b), row in zip(some, rows):
                family = int(row[:-1].argmax())
                if row[family] >= self.threshold and self.families[family] == self.templates[k][0] and not taken[a:b].any():
                    taken[a:b] = True
                    add(int(places[a, 1]), int(places[b - 1, 2]), self.families[family], float(row[family]),
                        length / len(self._ids[k]))
        # lines that no window touches, whole
        lines, a = [], 0
        for x in part.split("\n"):
            words = slice(*np.searchsorted(places[:, 1], [a, a + len(x)]))
            if self.may_agree(x) and not taken[words].any():
                lines.append((a, x))
            a += len(x) + 1
        for (a, x), f in zip(lines, self.classify([x for _, x in lines])):
            if f:
                add(a, a + len(x), *f)
        return sorted(out, key=lambda f: f["start"])

    def witnesses(self) -> list[str]:
        """Words of which every agreeing paragraph has at least one: of each template its longest words, as many
        as an agreeing paragraph cannot all lack."""
        out = set()
        for _, words in self.templates:
            out.update(sorted(words, key=len, reverse=True)[:int((1 - AGREE) * len(words) + 1e-9) + 1])
        return sorted(out)

    def may_agree(self, text: str) -> bool:
        """False only if no template can agree with any paragraph of the text."""
        lower = text.lower()
        return any(w in lower for w in self._witnesses)

    def classify(self, paragraphs: list[str]) -> list[tuple[str, float, float] | None]:
        """Per paragraph (family, probability, agreement) or None."""
        out: list = [None] * len(paragraphs)
        words = [normal_words(p) for p in paragraphs]
        for a in range(0, len(words), 512):
            part = words[a:a + 512]
            for k, row in enumerate(self.probabilities(self.matrix(part)), a):
                family = int(row[:-1].argmax())
                if row[family] >= self.threshold:
                    found = self.matches(words[k], {self.families[family]})
                    if found:
                        out[k] = (found[0], float(row[family]), found[1])
        return out


def sample_paragraphs(docs: DataFrame, text_col: str = "text", limit: int = SAMPLE_PARAGRAPHS) -> list[str]:
    """One paragraph of at most SAMPLE_CHARS characters from each of `limit` hash buckets: the one of smallest
    hash.  Equal paragraphs share a hash, so a hot one counts once."""
    lines = docs.select(F.explode(F.split(F.col(text_col), "\n")).alias("p")).filter(
        F.col("p").rlike(r"[^\x20\x09-\x0D]") & (F.char_length("p") <= SAMPLE_CHARS)).select("p", F.xxhash64("p").alias("h"))
    least = lines.groupBy(F.pmod("h", F.lit(limit)).alias("b")).agg(F.min("h").alias("h")).select("h")
    # broadcast: one hash per bucket
    rows = lines.join(F.broadcast(least), "h").groupBy("h").agg(F.min("p").alias("p")).orderBy("h").collect()
    return [r["p"] for r in rows]


def train(docs: DataFrame, text_col: str = "text", templates=TEMPLATES) -> Model:
    return Model(templates).fit(sample_paragraphs(docs, text_col))


FOUND = T.ArrayType(T.StructType([
    T.StructField("paragraph", T.IntegerType()), T.StructField("last_line", T.IntegerType()),
    T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("family", T.StringType()),
    T.StructField("probability", T.DoubleType()), T.StructField("agreement", T.DoubleType())]))
_ARROW = pa.list_(pa.struct([("paragraph", pa.int32()), ("last_line", pa.int32()), ("start", pa.int64()),
                             ("end", pa.int64()), ("family", pa.string()), ("probability", pa.float64()),
                             ("agreement", pa.float64())]))


def scan(text_col, model: Model):
    """Array column of the licence notices of a text: first and last line number, characters [start, end),
    family, probability, agreement."""
    spark = SparkSession.active()
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf(FOUND)
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([shared.value.find(t.as_py() or "") for t in texts], _ARROW)

    return run(text_col)
