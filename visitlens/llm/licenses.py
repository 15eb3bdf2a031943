"""License scans (operator 8): a trained paragraph classifier.

A paragraph (line) is a sparse bag of hashed word 1-grams and 2-grams, as
shares of its n-grams. A multinomial logistic regression tells the licence
families and "none" apart; it learns from the families' notices, varied, and
from a bounded sample of the corpus' own paragraphs as "none". A family's
probability must reach a limit that calibration paragraphs of the corpus set,
else the paragraph is unknown; and a prediction counts only if the paragraph
holds enough of one of the family's templates. A notice may run over several
lines up to a blank one: words of neighbouring lines that together hold enough
of a template are judged in the same way.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitlens.llm.common import arrow_rows, chunks, texts_as_bytes

# Licence families and the wording of their usual notices.
TEMPLATES = {
    "apache-2.0": ("Licensed under the Apache License, Version 2.0",
                   "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
                   "SPDX-License-Identifier: Apache-2.0"),
    "mit": ("Released under the MIT License", "Licensed under the MIT License",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
            "SPDX-License-Identifier: MIT"),
    "gpl-3.0": ("This work is licensed under the GNU General Public License, version 3",
                "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License",
                "SPDX-License-Identifier: GPL-3.0-only"),
    "cc-by-nc-4.0": ("Licensed under CC BY-NC 4.0",
                     "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    "cc-by-4.0": ("Licensed under CC BY 4.0",
                  "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    "bsd-3-clause": ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
                     "Distributed under the BSD 3-Clause License", "SPDX-License-Identifier: BSD-3-Clause"),
    "mpl-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", "SPDX-License-Identifier: MPL-2.0"),
    "all-rights-reserved": ("All rights reserved.",),
    "proprietary": ("All rights reserved. No part of this publication may be reproduced without prior written permission",),
}
NONE = "none"
DIMENSIONS = 1 << 15
#: paragraphs of the corpus that the model learns from and that set the limit, at most about
SAMPLE = 6000
#: variants of each notice to learn from
VARIANTS = 40
#: of a template's word pairs, the share that confirms a prediction
CONFIRM = 0.6
#: word pairs that tell a licence from its versions and kin; a template that holds some confirms only with all of them
TELLING = ("version 2.0", "version 3", "by-nc 4.0", "attribution-noncommercial 4.0", "by 4.0", "attribution 4.0",
           "bsd 3-clause", "v 2.0")
PASS_WORDS = 200_000
STRIP = b" \t\x0b\x0c\r.,;:!?\"'()[]{}<>*#|&$%"
SEED = 8


class _Numbers(dict):
    """Word -> number, after marks around it are stripped; nothing left: 0."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 400_000:
            self.clear()
        bare = word.strip(STRIP)
        n = self[word] = xxhash.xxh64_intdigest(bare) | 1 if bare else 0
        return n


_numbers = _Numbers()
_PAIR = np.uint64(0x9E3779B97F4A7C15)


def _numbered(paragraphs: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers without bare marks, the paragraph of each."""
    sizes = [len(p) for p in paragraphs]
    words = np.fromiter((_numbers[w] for p in paragraphs for w in p), np.uint64, sum(sizes))
    whose = np.repeat(np.arange(len(paragraphs)), sizes)
    real = words != 0
    return words[real], whose[real]


def _paired(words: np.ndarray) -> np.ndarray:
    """Hashes of all pairs of neighbours."""
    return ((words[:-1] * _PAIR) ^ (words[1:] + (words[1:] << np.uint64(7)))) * _PAIR >> np.uint64(1)


def _hashes(paragraphs: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``_numbered`` and hashes of pairs of neighbours, the paragraph of each."""
    words, whose = _numbered(paragraphs)
    same = whose[1:] == whose[:-1]
    return words, whose, _paired(words)[same], whose[1:][same]


def _features(words: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    return (np.concatenate((words * _PAIR, pairs * _PAIR)) >> np.uint64(64 - DIMENSIONS.bit_length() + 1)).astype(np.int64)


@dataclass
class Classifier:
    families: list[str]  # the last class is none
    weights: np.ndarray  # (features, classes)
    bias: np.ndarray
    limit: float
    templates: list[tuple[int, np.ndarray, np.ndarray]]  # family, sorted word pairs, those of them that tell it

    def probabilities(self, words, whose, pairs, pair_whose, n: int) -> np.ndarray:
        f, at = _features(words, pairs), np.concatenate((whose, pair_whose))
        share = 1.0 / np.maximum(np.bincount(at, minlength=n), 1)
        out = np.empty((n, len(self.bias)))
        for k in range(len(self.bias)):
            out[:, k] = np.bincount(at, weights=self.weights[f, k], minlength=n) * share + self.bias[k]
        out = np.exp(out - out.max(axis=1, keepdims=True))
        return out / out.sum(axis=1, keepdims=True)

    def predict(self, paragraphs: list[list[bytes]]) -> list[tuple[int, str, float, bool]]:
        """(paragraph, family, probability, confirmed) of those that the limit lets through."""
        n = len(paragraphs)
        words, whose, pairs, pair_whose = _hashes(paragraphs)
        p = self.probabilities(words, whose, pairs, pair_whose, n)[:, :-1]
        best = p.argmax(axis=1)
        found = []
        for i in np.flatnonzero(p[np.arange(n), best] >= self.limit).tolist():
            held = np.unique(pairs[pair_whose == i])
            share = max((np.isin(t, held).mean() for k, t, telling in self.templates if k == best[i] and np.isin(telling, held).all()), default=0.0)
            found.append((i, self.families[best[i]], float(p[i, best[i]]), bool(share >= CONFIRM)))
        return found

    def wrapped(self, lines: list[list[bytes]], blocks: np.ndarray) -> list[tuple[int, int, str, float]]:
        """(first line, last line, family, probability) of notices that run over
        several lines of one block (its number for each line, ascending)."""
        words, whose = _numbered(lines)
        if not len(words):
            return []
        pairs = _paired(words)
        known = np.unique(np.concatenate([t for _, t, _ in self.templates]))
        place = np.searchsorted(known, pairs).clip(max=len(known) - 1)
        inside = np.flatnonzero((known[place] == pairs) & (blocks[whose[1:]] == blocks[whose[:-1]]))
        spans = []
        for k, t, telling in self.templates:
            need, width = max(1, int(np.ceil(CONFIRM * len(t) - 1e-9))), 2 * len(t) + 8
            at = inside[np.isin(pairs[inside], t)]
            starts = np.flatnonzero((at[need - 1:] - at[:max(0, len(at) - need + 1)] <= width)) if len(at) >= need else []
            for i in starts:
                held = set()
                for j in at[i:]:
                    if j - at[i] > width or blocks[whose[j + 1]] != blocks[whose[at[i]]]:
                        break
                    held.add(int(pairs[j]))
                    if len(held) >= need and held.issuperset(telling.tolist()):
                        # from its first word to its last, on more lines than one
                        if whose[at[i]] < whose[j + 1]:
                            spans.append((k, int(at[i]), int(j) + 2))
                        break
        # the classifier judges the words of a span; of overlapping ones of a family the best counts
        f = [_features(words[a:b], pairs[a:b - 1]) for _, a, b in spans]
        best: list[tuple[int, int, str, float]] = []
        for (k, a, b), features in zip(spans, f):
            z = self.weights[features].mean(axis=0) + self.bias
            z = np.exp(z - z.max())
            p = z / z.sum()
            if p[:-1].argmax() == k and p[k] >= self.limit:
                best.append((int(whose[a]), int(whose[b - 1]), self.families[k], float(p[k])))
        merged: dict[str, list[tuple[int, int, str, float]]] = {}
        for a, b, family, q in sorted(best):
            own = merged.setdefault(family, [])
            if own and a <= own[-1][1] + 1 and blocks[a] == blocks[own[-1][0]]:
                own[-1] = (own[-1][0], max(b, own[-1][1]), family, max(q, own[-1][3]))
            else:
                own.append((a, b, family, q))
        return sorted(x for own in merged.values() for x in own)

    def notices(self, lines: list[list[bytes]], blocks: np.ndarray) -> list[tuple[int, str, float, bool]]:
        """``predict`` of the lines, and the first line of those that are wrapped.
        A span beside a confirmed line of its family is that line's notice;
        unconfirmed lines of a span go."""
        single = self.predict(lines)
        sure = {(i, family) for i, family, _, ok in single if ok}
        spans = [x for x in self.wrapped(lines, blocks)
                 if not any((i, x[2]) in sure and blocks[i] == blocks[x[0]] for i in range(max(0, x[0] - 1), min(len(lines), x[1] + 2)))]
        covered = {i for a, b, *_ in spans for i in range(a, b + 1)}
        return sorted([x for x in single if x[3] or x[0] not in covered] + [(a, family, q, True) for a, _, family, q in spans])


def _train(x: list[np.ndarray], y: np.ndarray, classes: int, steps: int = 200) -> tuple[np.ndarray, np.ndarray]:
    """Multinomial logistic regression by gradient steps scaled per weight (AdaGrad)."""
    size = np.array([len(f) for f in x])
    at, f = np.repeat(np.arange(len(x)), size), np.concatenate(x)
    value = 1.0 / np.maximum(size, 1)[at]
    used, f = np.unique(f, return_inverse=True)
    w, b = np.zeros((len(used), classes)), np.zeros(classes)
    gw, gb = np.full_like(w, 1e-8), np.full_like(b, 1e-8)
    # every class counts the same in all
    weight = (1.0 / np.bincount(y, minlength=classes).clip(1))[y] / classes
    for _ in range(steps):
        z = np.stack([np.bincount(at, weights=w[f, k] * value, minlength=len(x)) for k in range(classes)], axis=1) + b
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        p[np.arange(len(x)), y] -= 1
        p *= weight[:, None]
        g = np.stack([np.bincount(f, weights=p[at, k] * value, minlength=len(used)) for k in range(classes)], axis=1) + 1e-7 * w
        gw += g * g
        gb += (s := p.sum(axis=0)) * s
        w -= 1.0 * g / np.sqrt(gw)
        b -= 0.3 * s / np.sqrt(gb)
    full = np.zeros((DIMENSIONS, classes))
    full[used] = w
    return full, b


def fit(negatives: list[bytes]) -> Classifier:
    """A classifier from the templates and paragraphs that are (almost all) no
    notices; every other one of these sets the limit."""
    rng = np.random.default_rng(SEED)
    families = sorted(TEMPLATES)
    templates, x, y = [], [], []
    tell = np.concatenate([_hashes([t.encode().split()])[2] for t in TELLING])
    plain = [n.lower().split() for n in negatives]
    filler = [w for p in plain[:500] for w in p[:20]] or [b"the"]
    for k, family in enumerate(families):
        for text in TEMPLATES[family]:
            words = text.encode().lower().split()
            held = np.unique(_hashes([words])[2])
            templates.append((k, held, held[np.isin(held, tell)]))
            for v in range(VARIANTS):
                kept = [w for w in words if v == 0 or rng.random() > 0.08]
                head, tail = (int(rng.integers(0, 4)) if v % 2 else 0 for _ in range(2))
                noisy = [filler[i] for i in rng.integers(0, len(filler), head)] + kept + [filler[i] for i in rng.integers(0, len(filler), tail)]
                w, _, p, _ = _hashes([noisy])
                x.append(_features(w, p))
                y.append(k)
    for words in plain[::2]:
        w, _, p, _ = _hashes([words])
        x.append(_features(w, p))
        y.append(len(families))
    if not plain:  # no corpus: an empty paragraph stands for none
        x.append(np.empty(0, dtype=np.int64))
        y.append(len(families))
    weights, bias = _train(x, np.array(y), len(families) + 1)
    model = Classifier(families, weights, bias, 0.5, templates)
    # calibration: of the other paragraphs, those that hold no template must stay below the limit (0.1 % may not)
    rest = plain[1::2]
    if rest:
        words, whose, pairs, pair_whose = _hashes(rest)
        top = model.probabilities(words, whose, pairs, pair_whose, len(rest))[:, :-1].max(axis=1)
        noticed = {i for i, *_, sure in model.predict(rest) if sure}
        clean = np.array([top[i] for i in range(len(rest)) if i not in noticed])
        if len(clean):
            model.limit = float(min(0.9, max(0.5, np.quantile(clean, 0.999))))
    return model


def train(docs: DataFrame, sample: int = SAMPLE) -> Classifier:
    """Fits on about ``sample`` paragraphs: one of each of so many documents,
    chosen by hashes of their texts (all, if there are fewer)."""
    rows = docs.where("text is not null").select("text")
    n = rows.count()
    if not n:
        return fit([])
    pick = F.pmod(F.xxhash64(F.lit(SEED), "text"), F.lit(1 << 30)) < int(min(1.0, sample / n) * (1 << 30))
    lines = F.filter(F.split("text", "\n", -1), lambda x: F.length(F.trim(x)) > 0)
    one = rows.where(pick).select(lines.alias("l"), F.xxhash64(F.lit(SEED + 1), "text").alias("h")).where(F.size("l") > 0)
    # paragraphs are cut to 2,000 characters for learning only
    got = one.select("h", F.substring(F.get("l", F.pmod("h", F.size("l")).cast("int")), 1, 2000).alias("p")).orderBy("h", "p").collect()
    return fit([r["p"].encode() for r in got])


def _scan(model: Classifier):
    hit = pa.list_(pa.struct([("paragraph", pa.int64()), ("family", pa.string()), ("probability", pa.float64()), ("confirmed", pa.bool_())]))

    def run(batches):
        for b in batches:
            texts = texts_as_bytes(b)
            found: list[list[dict]] = [[] for _ in texts]
            n_paragraphs = []
            blocks = []  # lines without a blank one between them
            for d, t in enumerate(texts):
                own = [(d, i, ws) for i, line in enumerate(t.lower().split(b"\n")) if (ws := line.split())]
                n_paragraphs.append(len(own))
                cuts = [0, *(n for n in range(1, len(own)) if own[n][1] > own[n - 1][1] + 1), len(own)]
                blocks += [own[x:y] for x, y in zip(cuts, cuts[1:]) if x < y]
            for some in chunks(blocks, lambda x: sum(len(ws) for _, _, ws in x), PASS_WORDS):
                part = [line for x in some for line in x]
                number = np.repeat(np.arange(len(some)), [len(x) for x in some])
                for i, family, p, sure in model.notices([ws for _, _, ws in part], number):
                    found[part[i][0]].append({"paragraph": part[i][1], "family": family, "probability": p, "confirmed": sure})
            yield pa.RecordBatch.from_arrays([b.column("_row"), pa.array(n_paragraphs, pa.int64()), pa.array(found, hit)],
                                             names=["_row", "n_paragraphs", "hits"])
    return run


def scan(docs: DataFrame, model: Classifier, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of ``docs`` (which has text), n_paragraphs (lines
    with a word) and hits, an array of (paragraph: the line's number from 0,
    family, probability, confirmed) of the lines that are taken for a notice;
    a notice over several lines has the number of its first.
    Null and empty texts: no paragraph, no hit. Equal texts get equal hits."""
    arrow_rows(docs.sparkSession)
    rows = docs.select(F.struct(*[docs[c] for c in keep]).alias("_row"), docs["text"].alias("text"))
    kind = rows.schema["_row"].dataType.simpleString()
    out = rows.mapInArrow(_scan(model), f"_row {kind}, n_paragraphs long, "
                                        "hits array<struct<paragraph:long,family:string,probability:double,confirmed:boolean>>")
    return out.select(*[F.col("_row")[c].alias(c) for c in keep], "n_paragraphs", "hits")


#: a notice that names no licence; the report has it in columns of its own
RESERVED = "all-rights-reserved"


def license_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_paragraphs, n_notices (confirmed, of a licence), n_unconfirmed,
    families (of those notices, sorted, joined by commas), first_paragraph (of
    one, else null), probability (their highest); n_reserved, first_reserved and
    reserved_probability: the same of the confirmed notices 'All rights
    reserved', which name no licence."""
    found = scan(docs, train(docs), ["doc_id"])
    sure = F.filter("hits", lambda h: h["confirmed"] & (h["family"] != RESERVED))
    reserved = F.filter("hits", lambda h: h["confirmed"] & (h["family"] == RESERVED))
    return found.select(
        "doc_id", "n_paragraphs", F.size(sure).cast("long").alias("n_notices"),
        F.size(F.filter("hits", lambda h: ~h["confirmed"])).cast("long").alias("n_unconfirmed"),
        F.array_join(F.array_sort(F.array_distinct(F.transform(sure, lambda h: h["family"]))), ",").alias("families"),
        F.array_min(F.transform(sure, lambda h: h["paragraph"])).alias("first_paragraph"),
        F.array_max(F.transform(sure, lambda h: h["probability"])).alias("probability"),
        F.size(reserved).cast("long").alias("n_reserved"),
        F.array_min(F.transform(reserved, lambda h: h["paragraph"])).alias("first_reserved"),
        F.array_max(F.transform(reserved, lambda h: h["probability"])).alias("reserved_probability"))
