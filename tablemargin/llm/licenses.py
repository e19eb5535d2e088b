"""Licence scan: a trained paragraph classifier, confirmed by comparison with templates. Columns only.

A paragraph is a line of text, or what stands between blank lines with its lines joined, as licence texts are often
wrapped. Paragraphs are classified by a multinomial logistic regression on sparse word n-grams, with a class for
paragraphs that are no licence at all; its temperature is set on held-out folds of the training table, so that the
probability of that unknown class is calibrated. A predicted family counts as confirmed if one of its templates is
largely contained in the paragraph.

The model is fitted on the driver from the small table below and applied as joins: n-grams of the distinct paragraphs
with the weights and with the templates' shingles. To both a paragraph is the set of its n-grams that the model knows,
so only that is kept of it. Paragraphs whose n-grams cannot lift any family over the unknown class do not reach the joins.

Defined results: NULL and empty texts have no paragraphs and thus no licence. The same paragraph in many documents is
classified once. A paragraph of several lines counts as a notice of its own only for a family that none of its lines
names, and where it is confirmed, its unconfirmed lines of that family count no more. Repeated documents are reported
one by one. Of several families with equal probability the alphabetically first is taken. Extra columns stay; output
columns replace columns of that name.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tablemargin.sources.tables import stage

UNKNOWN = "unknown"

# Training table: notices by licence family, and paragraphs that are no licence. Fixed values.
NOTICES = {
    "agpl-3.0": ["This program is licensed under the GNU Affero General Public License, version 3.",
                 "GNU Affero General Public License as published by the Free Software Foundation, version 3",
                 "SPDX-License-Identifier: AGPL-3.0-only", "Distributed under the terms of the AGPL v3."],
    "all-rights-reserved": ["All rights reserved.", "Copyright. All rights reserved.",
                            "No part of this publication may be reproduced without prior written permission. All rights reserved.",
                            "This material is proprietary and confidential. All rights reserved worldwide."],
    "apache-2.0": ["Licensed under the Apache License, Version 2.0.",
                   "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
                   "SPDX-License-Identifier: Apache-2.0", "This project is released under the Apache 2.0 license.",
                   "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"],
    "bsd-2-clause": ["This software is released under the BSD 2-Clause License.", "Simplified BSD License, two clauses",
                     "SPDX-License-Identifier: BSD-2-Clause"],
    "bsd-3-clause": ["Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
                     "Released under the 3-Clause BSD License.", "SPDX-License-Identifier: BSD-3-Clause",
                     "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
                     "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software"],
    "cc-by": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License.",
              "Creative Commons Attribution license (CC BY)", "Text available under CC BY 3.0."],
    "cc-by-nc": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
                 "Creative Commons Attribution NonCommercial license (CC BY-NC)", "Shared under CC BY-NC 3.0 for non-commercial use."],
    "cc-by-sa": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
                 "Text is available under the Creative Commons Attribution-ShareAlike License", "Shared under CC BY-SA 3.0."],
    "cc0": ["To the extent possible under law, the author has waived all copyright and related rights to this work.",
            "CC0 1.0 Universal Public Domain Dedication", "Released into the public domain under CC0."],
    "epl-2.0": ["This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0.",
                "SPDX-License-Identifier: EPL-2.0"],
    "gpl-2.0": ["This program is free software; you can redistribute it under the terms of the GNU General Public License version 2.",
                "Licensed under the GNU General Public License, version 2.", "SPDX-License-Identifier: GPL-2.0-only", "Released under GPL v2."],
    "gpl-3.0": ["This work is licensed under the GNU General Public License, version 3.",
                "Licensed under the GNU General Public License, version 3.", "SPDX-License-Identifier: GPL-3.0-or-later", "Released under GPL v3.",
                "You can redistribute it and or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License"],
    "isc": ["Permission to use, copy, modify, and or distribute this software for any purpose with or without fee is hereby granted",
            "Released under the ISC License.", "SPDX-License-Identifier: ISC"],
    "lgpl": ["Licensed under the GNU Lesser General Public License, version 2.1.", "This library is free software under the GNU Lesser General Public License, version 3.",
             "SPDX-License-Identifier: LGPL-2.1-only", "Released under LGPL v3."],
    "mit": ["Released under the MIT License.", "Licensed under the MIT license.", "SPDX-License-Identifier: MIT", "The MIT License (MIT)",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
            "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."],
    "mpl-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
                "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/",
                "SPDX-License-Identifier: MPL-2.0"],
    "unlicense": ["This is free and unencumbered software released into the public domain.", "SPDX-License-Identifier: Unlicense"],
    UNKNOWN: ["She renewed her driving license at the public office in May.", "The doctor was licensed to work in two states.",
              "Version 2.0 of the game was released in the spring.", "The general public was invited to the opening.",
              "All rights of the child were discussed at the meeting.", "He asked for permission to park his car behind the house.",
              "The software company reserved a table for ten.", "A fishing license costs little and is granted at once.",
              "The copyright lawyer spoke about music and film.", "Free software was the topic of the first talk.",
              "They met at the common and talked about creative work.", "The eclipse was seen by the whole school.",
              "The notice on the door said that the shop was closed.", "Under the terms of the treaty the army left the city.",
              "The warranty covers the motor for three years.", "Students of the MIT built a small robot.",
              "The Apache are a people of the south west.", "You may not use this door except in an emergency.",
              "The foundation published its report for any purpose of the law.", "Public records are kept in the domain of the county.",
              "The bird is found in many forms with or without spots.", "A copy of the letter was included in the file.",
              "The conditions are met by most of the contributors.", "Third version of the plan was the one they used."],
}

NGRAMS = (1, 2, 3)
#: Share of a template's word pairs that confirms its family.
CONFIRM = 0.6
#: Grain of the bound on what an n-gram can do for a family.
STEP = 0.125


def tokens(paragraph: str) -> list[str]:
    return [w for w in re.split(r"[^a-z0-9]+", paragraph.lower()) if w]


def ngrams(words: Sequence[str]) -> set[str]:
    return {" ".join(words[i:i + n]) for n in NGRAMS for i in range(len(words) - n + 1)}


#: Words of the templates above: a paragraph without any of them holds no n-gram that speaks for a family.
ANCHORS = sorted({w for f, ts in NOTICES.items() if f != UNKNOWN for t in ts for w in tokens(t)})


def _train(rows: list[set[str]], y: np.ndarray, vocabulary: dict[str, int], classes: int, rounds: int = 300) -> np.ndarray:
    """Weights (n-grams and an intercept, by class) of a multinomial logistic regression."""
    x = np.zeros((len(rows), len(vocabulary) + 1))
    x[:, -1] = 1
    for i, row in enumerate(rows):
        x[i, [vocabulary[g] for g in row if g in vocabulary]] = 1
    w = np.zeros((x.shape[1], classes))
    target = np.eye(classes)[y]
    for _ in range(rounds):
        z = x @ w
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        w -= 0.5 * (x.T @ (p - target) / len(y) + 2e-4 * w)
    return w


class Model:
    """Weights of the n-grams by family, intercepts, and the temperature fitted on held-out folds."""

    def __init__(self, notices: dict[str, list[str]] = NOTICES, folds: int = 5):
        self.families = sorted(notices)
        rows = [(ngrams(tokens(t)), k) for k, f in enumerate(self.families) for t in notices[f]]
        grams, y = [g for g, _ in rows], np.array([k for _, k in rows])
        self.vocabulary = {g: i for i, g in enumerate(sorted(set().union(*grams)))}
        self.weights = _train(grams, y, self.vocabulary, len(self.families))
        logits = np.zeros((len(y), len(self.families)))
        for fold in range(folds):
            held = np.arange(len(y)) % folds == fold
            w = _train([g for g, h in zip(grams, held) if not h], y[~held], self.vocabulary, len(self.families))
            for i in np.flatnonzero(held):
                logits[i] = w[[*(self.vocabulary[g] for g in grams[i]), -1]].sum(0)

        def loss(temperature: float) -> float:
            z = logits / temperature
            return float((np.log(np.exp(z - z.max(1, keepdims=True)).sum(1)) + z.max(1) - z[np.arange(len(y)), y]).mean())

        self.temperature = min((0.25 * 1.25 ** k for k in range(16)), key=loss)
        self.templates = [(f, t) for f in self.families if f != UNKNOWN for t in notices[f]]
        # What an n-gram can do for any family against unknown, rounded up to a STEP, and what a family lacks at the start.
        over = (self.weights - self.weights[:, [self.families.index(UNKNOWN)]])
        over = np.delete(over, self.families.index(UNKNOWN), 1).max(1)
        self.lacks = -float(over[-1])
        self.favours: dict[float, list[str]] = {}
        for g, i in self.vocabulary.items():
            if over[i] > 0:
                self.favours.setdefault(float(np.ceil(over[i] / STEP) * STEP), []).append(g)


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda w: w != "")


def _grams(paragraph: Column, model: Model) -> Column:
    """Distinct n-grams of a paragraph that the model knows, sorted. The templates' word pairs are among them."""
    known = sorted({w for g in model.vocabulary for w in g.split(" ")})
    marks = F.transform(_words(paragraph), lambda w: F.when(w.isin(known), w).otherwise(""))

    def of_length(words: Column, n: int) -> Column:
        return F.transform(words, lambda w, i: F.when(w != "", F.concat_ws(" ", *[F.get(words, i + k) for k in range(n)])))

    def at(words: Column) -> Column:
        return F.filter(F.concat(*[of_length(words, n) for n in NGRAMS]), lambda g: g.isin(list(model.vocabulary)))

    return F.array_sort(F.array_distinct(F.element_at(F.transform(F.array(marks), at), 1)))


def _may_name_a_family(grams: Column, model: Model) -> Column:
    """False only where no family can come before unknown: the n-grams' best weights do not make up for the intercepts."""
    def most(total: Column, gram: Column) -> Column:
        best = F.lit(0.0)
        for weight, of in model.favours.items():
            best = F.when(gram.isin(of), F.lit(weight)).otherwise(best)
        return total + best

    return F.aggregate(grams, F.lit(0.0), most) >= model.lacks - 1e-6


def classify(paragraphs: DataFrame, model: Model) -> DataFrame:
    """(paragraph, family, probability, confirmed) of the distinct paragraphs that the model takes for a licence.

    A paragraph is given by the n-grams of it that the model knows (as of `_grams`, joined by "|").
    """
    spark: SparkSession = paragraphs.sparkSession
    names = [f"w{k}" for k in range(len(model.families))]
    weights = spark.createDataFrame([(g, *map(float, model.weights[i])) for g, i in model.vocabulary.items()],
                                    ", ".join(["gram string", *[f"{c} double" for c in names]]))
    shingles = [(i, f, s) for i, (f, t) in enumerate(model.templates) for s in sorted(_pairs(tokens(t)))]
    size = {i: sum(1 for j, _, _ in shingles if j == i) for i in range(len(model.templates))}
    template = spark.createDataFrame([(i, f, s, size[i]) for i, f, s in shingles], "template int, family string, gram string, size int")

    known = stage(paragraphs.select("paragraph").distinct().withColumn("_id", F.monotonically_increasing_id()), "licence-paragraphs")
    grams = known.select("_id", F.explode(F.split("paragraph", r"\|")).alias("gram"))
    # The model's few n-grams go to the tasks, so each paragraph is summed up where it is.
    z = grams.join(F.broadcast(weights), "gram", "left").groupBy("_id").agg(*[F.sum(F.coalesce(c, F.lit(0.0))).alias(c) for c in names])
    z = z.select("_id", F.array(*[(F.col(c) + float(b)) / model.temperature for c, b in zip(names, model.weights[-1])]).alias("z"))
    # Families are in order, so of equal ones the first is found.
    family = F.element_at(F.array(*map(F.lit, model.families)), F.array_position("z", F.array_max("z")).cast("int"))
    top = F.array_max("z")
    best = z.select("_id", family.alias("family"), (1 / F.aggregate("z", F.lit(0.0), lambda a, x: a + F.exp(x - top))).alias("probability"))
    named = stage(known.join(best.filter(F.col("family") != UNKNOWN), "_id"), "licence-named")
    likeness = (named.select("_id", "family", F.explode(F.split("paragraph", r"\|")).alias("gram")).join(F.broadcast(template), ["family", "gram"])
                .groupBy("_id", "template", "size").count()
                .groupBy("_id").agg(F.max(F.col("count") / F.col("size")).alias("likeness")))
    return (named.join(likeness, "_id", "left")
            .select("paragraph", "family", "probability", (F.coalesce("likeness", F.lit(0.0)) >= CONFIRM).alias("confirmed")))


def _pairs(words: list[str]) -> set[str]:
    return {" ".join(p) for p in zip(words, words[1:])} or set(words)


def _units(text: Column, model: Model) -> Column:
    """(at, whole, paragraph) of the lines that may name a family, and of the paragraphs of several lines."""
    # What a paragraph lacks its lines lack, too, so only paragraphs that may name a family are cut into lines.
    cut = F.transform(F.split(text, r"\n\s*\n"), lambda p, i: F.struct(i.alias("at"), p.alias("text"), _grams(p, model).alias("grams")))

    def unit(at: Column, whole: bool, grams: Column) -> Column:
        return F.struct(at.alias("at"), F.lit(whole).alias("whole"), F.array_join(grams, "|").alias("paragraph"))

    def units(p: Column) -> Column:
        lines = F.filter(F.transform(F.split(p.text, "\n"), lambda x: _grams(x, model)), lambda g: _may_name_a_family(g, model))
        return F.concat(F.transform(lines, lambda g: unit(p.at, False, g)),
                        F.filter(F.array(unit(p.at, True, p.grams)), lambda _: F.contains(p.text, F.lit("\n"))))

    return F.flatten(F.transform(F.filter(cut, lambda p: _may_name_a_family(p.grams, model)), units))


def scan(df: DataFrame, text: str = "text", model: Model | None = None, keep_text: bool = True) -> DataFrame:
    """`df` with licences (confirmed families, sorted), n_licences and n_unconfirmed (numbers of notices), and unconfirmed
    (families that some notice was taken for and not confirmed, sorted)."""
    results = ("licences", "n_licences", "n_unconfirmed", "unconfirmed")
    own = [c for c in df.columns if c not in results and (keep_text or c != text)]
    model = model or Model()
    rows = stage(df.withColumns({"_units": _units(F.coalesce(F.col(text), F.lit("")), model), "_row": F.monotonically_increasing_id()})
                 .select(*own, "_row", "_units"), "licence-lines")
    paragraphs = rows.select("_row", F.inline("_units"))
    judged = classify(paragraphs, model)
    confirmed, whole = F.col("confirmed"), F.col("whole")

    def number(of: Column) -> Column:
        return F.sum(of.cast("long"))

    # A paragraph counts beside its lines for a family that none of them names; one it confirms needs no confirmed line.
    found = paragraphs.join(judged, "paragraph").groupBy("_row", "at", "family").agg(
        number(~whole & confirmed).alias("lines"), number(~whole & ~confirmed).alias("open_lines"),
        number(whole & confirmed).alias("wholes"), number(whole & ~confirmed).alias("open_wholes"))
    found = found.select("_row", "family", F.greatest("lines", "wholes").alias("n"),
                         F.when(F.col("wholes") > 0, 0).when(F.col("lines") > 0, F.col("open_lines"))
                         .otherwise(F.greatest("open_lines", "open_wholes")).alias("n_open"))
    per_row = found.groupBy("_row").agg(
        F.array_sort(F.collect_set(F.when(F.col("n") > 0, F.col("family")))).alias("licences"),
        F.sum("n").alias("n_licences"), F.sum("n_open").alias("n_unconfirmed"),
        F.array_sort(F.collect_set(F.when(F.col("n_open") > 0, F.col("family")))).alias("unconfirmed"))
    zero, none = F.lit(0).cast("long"), F.array().cast("array<string>")
    return rows.join(per_row, "_row", "left").select(
        *own, F.coalesce("licences", none).alias("licences"), F.coalesce("n_licences", zero).alias("n_licences"),
        F.coalesce("n_unconfirmed", zero).alias("n_unconfirmed"), F.coalesce("unconfirmed", none).alias("unconfirmed"))
