"""Licence notices in texts: a trained paragraph classifier, confirmed by comparison with templates."""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sentences of well-known public licence notices, by family.
TEMPLATES = {
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS",
    ),
    "GPL": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License",
        "You should have received a copy of the GNU General Public License along with this program.",
    ),
    "LGPL": (
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License",
    ),
    "AGPL": (
        "Licensed under the GNU Affero General Public License, version 3.",
        "You can redistribute it and/or modify it under the terms of the GNU Affero General Public License",
    ),
    "BSD": (
        "Licensed under the BSD 3-Clause License.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    "CC-BY": (
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
    ),
    "CC-BY-SA": (
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Licensed under CC BY-SA 4.0.",
    ),
    "CC-BY-NC": (
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Licensed under CC BY-NC 4.0.",
    ),
    "CC0": (
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
        "This work is dedicated to the public domain under CC0 1.0 Universal.",
    ),
    "Unlicense": ("This is free and unencumbered software released into the public domain.",),
    "ISC": ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",),
    "EPL-2.0": ("This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0",),
    "proprietary": ("All rights reserved.", "Copyright (c) 2020 Example Corporation. All rights reserved.", "Confidential and proprietary. Unauthorized copying is strictly prohibited."),
}
# Notices of no family named above, which teach the class of unknown licences.
OTHER = (
    "Licensed under the Example License, version 1.",
    "This work is licensed under the terms of the license in the accompanying file.",
    "Released under the Sample Public License.",
    "See the LICENSE file for license terms.",
    "Distributed under its own license agreement.",
    "This software is provided under a custom licence.",
    "SPDX-License-Identifier: LicenseRef-Custom",
    "SPDX-License-Identifier: NONE",
)
# Titles of licence texts, and the identifiers of the public SPDX list, by family.
TITLES = {
    "MIT": ("MIT License", "The MIT License (MIT)"),
    "Apache-2.0": ("Apache License, Version 2.0", "Apache License Version 2.0, January 2004", "http://www.apache.org/licenses/LICENSE-2.0"),
    "GPL": ("GNU General Public License Version 3", "GNU General Public License Version 2, June 1991"),
    "LGPL": ("GNU Lesser General Public License Version 3",),
    "AGPL": ("GNU Affero General Public License Version 3",),
    "BSD": ("BSD 3-Clause License", "BSD 2-Clause License"),
    "MPL-2.0": ("Mozilla Public License Version 2.0",),
    "ISC": ("ISC License",),
    "EPL-2.0": ("Eclipse Public License v 2.0",),
}
IDENTIFIERS = {
    "MIT": ("MIT",),
    "Apache-2.0": ("Apache-2.0",),
    "GPL": ("GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later"),
    "LGPL": ("LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-or-later"),
    "AGPL": ("AGPL-3.0-only", "AGPL-3.0-or-later"),
    "BSD": ("BSD-2-Clause", "BSD-3-Clause"),
    "MPL-2.0": ("MPL-2.0",),
    "CC-BY": ("CC-BY-4.0",),
    "CC-BY-SA": ("CC-BY-SA-4.0",),
    "CC-BY-NC": ("CC-BY-NC-4.0",),
    "CC0": ("CC0-1.0",),
    "Unlicense": ("Unlicense",),
    "ISC": ("ISC",),
    "EPL-2.0": ("EPL-2.0",),
}
TEMPLATES = {
    family: (*texts, *TITLES.get(family, ()), *(f"SPDX-License-Identifier: {name}" for name in IDENTIFIERS.get(family, ())))
    for family, texts in TEMPLATES.items()
}
UNKNOWN, NONE = "unknown", "none"
TOKEN = r"[a-z0-9]+(?:[.+][a-z0-9]+)*"
# Marks of comments and quotes at the start of a line, which belong to no paragraph.
MARKS = r"^[\x20\t\r]*+(?:(?://+!?|/\*+|\*+/?|#+|;+|--+|%+|<!--|\.\.(?=\x20)|>+|\x22{3}|'{3})[\x20\t\r]*+)*+"
NUMBER = "\x01"  # set between the number of a line and its text
SHORT, WHOLE = 7, 5  # a notice counts as at least SHORT words and pairs; of up to WHOLE, all must be met
MOST_DOCUMENTS, MOST_LINES = 1000, 2000  # bounds of the sample of ordinary lines


def tokens_of(text: str) -> list[str]:
    return re.findall(TOKEN, text.lower())


def grams_of(tokens: list[str]) -> set[str]:
    return {*tokens, *(f"{a} {b}" for a, b in zip(tokens, tokens[1:]))}


@dataclass
class Classifier:
    """``weights`` has a row per feature (a word or two), a column per class; ``guards`` are the words
    of which every feature holds one, so a line without any has no feature."""

    classes: list[str]
    features: list[str]
    guards: list[str]
    weights: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    limit: float = 0.5


def _rows(examples: list[list[str]], features: dict[str, int]) -> np.ndarray:
    x = np.zeros((len(examples), len(features)), np.float32)
    for row, tokens in enumerate(examples):
        x[row, [features[gram] for gram in grams_of(tokens) if gram in features]] = 1
    return x


def _softmax(logits: np.ndarray) -> np.ndarray:
    shifted = np.exp(logits - logits.max(axis=1, keepdims=True))
    return shifted / shifted.sum(axis=1, keepdims=True)


def fit(lines: list[str], seed: int = 8, rounds: int = 300, sparsity: float = 1e-4) -> Classifier:
    """Softmax regression with a sparsity penalty. Cases are the templates, whole, cut, and set into
    ordinary ``lines``; other notices teach the unknown class, lines the class of none. Words met in a
    twentieth of the lines are no features by themselves. Half of the examples fit the weights, the
    other half the temperature and the least probability that names a family with a precision of 0.98."""
    rng = np.random.default_rng(seed)
    classes = [*TEMPLATES, UNKNOWN, NONE]
    plain = [tokens for tokens in map(tokens_of, lines) if tokens] or [["text"]]
    met: dict[str, int] = {}
    for tokens in plain:
        for token in set(tokens):
            met[token] = met.get(token, 0) + 1
    sources = [(classes.index(name), tokens_of(text)) for name, texts in {**TEMPLATES, UNKNOWN: OTHER}.items() for text in texts]
    usual = {token for token, n in met.items() if n * 20 > len(plain)}
    guards = sorted({token for _, tokens in sources for token in tokens if len(token) > 1 or token.isdigit()} - usual - COMMON)
    kept = set(guards)
    features = {gram: at for at, gram in enumerate(sorted({g for _, tokens in sources for g in grams_of(tokens) if kept & set(g.split(" "))}))}
    examples, marks = [], []
    for mark, tokens in sources:
        for _ in range(24):
            size = max(min(len(tokens), 4), int(rng.integers(int(0.6 * len(tokens)), len(tokens) + 1)))
            start = int(rng.integers(0, len(tokens) - size + 1))
            around = plain[int(rng.integers(len(plain)))]
            cut = int(rng.integers(0, len(around) + 1)) if rng.random() < 0.5 else 0
            examples.append(around[:cut][-30:] + tokens[start : start + size] + (around[cut:][:30] if cut else []))
            marks.append(mark)
    loose = [token for token in guards if token.isalpha()]
    for tokens in plain:
        examples.append(tokens if rng.random() < 0.7 else [*tokens[:20], loose[int(rng.integers(len(loose)))], *tokens[20:40]])
        marks.append(len(classes) - 1)
    x, y = _rows(examples, features), np.eye(len(classes), dtype=np.float32)[marks]
    share = rng.random(len(marks)) < 0.5
    weights, bias = np.zeros((len(features), len(classes)), np.float32), np.zeros(len(classes), np.float32)
    heft = (len(marks) / (len(classes) * np.maximum(y.sum(axis=0), 1)))[marks][:, None].astype(np.float32)
    heft /= heft[share].mean()
    for _ in range(rounds):
        slope = (_softmax(x[share] @ weights + bias) - y[share]) * heft[share] / share.sum()
        weights -= 4.0 * (x[share].T @ slope)
        bias -= 4.0 * slope.sum(axis=0)
        weights = np.sign(weights) * np.maximum(np.abs(weights) - 4.0 * sparsity, 0)
    logits, truth = x[~share] @ weights + bias, np.array(marks)[~share]
    heat = min((0.5, 0.7, 1.0, 1.4, 2.0, 3.0), key=lambda t: -np.log(_softmax(logits / t)[np.arange(len(truth)), truth] + 1e-9).mean())
    p = _softmax(logits / heat)
    best, sure = p.argmax(axis=1), p.max(axis=1)
    named = best < len(TEMPLATES)
    right = [(level, (best == truth)[named & (sure >= level)].mean()) for level in np.arange(0.3, 0.96, 0.05) if (named & (sure >= level)).any()]
    limit = next((float(level) for level, hit in right if hit >= 0.98), 0.95)
    return Classifier(classes, list(features), guards, weights, bias, heat, limit)


# Words of the templates that are ordinary English, no sign of a licence by themselves.
COMMON = frozenset(
    "the a an is to any of this and all or in be may you not use file with at by on as if it can for except should have received along "
    "that found following met was one subject program library work law required writing code form source author free person obtaining "
    "files software above included substantial portions extent possible under other related rights universal made available materials "
    "without purpose fee own custom example sample corporation accompanying its see conditions forms international version basis terms "
    "unless agreed applicable associated documentation shall notice granted charge hereby 1 2 3 4 2.0 1.0 4.0 2.1 2020 cc mit general public "
    "only later nc sa style clause 3.0 january june 1991 2004 none custom mozilla modify copy copies distributed provided released included governed strictly provided domain".split()
)


def sample_lines(docs: DataFrame, most_documents: int = MOST_DOCUMENTS, most_lines: int = MOST_LINES) -> list[str]:
    """At most ``most_lines`` ordinary lines of at most ``most_documents`` documents, those of the
    smallest hashes; lines that name a licence are left out, and long ones are cut into pieces of up to 400
    characters, each of which can be drawn (only for the sample: all lines are classified whole)."""
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id IS NOT NULL").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_documents)
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "doc_id")
    lines = own.select(F.explode(F.split("text", "\n")).alias("line")).where("length(line) > 0").where(~F.col("line").rlike("(?i)licen[cs]|copyright|rights reserved|public domain"))
    pieces = F.explode(F.regexp_extract_all("line", F.lit("(?s).{1,400}"), F.lit(0)))
    rows = lines.select(pieces.alias("line")).distinct().orderBy(F.xxhash64("line"), "line").limit(most_lines).collect()
    return [row["line"] for row in rows]


def _strings(values: list[str]) -> Column:
    return F.array(*[F.lit(value) for value in values])


def _paragraphs(text: Column, guard: str) -> Column:
    """Blocks of lines that are not blank, without marks of comments, if they hold a guard word. Every line is
    led by its number and NUMBER, so the text can be cut without counting again."""
    bare = F.transform(F.split(text, "\n"), lambda line: F.regexp_replace(line, MARKS, ""))
    numbered = F.transform(bare, lambda line, at: F.when(line.rlike(r"\S"), F.concat((at + 1).cast("string"), F.lit(NUMBER), line)).otherwise(F.lit("")))
    return F.filter(F.split(F.array_join(numbered, "\n"), "\n\n+"), lambda p: p.rlike(guard))


def notices(docs: DataFrame, model: Classifier, alike: float = 0.5) -> DataFrame:
    """(doc_id, found): per row of ``docs`` an array of (line, family, score, alike, confirmed).

    A paragraph is a block of lines that are not blank, marks of comments taken off. It is scored whole,
    as a notice can be wrapped over lines, and so is each of its lines, as it can hold several notices; both only
    where they hold a guard word. Where the calibrated class is a family, one template of the family must share at
    least ``alike`` of the words and pairs of words of the shorter of the two, else the licence is unknown. A
    paragraph adds its family, at its first line with a guard word, if no line of it is confirmed as that
    family; its lines of unknown licences then go. A paragraph of an unknown licence is known by its lines only.
    Only columns of Spark, in one pass without a shuffle. Null and empty texts have no notice, a line
    of no licence has no entry, repeated rows stay, an empty table gives no rows; other columns are
    ignored.
    """
    guard = r"(?i)(?<![a-z0-9.+])(?:" + "|".join(re.escape(word) for word in model.guards) + r")(?![a-z0-9])"
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    whole = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    rows = whole.select("doc_id", F.when(F.col("text").rlike(guard), _paragraphs(F.col("text"), guard)).otherwise(F.array().cast("array<string>")).alias("paragraphs"))
    words = lambda body: F.regexp_extract_all(F.lower(body), F.lit(TOKEN), F.lit(0))
    number = lambda line: F.regexp_extract(line, "^\n*([0-9]+)" + NUMBER, 1).cast("int")
    bare = lambda body: F.regexp_replace(body, r"(?m)^[0-9]+" + NUMBER, "")

    def cut(p: Column) -> Column:
        lines = F.filter(F.split(p, "\n"), lambda line: line.rlike(guard))
        each = F.transform(lines, lambda line: F.struct(number(line).alias("line"), words(bare(line)).alias("words")))
        block = F.struct(number(lines[0]).alias("line"), words(bare(p)).alias("words"))
        return F.struct(F.when(p.rlike("\\S\n"), block).alias("whole"), each.alias("lines"))

    rows = rows.select("doc_id", F.transform("paragraphs", cut).alias("parts"))

    def step(rows: DataFrame, change) -> DataFrame:
        """``change`` made to all paragraphs and lines, from struct to struct."""
        both = lambda p: F.struct(F.when(p["whole"].isNotNull(), change(p["whole"])).alias("whole"), F.transform(p["lines"], change).alias("lines"))
        return rows.select("doc_id", F.transform("parts", both).alias("parts"))

    keep = lambda s, *names: [s[name].alias(name) for name in names]
    pairs = lambda w: F.zip_with(w, F.slice(w, 2, F.greatest(F.size(w), F.lit(1))), lambda a, b: F.concat(a, F.lit(" "), b))
    templates = [(family, grams_of(tokens_of(body))) for family, texts in TEMPLATES.items() for body in texts]
    every = sorted({*model.features, *(gram for _, grams in templates for gram in grams)})
    rows = step(rows, lambda s: F.struct(*keep(s, "line"), F.array_distinct(F.concat(s["words"], F.filter(pairs(s["words"]), lambda g: g.isNotNull()))).alias("grams")))
    rows = step(rows, lambda s: F.struct(*keep(s, "line"), F.size(s["grams"]).alias("size"), F.array_intersect(s["grams"], _strings(every)).alias("grams")))

    used = [(name, row) for name, row in zip(model.features, (model.weights / model.temperature).astype(float)) if np.abs(row).max() > 1e-6]
    table = F.map_from_arrays(_strings([name for name, _ in used]), F.array(*[F.array(*[F.lit(float(v)) for v in row]) for _, row in used]))
    bias = F.array(*[F.lit(float(v)) for v in model.bias / model.temperature])
    flat = F.array(*[F.lit(0.0) for _ in model.classes])
    add = lambda total, gram: F.zip_with(total, F.coalesce(F.try_element_at(table, gram), flat), lambda a, b: a + b)
    rows = step(rows, lambda s: F.struct(*keep(s, "line", "size", "grams"), F.aggregate(s["grams"], bias, add).alias("logits")))
    scaled = lambda s: F.transform(s["logits"], lambda v: F.exp(v - F.array_max(s["logits"])))
    place = lambda s: F.array_position(s["logits"], F.array_max(s["logits"])).cast("int")
    chance = lambda s: F.lit(1.0) / F.aggregate(scaled(s), F.lit(0.0), lambda a, b: a + b)
    rows = step(rows, lambda s: F.struct(*keep(s, "line", "size", "grams"), F.element_at(_strings(model.classes), place(s)).alias("class"), chance(s).alias("score")))

    def compared(s: Column) -> Column:
        shares = []
        for family, grams in templates:
            least = F.least(F.lit(len(grams)), F.greatest(s["size"], F.lit(SHORT)))
            share = F.size(F.array_intersect(s["grams"], _strings(sorted(grams)))) / least
            shares.append(F.when((s["class"] == family) & ((share >= 1) | (least > WHOLE)), share).otherwise(0.0))
        return F.struct(*keep(s, "line", "class", "score"), F.least(F.lit(1.0), F.greatest(*shares)).alias("alike"))

    rows = step(rows, compared)
    confirmed = lambda s: (s["class"] != NONE) & (s["class"] != UNKNOWN) & (s["score"] >= model.limit) & (s["alike"] >= alike)
    family = lambda s: F.when(confirmed(s), s["class"]).when(s["class"] != NONE, UNKNOWN).otherwise(NONE)
    rows = step(rows, lambda s: F.struct(*keep(s, "line"), family(s).alias("family"), *keep(s, "score", "alike"), confirmed(s).alias("confirmed")))

    def decided(p: Column) -> Column:
        wraps = F.coalesce(p["whole"]["confirmed"], F.lit(False))
        same = F.exists(p["lines"], lambda s: s["family"] == p["whole"]["family"])
        lines = F.filter(p["lines"], lambda s: s["confirmed"] | ((s["family"] != NONE) & ~wraps))
        return F.when(wraps & ~same, F.concat(F.array(p["whole"]), lines)).otherwise(lines)

    return rows.select("doc_id", F.array_sort(F.flatten(F.transform("parts", decided))).alias("found"))


def license_report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_notices, n_confirmed, families, notices): families in order of name, each once;
    notices as ``line:family`` in the order of the text; one row per row of ``docs``."""
    rows = notices(docs, fit(sample_lines(docs)))
    families = F.array_join(F.array_sort(F.array_distinct(F.transform("found", lambda s: s["family"]))), ",")
    listed = F.array_join(F.transform("found", lambda s: F.concat_ws(":", s["line"].cast("string"), s["family"])), ",")
    counts = F.size("found").cast("long").alias("n_notices"), F.size(F.filter("found", lambda s: s["confirmed"])).cast("long").alias("n_confirmed")
    return rows.select("doc_id", *counts, families.alias("families"), listed.alias("notices"))
