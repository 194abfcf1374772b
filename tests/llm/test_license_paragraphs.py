"""Licence notices are found in titles, identifiers and wrapped paragraphs, and agree with a plain version."""

from __future__ import annotations

import re

import numpy as np
import pytest

from tallyframe.llm import licenses

FOLDER = "/root/testdata/sf0.001"
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction."""
APACHE = """// Licensed under the Apache License, Version 2.0 (the "License");
// you may not use this file except in compliance with the License.
// You may obtain a copy of the License at
//
//     http://www.apache.org/licenses/LICENSE-2.0"""
CASES = [
    ("MIT License", {"MIT"}),
    ("# SPDX-License-Identifier: MIT\nimport os", {"MIT"}),
    ("/* SPDX-License-Identifier: Apache-2.0 */", {"Apache-2.0"}),
    ("SPDX-License-Identifier: GPL-3.0-or-later", {"GPL"}),
    (MIT, {"MIT"}),
    ("/*\n" + "\n".join(" * " + line for line in MIT.split("\n")) + "\n */", {"MIT"}),
    (APACHE, {"Apache-2.0"}),
    ("Licensed under the Foo Bar License, version 9.", {"unknown"}),
    ("mit der Zeit under the bridge", set()),
    ("The fees are in the general terms.\nThe public library was free of charge.", set()),
    ("", set()),
    (None, set()),
]


@pytest.fixture(scope="module")
def model(spark):
    return licenses.fit(licenses.sample_lines(spark.read.parquet(f"{FOLDER}/documents.parquet")))


def plain(text: str, model: licenses.Classifier) -> list[tuple[int, str]]:
    """The families of a text by loops over paragraphs and lines."""
    guard = re.compile(r"(?<![a-z0-9.+])(?:" + "|".join(map(re.escape, model.guards)) + r")(?![a-z0-9])", re.IGNORECASE | re.ASCII)
    place = {name: at for at, name in enumerate(model.features)}

    def judge(body: str) -> str:
        grams = licenses.grams_of(licenses.tokens_of(body))
        logits = (model.bias + model.weights[[place[g] for g in grams if g in place]].sum(axis=0)) / model.temperature
        best, score = int(logits.argmax()), 1 / np.exp(logits - logits.max()).sum()
        name = model.classes[best]
        if name in (licenses.NONE, licenses.UNKNOWN):
            return name
        shares = [0.0]
        for template in licenses.TEMPLATES[name]:
            own = licenses.grams_of(licenses.tokens_of(template))
            least = min(len(own), max(len(grams), licenses.SHORT))
            share = len(own & grams) / least
            shares.append(share if share >= 1 or least > licenses.WHOLE else 0.0)
        return name if score >= model.limit and max(shares) >= 0.5 else licenses.UNKNOWN

    found, block = [], []
    for at, line in enumerate([*text.split("\n"), ""], 1):
        line = re.sub(licenses.MARKS, "", line)
        if re.search(r"[^\x20\x09-\x0D]", line):
            block.append((at, line))
            continue
        held = [(n, judge(body)) for n, body in block if guard.search(body)]
        if held:
            name = judge("\n".join(body for _, body in block)) if len(block) > 1 else licenses.NONE
            wraps = name not in (licenses.NONE, licenses.UNKNOWN)
            own = [(n, f) for n, f in held if f != licenses.NONE and not (f == licenses.UNKNOWN and wraps)]
            found += own if not wraps or name in {f for _, f in own} else [(held[0][0], name), *own]
        block = []
    return sorted(found)


def families(spark, texts, model):
    docs = spark.createDataFrame([(k, text, "x") for k, text in enumerate(texts)], "doc_id long, text string, parts string")
    return {r["doc_id"]: [(f["line"], f["family"]) for f in r["found"]] for r in licenses.notices(docs, model).collect()}


def test_titles_identifiers_and_wrapped_notices(spark, model):
    got = families(spark, [text for text, _ in CASES], model)
    assert {k: {f for _, f in found} for k, found in got.items()} == {k: want for k, (_, want) in enumerate(CASES)}


def test_equal_to_a_plain_version(spark, model):
    texts = [r["text"] or "" for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("text").collect()]
    texts += [text or "" for text, _ in CASES] + ["\n\n".join(text or "" for text, _ in CASES), "\n" * 3 + "\x01" + MIT + "\n5\x01 MIT License"]
    texts += [body for family in licenses.TEMPLATES.values() for body in family]
    texts += ["Licensed under the MIT License.\nLicensed under the Apache License, Version 2.0.\n" * 50]
    got = families(spark, texts, model)
    assert {k: found for k, found in got.items()} == {k: plain(text, model) for k, text in enumerate(texts)}
