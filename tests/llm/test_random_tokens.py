"""Random tokens are found by the tests' own distributions, whatever else the corpus holds."""

from __future__ import annotations

import numpy as np

from tallyframe.llm import secrets_scan

WORDS = "responsibilities internationalization averyordinaryidentifier spark-sql-shuffle-partitions tallyframe/llm/secrets_scan getElementsByClassName2 2024-11-12T10-15-30 ---------------- counterrevolutionaries"


def test_random_tokens_of_few_rows_are_found(spark):
    rng = np.random.default_rng(12)
    alphabets = (secrets_scan._SYMBOLS, "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "abcdefghijklmnopqrstuvwxyz", "0123456789ABCDEF")
    tokens = ["".join(rng.choice(list(letters), 96)) for letters in alphabets for _ in range(5)]
    tokens += ["".join(rng.choice(list(secrets_scan._SYMBOLS), 40)) for _ in range(10)]
    for repeats in (1, 40):  # the same tokens stand out among few and among many ordinary ones
        rows = [(k, f"{WORDS} and {token} end", "x") for k, token in enumerate(tokens)] + [(1000 + k, WORDS, "x") for k in range(10 * repeats)]
        docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
        found = {r["doc_id"]: [(s["start"], s["end"]) for s in r["all"]] for r in secrets_scan.find_secrets(docs).collect()}
        right = [found[k] == [(len(WORDS) + 5, len(WORDS) + 5 + len(token))] for k, token in enumerate(tokens)]
        assert sum(right) >= 0.9 * len(tokens)
        assert all(found[k] == [] for k in range(1000, 1000 + 10 * repeats))


def test_p_values_of_random_tokens_are_uniform():
    rng = np.random.default_rng(13)
    for letters in (secrets_scan._SYMBOLS, "abcdefghijklmnopqrstuvwxyz"):
        rarer, _ = secrets_scan.ranks(["".join(rng.choice(list(letters), 24)) for _ in range(500)])
        p = (1 + rarer) / (1 + secrets_scan.DRAWS)
        assert all(abs((p <= level).mean() - level) < 0.08 for level in (0.1, 0.25, 0.5, 0.75))


def test_discoveries_are_controlled_over_ordinary_tokens():
    rng = np.random.default_rng(21)
    ordinary, random = [], []
    for kind in range(4):
        for n in (16, 24, 32, 48, 64):
            ordinary += secrets_scan._ordinary(kind, n, rng)
            letters = "abcdefghijklmnopqrstuvwxyz" if kind == 3 else secrets_scan._SYMBOLS[: secrets_scan.ENCODINGS[kind][1]]
            random += ["".join(rng.choice(list(letters), n)) for _ in range(20)]
    _, usual = secrets_scan.ranks(ordinary + random)
    met = {int(s): int((usual == s).sum()) for s in np.unique(usual)}
    least = secrets_scan.discovered(met)
    false, right = (usual[: len(ordinary)] >= least).sum(), (usual[len(ordinary) :] >= least).sum()
    print("ordinary", len(ordinary), "found", false, "random", len(random), "found", right)
    assert false <= 0.03 * max(false + right, 1) and right >= 0.4 * len(random)
    none = {int(s): int((usual[: len(ordinary)] == s).sum()) for s in np.unique(usual[: len(ordinary)])}
    assert (usual[: len(ordinary)] >= secrets_scan.discovered(none)).sum() <= 4  # of 40,000, without a secret among them


def test_procedure_equals_the_plain_one():
    rng = np.random.default_rng(5)
    for _ in range(50):
        surprises = rng.integers(0, 60, 200)
        p = np.sort(2 ** (-surprises / secrets_scan.STEPS))
        passed = np.nonzero(p <= 0.01 * np.arange(1, 201) / 200)[0]
        want = (p <= p[passed[-1]]).sum() if len(passed) else 0
        least = secrets_scan.discovered({int(s): int((surprises == s).sum()) for s in set(surprises)})
        assert (surprises >= least).sum() == want


def test_tokens_that_touch_base_spans_are_left_to_them(spark):
    text = " ".join(f"token={'ab12' * 5} {'0123456789abcdef' * 2}" for _ in range(5000))
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    row = secrets_scan.find_secrets(docs).first()
    assert len(row["base"]) == 15_000 and all(s["order"] != 3 for s in row["all"])
