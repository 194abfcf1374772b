"""Recall of the sorted passes on labels far larger than their window."""

from __future__ import annotations

import numpy as np
import pytest

from tallyframe.llm import embedding_dedup


@pytest.mark.parametrize("rows", [2_000, 200_000])
def test_planted_pairs_meet_in_some_pass(rows):
    """The passes by numpy: pairs at cosine 0.93 among random vectors, all of one label."""
    rng = np.random.default_rng(4)
    pairs, size, passes = 1000, 64, embedding_dedup.passes_for(rows)
    base = rng.standard_normal((rows - pairs, size))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    side = rng.standard_normal((pairs, size))
    side -= (side * base[:pairs]).sum(axis=1, keepdims=True) * base[:pairs]
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    vectors = np.vstack([base, 0.93 * base[:pairs] + np.sqrt(1 - 0.93**2) * side])
    met = np.zeros(pairs, bool)
    for _ in range(passes):
        signs = vectors @ rng.standard_normal((size, embedding_dedup.CODE_BITS)) > 0
        place = np.argsort(np.argsort(signs @ (1 << np.arange(embedding_dedup.CODE_BITS - 1, -1, -1)), kind="stable"), kind="stable")
        block = place // embedding_dedup.BLOCK
        met |= np.abs(block[:pairs] - block[rows - pairs :]) <= 1
    assert met.mean() >= 0.985


def test_recall_against_brute_force_on_one_large_label(spark):
    rng = np.random.default_rng(5)
    rows, pairs, size = 12_000, 1000, 16
    base = rng.standard_normal((rows - pairs, size))
    near = base[:pairs] + 0.08 * np.linalg.norm(base[:pairs], axis=1, keepdims=True) * rng.standard_normal((pairs, size))
    vectors = np.vstack([base, near]).round(4)
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    links = np.array([(unit[at : at + 1000] @ unit.T >= 0.93).sum(axis=1) - 1 for at in range(0, rows, 1000)]).ravel()
    assert (links > 0).sum() > 1000
    frame = spark.createDataFrame([(k, 1, row) for k, row in enumerate(vectors.tolist())], "vec_id long, label int, embedding array<double>")
    got = {r["vec_id"]: r["n_links"] for r in embedding_dedup.near_duplicate_vectors(frame).collect()}
    linked = [k for k in range(rows) if links[k]]
    assert sum(got[k] == links[k] for k in linked) >= 0.985 * len(linked) and all(got[k] <= links[k] for k in range(rows))
