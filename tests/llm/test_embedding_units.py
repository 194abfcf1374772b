"""Counts of links inside one large unit."""

from __future__ import annotations

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from tallyframe.llm import embedding_dedup


@pytest.mark.parametrize("asked", [0, 2000])
def test_a_large_unit_is_counted_in_bounded_memory(asked):
    rng = np.random.default_rng(3)
    rows = 6000
    vectors = rng.standard_normal((40, 8))[rng.integers(0, 40, rows)] + 0.1 * rng.standard_normal((rows, 8))
    copies, asks = rng.integers(1, 4, rows), np.arange(rows) < asked
    table = pa.table({"rep": np.arange(rows), "copies": copies, "asks": asks, "v": vectors.tolist()})
    tracemalloc.start()
    got = embedding_dedup._counts(0.93)(table)["links"].to_numpy()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    unit = embedding_dedup._unit(vectors.tolist())
    close = unit @ unit.T >= 0.93
    np.fill_diagonal(close, False)
    if asked:
        close &= asks[:, None] != asks[None, :]
    assert (got == close @ copies).all()
    assert peak < 100e6  # the whole matrix of cosines would take 288 MB
