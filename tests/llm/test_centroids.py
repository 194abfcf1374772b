"""Centroid clustering against plain whole-number arithmetic."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest

import check
from tallyframe.llm import centroids, checks, registry

FOLDER = "/root/testdata/sf0.001"
LAYOUT = "vec_id long, embedding array<double>, label int, cluster int, v string, distance string"


def brute(rows, clusters=40, rounds=5):
    kept = [(i, [math.floor(256 * x) for x in v]) for i, v, *_ in rows if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    name = lambda i: hashlib.sha256(f"2:{'' if i is None else i}".encode()).hexdigest()
    middle = [v for i, v in sorted(kept, key=lambda r: (name(r[0]), r[1]))[:clusters]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(middle))
    for _ in range(rounds):
        own = [near(v)[1] for _, v in kept]
        for j in set(own):
            members = [v for (_, v), k in zip(kept, own) if k == j]
            middle[j] = [sum(column) // len(members) for column in zip(*members)]
    found = [(i, *near(v)) for i, v in kept]
    whole = sum(d for _, d, _ in found)
    for i, d, j in found:
        yield i, j, d, sum(e for _, e, k in found if k == j), whole, hashlib.sha256(",".join(map(str, middle[j])).encode()).hexdigest()


def awkward():
    rng = np.random.default_rng(1)
    rows = [(i, (rng.standard_normal(64) * 0.2).tolist(), 1, 1, "x", None) for i in range(90)]
    rows += [(i, rows[0][1], 1, None, None, None) for i in range(100, 130)]  # copies
    rows += [(5, rows[3][1], None, None, None, None), (None, rows[4][1], None, None, None, None), (200, [0.0] * 64, None, None, None, None)]
    broken = [[0.5] * 63, [0.5] * 65, [], None, [None] + [0.1] * 63, [math.nan] + [0.1] * 63, [math.inf] + [0.1] * 63]
    return rows + [(300 + k, v, 2, None, None, None) for k, v in enumerate(broken)]


def _sorted(rows):
    return sorted(map(tuple, rows), key=repr)


def test_clusters_of_awkward_vectors(spark):
    rows = awkward()
    assert _sorted(centroids.cluster_vectors(spark.createDataFrame(rows, LAYOUT)).collect()) == _sorted(brute(rows))


def test_large_components_stay_exact(spark):
    rng = np.random.default_rng(2)
    rows = [(i, (rng.standard_normal(64) * (1e5 if i % 2 else 1.0)).tolist(), 1, 1, "x", None) for i in range(60)]
    assert _sorted(centroids.cluster_vectors(spark.createDataFrame(rows, LAYOUT)).collect()) == _sorted(brute(rows))
    rows[0] = (0, [1e12] + [0.0] * 63, 1, 1, "x", None)
    rows[1] = (1, [-1e12] + [0.0] * 63, 1, 1, "x", None)
    found = centroids.cluster_vectors(spark.createDataFrame(rows, LAYOUT), clusters=1).collect()
    assert sum(row["distance"] is None for row in found) == 2 and {row["inertia"] for row in found} == {None}


def test_few_or_no_vectors(spark):
    few = awkward()[:7]
    assert _sorted(centroids.cluster_vectors(spark.createDataFrame(few, LAYOUT)).collect()) == _sorted(brute(few))
    assert centroids.cluster_vectors(spark.createDataFrame([], LAYOUT)).collect() == []


def test_clusters_equal_their_sql(spark):
    database = check.connect(FOLDER)
    assert check.difference(spark, database, FOLDER, registry.op11_centroids, checks.ORACLES["op11_centroids"]) is None


@pytest.mark.parametrize("spread", [2, 300, 1 << 23])
def test_progressive_search_finds_the_first_nearest(spread):
    rng = np.random.default_rng(spread)
    vectors, middle = rng.integers(-spread, spread, (700, 64)), rng.integers(-spread, spread, (40, 64))
    middle[7] = middle[3]  # a tie
    vectors[:5] = middle[7]
    apart = ((vectors[:, None] - middle[None]) ** 2).sum(axis=2)
    found, distance = centroids.nearest(vectors, middle)
    assert (found == apart.argmin(axis=1)).all() and (distance == apart.min(axis=1)).all()


def test_transform_keeps_distances():
    rng = np.random.default_rng(4)
    a, b = rng.integers(-99, 99, (2, 5, 64))
    apart = centroids.hadamard(a) - centroids.hadamard(b)
    assert ((apart**2).sum(axis=1) == 64 * ((a - b) ** 2).sum(axis=1)).all()
    assert sorted(centroids.by_changes()) == list(range(64))
