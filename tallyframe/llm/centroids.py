"""Clustering of integer vectors; the nearest centroid is found in Walsh-Hadamard coefficients, coarse to fine."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.session import stored

SIZE = 64
SCALE = 256
CLUSTERS, ROUNDS, SEED = 40, 5, 2
STEPS = (4, 8, 16, 32, 64)  # coefficients taken into account after each step
ROWS = 1024  # vectors searched at once
EXACT = 1 << 24  # components up to this keep every sum of 64 squared coefficients below 2**63
WIDEST = 1 << 62


def by_changes(size: int = SIZE) -> np.ndarray:
    """Rows of the Hadamard matrix by number of sign changes, fewest first."""
    signs = hadamard(np.eye(size, dtype=np.int64))
    return np.argsort((np.diff(signs, axis=1) != 0).sum(axis=1), kind="stable")


def hadamard(rows: np.ndarray) -> np.ndarray:
    """The Walsh-Hadamard transform of each row, in whole numbers and without a factor: squared distances grow by the row length."""
    count, size = rows.shape
    half = 1
    while half < size:
        pairs = rows.reshape(count, size // (2 * half), 2, half)
        rows = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(count, size)
        half *= 2
    return rows


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the nearest centroid, squared distance) per row; of equally near ones the smallest number.

    The differences of coefficients are squared and added from the coarse ones on, so a partial sum is never
    above the whole. After each step the centroid that leads is measured in full, and those whose
    partial sum is strictly above the least full one are given up; the others go through all coefficients.
    Components beyond EXACT are computed in Python's whole numbers.
    """
    wide = max((int(abs(part).max()) for part in (vectors, centroids) if part.size), default=0) > EXACT
    kind = object if wide else np.int64
    order = by_changes()
    points = [hadamard(part.astype(kind))[:, order] for part in (vectors, centroids)]
    found, distances = np.zeros(len(vectors), np.int64), np.zeros(len(vectors), kind)
    for at in range(0, len(vectors), ROWS):
        x, c = points[0][at : at + ROWS], points[1]
        every = np.arange(len(x))
        partial = np.zeros((len(x), len(c)), kind)
        alive = np.ones(partial.shape, bool)
        bound, low = None, 0
        for high in STEPS:
            row, number = np.nonzero(alive)
            apart = x[row, low:high] - c[number, low:high]
            partial[row, number] += (apart * apart).sum(axis=1)
            best = np.where(alive, partial, partial.max() + 1).argmin(axis=1)
            apart = x[:, high:] - c[best, high:]
            whole = partial[every, best] + (apart * apart).sum(axis=1)
            bound = whole if bound is None else np.minimum(bound, whole)
            alive &= (partial <= bound[:, None]).astype(bool)
            low = high
        found[at : at + ROWS] = best
        distances[at : at + ROWS] = bound
    return found, distances // SIZE


def whole_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, v): the usable vectors as doubles: SIZE components, none null or not finite."""
    v = F.col("embedding").cast("array<double>")
    fine = (F.size(v) == SIZE) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < WIDEST / SCALE))
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).where(F.col("embedding").isNotNull() & fine)


def _integers(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return np.floor(SCALE * flat.reshape(len(column), SIZE)).astype(np.int64)


def seed_centroids(kept: DataFrame, clusters: int = CLUSTERS, seed: int = SEED) -> np.ndarray:
    """The scaled vectors with the smallest SHA-256 of ``seed:vec_id``, in that order."""
    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    first = kept.select(drawn.alias("drawn"), "v").orderBy("drawn", "v").limit(clusters).collect()
    rows = [row["v"] for row in sorted(first, key=lambda row: (row["drawn"], row["v"]))]
    return np.floor(SCALE * np.array(rows, float).reshape(len(rows), SIZE)).astype(np.int64)


def cluster_sums(kept: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(cluster, place, total, n): component sums of the vectors nearest to each centroid.

    Each task sends one row per cluster and component, whatever it read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, counts = np.zeros((len(centroids), SIZE), object), np.zeros(len(centroids), np.int64)
        for batch in batches:
            vectors = _integers(batch.column(0))
            own, _ = nearest(vectors, centroids)
            if abs(vectors).max(initial=0) > EXACT:
                vectors = vectors.astype(object)
            for cluster in np.unique(own):
                members = vectors[own == cluster]
                totals[cluster] = totals[cluster] + members.sum(axis=0)
                counts[cluster] += len(members)
        full = np.flatnonzero(counts)
        columns = [
            pa.array(np.repeat(full, SIZE), pa.int32()),
            pa.array(np.tile(np.arange(SIZE), len(full)), pa.int32()),
            pa.array([Decimal(int(value)) for value in totals[full].ravel()], pa.decimal128(38, 0)),
            pa.array(np.repeat(counts[full], SIZE), pa.int64()),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["cluster", "place", "total", "n"])

    parts = kept.select("v").mapInArrow(run, "cluster int, place int, total decimal(38,0), n long")
    return parts.groupBy("cluster", "place").agg(F.sum("total").cast("decimal(38,0)").alias("total"), F.sum("n").alias("n"))


def assigned(kept: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(vec_id, cluster, distance) per vector; a distance of 2**63 or more is null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, distance = nearest(_integers(batch.column(1)), centroids)
            fits = pa.array([int(d) if d < 2**63 else None for d in distance] if distance.dtype == object else distance, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(own, pa.int32()), fits], ["vec_id", "cluster", "distance"])

    return kept.mapInArrow(run, "vec_id long, cluster int, distance long")


def cluster_vectors(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED) -> DataFrame:
    """One row per usable vector: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    Vectors that are null, of another length than SIZE, or hold null or non-finite components are left out, as are those with
    components of 2**54 and more; a distance or inertia that does not fit a long is null. Rows that repeat a vec_id
    are vectors of their own, a null vec_id is drawn by the hash of ``seed:`` alone. Fewer vectors than clusters give fewer
    clusters, an empty table no rows; other columns are ignored. Each round reads the vectors once and moves
    ``clusters`` x SIZE sums per task; those of all tasks together, as many, come to the driver.
    """
    kept = whole_vectors(vectors)
    centroids = seed_centroids(kept, clusters, seed)
    layout = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    if not len(centroids):
        return vectors.sparkSession.createDataFrame([], layout)
    for _ in range(rounds):
        for row in cluster_sums(kept, centroids).collect():
            centroids[row["cluster"], row["place"]] = int(row["total"]) // row["n"]
    found = stored(assigned(kept, centroids), "assigned")
    sums = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("sum"), (F.count("distance") < F.count(F.lit(1))).alias("gap"))
    inertia = {row["cluster"]: None if row["gap"] else int(row["sum"]) for row in sums.collect()}
    whole = None if None in inertia.values() else sum(inertia.values())
    names = [hashlib.sha256(",".join(map(str, row.tolist())).encode()).hexdigest() for row in centroids]
    fits = lambda value: value if value is not None and value < 2**63 else None
    rows = [(cluster, fits(value), fits(whole), names[cluster]) for cluster, value in sorted(inertia.items())]
    table = vectors.sparkSession.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(table), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
