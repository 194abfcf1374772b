"""Near-duplicate vectors by sorted passes over random projection codes."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.components import connected_components
from tallyframe.llm.simhash import lowest_labels
from tallyframe.operators.ordered import with_row_index
from tallyframe.session import stored

THRESHOLD = 0.93
PASSES, MISSED = 8, 0.005  # at least so many passes; the share of pairs at the threshold that they may miss
CODE_BITS = 48
BLOCK = 256
MOST_CELLS = 1 << 21  # of a matrix of cosines that is held at once


def vector_classes(vectors: DataFrame) -> DataFrame:
    """(label, size, v, rep, copies): the distinct vectors that can link; ``rep`` is their least vec_id.

    Equal vectors of a label link with each other by cosine 1, so they travel once.
    """
    v = F.col("embedding").cast("array<double>")
    fine = F.col("label").isNotNull() & F.col("embedding").isNotNull() & F.forall(v, lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x))
    usable = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label"), v.alias("v")).where(fine & F.exists(v, lambda x: x != 0))
    return usable.groupBy("label", "v").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"))


def passes_for(rows: int, block: int = BLOCK, threshold: float = THRESHOLD) -> int:
    """How many passes miss at most MISSED of the pairs at ``threshold`` among ``rows`` vectors of a label.

    A pass puts a pair into one window if their codes agree on the leading bits that part ``rows`` vectors into
    sets of a block; each bit agrees with probability 1 - angle / pi. This takes the vectors as spread
    evenly over the codes.
    """
    bits = max(0.0, math.log2(max(rows, 1) / block))
    met = (1 - math.acos(threshold) / math.pi) ** bits
    return max(PASSES, math.ceil(math.log(MISSED) / math.log1p(-met))) if met < 1 else PASSES


def projection_codes(classes: DataFrame, passes: int, seed: int) -> DataFrame:
    """Per distinct vector and pass its code: the signs of CODE_BITS random projections, one after the other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        weights = 1 << np.arange(CODE_BITS - 1, -1, -1, dtype=np.int64)
        for batch in batches:
            rows = batch.column(0).to_pylist()
            sizes = np.array([len(row) for row in rows])
            codes = np.zeros((len(rows), passes), np.int64)
            for size in set(sizes.tolist()):
                own = np.flatnonzero(sizes == size)
                if size not in planes:
                    planes[size] = np.random.default_rng([seed, size]).standard_normal((size, passes * CODE_BITS))
                matrix = np.array([rows[k] for k in own], float)
                for at in range(passes):  # one by one, so memory does not grow with their number
                    codes[own, at] = (matrix @ planes[size][:, at * CODE_BITS : (at + 1) * CODE_BITS] > 0) @ weights
            found = pa.ListArray.from_arrays(np.arange(0, codes.size + 1, passes, dtype=np.int32), pa.array(codes.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, found], [*batch.schema.names, "codes"])

    label = classes.schema["label"].dataType.simpleString()
    ordered = classes.select("v", "label", "rep", "copies")
    return ordered.mapInArrow(run, f"v array<double>, label {label}, rep long, copies long, codes array<long>")


def _unit(rows: list[list[float]]) -> np.ndarray:
    matrix = np.array(rows, float)
    matrix = matrix / np.abs(matrix).max(axis=1, keepdims=True)
    return matrix / np.sqrt((matrix * matrix).sum(axis=1, keepdims=True))


def _classes(table: pa.Table) -> Iterator[np.ndarray]:
    """Row numbers of each (label, length of vector) in a table."""
    groups: dict[tuple, list[int]] = {}
    for at, key in enumerate(zip(table["label"].to_pylist(), (len(row) for row in table["v"].to_pylist()))):
        groups.setdefault(key, []).append(at)
    return (np.array(own) for own in groups.values() if len(own) > 1)


def _stars(threshold: float):
    """Links of a block and of the block with the one before it, as stars to the least rep."""

    def run(table: pa.Table) -> pa.Table:
        reps, vectors, before = table["rep"].to_numpy(), table["v"].to_pylist(), table["before"].to_numpy(zero_copy_only=False)
        a, b = [], []
        for own in _classes(table):
            own = own[np.argsort(reps[own], kind="stable")]
            unit = _unit([vectors[k] for k in own])
            close = np.triu(unit @ unit.T >= threshold, 1)
            close &= ~(before[own][:, None] & before[own][None, :])
            labels = lowest_labels(len(own), *np.nonzero(close))
            moved = np.flatnonzero(labels != np.arange(len(own)))
            a.append(reps[own[moved]])
            b.append(reps[own[labels[moved]]])
        empty = [np.zeros(0, np.int64)]
        return pa.table({"a": np.concatenate(a + empty), "b": np.concatenate(b + empty)})

    return run


def neighbour_links(coded: DataFrame, passes: int, block: int = BLOCK, threshold: float = THRESHOLD) -> DataFrame:
    """(a, b) links between representatives that connect the close pairs met in all passes.

    Each pass orders the vectors of a label by their code. The rows of all passes get one global
    position; a row is compared with those of its block and of the block before, so it meets at
    least ``block`` neighbours on either side. Blocks have a fixed size whatever the label or the code
    holds. The cosine of each pair met is computed; only stars leave a block.
    """
    each = coded.select("v", "label", "rep", F.posexplode("codes").alias("pass", "code"))
    order = [F.col(name) for name in ("pass", "label")] + [F.size("v"), F.col("code"), F.col("rep")]
    placed = with_row_index(each, order, "at").withColumn("own", F.floor(F.col("at") / block))
    spread = placed.withColumn("block", F.explode(F.array("own", F.col("own") + 1))).withColumn("before", F.col("block") > F.col("own"))
    return spread.select("block", "v", "label", "rep", "before").groupBy("block").applyInArrow(_stars(threshold), "a long, b long")


def _counts(threshold: float):
    """Per row how many rows (with their copies) it links to, within a pair of chunks."""

    def run(table: pa.Table) -> pa.Table:
        reps, copies = table["rep"].to_numpy(), table["copies"].to_numpy()
        asks, vectors = table["asks"].to_numpy(zero_copy_only=False), table["v"].to_pylist()
        unit, links = _unit(vectors), np.zeros(len(reps), np.int64)
        step = max(1, MOST_CELLS // max(len(reps), 1))
        for at in range(0, len(reps), step):  # blocks of rows, so memory does not grow with the square of a unit
            own = np.arange(at, min(at + step, len(reps)))
            close = unit[own] @ unit.T >= threshold
            close[own - at, own] = False
            if asks.any():  # two chunks: only pairs across
                close &= asks[own, None] != asks[None, :]
            links[own] = close @ copies
        return pa.table({"rep": reps, "links": links})

    return run


def count_links(members: DataFrame, threshold: float = THRESHOLD, chunk: int = 32, most_chunks: int = 64) -> DataFrame:
    """(rep, links) for ``members`` (component, rep, copies, v): all pairs of a component are compared.

    A component is cut into chunks, at most ``most_chunks``, and each pair of chunks is a group of
    its own; a group returns one count per row, so no pair is written. Chunks grow with a component
    beyond that, but a group compares them in blocks of rows of at most MOST_CELLS cosines.
    """
    sizes = members.groupBy("component").agg(F.count(F.lit(1)).alias("rows"))
    chunks = F.least(F.ceil(F.col("rows") / chunk), F.lit(most_chunks)).cast("long")
    cut = members.join(sizes, "component").withColumn("chunks", chunks).withColumn("own", F.pmod(F.xxhash64("rep"), "chunks"))
    paired = cut.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
    unit = (F.least("own", "other") * F.col("chunks") + F.greatest("own", "other")).alias("unit")
    dealt = paired.select("component", unit, "rep", "copies", "v", (F.col("own") > F.col("other")).alias("asks"))
    dealt = dealt.repartition("component", "unit")  # the join left all units of a component in one partition
    counted = dealt.groupBy("component", "unit").applyInArrow(_counts(threshold), "rep long, links long")
    return counted.groupBy("rep").agg(F.sum("links").alias("links"))


def near_duplicate_vectors(vectors: DataFrame, threshold: float = THRESHOLD, passes: int | None = None, seed: int = 9) -> DataFrame:
    """(vec_id, n_links, component_id, kept): one row per row of ``vectors``.

    Vectors of one label link where their cosine in double precision is at least ``threshold``. Pairs are
    found as neighbours in sorted passes, by default as many as the largest label needs; then all pairs inside each component found are compared, so
    a group larger than a window loses no link. A vector that is null, zero, of another length, or
    holds null or non-finite components, and one without label, links with nothing and stays. Rows
    that repeat a vec_id count as vectors of their own. An empty table gives no rows; other columns
    are ignored.
    """
    if passes is None:
        passes = passes_for(vectors.groupBy("label").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0)
    classes = stored(projection_codes(vector_classes(vectors).where("rep IS NOT NULL"), passes, seed), "codes")
    links = neighbour_links(classes, passes, threshold=threshold)
    found = connected_components(links).withColumnRenamed("node", "rep")
    members = stored(classes.select("rep", "copies", "v").join(found, "rep"), "members")
    counted = count_links(members, threshold)
    per_class = classes.select("label", "v", "rep", "copies").join(members.select("rep", "component"), "rep", "left").join(counted, "rep", "left")
    total = F.coalesce("links", F.lit(0)) + F.col("copies") - 1
    per_class = per_class.select(F.col("label").alias("_label"), F.col("v").alias("_v"), total.alias("_links"), F.coalesce("component", "rep").alias("_component"))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label"), F.col("embedding").cast("array<double>").alias("v"))
    named = rows.join(per_class, (F.col("label") == F.col("_label")) & (F.col("v") == F.col("_v")), "left")
    component = F.coalesce("_component", "vec_id").alias("component_id")
    kept = F.col("vec_id").eqNullSafe(F.coalesce("_component", "vec_id")).alias("kept")
    return named.select("vec_id", F.coalesce("_links", F.lit(0)).cast("long").alias("n_links"), component, kept)
