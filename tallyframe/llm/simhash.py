"""Near-duplicate texts by SimHash fingerprints linked within a Hamming radius through BK-trees."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.components import connected_components
from tallyframe.session import stored

SEED = 42
RADIUS = 3
BITS = 64
LEAF = 16


def fingerprint(data: bytes, words: int = 3) -> int:
    """The unsigned 64-bit fingerprint of a UTF-8 text (``bytes`` methods touch ASCII only)."""
    parts = data.lower().split()
    if not parts:
        return 0
    joined, take = b" ".join(parts), min(words, len(parts))
    starts = [0, *accumulate(len(part) + 1 for part in parts)]
    digest = xxhash.xxh64_intdigest
    hashes = [digest(joined[start : end - 1], SEED) for start, end in zip(starts, starts[take:])]
    bits = np.unpackbits(np.array(hashes, np.uint64).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    majority = 2 * bits.sum(axis=0, dtype=np.int64) > len(hashes)
    return int(np.packbits(majority, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """(doc_id, fp): one row per row of ``docs``; a null text counts as empty, fp is a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(text or b"", words) for text in batch.column(1).cast(pa.binary()).to_pylist()]
            signed = pa.array(np.array(found, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), signed], ["doc_id", "fp"])

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(run, "doc_id long, fp long")


def bits_apart(left: np.ndarray, right: np.ndarray, wide: bool = False) -> np.ndarray:
    """Hamming distances of 64-bit values; those of wide ones have their words along the last axis."""
    apart = np.bitwise_count(left ^ right)
    return apart.sum(axis=-1, dtype=np.uint16) if wide else apart


def bk_tree(values: np.ndarray, most: int = LEAF) -> list:
    """Nodes (pivot, members of a leaf or None, {distance: child}); children are keyed by the integer
    Hamming distance to the pivot, and sets of up to ``most`` values stay together as a leaf. Values are
    64-bit numbers or, wide ones, rows of them."""
    nodes, todo, wide = [], [(np.arange(len(values)), None, 0)], values.ndim > 1
    while todo:
        members, parent, distance = todo.pop()
        if parent is not None:
            nodes[parent][2][distance] = len(nodes)
        if len(members) <= most:
            nodes.append((None, members, {}))
            continue
        pivot, rest = members[0], members[1:]
        apart = bits_apart(values[rest], values[pivot], wide)
        todo.extend((rest[apart == d], len(nodes), int(d)) for d in np.unique(apart))
        nodes.append((pivot, None, {}))
    return nodes


def within(nodes: list, values: np.ndarray, asked: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(query, value) index pairs at most ``radius`` apart. All queries go down the tree together;
    each follows only the edges whose distance differs from its own by at most the radius."""
    left, right, todo, wide = [], [], [(0, np.arange(len(asked)))], values.ndim > 1
    while todo:
        at, queries = todo.pop()
        pivot, members, children = nodes[at]
        if members is not None:
            i, j = np.nonzero(bits_apart(asked[queries][:, None], values[members][None, :], wide) <= radius)
            left.append(queries[i])
            right.append(members[j])
            continue
        apart = bits_apart(asked[queries], values[pivot], wide).astype(np.int64)
        hit = queries[apart <= radius]
        left.append(hit)
        right.append(np.full(len(hit), pivot))
        for distance, child in children.items():
            near = queries[np.abs(apart - distance) <= radius]
            if len(near):
                todo.append((child, near))
    return np.concatenate(left), np.concatenate(right)


def lowest_labels(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Per item the smallest item it is connected with."""
    labels = np.arange(n)
    while True:
        low = np.minimum(labels[left], labels[right])
        after = labels.copy()
        np.minimum.at(after, left, low)
        np.minimum.at(after, right, low)
        after = after[after]
        if np.array_equal(after, labels):
            return labels
        labels = after


def _link_shard(fp: np.ndarray, doc: np.ndarray, asks: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of one shard, as stars to the smallest doc. ``asks`` marks rows that only ask the tree."""
    order = np.argsort(doc, kind="stable")
    fp, doc, asks = fp[order], doc[order], asks[order]
    tree = np.flatnonzero(~asks)
    queries = np.flatnonzero(asks) if asks.any() else tree
    if not len(tree):
        return doc[:0], doc[:0]
    i, j = within(bk_tree(fp[tree]), fp[tree], fp[queries], radius)
    labels = lowest_labels(len(fp), queries[i], tree[j])
    moved = np.flatnonzero(labels != np.arange(len(fp)))
    return doc[moved], doc[labels[moved]]


def _link_leaves(fp: np.ndarray, doc: np.ndarray, run: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """The same for many shards at once whose trees are a single leaf; ``run`` numbers them in order."""
    left, right = [], []
    for apart in range(1, min(LEAF, len(fp))):
        close = (run[apart:] == run[:-apart]) & (np.bitwise_count(fp[apart:] ^ fp[:-apart]) <= radius)
        left.append(np.flatnonzero(close))
        right.append(left[-1] + apart)
    if not left:
        return doc[:0], doc[:0]
    ends, inverse = np.unique(np.concatenate(left + right), return_inverse=True)
    order = np.argsort(doc[ends], kind="stable")
    place = np.argsort(order, kind="stable")[inverse]
    labels = lowest_labels(len(ends), place[: len(place) // 2], place[len(place) // 2 :])
    moved = np.flatnonzero(labels != np.arange(len(ends)))
    ordered = doc[ends][order]
    return ordered[moved], ordered[labels[moved]]


def _link_sorted(radius: int):
    """Links within runs of equal (shard, unit) of a partition sorted by them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[np.ndarray] | None = None

        def links(parts: list[np.ndarray], last: bool) -> tuple[pa.RecordBatch, list[np.ndarray]]:
            shard, unit, asks, fp, doc = parts
            borders = np.flatnonzero((shard[1:] != shard[:-1]) | (unit[1:] != unit[:-1])) + 1
            bounds = np.r_[0, borders, len(shard)] if last else np.r_[0, borders]
            start, sizes = int(bounds[-1]), np.diff(bounds)
            run_of = np.repeat(np.arange(len(sizes)), sizes)
            asked = np.zeros(len(sizes), bool)
            asked[run_of[asks[:start]]] = True
            leaf = (sizes <= LEAF) & ~asked
            in_leaf = leaf[run_of]
            out = [_link_leaves(fp[:start][in_leaf], doc[:start][in_leaf], run_of[in_leaf], radius)]
            for at in np.flatnonzero(~leaf):
                own = slice(bounds[at], bounds[at + 1])
                out.append(_link_shard(fp[own], doc[own], asks[own], radius))
            pairs = [np.concatenate(side) for side in zip(*out)]
            return pa.RecordBatch.from_arrays([pa.array(side) for side in pairs], ["a", "b"]), [part[start:] for part in parts]

        for batch in batches:
            parts = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(5)]
            parts[3] = parts[3].view(np.uint64)
            kept = parts if kept is None else [np.concatenate(pair) for pair in zip(kept, parts)]
            found, kept = links(kept, False)
            yield found
        if kept is not None:
            yield links(kept, True)[0]

    return run


def fingerprint_links(nodes: DataFrame, radius: int = RADIUS, shard_rows: int = 4096, most_chunks: int = 64) -> DataFrame:
    """(a, b) doc links that connect all fingerprints of ``nodes`` (fp, doc; fp distinct) within ``radius``.

    Of ``radius + 1`` blocks of bits, two fingerprints that close agree on at least one, so each
    (block, value) is a shard with a BK-tree of its own, and no pair is missed. A tree is sent to the
    task of the queries that share its block value instead of to all executors, so what travels
    does not grow with the square of the input. A shard over ``shard_rows`` is cut into chunks of
    fingerprints, at most ``most_chunks``, and each pair of chunks is a unit: the tree of one, asked
    by the other. Within a unit only stars are returned, never all pairs of a group.
    """
    blocks = radius + 1
    width = BITS // blocks
    shards = F.array(*[
        F.shiftrightunsigned("fp", width * k).bitwiseAND(F.lit((1 << width) - 1)) + F.lit(k << width) for k in range(blocks)
    ])
    spread = nodes.where("doc IS NOT NULL").select("fp", "doc", F.explode(shards).alias("shard"))
    large = spread.groupBy("shard").agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > shard_rows)
    chunks = F.when(F.col("rows").isNull(), 1).otherwise(F.least(F.ceil(F.col("rows") / shard_rows), F.lit(most_chunks)))
    own = F.pmod(F.xxhash64("fp"), F.col("chunks"))
    counted = spread.join(large, "shard", "left").withColumn("chunks", chunks.cast("long")).withColumn("own", own)
    paired = counted.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
    unit = F.least("own", "other") * F.col("chunks") + F.greatest("own", "other")
    units = paired.select("shard", unit.alias("unit"), (F.col("own") > F.col("other")).alias("asks"), "fp", "doc")
    dealt = units.repartition("shard", "unit").sortWithinPartitions("shard", "unit")
    return dealt.mapInArrow(_link_sorted(radius), "a long, b long")


def near_duplicates(docs: DataFrame, words: int = 3, radius: int = RADIUS) -> DataFrame:
    """(doc_id, fingerprint, component_id): one row per row of ``docs``.

    Fingerprints over lower-cased word shingles link at ``radius`` or fewer differing bits;
    ``component_id`` is the smallest doc_id reachable. Null and empty texts and those of white space
    only have the fingerprint of 16 zeros and link like any other; texts of fewer words than a
    shingle are one shingle. Equal texts and repeated rows share a fingerprint and a component. Rows
    without doc_id get a fingerprint, link nothing and have a null component unless others share
    their fingerprint. An empty table gives no rows; other columns are ignored.
    """
    prints = stored(fingerprints(docs, words), "fingerprints")
    nodes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("doc")), "nodes")
    found = connected_components(fingerprint_links(nodes, radius)).withColumnRenamed("node", "doc")
    classes = nodes.join(found, "doc", "left").select("fp", F.coalesce("component", "doc").alias("component_id"))
    named = F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint")
    return prints.join(classes, "fp").select("doc_id", named, "component_id")


def drop_near_duplicates(docs: DataFrame, words: int = 3, radius: int = RADIUS) -> DataFrame:
    """``docs`` with all its columns and without the documents that are near a document of smaller
    doc_id: one of each component stays. Rows that share a doc_id are one document; rows without
    doc_id stay."""
    found = near_duplicates(docs, words, radius)
    dropped = found.where("doc_id != component_id").select(F.col("doc_id").alias("_dropped")).distinct()
    return docs.join(dropped, docs["doc_id"].cast("long") == dropped["_dropped"], "left_anti")
