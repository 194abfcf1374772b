"""Near-duplicate texts by SimHash fingerprints of their word shingles in BK-trees; the exact similarity of the shingles decides."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.components import connected_components
from tallyframe.llm.simhash import bits_apart, bk_tree, lowest_labels, within
from tallyframe.session import stored

SEED = 42
WORDS = 5
SIMILARITY = 0.8
BLOCKS, WIDTH = 64, 12  # bits of a pair at 0.8 differ with probability 0.15: it agrees on a block with 1 - (1 - 0.85**12)**64 = 0.9999
PRINT_WORDS = 2  # 128 of the bits are the fingerprint that is compared in the trees
RADIUS = 36  # a pair at 0.8 has 19 differing bits on average, 36 or fewer with probability 0.99998; other texts 64
WHOLE_RADIUS = 165  # of all bits a pair at 0.8 has 116 differing on average, 124 at worst with a deviation of 10, other texts 384
FEW, FEW_RADIUS = 6, 188  # sets of 4 and 5 hashes have 144
SURE = 110  # pairs at most so far apart are mostly similar
LEAF = 64
SHARD_ROWS = 4096
ASKED = 512  # queries that go down a tree together
STEP = 255  # bits that are added up as bytes
CHUNK = 512  # documents of a band that are compared at once
COLUMNS = 4096  # shingles of a unit that are multiplied at once
SLICE = 128  # texts that are held as shingle sets at once
ROWS = 256  # documents of a band whose distances to all others are held at once


def shingle_hashes(data: bytes, words: int = WORDS) -> np.ndarray:
    """Hashes of the lower-cased word shingles of a UTF-8 text; fewer words, or none, are one shingle."""
    parts = data.lower().split()
    joined, take = b" ".join(parts), min(words, len(parts))
    starts = [0, *accumulate(len(part) + 1 for part in parts)]
    digest = xxhash.xxh64_intdigest
    spans = zip(starts, starts[take:]) if parts else [(0, 1)]
    return np.array([digest(joined[start : end - 1], SEED) for start, end in spans], np.uint64)


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Shared shingles over all shingles, of two arrays of distinct hashes."""
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return shared / (len(a) + len(b) - shared)


def fingerprint(hashes: np.ndarray) -> np.ndarray:
    """The SimHash bits of a set of hashes, as 64-bit words: a bit is 1 if set in over half of the hashes."""
    salts = np.random.default_rng(SEED).integers(0, 2**64, BLOCKS * WIDTH // 64, np.uint64)
    counts = np.zeros(BLOCKS * WIDTH, np.int64)
    for at in range(0, len(hashes), STEP):
        mixed = hashes[at : at + STEP, None] + salts
        mixed = (mixed ^ (mixed >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        mixed = (mixed ^ (mixed >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        mixed ^= mixed >> np.uint64(31)
        counts += np.add.reduce(np.unpackbits(mixed.view(np.uint8), axis=1), axis=0, dtype=np.uint8)
    return np.packbits(2 * counts > len(hashes)).view(np.uint64)


def signatures(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """(doc, whole, size, print, shards) of the documents (doc, text): a digest of the shingle set, the number of its
    shingles, the fingerprint and the number of each block of bits with its value."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, first = 1 << np.arange(WIDTH)[::-1], np.arange(BLOCKS) << WIDTH
        for batch in batches:
            for at in range(0, len(batch), SLICE):
                part = batch.slice(at, SLICE)
                wholes, sizes, prints, shards = [], [], [], []
                for text in part.column(1).cast(pa.binary()).to_pylist():
                    hashes = np.unique(shingle_hashes(text or b"", words))
                    wholes.append(xxhash.xxh128_digest(hashes.tobytes()))
                    bits = fingerprint(hashes)
                    sizes.append(len(hashes))
                    prints.append(bits.view(np.int64))
                    shards.append(np.unpackbits(bits.view(np.uint8)).reshape(BLOCKS, WIDTH) @ place + first)
                lists = [pa.array(values, pa.list_(pa.int64())) for values in (prints, shards)]
                found = [pa.array(wholes, pa.binary()), pa.array(sizes, pa.int64()), *lists]
                yield pa.RecordBatch.from_arrays([part.column(0), *found], ["doc", "whole", "size", "print", "shards"])

    return docs.mapInArrow(run, "doc long, whole binary, size long, print array<long>, shards array<long>")


def _even(left: np.ndarray, right: np.ndarray, least: float) -> np.ndarray:
    """Whether sets of these sizes can be ``least`` similar: they share at most the smaller of all in the larger."""
    return np.minimum(left, right) / np.maximum(left, right) >= least


def _close_in_leaves(prints: np.ndarray, size: np.ndarray, run: np.ndarray, radius: int, least: float, leaf: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs at most ``radius`` apart and of like size within runs of up to ``leaf`` rows; ``run`` numbers them in order."""
    left, right = [prints[:0, 0].astype(np.int64)], [prints[:0, 0].astype(np.int64)]
    for step in range(1, min(leaf, len(run))):
        rows = np.flatnonzero(run[step:] == run[:-step])
        if not len(rows):
            break
        rows = rows[_even(size[rows], size[rows + step], least)]
        rows = rows[bits_apart(prints[rows], prints[rows + step], True) <= radius]
        left.append(rows)
        right.append(rows + step)
    return np.concatenate(left), np.concatenate(right)


def _close_in_tree(prints: np.ndarray, size: np.ndarray, radius: int, least: float, leaf: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs that connect all rows of like size at most ``radius`` apart, found by a BK-tree; at most one per row and ASKED rows."""
    nodes, left, right = bk_tree(prints, leaf), [], []
    for at in range(0, len(prints), ASKED):
        i, j = within(nodes, prints, prints[at : at + ASKED], radius)
        even = _even(size[i + at], size[j], least)
        labels = lowest_labels(len(prints), i[even] + at, j[even])
        moved = np.flatnonzero(labels != np.arange(len(prints)))
        left.append(labels[moved])
        right.append(moved)
    return np.concatenate(left), np.concatenate(right)


def neighbours(prints: DataFrame, radius: int = RADIUS, shard_rows: int = SHARD_ROWS, leaf: int = LEAF, least: float = SIMILARITY) -> DataFrame:
    """(doc, band): groups of two and more documents (doc, print, shards) that are connected, within a shard, by
    fingerprints at most ``radius`` bits apart and, if there is a column ``size``, by sizes that allow ``least``.

    A shard has the documents that agree on a block of bits, and a BK-tree of its own; up to ``leaf`` documents
    are one leaf. A shard over ``shard_rows`` is cut into chunks, and each pair of chunks is a unit, so no task holds
    a shard. The same group found in several shards counts once.
    """

    def groups(shard: np.ndarray, unit: np.ndarray, doc: np.ndarray, size: np.ndarray, prints: np.ndarray) -> pa.RecordBatch:
        borders = np.flatnonzero((shard[1:] != shard[:-1]) | (unit[1:] != unit[:-1])) + 1
        bounds = np.r_[0, borders, len(doc)]
        sizes = np.diff(bounds)
        run_of = np.repeat(np.arange(len(sizes)), sizes)
        small = np.flatnonzero((sizes <= leaf)[run_of])
        pairs = [[small[end] for end in _close_in_leaves(prints[small], size[small], run_of[small], radius, least, leaf)]]
        for at in np.flatnonzero(sizes > leaf):
            start, own = bounds[at], slice(bounds[at], bounds[at + 1])
            pairs.append([start + end for end in _close_in_tree(prints[own], size[own], radius, least, leaf)])
        left, right = (np.concatenate(side) for side in zip(*pairs))
        ends, inverse = np.unique(np.concatenate([left, right]), return_inverse=True)
        labels = lowest_labels(len(ends), inverse[: len(left)], inverse[len(left) :])
        order = np.lexsort((doc[ends], labels))
        docs, labels = doc[ends][order], labels[order]
        cuts = np.r_[0, np.flatnonzero(labels[1:] != labels[:-1]) + 1, len(docs)] if len(docs) else np.zeros(1, np.int64)
        names = [xxhash.xxh64_intdigest(docs[start:end].tobytes(), SEED) for start, end in zip(cuts, cuts[1:])]
        bands = np.repeat(np.array(names, np.uint64).view(np.int64), np.diff(cuts))
        return pa.RecordBatch.from_arrays([pa.array(docs), pa.array(bands)], ["doc", "band"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not len(batch):
                continue
            columns = [batch.column(k).to_numpy() for k in range(4 + PRINT_WORDS)]
            parts = [*columns[:4], np.stack(columns[4:], axis=1).view(np.uint64)]
            held = parts if held is None else [np.concatenate(both) for both in zip(held, parts)]
            last = np.flatnonzero((held[0] != held[0][-1]) | (held[1] != held[1][-1]))
            if len(last):
                start = int(last[-1]) + 1
                yield groups(*(part[:start] for part in held))
                held = [part[start:] for part in held]
        if held is not None:
            yield groups(*held)

    large = prints.select(F.explode("shards").alias("shard")).groupBy("shard").count().where(F.col("count") > shard_rows)
    words = [F.col("print")[k].alias(f"word_{k}") for k in range(PRINT_WORDS)]
    size = F.col("size") if "size" in prints.columns else F.lit(1).cast("long").alias("size")
    spread = prints.select("doc", size, *words, F.explode("shards").alias("shard")).join(F.broadcast(large), "shard", "left")
    cut = spread.withColumn("chunks", F.coalesce(F.ceil(F.col("count") / shard_rows), F.lit(1)).cast("long"))
    cut = cut.withColumn("chunk", F.pmod(F.xxhash64("doc"), "chunks"))
    paired = cut.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
    unit = (F.least("chunk", "other") * F.col("chunks") + F.greatest("chunk", "other")).alias("unit")
    dealt = paired.select("shard", unit, "doc", "size", *(f"word_{k}" for k in range(PRINT_WORDS)))
    return dealt.repartition("shard", "unit").sortWithinPartitions("shard", "unit").mapInArrow(run, "doc long, band long").distinct()


def _near(apart: np.ndarray, size: tuple[np.ndarray, np.ndarray], doc: tuple[np.ndarray, np.ndarray], least: float) -> np.ndarray:
    """Whether sets of these sizes and distances can be ``least`` similar; what the sizes alone rule out is exact."""
    return (apart <= np.where(np.minimum(*size) < FEW, FEW_RADIUS, WHOLE_RADIUS)) & _even(*size, least) & (doc[0] != doc[1])


def _nearest_in_small(doc: np.ndarray, size: np.ndarray, prints: np.ndarray, run: np.ndarray, least: float) -> list[np.ndarray]:
    """Rows, their root, nearest, distance, hub and its degree, in runs of up to LEAF rows; ``run`` numbers them in order."""
    left, right, far = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for step in range(1, min(LEAF, len(run))):
        rows = np.flatnonzero(run[step:] == run[:-step])
        if not len(rows):
            break
        ends = rows, rows + step
        apart = bits_apart(*(prints[end] for end in ends), True)
        near = _near(apart, tuple(size[end] for end in ends), tuple(doc[end] for end in ends), least)
        left.append(rows[near])
        right.append(rows[near] + step)
        far.append(apart[near])
    low, high, far = (np.concatenate(parts) for parts in (left, right, far))
    i, j, far = np.r_[low, high], np.r_[high, low], np.r_[far, far].astype(np.int64)
    degree = np.bincount(i[far <= SURE], minlength=len(doc))
    first = []
    for order in (np.lexsort((j, far, i)), np.lexsort((j, -degree[j], far > SURE, i))):
        first.append(order[np.flatnonzero(np.diff(i[order], prepend=-1))])
    nearest, hub = first
    rows = i[nearest]
    return [rows, lowest_labels(len(doc), low, high)[rows], j[nearest], far[nearest], j[hub], degree[j[hub]]]


def _nearest_in_large(doc: np.ndarray, size: np.ndarray, prints: np.ndarray, least: float) -> list[np.ndarray]:
    """The same for the rows of one run, some rows against all at once."""

    def blocks() -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        for at in range(0, len(doc), ROWS):
            rows = np.arange(at, min(at + ROWS, len(doc)))
            apart = np.zeros((len(rows), len(doc)), np.int64)
            for word in range(prints.shape[1]):
                apart += np.bitwise_count(prints[rows, word][:, None] ^ prints[None, :, word])
            yield rows, apart, _near(apart, (size[rows][:, None], size[None, :]), (doc[rows][:, None], doc[None, :]), least)

    degree, left, right = np.zeros(len(doc), np.int64), [], []
    for rows, apart, near in blocks():
        degree[rows] = (near & (apart <= SURE)).sum(axis=1)
        i, j = np.nonzero(near)
        labels = lowest_labels(len(doc), rows[i], j)
        moved = np.flatnonzero(labels != np.arange(len(doc)))
        left.append(labels[moved])
        right.append(moved)
    labels, found = lowest_labels(len(doc), np.concatenate(left), np.concatenate(right)), []
    for rows, apart, near in blocks():
        nearest = np.where(near, apart, prints.shape[1] * 64 + 1).argmin(axis=1)
        hub = np.where(near, np.where(apart <= SURE, degree[None, :], -1), -2).argmax(axis=1)
        any_near = np.flatnonzero(near.any(axis=1))
        nearest, hub = nearest[any_near], hub[any_near]
        found.append([rows[any_near], labels[rows[any_near]], nearest, apart[any_near, nearest], hub, degree[hub]])
    return [np.concatenate(parts) for parts in zip(*found)]


def nearest_in_bands(bands: DataFrame, prints: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """(doc, root, nearest, apart, hub, degree): the documents of ``bands`` (doc, band) that are near another of their band by
    all bits of the fingerprint and by size (doc, size, print).

    ``root`` is the smallest document that near ones connect it with in the band, ``nearest`` the one with the fewest
    differing bits, ``hub`` of those at most SURE bits away the one with most such neighbours. A band has at
    most two chunks of a shard, and only fingerprints come to it.
    """

    def bounds(band: np.ndarray) -> np.ndarray:
        return np.r_[0, np.flatnonzero(band[1:] != band[:-1]) + 1, len(band)]

    def nearest(band: np.ndarray, doc: np.ndarray, size: np.ndarray, words: np.ndarray) -> pa.RecordBatch:
        cuts = bounds(band)
        sizes = np.diff(cuts)
        run_of = np.repeat(np.arange(len(sizes)), sizes)
        small = np.flatnonzero((sizes <= LEAF)[run_of])
        rows, root, near, apart, hub, degree = _nearest_in_small(doc[small], size[small], words[small], run_of[small], least)
        parts = [[small[rows], small[root], small[near], apart, small[hub], degree]]
        for at in np.flatnonzero(sizes > LEAF):
            own = slice(cuts[at], cuts[at + 1])
            rows, root, near, apart, hub, degree = _nearest_in_large(doc[own], size[own], words[own], least)
            parts.append([own.start + rows, own.start + root, own.start + near, apart, own.start + hub, degree])
        rows, root, near, apart, hub, degree = (np.concatenate(side) for side in zip(*parts))
        columns = [doc[rows], doc[root], doc[near], apart, doc[hub], degree]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["doc", "root", "nearest", "apart", "hub", "degree"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not len(batch):
                continue
            words = batch.column(3).flatten().to_numpy().reshape(len(batch), -1).view(np.uint64)
            parts = [*(batch.column(k).to_numpy() for k in range(3)), words]
            held = parts if held is None else [np.concatenate(both) for both in zip(held, parts)]
            start = bounds(held[0])[-2]
            if start:
                yield nearest(*(part[:start] for part in held))
                held = [part[start:] for part in held]
        if held is not None:
            yield nearest(*held)

    dealt = bands.join(prints.select("doc", "size", "print"), "doc").select("band", "doc", "size", "print")
    sorted_bands = dealt.repartition("band").sortWithinPartitions("band", "doc")
    return sorted_bands.mapInArrow(run, "doc long, root long, nearest long, apart long, hub long, degree long")


def similar_pairs(pairs: DataFrame, docs: DataFrame, words: int = WORDS, least: float = SIMILARITY) -> DataFrame:
    """The ``pairs`` (a, b) of documents (doc, text) whose shingle sets are at least ``least`` similar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for at in range(0, len(batch), SLICE):
                sets: dict[bytes, np.ndarray] = {}
                part = batch.slice(at, SLICE)
                for row, texts in enumerate(zip(*(part.column(k).cast(pa.binary()).to_pylist() for k in (2, 3))), at):
                    for text in texts:
                        if (text or b"") not in sets:
                            sets[text or b""] = np.unique(shingle_hashes(text or b"", words))
                    if similarity(*(sets[text or b""] for text in texts)) >= least:
                        kept.append(row)
            rows = pa.array(kept, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(k).take(rows) for k in (0, 1)], ["a", "b"])

    left, right = (docs.select(F.col("doc").alias(end), F.col("text").alias(f"text_{end}")) for end in "ab")
    return pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each (band, unit) of batches sorted by them."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not len(batch):
            continue
        keys = np.stack([batch.column(k).to_numpy() for k in (0, 1)])
        borders = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist(), len(batch)]
        if held and tuple(keys[:, 0]) != tuple(held[-1].column(k)[0].as_py() for k in (0, 1)):
            yield pa.Table.from_batches(held)
            held = []
        for start, end in zip(borders, borders[1:]):
            held.append(batch.slice(start, end - start))
            if end < len(batch):
                yield pa.Table.from_batches(held)
                held = []
    if held:
        yield pa.Table.from_batches(held)


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """How many hashes each two of the sets share, found by multiplying blocks of the matrix of sets and hashes."""
    sizes = np.array([len(own) for own in sets])
    hashes, place, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rows = np.repeat(np.arange(len(sets)), sizes)
    often = times[place] > 1  # what one set has alone is shared by none
    rows, place = rows[often], place[often]
    order = np.argsort(place, kind="stable")
    rows, place = rows[order], place[order]
    counts = np.zeros((len(sets), len(sets)), np.float32)
    for low in range(0, len(hashes), COLUMNS):
        start, end = np.searchsorted(place, [low, low + COLUMNS])
        if start < end:
            names, column = np.unique(place[start:end], return_inverse=True)
            block = np.zeros((len(sets), len(names)), np.float32)
            block[rows[start:end], column] = 1
            counts += block @ block.T
    return counts


def close_links(members: DataFrame, words: int = WORDS, least: float = SIMILARITY) -> DataFrame:
    """(a, b), a < b: links that connect the similar documents of different components ``own`` of a band
    (band, doc, own, text).

    A band over CHUNK documents is cut into chunks of about that size, and each pair of chunks is a unit of its own, so no
    task holds a band. The largest component of a band has chunks of its own that meet only those of the others, so
    its documents are copied once per CHUNK documents outside of it. All sets of a unit are compared exactly; a unit
    writes stars, at most a row per document.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _runs(batches):
            docs, owns = (table[name].to_numpy() for name in ("doc", "own"))
            sets = [np.unique(shingle_hashes(text or b"", words)) for text in table["text"].cast(pa.binary()).to_pylist()]
            sizes, shared = np.array([len(own) for own in sets], np.float32), shared_counts(sets)
            close = shared >= np.float32(least) * (sizes[:, None] + sizes[None, :] - shared) - 1e-3
            close &= owns[:, None] != owns[None, :]
            pairs = [(a, b) for a, b in zip(*np.nonzero(np.triu(close, 1))) if similarity(sets[a], sets[b]) >= least]
            if pairs:
                labels = lowest_labels(len(docs), *(np.array(end) for end in zip(*pairs)))
                moved = np.flatnonzero(labels != np.arange(len(docs)))
                yield pa.RecordBatch.from_arrays([pa.array(docs[labels[moved]]), pa.array(docs[moved])], ["a", "b"])

    owns = members.groupBy("band", "own").agg(F.count(F.lit(1)).alias("rows"))
    sizes = owns.groupBy("band").agg(F.sum("rows").alias("all"), F.max(F.struct("rows", "own")).alias("most"))
    cut_up, main = F.col("all") > CHUNK, F.col("most.rows")
    mains = F.when(cut_up, F.ceil(main / CHUNK)).otherwise(0).cast("long").alias("mains")
    others = F.when(cut_up, F.greatest(F.ceil((F.col("all") - main) / CHUNK), F.lit(1))).otherwise(1).cast("long").alias("others")
    cut = members.join(sizes.select("band", F.col("most.own").alias("main"), mains, others), "band")
    cut = cut.withColumn("in_main", (F.col("own") == F.col("main")) & (F.col("mains") > 0))
    place, chunks = F.xxhash64("doc"), F.col("others") + F.col("mains")
    own_chunk = F.when(F.col("in_main"), F.col("others") + F.pmod(place, F.greatest("mains", F.lit(1)))).otherwise(F.pmod(place, "others"))
    zero = F.lit(0).cast("long")
    every = F.filter(F.sequence(zero, chunks - 1), lambda other: (other != F.col("chunk")) | (chunks == 1))
    meets = F.when(F.col("in_main"), F.sequence(zero, F.col("others") - 1)).otherwise(every)
    paired = cut.withColumn("chunk", own_chunk).withColumn("other", F.explode(meets))
    unit = (F.least("chunk", "other") * chunks + F.greatest("chunk", "other")).alias("unit")
    dealt = paired.select("band", unit, "doc", "own", "text").repartition("band", "unit").sortWithinPartitions("band", "unit", "doc")
    return dealt.mapInArrow(run, "a long, b long").distinct()


def similar_links(docs: DataFrame, words: int = WORDS, least: float = SIMILARITY) -> DataFrame:
    """(a, b) links that connect all pairs of ``docs`` (doc, text) that share a band and are similar.

    Documents with equal shingle sets are represented by one. Fingerprints near each other in a shard's BK-tree
    make groups, the bands, and inside them all bits and the sizes of the sets tell who can be similar. Each document is
    compared with its nearest and with a hub, so a large group of near copies costs two comparisons per document. Groups
    that are not connected by then are put together over all bands, so that a document's text travels once and
    not once per band, and all documents of different components are compared inside tasks, in units of a fixed size.
    So no pair is skipped because a hub differs from one of its ends, and only links are written. The work inside such
    a group still grows with its documents times those outside its largest component, that inside a shard with the
    square of its fingerprints.
    """
    signed = stored(signatures(docs, words), "signatures")
    wholes = signed.groupBy("whole").agg(F.min("doc").alias("rep"))
    equal = signed.select("doc", "whole").join(wholes, "whole").where("doc != rep").select(F.col("rep").alias("a"), F.col("doc").alias("b")).distinct()
    reps = stored(signed.join(wholes.select(F.col("rep").alias("doc"), "whole"), ["doc", "whole"]).drop("whole"), "prints")
    near = stored(nearest_in_bands(stored(neighbours(reps, least=least), "bands"), reps, least), "nearest")
    closest, hub = F.min(F.struct("apart", "nearest"))["nearest"], F.max(F.struct("degree", F.negative("hub").alias("hub")))["hub"]
    ends = near.groupBy("doc").agg(F.array(closest, F.negative(hub)).alias("ends")).select("doc", F.explode("ends").alias("end"))
    met = stored(ends.select(F.least("doc", "end").alias("a"), F.greatest("doc", "end").alias("b")).distinct(), "met")
    links = stored(similar_pairs(met, docs, words, least), "similar").distinct()
    groups = stored(connected_components(links), "groups")
    stars = near.select("doc", "root").where("doc != root").distinct()
    for end in ("doc", "root"):
        own = groups.select(F.col("node").alias(end), F.col("component").alias(f"{end}_own"))
        stars = stars.join(own, end, "left").withColumn(f"{end}_own", F.coalesce(f"{end}_own", end))
    clusters = connected_components(stars.where("doc_own != root_own").select("doc_own", "root_own").distinct(), "doc_own", "root_own")
    own = near.select("doc").distinct().join(groups, near["doc"] == groups["node"], "left").select("doc", F.coalesce("component", "doc").alias("own"))
    apart = own.join(clusters.select(F.col("node").alias("own"), F.col("component").alias("band")), "own")
    apart = stored(apart.join(docs, "doc").select("band", "doc", "own", "text"), "apart")
    return equal.union(links).union(close_links(apart, words, least))


def drop_similar(docs: DataFrame, words: int = WORDS, least: float = SIMILARITY) -> DataFrame:
    """``docs`` with all its columns and one document, that of the smallest doc_id, of each group connected
    by shingle similarity of ``least`` or more. Rows that share a doc_id are one document; rows without
    doc_id stay; texts without words are equal."""
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc"), F.col("text").cast("string").alias("text")).where("doc IS NOT NULL")
    found = connected_components(similar_links(narrow, words, least))
    dropped = found.where("node != component").select(F.col("node").alias("_dropped"))
    return docs.join(dropped, docs["doc_id"].cast("long") == dropped["_dropped"], "left_anti")
