"""Exact duplicates, white space aside, through an extendible-hash index on shared files."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.session import stored

WHITE = b" \t\n\x0b\x0c\r"
ROW_BITS = 40  # rows of one task below, task number above
PREFIX_BITS = 16  # the directory has at most 2**16 entries, so its size does not grow with the data


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per row its key and the row that stands for it among the equal texts of its batch: the one
    with the most code points, then the smallest doc_id. Only such heads keep their columns."""
    base = TaskContext.get().partitionId() << ROW_BITS
    for batch in batches:
        row = batch.column(0)
        texts = row.field("text").fill_null("")
        sizes = pc.utf8_length(texts).to_pylist()
        ids = row.field("doc_id").to_pylist()
        heads: dict[bytes, int] = {}
        norms = [text.translate(None, WHITE) for text in texts.cast(pa.binary()).to_pylist()]
        rank = [(-size, doc is None, doc or 0, place) for place, (size, doc) in enumerate(zip(sizes, ids))]
        copies: dict[bytes, int] = {}
        for place, norm in enumerate(norms):
            copies[norm] = copies.get(norm, 0) + 1
            if norm not in heads or rank[place] < rank[heads[norm]]:
                heads[norm] = place
        places = [heads[norm] for norm in norms]
        own = [place if place == head else None for place, head in enumerate(places)]
        keys = {norm: xxhash.xxh64_intdigest(norm) for norm in heads}
        yield pa.RecordBatch.from_arrays(
            [
                row.take(pa.array(own, pa.int64())),
                pa.array([base + place for place in range(len(norms))], pa.int64()),
                pa.array([base + head for head in places], pa.int64()),
                pa.array(ids, pa.int64()),
                pa.array(sizes, pa.int64()),
                pa.array([keys[norm] - (1 << 64) if keys[norm] >> 63 else keys[norm] for norm in norms], pa.int64()),
                pa.array([copies[norm] for norm in norms], pa.int64()),
            ],
            ["row", "rid", "head", "doc_id", "n_chars", "key", "copies"],
        )
        base += len(norms)


def directory(counts: dict[int, int], capacity: int, bits: int = PREFIX_BITS) -> list[int]:
    """Bucket number per directory slot. ``counts`` has the keys per prefix of ``bits`` bits.

    Starts with one bucket and one slot. An overfull bucket splits in two by its next bit; where it
    is already as deep as the directory, the directory doubles first. Buckets are ranges of keys.
    """
    total = [0]
    for prefix in range(1 << bits):
        total.append(total[-1] + counts.get(prefix, 0))
    slots, depth, local, todo = [0], 0, [0], [(0, 0, 0)]
    while todo:
        bucket, deep, value = todo.pop()
        first, last = value << (bits - deep), (value + 1) << (bits - deep)
        if deep == bits or total[last] - total[first] <= capacity:
            continue
        if deep == depth:
            slots, depth = [bucket for bucket in slots for _ in (0, 1)], depth + 1
        new = len(local)
        local[bucket] = deep + 1
        local.append(deep + 1)
        width = 1 << (depth - deep - 1)
        start = ((value << 1) | 1) * width
        slots[start : start + width] = [new] * width
        todo += [(bucket, deep + 1, value << 1), (new, deep + 1, (value << 1) | 1)]
    return slots


class _Chain:
    """The distinct texts met under one key."""

    def __init__(self, key: int):
        self.key = key
        self.texts: dict[bytes, list] = {}

    def add(self, norm: bytes, head: int, rank: tuple, copies: int) -> None:
        known = self.texts.get(norm)  # equal hashes of the dict are settled by comparing the bytes
        if known is None:
            self.texts[norm] = [rank, copies, [head]]
        else:
            known[0], known[1] = min(known[0], rank), known[1] + copies
            known[2].append(head)

    def rows(self) -> Iterator[tuple]:
        for norm, (rank, copies, heads) in self.texts.items():
            digest = hashlib.sha256(norm).hexdigest()
            for head in heads:
                yield head, rank[3], None if rank[1] else rank[2], copies, digest, self.key


INDEX = pa.schema([
    ("head", pa.int64()), ("keep_rid", pa.int64()), ("keep_id", pa.int64()), ("group_size", pa.int64()),
    ("text_sha256", pa.string()), ("key", pa.int64()),
])


def _own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The owner of a range of keys, sorted by key: chains the entries of a key and compares bytes."""
    chain: _Chain | None = None
    out: list[tuple] = []

    def packed() -> pa.RecordBatch:
        columns = zip(*out) if out else [[] for _ in INDEX]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, INDEX)], schema=INDEX)

    for batch in batches:
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        rest = zip(*(batch.column(name).to_pylist() for name in ("key", "head", "n_chars", "doc_id", "copies")))
        for text, (key, head, size, doc, copies) in zip(texts, rest):
            if chain is None or chain.key != key:
                if chain is not None:
                    out.extend(chain.rows())
                chain = _Chain(key)
            chain.add((text or b"").translate(None, WHITE), head, (-size, doc is None, doc or 0, head), copies)
        yield packed()
        out.clear()
    if chain is not None:
        out.extend(chain.rows())
        yield packed()


@dataclass
class Index:
    """``entries``: per row (rid, head, doc_id, n_chars, and of heads the ``row``); ``classes``: per
    head (keep_rid, keep_id, group_size, text_sha256). Both are files in the shared folder."""

    entries: DataFrame
    classes: DataFrame


def build_index(docs: DataFrame, bucket_keys: int = 512) -> Index:
    """Write the entries, lay out the directory, and let each owner settle its range of keys.

    Copies within an Arrow batch collapse before any shuffle, so a text that holds a third of all
    rows reaches its owner once per batch. The directory is driven by the number of distinct keys
    per 16-bit prefix, the only thing that is collected; ``bucket_keys`` grows where the directory is
    at its greatest depth, and an owner streams its range, holding one key's texts at a time.
    """
    shaped = docs.withColumns({"doc_id": F.col("doc_id").cast("long"), "text": F.col("text").cast("string")})
    whole = shaped.select(F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("row"))
    kind = whole.schema["row"].dataType.simpleString()
    layout = f"row {kind}, rid long, head long, doc_id long, n_chars long, key long, copies long"
    entries = stored(whole.mapInArrow(_entries, layout), "entries")
    heads = entries.where("rid = head")
    prefix = F.shiftrightunsigned("key", 64 - PREFIX_BITS).cast("int")
    counted = heads.select("key").distinct().groupBy(prefix.alias("prefix")).count().collect()
    slots = directory({r["prefix"]: r["count"] for r in counted}, bucket_keys)
    step = (1 << PREFIX_BITS) // len(slots)
    laid = docs.sparkSession.createDataFrame([(p, slots[p // step]) for p in range(1 << PREFIX_BITS)], "prefix int, bucket int")
    placed = heads.select("key", "head", "n_chars", "doc_id", "copies", F.col("row.text").alias("text"), prefix.alias("prefix"))
    owned = placed.join(F.broadcast(laid), "prefix").drop("prefix").repartition("bucket").sortWithinPartitions("bucket", "key")
    fields = "head long, keep_rid long, keep_id long, group_size long, text_sha256 string, key long"
    return Index(entries, stored(owned.mapInArrow(_own, fields), "index"))


def exact_duplicates(docs: DataFrame, bucket_keys: int = 512) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256): one row per row of ``docs``.

    Texts are equal when they are after deleting ASCII white space; null counts as empty. Of equal
    texts the row with the most code points stays, then the smallest doc_id (null last), then the
    first read, so exactly one row of a group has ``kept``, also among repeated rows. An empty table
    gives no rows; other columns are ignored.
    """
    index = build_index(docs.select("doc_id", "text"), bucket_keys)
    found = index.entries.select("rid", "head", "doc_id").join(index.classes, "head")
    return found.select("doc_id", "keep_id", "group_size", (F.col("rid") == F.col("keep_rid")).alias("kept"), "text_sha256")


def drop_exact_duplicates(docs: DataFrame, bucket_keys: int = 512) -> DataFrame:
    """The rows of ``docs`` that stay, with all columns."""
    index = build_index(docs, bucket_keys)
    stays = index.classes.select("keep_rid").distinct()
    kept = index.entries.join(stays, F.col("rid") == F.col("keep_rid"), "left_semi")
    return kept.select(*[F.col("row").getField(name).alias(name) for name in docs.columns])
