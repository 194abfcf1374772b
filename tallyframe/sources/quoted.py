"""Quoted text files whose fields hold line breaks, read by as many tasks as the bytes ask for."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

RECORD, END, START, MIDDLE = 0, 1, 2, 3  # a whole record, or the part of one that a border of the scan cuts
PLACE = ("file", "block")


def quoted_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, line): lines with the file (a hash of its path) and the place of the block of the scan they are
    in; a block is read in order by one task."""
    lines = spark.read.option("lineSep", "\n").text(path)
    line = F.regexp_replace("value", "\r$", "").alias("line")
    return lines.select(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), line)


def open_blocks(lines: DataFrame, quote: str = '"') -> DataFrame:
    """(file, block, inside): the blocks that start inside a quoted field, that is after an odd number of quotes.

    Each task counts the quotes of its blocks; what is added up along a file is one number per block.
    """
    quotes = F.length("line") - F.length(F.replace("line", F.lit(quote)))
    counts = lines.groupBy(*PLACE).agg(F.sum(quotes).alias("quotes"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    odd = F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1
    return counts.select(*PLACE, odd.alias("inside")).where("inside")


def cut_records(lines: DataFrame, quote: str = '"') -> DataFrame:
    """(file, block, kind, text) of lines (file, block, inside, line): whole records, and parts of those that reach
    over the border of a block. The first line of a file is its header and is left out. Lines whose record is
    open are held, nothing else."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, held, kind = None, [], START  # the open record, and what it is when its block ends

        def rows(found: list[tuple[int, str]]) -> pa.RecordBatch:
            kinds, texts = zip(*found) if found else ((), ())
            columns = [pa.array([place[0]] * len(found), pa.int64()), pa.array([place[1]] * len(found), pa.int64())]
            return pa.RecordBatch.from_arrays([*columns, pa.array(kinds, pa.int32()), pa.array(texts, pa.string())], ["file", "block", "kind", "text"])

        for batch in batches:
            if not len(batch):
                continue
            files, blocks = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            odd = pc.count_substring(batch.column(3), quote).to_numpy(zero_copy_only=False) % 2 == 1
            edges = [0, *(np.flatnonzero((files[1:] != files[:-1]) | (blocks[1:] != blocks[:-1])) + 1).tolist(), len(batch)]
            for first, last in zip(edges, edges[1:]):
                here = (batch.column(0)[first].as_py(), batch.column(1)[first].as_py())
                if here != place:
                    if held:
                        yield rows([(kind, "\n".join(held))])
                    place, held = here, []
                    inside = batch.column(2)[first].as_py()
                    kind = MIDDLE if inside else START
                    first += here[1] == 0
                texts, found, at = batch.column(3).slice(first, last - first).to_pylist(), [], 0
                for stop in np.flatnonzero(odd[first:last]).tolist():
                    if held or kind == MIDDLE:
                        held += texts[at : stop + 1]
                        found.append((END if kind == MIDDLE else RECORD, "\n".join(held)))
                        held, kind, at = [], START, stop + 1
                    else:
                        found += [(RECORD, text) for text in texts[at:stop]]
                        held, at = [texts[stop]], stop + 1
                if held or kind == MIDDLE:
                    held += texts[at:]
                else:
                    found += [(RECORD, text) for text in texts[at:]]
                yield rows(found)
        if held:
            yield rows([(kind, "\n".join(held))])

    return lines.select(*PLACE, "inside", "line").mapInArrow(run, "file long, block long, kind int, text string")


def joined_parts(parts: DataFrame) -> DataFrame:
    """(file, text): the records that reach over borders, put together. There are at most two parts per block, so
    a file's parts fit one task; a record whose quote never closes ends with its file."""
    along = Window.partitionBy("file").orderBy("block", "kind")
    numbered = parts.where(F.col("kind") != RECORD).withColumn("record", F.sum((F.col("kind") == START).cast("int")).over(along))
    pieces = F.array_sort(F.collect_list(F.struct("block", "kind", "text")))
    return numbered.groupBy("file", "record").agg(F.array_join(F.transform(pieces, lambda piece: piece["text"]), "\n").alias("text")).drop("record")


def quoted_records(spark: SparkSession, path: str, quote: str = '"') -> DataFrame:
    """(text): the records of quoted text files, the first of each file (its header) and empty ones left out.

    A file is split by bytes like any text file. A line break is inside a field where the number of quotes
    before it in the file is odd, so what a task needs to know of the rest of the file is one bit: the blocks'
    counts of quotes are added up first, then each task cuts its own lines, and only the few parts of
    records at the borders meet in a shuffle. The text is read twice and not shuffled.
    """
    lines = quoted_lines(spark, path)
    known = F.broadcast(open_blocks(lines, quote))  # a short row per block that starts inside a field: a terabyte has 8,000 blocks
    placed = lines.join(known, list(PLACE), "left").withColumn("inside", F.coalesce("inside", F.lit(False)))
    parts = cut_records(placed, quote)
    records = parts.where(F.col("kind") == RECORD).select("text").union(joined_parts(parts).select("text"))
    return records.where("text != ''")
