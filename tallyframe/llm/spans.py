"""Spans of regular expressions in texts, as columns: no Python runs on the rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BLOCK = 256


def matches(text: Column, pattern: str, guard: Column) -> Column:
    """All leftmost non-overlapping matches; an empty array where ``guard`` says there can be none."""
    return F.when(guard, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(F.array().cast("array<string>"))


def pieces(text: Column, pattern: str, guard: Column) -> Column:
    """The text between the matches: one piece more than there are matches."""
    return F.when(guard, F.split(text, pattern, -1)).otherwise(F.array().cast("array<string>"))


def starts(found: Column, between: Column) -> Column:
    """Code point offset of each match, from the lengths of matches and of the text between them.

    The lengths are added up in blocks and over blocks, as an array grows by copying all of it."""
    none = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("all"))
    grown = lambda acc, gap, width: F.struct((acc["at"] + gap + width).alias("at"), F.concat(acc["all"], F.array(acc["at"] + gap)).alias("all"))
    blocks = F.when(F.size(found) > 0, F.sequence(F.lit(0), F.floor((F.size(found) - 1) / BLOCK).cast("int"))).otherwise(F.array().cast("array<int>"))

    def block(k: Column) -> Column:
        first, length = k * BLOCK + 1, F.least(F.lit(BLOCK), F.size(found) - k * BLOCK)
        widths = F.zip_with(F.slice(found, first, length), F.slice(between, first, length), lambda m, p: F.struct(F.length(p).alias("gap"), F.length(m).alias("width")))
        return F.aggregate(widths, none, lambda acc, w: grown(acc, w["gap"], w["width"]))

    parts = F.transform(blocks, block)
    bases = F.aggregate(parts, none, lambda acc, part: grown(acc, F.lit(0), part["at"]), lambda acc: acc["all"])
    return F.flatten(F.zip_with(parts, bases, lambda part, base: F.transform(part["all"], lambda at: at + base)))


def joined(spans: Column) -> Column:
    """``kind:start:end`` of an array of spans, comma-joined in its order."""
    text = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, text), ",")
