"""Mixing sources to target weights by capped water-filling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.session import stored

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
MOST_EPOCHS = 3
BINS = 1024
SALTS = 64  # a source's rows meet its one plan row in this many parts


def word_count(text: str = "text") -> Column:
    """Number of words between ASCII white space; 0 for null."""
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return F.regexp_count(whole, F.lit(WORD)).cast("long")


def water_levels(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most_epochs: int = MOST_EPOCHS) -> DataFrame:
    """(source, source_size, target) from (source, size), one row per source.

    Sources in code point order, null last, get the weights in turn. A source is clamped at
    ``most_epochs`` times its size and the excess goes to the others by weight until none is above.
    The fixed point of that is a level: with the sources sorted by cap / weight, the level before a
    source is what is left after the caps of those below, per weight; the greatest one is final. The
    windows run over one row per source.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1
    turn = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    weighed = totals.withColumn("weight", turn.cast("long")).withColumn("cap", F.col("source_size") * most_epochs)
    below = Window.orderBy(F.col("cap") / F.col("weight"), F.asc_nulls_last("source")).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(below), F.lit(0))
    weight_left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(below), F.lit(0))
    levels = weighed.withColumn("level", left.cast("double") / weight_left.cast("double"))
    final = F.max("level").over(everything)
    target = F.least(F.col("cap").cast("double"), final * F.col("weight"))
    return levels.select("source", "source_size", target.alias("target"))


def draw(seed: int) -> Column:
    """32 seeded bits of a document, the same in every run."""
    text = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(f":{seed}"))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def _drawn(docs: DataFrame, seed: int) -> DataFrame:
    return docs.withColumn("_draw", draw(seed)).withColumn("_bin", F.floor(F.col("_draw") / (2**32 // BINS)))


def mix(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    most_epochs: int = MOST_EPOCHS,
    seed: int = 4,
    sizes: DataFrame | None = None,
) -> DataFrame:
    """``docs`` (doc_id, source, size and any other columns) with source_size, target and taken.

    Each document is repeated the whole number of times that its source's target holds the source.
    The words that are then missing are taken once more from documents in a seeded order: wholly
    until the target is reached, and the last one of a source in part. So a source takes its target,
    rounded to a word, and no document more than ``most_epochs`` times its size.

    The order is not sorted as a whole: sizes are summed per source and bin of the drawn number, the
    bin that holds the end is found from these sums, and only its documents are sorted. Null sources
    are a source, sources without words have target 0, an empty table gives no rows. Ties in the draw
    go by doc_id and size; equal rows of one document share what they take in any order. ``sizes``
    may give doc_id, source and size of the same rows where reading ``docs`` again costs more.
    """
    narrow = docs.select("doc_id", "source", "size") if sizes is None else sizes
    levels = water_levels(narrow, weights, most_epochs)
    missing = F.round("target").cast("long") - F.col("_whole") * F.col("source_size")
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    plan = levels.withColumn("_whole", whole).withColumn("_missing", missing)
    bins = _drawn(narrow, seed).groupBy("source", "_bin").agg(F.sum("size").alias("_sum"))
    upto = Window.partitionBy("source").orderBy("_bin").rowsBetween(Window.unboundedPreceding, 0)
    summed = bins.withColumn("_upto", F.sum("_sum").over(upto)).withColumnRenamed("source", "_source")
    ends = summed.join(plan, F.col("_source").eqNullSafe(F.col("source"))).where(F.col("_upto") > F.col("_missing"))
    first = ends.groupBy("_source").agg(F.min_by(F.struct("_bin", (F.col("_upto") - F.col("_sum")).alias("_before")), "_bin").alias("_end"))
    first = first.select(F.col("_source").alias("_of"), F.col("_end._bin").alias("_end_bin"), F.col("_end._before").alias("_before"))
    plan = plan.join(first, F.col("source").eqNullSafe(F.col("_of")), "left").drop("_of").withColumnRenamed("source", "_source")
    salted = plan.withColumn("_plan_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    own_salt = F.col("_draw") % SALTS == F.col("_plan_salt")
    known = _drawn(docs, seed).join(salted, F.col("source").eqNullSafe(F.col("_source")) & own_salt)
    end_bin = F.coalesce(F.col("_bin") == F.col("_end_bin"), F.lit(False))
    clear = known.where(~end_bin).withColumn("_more", F.when(F.col("_end_bin").isNull() | (F.col("_bin") < F.col("_end_bin")), F.col("size")).otherwise(0))
    ordered = Window.partitionBy("source").orderBy("_draw", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    room = F.col("_missing") - F.col("_before") - (F.sum("size").over(ordered) - F.col("size"))
    edge = known.where(end_bin).withColumn("_more", F.least("size", F.greatest(room, F.lit(0))))
    both = clear.unionByName(edge).withColumn("taken", F.col("_whole") * F.col("size") + F.col("_more"))
    return both.select(*docs.columns, "source_size", "target", "taken")


def mix_documents(docs: DataFrame, weights: Sequence[int] = WEIGHTS, most_epochs: int = MOST_EPOCHS, seed: int = 4) -> DataFrame:
    """(doc_id, size, source_size, target, taken), one row per row of ``docs``; see ``mix``."""
    sizes = stored(docs.select("doc_id", "source", word_count().alias("size")), "sizes")
    return mix(sizes, weights, most_epochs, seed).select("doc_id", "size", "source_size", "target", "taken")


def repeat_documents(docs: DataFrame, weights: Sequence[int] = WEIGHTS, most_epochs: int = MOST_EPOCHS, seed: int = 4) -> DataFrame:
    """The mix itself, with the columns of ``docs``: a row per repetition of a document. A document
    taken in part ends with a row of its first words, whose n_chars is counted anew. Documents that
    the mix does not take, and those without words, have no row."""
    names = docs.columns
    row = F.struct(*[F.col(f"`{name}`") for name in names]).alias("_row")
    sizes = stored(docs.select("doc_id", "source", word_count().alias("size")), "sizes")
    mixed = mix(docs.select(row, "doc_id", "source", word_count().alias("size")), weights, most_epochs, seed, sizes)
    parts = mixed.where("taken > 0").selectExpr("_row", "taken div size AS whole", "taken % size AS part")
    rows = parts.withColumn("_at", F.explode(F.sequence(F.lit(1).cast("long"), F.col("whole") + (F.col("part") > 0).cast("long"))))
    text, cut_off = F.col("_row").getField("text"), F.col("_at") > F.col("whole")
    pattern = F.concat(F.lit(r"^(?:[\x20\x09-\x0D]*+[^\x20\x09-\x0D]++){"), F.col("part").cast("string"), F.lit("}+"))
    start = F.call_function("regexp_extract", text.cast("string"), pattern, F.lit(0))
    taken = {"text": start.cast(docs.schema["text"].dataType)}
    if "n_chars" in names:
        taken["n_chars"] = F.length(start).cast(docs.schema["n_chars"].dataType)
    field = {name: F.col("_row").getField(name) for name in names}
    return rows.select(*[(F.when(cut_off, taken[n]).otherwise(field[n]) if n in taken else field[n]).alias(n) for n in names])
