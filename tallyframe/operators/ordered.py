"""Operators over one global order (row number, moving average, dense rank, exact quantile)
that stay spread over many tasks, where a window without partitions would use a single one."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.session import cut

# monotonically_increasing_id() is documented as: partition number above bit 33, row number below.
ROW_BITS = 33
SLICE_ROWS, ACCURACY = 1 << 16, 10_000  # rows that the exact quantile sorts at most, and one over the rank error of its sketch


def with_row_index(df: DataFrame, order: Sequence[Column], name: str = "row_index", partitions: int | None = None) -> DataFrame:
    """Number all rows from 0 in the given order.

    Rows are range-partitioned and sorted; equal keys are told apart by their input position, so a
    key that holds much of the data is still split. Without ``partitions`` adaptive execution merges small
    neighbouring ranges.
    """
    keys = [*order, F.col("_tie")]
    tied = df.withColumn("_tie", F.monotonically_increasing_id())
    ranged = tied.repartitionByRange(partitions, *keys) if partitions else tied.repartitionByRange(*keys)
    return number_as_given(ranged.sortWithinPartitions(*keys).drop("_tie"), name)


def number_as_given(df: DataFrame, name: str = "row_index") -> DataFrame:
    """Number all rows from 0 in the order in which they lie, that of a sorted frame above all.

    The partitions are cut off into the shared folder, as a recomputed sort could draw other borders. Each
    partition starts where those before it end; that table has one row per partition.
    """
    placed = cut(df.withColumn("_at", F.monotonically_increasing_id()))
    numbered = placed.select(
        *df.columns,
        F.shiftright("_at", ROW_BITS).alias("_part"),
        F.col("_at").bitwiseAND(F.lit((1 << ROW_BITS) - 1)).alias("_row"),
    )
    sizes = numbered.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    starts = sizes.select("_part", (F.sum("_size").over(Window.orderBy("_part")) - F.col("_size")).alias("_start"))
    joined = numbered.join(F.broadcast(starts), "_part")
    return joined.select(*df.columns, (F.col("_start") + F.col("_row")).alias(name))


def centred_average(
    df: DataFrame,
    order: Sequence[Column],
    value: str,
    name: str,
    before: int = 2,
    after: int = 2,
    groups: Sequence[str] = (),
    bucket_rows: int = 1 << 18,
    partitions: int | None = None,
) -> DataFrame:
    """Mean over the rows ``-before … +after`` around each row, shorter at the ends.

    Numbered rows go into buckets of fixed size; those close to a border are copied into the
    neighbouring bucket as well, so each bucket is a task of its own and the frames are complete.
    With ``groups`` the frame does not reach into another group.
    """
    ordered = with_row_index(df, [*[F.col(group) for group in groups], *order], "_index", partitions)
    index = F.col("_index")
    first = F.floor(F.greatest(index - after, F.lit(0)) / bucket_rows)
    last = F.floor((index + before) / bucket_rows)
    spread = ordered.withColumn("_bucket", F.explode(F.sequence(first, last)))
    frame = Window.partitionBy("_bucket", *groups).orderBy("_index").rowsBetween(-before, after)
    averaged = spread.withColumn(name, F.avg(value).over(frame))
    return averaged.where(F.floor(index / bucket_rows) == F.col("_bucket")).drop("_index", "_bucket")


def dense_rank_all(df: DataFrame, descending: Sequence[str], name: str, partitions: int | None = None) -> DataFrame:
    """Dense rank over all rows, greatest first: the distinct keys are numbered and joined back."""
    once = cut(df)
    order = [F.desc(key) for key in descending]
    numbered = with_row_index(once.select(*descending).distinct(), order, "_index", partitions)
    ranks = numbered.select(*[F.col(key).alias(f"_{key}") for key in descending], (F.col("_index") + 1).alias(name))
    same = [F.col(key).eqNullSafe(F.col(f"_{key}")) for key in descending]
    return once.join(ranks, same).select(*df.columns, name)


def exact_quantile(df: DataFrame, column: str, fraction: float, slice_rows: int = SLICE_ROWS, accuracy: int = ACCURACY) -> DataFrame:
    """The value at rank ``ceil(fraction * n)`` of the non-null values, as one row; no row without values.

    Selection instead of a sort: a mergeable sketch gives a value a little below and one a little above the
    rank, counts of both say where in between the rank lies, and so on inside that slice until it has
    at most ``slice_rows`` rows, whose smallest or largest ones up to the rank are taken. A pass leaves about
    4 / ``accuracy`` of the rows, so two passes do for billions; nothing is shuffled but the sketches. Bounds that the
    counts do not confirm are widened. ``df`` is read twice per pass: store it where that is dear.
    """
    value = F.col(column)
    inside = df.select(value.alias("quantile")).where(value.isNotNull())
    rows = inside.count()
    rank, margin = max(math.ceil(rows * fraction), 1), 2 / accuracy
    sketched = isinstance(inside.schema["quantile"].dataType, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType))
    while sketched and rows > slice_rows:
        shares = [min(max(rank / rows + step, 0.0), 1.0) for step in (-margin, margin)]
        low, high = inside.agg(F.percentile_approx("quantile", shares, accuracy)).first()[0]
        under, upto = inside.agg(F.count_if(F.col("quantile") < low), F.count_if(F.col("quantile") <= high)).first()
        if not under < rank <= upto or (upto - under == rows and low != high):
            if margin >= 1:
                break
            margin = min(4 * margin, 1.0)
            continue
        inside = inside.where(F.col("quantile").between(low, high))
        rank, rows = rank - under, upto - under
        if low == high:
            return inside.limit(1)
    if not rows:
        return inside.limit(1)
    from_top = rank > rows // 2
    order = F.desc("quantile") if from_top else F.asc("quantile")
    return inside.orderBy(order).offset(rows - rank if from_top else rank - 1).limit(1)


def sketched_quantile(df: DataFrame, column: str, fraction: float, relative_error: float = 0.01) -> DataFrame:
    """The same within a rank error, from one mergeable sketch; NULLs are ignored."""
    accuracy = int(round(1 / relative_error))
    return df.agg(F.percentile_approx(column, fraction, accuracy).alias("quantile"))
