"""Grouped and global aggregations. All merge partial results on the map side."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def average_by(df: DataFrame, keys: Sequence[str], value: str, average: str = "avg", count: str = "n") -> DataFrame:
    """Mean and number of the non-null values per key."""
    return df.groupBy(*keys).agg(F.avg(value).alias(average), F.count(value).alias(count))


def sums_by(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Sum and number per key: the mergeable half of an average, for folding before a join."""
    return df.groupBy(*keys).agg(F.sum(value).alias("total"), F.count(value).alias("n"))


def average_of_sums(df: DataFrame, keys: Sequence[str], average: str = "avg") -> DataFrame:
    """Finish :func:`sums_by` over coarser keys: weighted mean and total count."""
    merged = df.groupBy(*keys).agg(F.sum("total").alias("total"), F.sum("n").alias("n")).where("n > 0")
    return merged.select(*keys, (F.col("total") / F.col("n")).alias(average), "n")


def average_wide(df: DataFrame, keys: Sequence[str], group: str, value: str, columns: Mapping[str, str]) -> DataFrame:
    """One mean per named group value, side by side; one pass, other group values are ignored."""
    listed = df.where(F.col(group).isin(*columns))
    means = [F.avg(F.when(F.col(group) == label, F.col(value))).alias(name) for label, name in columns.items()]
    return listed.where(F.col(value).isNotNull()).groupBy(*keys).agg(*means)


def count_by(df: DataFrame, keys: Sequence[str], name: str = "n", counted: str | None = None) -> DataFrame:
    """Rows per key; with ``counted`` only the rows in which that column is not null."""
    return df.groupBy(*keys).agg(F.count(counted or F.lit(1)).alias(name))


def distinct_values(column: str) -> Column:
    """Number of distinct values where NULL counts as one value, as in ``distinct().count()``."""
    holds_null = F.coalesce(F.max(F.when(F.col(column).isNull(), 1).otherwise(0)), F.lit(0))
    return F.count_distinct(column) + holds_null


def share_of_rows(predicate: Column) -> Column:
    """Share of the rows that meet a predicate, in percent; NULL meets nothing."""
    return F.avg(F.when(predicate, 100.0).otherwise(0.0))


def count_with_share(df: DataFrame, key: str, name: str = "n", share: str = "pct") -> DataFrame:
    """Rows per value and their percent of all rows. The total sums the counts, whose shuffle
    Spark reuses, so the rows are read once."""
    counts = count_by(df, [key], name)
    total = counts.agg(F.sum(name).alias("rows")).scalar()
    return counts.withColumn(share, F.col(name) * 100.0 / total)


def best_row(df: DataFrame, columns: Sequence[str], *rank: Column) -> DataFrame:
    """The row with the greatest ``rank`` as one row (none for no input), without sorting."""
    best = df.agg(F.max_by(F.struct(*columns), F.struct(*rank)).alias("best")).where("best is not null")
    return best.select("best.*")
