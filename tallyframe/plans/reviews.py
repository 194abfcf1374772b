"""Text reviews: words without stop words, counts by category and aspect, top words.

Tables: reviews(id, review, category, aspect, sentiment), stopwords(stopword). Which columns make
a review distinct differs by analysis, and changes its word counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.operators.aggregates import count_by
from tallyframe.operators.rows import distinct_rows, top_per_group, top_rows
from tallyframe.operators.words import content_words


def review_words(reviews: DataFrame, stopwords: DataFrame) -> DataFrame:
    """One row per content word of each distinct row."""
    labels = ("id", "category", "aspect", "sentiment")
    words = content_words(distinct_rows(reviews, "id", "review", *labels[1:]), "review", stopwords, *labels)
    return words.select("id", "word", *labels[1:])


def frequent_words(reviews: DataFrame, stopwords: DataFrame, more_than: int = 500) -> DataFrame:
    words = content_words(distinct_rows(reviews, "id", "review"), "review", stopwords)
    return count_by(words, ["word"], "freq").where(F.col("freq") > more_than)


def rows_per(reviews: DataFrame, column: str, sentiment: str | None = None, name: str = "total_comments") -> DataFrame:
    """Raw rows with an id per category or aspect, of one sentiment if named."""
    rows = reviews if sentiment is None else reviews.where(F.col("sentiment") == sentiment)
    return count_by(rows, [column], name, counted="id")


def most_of(counts: DataFrame, column: str, count: str) -> DataFrame:
    """The value with the highest count; the first in text order wins a tie."""
    return top_rows(counts, 1, F.desc(count), F.asc(column))


def top_words(reviews: DataFrame, stopwords: DataFrame, k: int = 5, sentiment: str | None = None) -> DataFrame:
    """The ``k`` most frequent words per category, of one sentiment if named; ties by word."""
    labels = ["category"] if sentiment is None else ["category", "sentiment"]
    rows = distinct_rows(reviews, "id", "review", *labels)
    if sentiment is not None:
        rows = rows.where(F.col("sentiment") == sentiment)
    counts = count_by(content_words(rows, "review", stopwords, *labels), [*labels, "word"], "freq")
    return top_per_group(counts, ["category"], k, F.desc("freq"), F.asc("word"))
