"""Rows of words out of rows of text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.functions.text import word_pieces
from tallyframe.operators.joins import without_listed


def words_of(df: DataFrame, text: str, *kept: str, word: str = "word") -> DataFrame:
    """One row per word of each text, repeated words kept, with the ``kept`` columns.

    The empty piece before or after the words of a text goes behind the explode, which keeps the
    whole step inside generated code.
    """
    return df.select(*kept, F.explode(word_pieces(F.col(text))).alias(word)).where(F.col(word) != "")


def content_words(df: DataFrame, text: str, stopwords: DataFrame, *kept: str) -> DataFrame:
    """Words that are not on the stop list. The list joins by equality, so entries of several
    words never match. It is small enough for Spark to broadcast, and words go before the shuffle."""
    words = words_of(df, text, *kept)
    return without_listed(words, "word", stopwords, "stopword").select(*kept, "word")
