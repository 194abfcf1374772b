"""Text helpers: cleaning, tokens, list fields, fixed-width number text and line templates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The character classes that make up words.
NOT_WORD_OR_SPACE = r"[^\p{L}\p{N}\s]"
NOT_WORD = r"[^\p{L}\p{N}]+"
SPACES = r"\s+"
CONTROL_EDGES = r"^[\x00-\x20]+|[\x00-\x20]+$"


def strip_punctuation(text: Column) -> Column:
    """Every character that is no letter, digit or white space becomes one space."""
    return F.regexp_replace(text, NOT_WORD_OR_SPACE, " ")


def collapse_spaces(text: Column) -> Column:
    return F.regexp_replace(text, SPACES, " ")


def trim_all(text: Column) -> Column:
    """Strip blanks, tabs, line breaks and other control characters from both ends."""
    return F.regexp_replace(text, CONTROL_EDGES, "")


def clean_text(text: Column) -> Column:
    """Lower case, punctuation to spaces, runs of white space to one, no space at the ends."""
    return F.trim(collapse_spaces(strip_punctuation(F.lower(text))))


def word_pieces(text: Column) -> Column:
    """The words of ``clean_text``, duplicates kept, by one pass of one pattern; the first and the
    last piece may be empty.

    A word is a longest run of letters and digits, so splitting the raw lower-cased text on all
    else gives the same words as cleaning first and splitting on the single spaces that remain.
    """
    return F.split(F.lower(text), NOT_WORD)


def list_items(field: Column, trimmed: bool = True) -> Column:
    """The items of a ``|``-separated field. The trimmed form leaves out empty items at the end of the
    field, so a field of bars only has none; the other keeps every item."""
    if not trimmed:
        return F.split(field, r"\|")
    inner = F.split(F.regexp_replace(field, r"\|+$", ""), r"\|")
    return F.when(field.rlike(r"^\|+$"), F.array().cast("array<string>")).otherwise(F.transform(inner, trim_all))


def strip_carriage_return(text: Column) -> Column:
    return F.regexp_replace(text, "\r", "")


def fixed2_half_up(number: Column) -> Column:
    """Two decimals, ties away from zero, judged on the printed digits (2.675 -> 2.68)."""
    return F.format_string("%.2f", number)


def fixed2_half_even(number: Column) -> Column:
    """Two decimals, ties to even, judged on the exact binary value (3.125 -> 3.12, 2.675 -> 2.67)."""
    return F.call_function("format_number", number, F.lit("0.00"))


def fixed1_half_even(number: Column) -> Column:
    return F.call_function("format_number", number, F.lit("0.0"))


def thousands(number: Column) -> Column:
    return F.format_number(number, 0)


def percent_bar(percent: Column) -> Column:
    """One ``#`` per full two percent."""
    return F.repeat(F.lit("#"), F.floor(percent / 2).cast("int"))
