"""Words of whole texts as Spark expressions. A word is a longest run of
characters other than space, tab, line feed, vertical tab, form feed and
carriage return; NULL texts have none."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: the characters between words.
WHITE_SPACE = " \t\n\x0b\f\r"
_SPACES = r"[\x20\x09-\x0D]+"


def _trimmed(text: Column) -> Column:
    return F.btrim(F.coalesce(text, F.lit("")), F.lit(WHITE_SPACE))


def words(text: Column) -> Column:
    """Array of the words, in order."""
    t = _trimmed(text)
    return F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, _SPACES))


def word_count(text: Column) -> Column:
    t = _trimmed(text)
    return F.when(t == "", F.lit(0)).otherwise(F.size(F.split(t, _SPACES))).cast("long")
