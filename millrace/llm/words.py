"""Words as the contracts define them: runs of bytes other than ASCII white space."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """All words in order; none for null and blank texts."""
    inner = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(F.length(inner) == 0, F.array().cast("array<string>")).otherwise(F.split(inner, GAP))


def word_count(text: Column) -> Column:
    """The number of words without making them."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("bigint")
