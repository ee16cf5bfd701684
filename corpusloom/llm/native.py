"""Column expressions shared by the operators that use DataFrame functions only."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows that may be broadcast; beyond it the same join is shuffled.
BROADCAST_ROWS = 200_000


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else.

    ``lower`` does just that, and fast, on a text of ASCII characters only.
    """
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def words(text: Column, separators: str) -> Column:
    """The words of a lower-cased text between runs of separators; a null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), separators), "")


def bounded(df: DataFrame, rows: int) -> DataFrame:
    """Marked for broadcast if it has no more than BROADCAST_ROWS rows, which the caller counted."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df
