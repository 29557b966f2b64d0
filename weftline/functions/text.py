"""Text and number tests."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_null_or_blank(column: str) -> Column:
    """True for NULL, for empty text and for text of blanks only."""
    value = F.col(column)
    return value.isNull() | (F.trim(value) == "")


def as_number(column: str, type_name: str = "double") -> Column:
    """Text read as a number; text that is none gives NULL instead of failing the job."""
    return F.col(column).try_cast(type_name)
