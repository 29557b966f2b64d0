"""Units: bytes as text, times and bytes in report units."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Powers of 1024.
BYTE_UNITS = ("B", "KB", "MB", "GB", "TB", "PB", "EB", "ZB", "YB")

MS_PER_SECOND = 1000
MS_PER_MINUTE = 60_000
BYTES_PER_MB = 1024 * 1024


def format_bytes(column: Column | str) -> Column:
    """``0B`` for zero, otherwise ``<value> <unit>`` in powers of 1024, rounded to two decimals."""
    size = F.col(column) if isinstance(column, str) else column
    text = F.when(size == 0, F.lit("0B"))
    # Compare with exact powers: a logarithm can land just below a whole number.
    for power, unit in reversed(list(enumerate(BYTE_UNITS))):
        scaled = F.round(size.cast("double") / F.lit(float(1024**power)), 2)
        text = text.when(
            size.cast("double") >= float(1024**power),
            F.concat(scaled.cast("string"), F.lit(f" {unit}")),
        )
    return text


def to_seconds(column: str) -> Column:
    return F.col(column) / MS_PER_SECOND


def to_minutes(column: str) -> Column:
    return F.col(column) / MS_PER_MINUTE


def to_mb(column: str) -> Column:
    return F.col(column) / BYTES_PER_MB
