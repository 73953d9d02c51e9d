"""Column-expression builders for numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PLAIN = 2.0**40  # up to here a scaled number is exact to 1/8192
MARGIN = 1e-3


def rounded(col: Column | str, digits: int) -> Column:
    """``F.round(col, digits)`` of a double, value for value.  ``F.round`` goes through the decimal text of each number; that is
    needed only near the middle between two results, so all others are rounded by arithmetic."""
    x = F.col(col) if isinstance(col, str) else col
    scaled = x * F.lit(float(10**digits))
    plain = (F.abs(scaled) < PLAIN) & (F.abs(scaled - F.floor(scaled) - 0.5) > MARGIN)
    return F.when(plain, F.floor(scaled + 0.5) / F.lit(float(10**digits))).otherwise(F.round(x, digits))
