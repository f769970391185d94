"""Range rules on numeric columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .casts import ColumnOrName, as_column


def clamp(c: ColumnOrName, low: float, high: float) -> Column:
    """Pull a value into [low, high]; null stays null (greatest/least drop it)."""
    c = as_column(c)
    return F.when(c < low, F.lit(low)).when(c > high, F.lit(high)).otherwise(c)


def null_below(c: ColumnOrName, floor: float) -> Column:
    c = as_column(c)
    return F.when(c >= floor, c)
