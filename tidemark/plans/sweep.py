"""Interval sweeps: counting what is alive at each date without a range join.

An interval [start, end) adds its weight at the start and removes it at the
end; the level at a date is the running sum of those changes. The cost is
linear in the number of intervals and the only unpartitioned window runs over
one row per date.
"""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F


def running_level(at: str, *changes: str) -> list[Column]:
    """Running sums of change columns over one-row-per-date frames."""
    upto = Window.orderBy(at).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return [F.sum(c).over(upto).alias(c) for c in changes]

