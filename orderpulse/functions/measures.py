"""Small numeric column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def share(part: Column, whole: Column) -> Column:
    """part / whole with an empty whole counted as one."""
    return part / F.greatest(whole, F.lit(1))


def percent_of(part: Column, whole: Column) -> Column:
    """Percentage, zero for an empty whole, NULL when either side is unknown."""
    return F.when(whole == 0, F.lit(0.0)).otherwise(part / whole * 100)


def sum_where(condition: Column, value: str) -> Column:
    """Sum over matching rows, NULL when none matches."""
    return F.sum(F.when(condition, F.col(value)))


def mean_where(condition: Column, value: Column) -> Column:
    return F.avg(F.when(condition, value))


def mean_minutes_where(condition: Column, seconds: Column) -> Column:
    """Mean in minutes from exact sums, so that it does not depend on the order of rows."""
    known = F.when(condition, seconds)
    return F.try_divide(F.sum(known), F.count(known) * F.lit(60.0))
