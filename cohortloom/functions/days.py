"""Closed day intervals and ages; the one place where their off-by-ones live."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def length(start, end) -> Column:
    """Days of a closed interval."""
    return (F.datediff(end, start) + 1).cast("long")


def within(day, index, low: int | None, high: int | None) -> Column:
    """Whether day is from low to high days after index, both included; None: no limit."""
    gap = F.datediff(day, index)
    out = F.lit(True)
    if low is not None:
        out = out & (gap >= low)
    if high is not None:
        out = out & (gap <= high)
    return out


def age(birth, day) -> Column:
    """Completed years: one less before the (month, day) of birth."""
    before = (F.month(day) < F.month(birth)) | ((F.month(day) == F.month(birth)) & (F.dayofmonth(day) < F.dayofmonth(birth)))
    return (F.year(day) - F.year(birth) - before.cast("int")).cast("long")


def band(value, cuts: list[int]) -> Column:
    """Label of the half-open band of cuts that value is in: <a, a-b, .., >=z."""
    value = F.col(value) if isinstance(value, str) else value
    out = F.when(value < cuts[0], f"<{cuts[0]}")
    for a, b in zip(cuts, cuts[1:]):
        out = out.when(value < b, f"{a}-{b - 1}")
    return out.when(value >= cuts[-1], f">={cuts[-1]}")
