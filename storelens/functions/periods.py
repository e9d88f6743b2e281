"""Calendar periods, labelled by their last day."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Lag of the long growth rate, in periods.
LONG_LAG = {"M": 12, "W": 4, "Q": 4}


def period_end(date: Column, period: str) -> Column:
    if period == "M":
        return F.last_day(date)
    if period == "W":
        return F.next_day(F.date_sub(date, 1), "SUN")
    if period == "Q":
        return F.last_day(F.add_months(F.trunc(date, "quarter"), 2))
    raise ValueError(f"period must be M, W or Q, not {period!r}")


def period_ends_between(first: Column, last: Column, period: str) -> Column:
    """All period ends from one period end to another, as an array."""
    if period == "W":
        return F.sequence(first, last, F.expr("interval 7 days"))
    step = "interval 1 month" if period == "M" else "interval 3 months"
    starts = F.sequence(F.trunc(first, "month"), F.trunc(last, "month"), F.expr(step))
    return F.transform(starts, F.last_day)
