"""Order-independent money arithmetic.

Double sums depend on the order partial sums arrive in, so a retried task can change the last
digits of a total. Amounts are therefore summed exactly, to ten fractional digits: enough for a
four-digit amount times a six-digit rate. The sums run on longs (whole units and two groups of
five digits), which stay in generated code and cannot overflow below 10^13 rows per group; only
the finished totals are decimals.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, functions as F

EXACT = "decimal(28,10)"
TOTAL = "decimal(20,0)"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def exact(c: str | Column) -> Column:
    """One amount as an exact decimal."""
    return col(c).cast(EXACT)


def exact_sum(c: str | Column) -> Column:
    """Exact decimal total of doubles, for totals that are added up again."""
    v = col(c).cast("double")
    whole = F.floor(v)
    digits = F.floor((v - whole) * 1e10 + 0.5)
    upper = F.floor(digits / 100000)
    lower = digits - upper * 100000
    return (F.sum(whole).cast(TOTAL) + F.sum(upper).cast(TOTAL) * F.lit(Decimal("0.00001"))
            + F.sum(lower).cast(TOTAL) * F.lit(Decimal("0.0000000001"))).cast("decimal(38,10)")


def as_money(total: str | Column) -> Column:
    """An exact total as a double with four fractional digits."""
    return F.round(col(total), 4).cast("double")


def money_sum(c: str | Column) -> Column:
    return as_money(exact_sum(c))


def ratio(numerator: str | Column, denominator: str | Column) -> Column:
    """Double division; null on a zero or null denominator."""
    return F.try_divide(col(numerator).cast("double"), col(denominator).cast("double"))


def growth(current: str | Column, base: str | Column) -> Column:
    return ratio(current, base) - F.lit(1.0)
