"""Exact money aggregates.

Sums of doubles depend on the order of the rows, so money stays decimal until
the last step. Per row a decimal sum allocates objects; splitting the cents
into two whole numbers keeps the aggregate in plain long arithmetic. Both parts
stay exact up to 5e11 rows in one group, and the session's overflow check
guards the rest.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_SPLIT_BITS = 24


def _cents(amount: Column) -> Column:
    return (amount.cast("decimal(14,2)") * 100).cast("long")


def money_sum(amount: Column) -> Column:
    """Exact sum of an amount with two decimals, as ``decimal(24,2)``."""
    cents = _cents(amount)
    high = F.sum(F.shiftright(cents, _SPLIT_BITS))
    low = F.sum(cents.bitwiseAND(F.lit((1 << _SPLIT_BITS) - 1)))
    total = high.cast("decimal(20,0)") * F.lit(1 << _SPLIT_BITS).cast("decimal(8,0)") + low.cast("decimal(20,0)")
    return (total * F.lit("0.01").cast("decimal(2,2)")).cast("decimal(24,2)")


def half_up_ratio(total: Column, count: Column) -> Column:
    """``total / count`` rounded half up to two decimals; NULL unless count > 0.

    The quotient has 16 decimals. A quotient that is not itself a tie is at
    least ``1 / (200 * count)`` away from one, so rounding twice is safe for
    any count below 1e14.
    """
    exact = total.cast("decimal(24,2)") / F.when(count > 0, count).cast("decimal(15,0)")
    return F.round(exact, 2).cast("double")


def money_avg(amount: Column) -> Column:
    """Average over the rows that have an amount, half up to two decimals."""
    return half_up_ratio(money_sum(amount), F.count(amount))
