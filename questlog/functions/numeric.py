"""Rounding, ratios and sums whose result does not depend on row order."""

from __future__ import annotations

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F

#: Digits behind the point with which amounts are summed, unless the caller says otherwise.
MONEY_DIGITS = 6


def round_half_away(value: Column, digits: int) -> Column:
    """Scale, round half away from zero, scale back - all in double arithmetic."""
    factor = F.lit(float(10**digits))
    return F.round(value.cast("double") * factor, 0) / factor


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double division; NULL where the denominator is zero."""
    return numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))


def money(amount: Column, digits: int = MONEY_DIGITS) -> Column:
    """Amount as a fixed-point decimal; NULL for NaN, infinities and what has over 22 digits before the point."""
    return amount.try_cast(f"decimal({22 + digits},{digits})")


def exact_sum(
    amount: Column, over: WindowSpec | None = None, digits: int = MONEY_DIGITS
) -> Column:
    """Sum of a double column (over a window if given); NULL if nothing was summed.

    Amounts add up as fixed-point decimals, so partial sums may be merged in
    any order. What does not fit a decimal (NaN, infinities) is summed apart
    as double and added at the end.
    """
    fixed = F.sum(money(amount, digits))
    rest = F.sum(F.when(money(amount, digits).isNull(), amount.cast("double")))
    if over is not None:
        fixed, rest = fixed.over(over), rest.over(over)
    fixed = fixed.cast("double")
    return F.when(rest.isNull(), fixed).otherwise(F.coalesce(fixed, F.lit(0.0)) + rest)
