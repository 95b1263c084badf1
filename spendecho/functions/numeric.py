from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, functions as F


def round_n(x: Column, places: int) -> Column:
    """Half away from zero on the binary value, the same on every engine."""
    scale = float(10 ** places)
    return F.signum(x) * F.floor(F.abs(x) * F.lit(scale) + F.lit(0.5)) / F.lit(scale) + F.lit(0.0)


def ratio(a: Column, b: Column, places: int | None = None) -> Column:
    """a / b as double; NULL when b is zero."""
    value = F.try_divide(a.cast("double"), b.cast("double"))
    return value if places is None else round_n(value, places)


def money_sum(amount: Column) -> Column:
    """Exact sum of a two-place decimal.

    Adds whole cents as 64-bit integers (no big-decimal arithmetic per row), so
    the total does not depend on task order; good for 9.2e16 currency units.
    """
    cents = F.sum((amount * F.lit(100)).cast("bigint"))
    return (cents.cast("decimal(20,0)") * F.lit(Decimal("0.01"))).cast("decimal(22,2)")


def exact_avg(x: Column, places: int) -> Column:
    """Average of a double that does not depend on row order: values are added as
    decimals of 17 places, which hold every double of [0, 1] to its last digit.
    Values of 1e11 and more, where that type ends, are averaged as doubles."""
    wide = F.when(F.abs(x) < 1e11, x).cast("decimal(28,17)")
    exact = ratio(F.sum(wide), F.count(x), places)
    return F.when(F.count(wide) == F.count(x), exact).otherwise(round_n(F.avg(x), places))


def clamp01(x: Column) -> Column:
    """Text or number to [0, 1]; anything that is not a number becomes 0."""
    value = F.coalesce(x.try_cast("double"), F.lit(0.0))
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), value))
