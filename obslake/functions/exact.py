"""Order-independent arithmetic.

Sums of doubles depend on the order in which partitions arrive, so the same job can give two answers.
Readings carry at most four decimals; they are added as whole numbers of 1/10000 ("ticks"), which is
exact in any order, fits a mutable hash-aggregate buffer and needs no decimal objects.  A total may
reach 9e14 units; beyond that the sum raises an overflow instead of losing digits.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

SCALE_DIGITS = 4
SCALE = 10 ** SCALE_DIGITS
NAN = float("nan")

# Added to a double it changes -0.0 to 0.0 and nothing else.
_NO_MINUS_ZERO = 0.0
# Doubles below this keep nine decimals.
_FAST_LIMIT = 9.0e6
_GUARD_DIGITS = 9


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ticks(c: str | Column) -> Column:
    """The reading as a whole number of ticks; NaN and infinities give NULL."""
    return F.rint(col(c) * float(SCALE)).try_cast("bigint")


def amount(total: Column) -> Column:
    """A number of ticks as a double."""
    return total.cast("double") / float(SCALE)


def mean(total: Column, count: Column) -> Column:
    """Mean of ``count`` readings that add up to ``total`` ticks, NULL where there is none."""
    return F.try_divide(amount(total), count.cast("double"))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as a double, NULL on a zero or missing denominator."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def dround(c: str | Column, digits: int) -> Column:
    """Round half away from zero on the decimal value (2.675 gives 2.68), whatever its binary form.

    What differs from a half by less than the ninth decimal counts as a half.
    """
    x = col(c)
    power = 10.0 ** digits
    guard = 0.5 + 0.5 * 10.0 ** (digits - _GUARD_DIGITS)
    fast = F.signum(x) * F.floor(F.abs(x) * power + guard) / power + _NO_MINUS_ZERO
    return F.when(F.abs(x) < _FAST_LIMIT, fast).otherwise(F.round(x.cast("double"), digits))


def round_ticks(total: Column, digits: int) -> Column:
    """Round an exact total, halves away from zero."""
    step = 10 ** (SCALE_DIGITS - digits)
    units = F.call_function("div", F.abs(total) + step // 2, F.lit(step))
    return F.signum(total) * units / F.lit(10.0 ** digits) + _NO_MINUS_ZERO


def round_mean(total: Column, count: Column, digits: int) -> Column:
    """Mean of ``count`` readings rounded half away from zero, in whole numbers throughout."""
    unit = count * (2 * 10 ** (SCALE_DIGITS - digits))
    units = F.call_function("div", F.abs(total) * 2 + count * 10 ** (SCALE_DIGITS - digits), unit)
    return F.signum(total) * units / F.lit(10.0 ** digits) + _NO_MINUS_ZERO
