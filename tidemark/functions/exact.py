"""Exact arithmetic for money and averages.

Sums of doubles depend on the order in which tasks finish. Money is therefore summed as
decimals, and averages are formed from an exact sum and an exact count.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

# Money is summed in whole units of ten decimal places.
PLACES = 10
UNITS = 10**PLACES
# Amounts with up to four places take the fast way: rounding a double to a whole number costs a few
# nanoseconds, where a cast to a decimal goes through text.
_FAST = 10_000
# Degrees keep 14 digits behind the point.
DEGREES = DecimalType(18, 14)


def money(name: str) -> Column:
    """A money column in whole units, as a decimal whose sums hold totals below 1e28.

    The digits of the input are kept to ten places: a double stands for the shortest decimal that
    reads as it. NaN and amounts from 1e24 on are no amounts: they are null here, and
    ``left_out`` counts them, so one bad value neither ends a run nor vanishes in silence.
    """
    x = F.col(name).cast("double")
    steps = F.rint(x * F.lit(float(_FAST)))
    short = (steps / F.lit(float(_FAST)) == x) & (F.abs(steps) < F.lit(9.2e12))
    fast = (steps.try_cast("bigint") * F.lit(UNITS // _FAST)).cast("decimal(38,0)")
    units = F.lit(Decimal(UNITS))
    fine = (x.try_cast("decimal(28,10)") * units).cast("decimal(38,0)")
    # from 1e16 on a double is a whole number
    large = (x.try_cast("decimal(26,0)").cast("decimal(27,0)") * units).cast("decimal(38,0)")
    return F.when(short, fast).when(F.abs(x) < F.lit(1e16), fine).when(F.abs(x) < F.lit(1e24), large)


def left_out(name: str) -> Column:
    """Aggregate: values of a money column that no sum can hold."""
    return F.count_if(F.col(name).isNotNull() & money(name).isNull())


def degrees(name: str) -> Column:
    return F.col(name).cast(DEGREES)


def amount(units: Column, places: int = 2) -> Column:
    """A total in money units as an exact, rounded decimal amount."""
    return half_up_ratio(units, F.lit(Decimal(UNITS)), places, scale=0)


def half_up_ratio(numerator: Column, denominator: Column, places: int, scale: int = 0) -> Column:
    """``numerator / denominator`` rounded half up to ``places``, without an inexact quotient.

    Works on integers: the whole part and ``(2·rest·10^places + |d|) div (2·|d|)`` for the places, so
    a total up to the 38 digits of a sum is never multiplied itself. A zero denominator gives null.
    ``scale`` is the number of decimal digits both inputs may carry.
    """
    wide = DecimalType(34 if scale else 38, scale)
    n = numerator.try_cast(wide)
    d = denominator.cast(wide)
    divisor = F.nullif(F.abs(d), F.lit(Decimal(0)))
    step, steps = F.lit(Decimal(1).scaleb(-places)), F.lit(Decimal(2 * 10**places))
    if scale:
        doubled = F.abs(n) * steps + F.abs(d)
        size = F.call_function("div", doubled, divisor * F.lit(Decimal(2))).try_cast("decimal(28,0)") * step
    else:
        # ``div`` gives a BIGINT, which large totals leave; a division without remainder does not
        rest = F.abs(n) % divisor
        whole = F.try_divide(F.abs(n) - rest, divisor).try_cast("decimal(28,0)")
        doubled, twice = rest * steps + divisor, divisor * F.lit(Decimal(2))
        size = whole + ((doubled - doubled % twice) / twice).cast(DecimalType(places + 1, 0)) * step
    signed = F.when((n < 0) != (d < 0), -size).otherwise(size)
    return signed.cast(DecimalType(max(30, 28 + places), places))


def mean(total: Column, count: Column, places: int, scale: int = 0) -> Column:
    """Rounded average from an exact total and count, as a double."""
    return half_up_ratio(total, count, places, scale).cast("double")


def mean_amount(units: Column, count: Column, places: int = 2) -> Column:
    """Rounded average of a money column from its total in units, as a double."""
    return half_up_ratio(units, count.cast("decimal(20,0)") * F.lit(Decimal(UNITS)), places).cast("double")


def percent(part: Column, whole: Column, places: int) -> Column:
    """``part`` of ``whole`` in percent, as a decimal with ``places`` digits."""
    return half_up_ratio(part * F.lit(100), whole, places)
