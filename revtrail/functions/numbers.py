"""Rounding and division with the same result on every engine."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
# Room for sums of money and for their products with small whole numbers.
_WIDE = "decimal(28,4)"


def rounded_ratio(numerator: Column, denominator: Column, places: int, even: bool = False) -> Column:
    """Fraction of two exact numbers, rounded once; null where the denominator is zero or null.

    The whole units come from a division without rest, and the rest decides the rounding:
    half away from zero, or with `even` to the even neighbour.
    """
    below = F.nullif(F.abs(denominator.cast("decimal(18,4)")), F.lit(0).cast("decimal(18,4)"))
    above = numerator.cast(_WIDE)
    positive = (above >= 0) == (denominator >= 0)
    units = F.abs(above) * F.lit(10**places).cast("decimal(10,0)")
    rest = units % below
    whole = ((units - rest) / below).cast("decimal(30,0)")
    twice = rest * 2
    up = twice >= below
    if even:
        up = (twice > below) | ((twice == below) & (whole % 2 == 1))
    size = (whole + F.when(up, 1).otherwise(0)).cast("double") / 10**places
    return F.when(positive, size).otherwise(-size)


def round_half_up(value: Column, places: int) -> Column:
    """Round an exact number half away from zero."""
    return F.round(value.cast("decimal(38,10)"), places).cast("double")


def round_double(value: Column, places: int) -> Column:
    """Round a floating-point number."""
    return F.round(value, places)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Fraction of two numbers; null where the denominator is zero or null."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def percent(numerator: Column, denominator: Column, places: int = 1) -> Column:
    return rounded_ratio(F.lit(100) * numerator, denominator, places)


def rounded_mean(value: Column, places: int) -> Column:
    """Average from the exact sum, rounded once."""
    return rounded_ratio(F.sum(value), F.count(value), places)


def mean_of(value: Column) -> Column:
    """Average of a money column from its exact sum."""
    return ratio(F.sum(value), F.count(value))
