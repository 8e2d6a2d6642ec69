"""Ratios with the guards the reports need, and printf-style rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    """Division that gives 0 when there is nothing to divide by."""
    return F.when(denominator > 0, numerator / denominator).otherwise(F.lit(0.0))


def floor_ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    """Floor division as a bigint, 0 when the denominator is not positive.

    Spark's ``div`` truncates towards zero, so negative totals need ``floor``.
    """
    quotient = F.floor(F.try_divide(numerator, denominator)).cast("bigint")
    return F.when(denominator > 0, quotient).otherwise(F.lit(0).cast("bigint"))


def _printed_units(x: Column, digits: int) -> Column:
    """``x >= 0`` in units of ``10**-digits``, rounded on its exact binary value.

    A printed number is rounded on the exact value of the double, ties to even,
    while SQL ``round`` works on its shortest decimal text (0.35 is stored a
    little below 0.35 and prints as 0.3). The scale is split into powers of two,
    whose products are exact, and subtracting them from the nearby half-way
    point one after the other is exact too, so the comparison has no error.
    """
    # 2 * 10**digits as a sum of powers of two
    powers = {1: (16.0, 4.0), 2: (128.0, 64.0, 8.0)}[digits]
    below = F.floor(x * float(10 ** digits)).cast("bigint")
    rest = (below * 2 + 1).cast("double")
    for power in powers[:-1]:
        rest = rest - x * power
    last = x * powers[-1]
    return (F.when(last < rest, below)
            .when(last > rest, below + 1)
            .otherwise(below + below % 2))


def printed(x: Column, digits: int) -> Column:
    """Text of a double with one or two decimals, as printf writes it."""
    units = _printed_units(F.abs(x), digits)
    scale = 10 ** digits
    return F.concat(F.when((x < 0), F.lit("-")).otherwise(F.lit("")),
                    F.floor(units / scale).cast("string"), F.lit("."),
                    F.lpad((units % scale).cast("string"), digits, "0"))


def printed_round(x: Column, digits: int) -> Column:
    """A double rounded to one or two decimals, as printf rounds it."""
    units = _printed_units(F.abs(x), digits) / float(10 ** digits)
    return F.when(x < 0, -units).otherwise(units)


def human_duration(seconds: Column) -> Column:
    """Seconds as ``12.3s``, ``4.5m`` or ``6.7h``."""
    return (F.when(seconds < 60, F.concat(printed(seconds, 1), F.lit("s")))
            .when(seconds < 3600, F.concat(printed(seconds / 60.0, 1), F.lit("m")))
            .otherwise(F.concat(printed(seconds / 3600.0, 1), F.lit("h"))))
