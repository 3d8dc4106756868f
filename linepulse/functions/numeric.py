"""Rounding and division with the host database's numeric rules.

``ROUND(x::numeric, s)`` first turns the double into the decimal of its 15
significant digits, whatever its size, and then rounds half away from zero.
We do the same: a value of 10^15 or more has no digits behind the point left and
is its 15 digits; a smaller one is rounded as DECIMAL(38,22), which holds all 15
digits from 10^-7 on (less than that rounds to zero at any scale up to 6).
``ROUND(double)`` without scale rounds half to even (``rint``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMERIC_TYPE = "decimal(38,22)"
WHOLE_FROM = 1e15


def round_numeric(x: Column, scale: int) -> Column:
    """Half-away-from-zero rounding of a double through its 15 significant
    digits, for scales 0 to 6; NULL for NULL and for values that are no number."""
    x = x.cast("double")
    digits = F.format_string("%.14e", x)
    return (F.when(F.isnan(x) | x.isNull() | (F.abs(x) == float("inf")), F.lit(None).cast("double"))
            .when(F.abs(x) >= WHOLE_FROM, digits.cast("double"))
            .otherwise(F.round(digits.try_cast(NUMERIC_TYPE), scale).cast("double")))


def round_half_even(x: Column) -> Column:
    """``ROUND(double precision)``: nearest integer, ties to even."""
    return F.rint(x)


def safe_div(num: Column, den: Column) -> Column:
    """Division that yields NULL for a zero or NULL denominator."""
    return F.try_divide(num.cast("double"), den.cast("double"))
