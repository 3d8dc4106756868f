"""Time arithmetic on TIMESTAMP_NTZ, exact in BIGINT microseconds.

Spark has no ``EXTRACT(EPOCH ...)`` and ``unix_micros`` rejects
TIMESTAMP_NTZ.  Epoch microseconds are assembled from date parts (days since
1970, hour, minute, seconds with fraction), which for NTZ values never
consult the session time zone, so results are the same under any
``spark.sql.session.timeZone`` and across daylight-saving changes.  Sums stay
BIGINT and are divided once at the end, so results do not depend on
summation order.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_SECOND = 1_000_000
MICROS_PER_HOUR = 3_600 * MICROS_PER_SECOND
MICROS_PER_DAY = 24 * MICROS_PER_HOUR

_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def epoch_micros(ts: Column | str) -> Column:
    """Microseconds since 1970-01-01 00:00 of a TIMESTAMP_NTZ (BIGINT)."""
    t = _c(ts)
    days = F.datediff(F.to_date(t), F.lit("1970-01-01").cast("date")).cast("bigint")
    return (days * F.lit(MICROS_PER_DAY)
            + F.hour(t).cast("bigint") * F.lit(MICROS_PER_HOUR)
            + F.minute(t).cast("bigint") * F.lit(60 * MICROS_PER_SECOND)
            + (F.extract(F.lit("SECOND"), t) * F.lit(MICROS_PER_SECOND)).cast("bigint"))


def elapsed_micros(start: Column | str, end: Column | str) -> Column:
    """``end - start`` in microseconds (BIGINT); NULL if either is NULL."""
    return epoch_micros(end) - epoch_micros(start)


def from_epoch_micros(us: Column | str) -> Column:
    """Inverse of :func:`epoch_micros`, returns TIMESTAMP_NTZ."""
    return F.timestamp_add("MICROSECOND", _c(us), F.expr(_EPOCH))


def floor_div(value: Column | str, divisor: int | Column) -> Column:
    """Floor division of a BIGINT by a positive divisor (also below zero).

    The dividend is first made an exact multiple, so the division is exact
    for magnitudes below 2^53 (epoch microseconds up to the year 2255).
    ``divisor`` may be a column (e.g. a scalar subquery).
    """
    v = _c(value)
    d = divisor if isinstance(divisor, Column) else F.lit(divisor)
    return ((v - F.pmod(v, d)) / d).cast("bigint")


def hours_from_micros(us: Column | str) -> Column:
    """BIGINT microseconds to DOUBLE hours (one division, done last)."""
    return _c(us) / F.lit(float(MICROS_PER_HOUR))


def txn_date(ts: Column | str) -> Column:
    """Calendar date of a timestamp; an interval belongs to its start date."""
    return F.to_date(_c(ts))


def month_abbr(d: Column | str) -> Column:
    """``TO_CHAR(d, 'MON')``: upper-case English month abbreviation."""
    return F.upper(F.date_format(_c(d), "MMM"))


def ntz_literal(value) -> Column:
    """A TIMESTAMP_NTZ (or DATE) literal from a Python datetime/date, built
    from its ISO text so neither the Python nor the session time zone
    shifts it (``F.lit(datetime)`` goes through the local zone)."""
    import datetime as _dt

    if isinstance(value, _dt.datetime):
        return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")
    if isinstance(value, _dt.date):
        return F.lit(value.isoformat()).cast("date")
    raise TypeError(type(value))
