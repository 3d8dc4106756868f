"""Parsing of timestamps written as text in the two formats the loads use."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two text layouts found in the source loads
# (TO_DATE / TO_TIMESTAMP with 'MM/DD/YYYY HH24:MI:SS', and ISO text).
US_LAYOUT = "MM/dd/yyyy HH:mm:ss"
ISO_LAYOUT = "yyyy-MM-dd HH:mm:ss"


# The same layouts as patterns; seconds may carry a fraction of up to six digits.
_CLOCK = r"(\d{1,2}):(\d{1,2}):(\d{1,2}(?:\.\d{1,6})?)"
_US = r"^\s*(\d{1,2})/(\d{1,2})/(\d{4})"
_ISO = r"^\s*(\d{4})-(\d{1,2})-(\d{1,2})"


def _time(text: Column, date: str, year: int, month: int, day: int, clock: bool) -> Column:
    """The parts of a matching text as TIMESTAMP_NTZ, NULL where they are no
    time.  No zone takes part, so every wall-clock time is kept as written."""
    pattern = date + (r"[ T]" + _CLOCK if clock else "") + r"\s*$"

    def part(k: int, kind: str = "int") -> Column:
        return F.regexp_extract(text, pattern, k).try_cast(kind)

    zero = F.lit(0)
    hour, minute = (part(4), part(5)) if clock else (zero, zero)
    second = part(6, "decimal(16,6)") if clock else zero.cast("decimal(16,6)")
    # A leap second would pass into the next minute; it is no time here.
    valid = second < 60
    return F.when(valid, F.try_make_timestamp_ntz(part(year), part(month), part(day), hour, minute, second))


def parse_text_time(text: Column) -> Column:
    """TIMESTAMP_NTZ from either layout, fractions of seconds included;
    unparseable text gives NULL."""
    return F.coalesce(_time(text, _US, 3, 1, 2, True), _time(text, _ISO, 1, 2, 3, True))


def parse_text_date(text: Column) -> Column:
    """DATE from either timestamp layout or the same layouts without time."""
    return F.coalesce(parse_text_time(text), _time(text, _US, 3, 1, 2, False),
                      _time(text, _ISO, 1, 2, 3, False)).cast("date")
