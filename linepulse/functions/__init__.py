"""Column-expression helpers (all JVM-side, codegen friendly)."""

from linepulse.functions.numeric import round_half_even, round_numeric, safe_div
from linepulse.functions.timecalc import (
    MICROS_PER_DAY,
    MICROS_PER_HOUR,
    MICROS_PER_SECOND,
    elapsed_micros,
    epoch_micros,
    floor_div,
    from_epoch_micros,
    hours_from_micros,
    month_abbr,
    ntz_literal,
    txn_date,
)
from linepulse.functions.textdates import parse_text_time

__all__ = [
    "MICROS_PER_DAY", "MICROS_PER_HOUR", "MICROS_PER_SECOND",
    "elapsed_micros", "epoch_micros", "floor_div", "from_epoch_micros",
    "hours_from_micros", "month_abbr", "ntz_literal", "txn_date", "parse_text_time",
    "round_half_even", "round_numeric", "safe_div",
]
