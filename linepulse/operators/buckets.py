"""Time-bucket width for the bucketed equi-joins.

Each interval is cut into the buckets it touches and events (or other
intervals) meet it in their own bucket.  A bucket much longer than the
intervals makes an event meet many intervals it is not in; a much shorter
one cuts every interval into many rows.  The width follows the median
interval length, clamped to [1 minute, 1 day] and rounded down to a power of
two seconds.  It is a scalar subquery evaluated once when the query runs
(no job while the plan is built).  Results never depend on the width, only
the amount of work does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linepulse.functions import MICROS_PER_DAY, MICROS_PER_SECOND, elapsed_micros

MIN_BUCKET_US = 60 * MICROS_PER_SECOND
MAX_BUCKET_US = MICROS_PER_DAY


def auto_bucket_us(intervals: DataFrame, start: str = "start_time",
                   end: str = "end_time") -> Column:
    """Bucket width in microseconds as a scalar-subquery column."""
    valid = intervals.filter(F.col(end).isNotNull() & (F.col(end) > F.col(start)))
    median = F.percentile_approx(elapsed_micros(start, end), 0.5, 1000)
    clamped = F.least(F.greatest(median, F.lit(MIN_BUCKET_US)), F.lit(MAX_BUCKET_US))
    seconds = F.floor(clamped / F.lit(MICROS_PER_SECOND))
    pow2 = F.pow(F.lit(2.0), F.floor(F.log2(seconds))).cast("bigint")
    width = F.coalesce(pow2 * F.lit(MICROS_PER_SECOND), F.lit(3600 * MICROS_PER_SECOND))
    return valid.select(width.cast("bigint").alias("bucket_us")).scalar()
