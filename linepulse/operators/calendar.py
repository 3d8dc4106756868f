"""Half-open range join of dates to fiscal calendar weeks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linepulse.operators.joins import bounded_broadcast


def calendar_days(calendar: DataFrame) -> DataFrame:
    """One row per (calendar row, day in [start_date, end_date)).

    Rows with end <= start cover no day.  Overlapping weeks give a day two
    rows; days in a gap get none.  Size is bounded by the calendar's span.
    """
    last = F.date_sub("end_date", 1)
    days = F.when(F.col("end_date") > F.col("start_date"),
                  F.sequence("start_date", last)).otherwise(F.array().cast("array<date>"))
    return calendar.select("*", F.explode(days).alias("cal_date"))


def join_calendar(df: DataFrame, calendar: DataFrame, date_col: str = "txndate",
                  columns: tuple[str, ...] = ("quarter", "year")) -> DataFrame:
    """Inner join ``df.date_col`` to weeks with ``start <= date < end``.

    Instead of a non-equi (nested-loop) join, the calendar is expanded to
    days and joined on the date: a hash join, broadcast when the expanded
    calendar is within the size bound (it grows with the calendar's years,
    not with the data).
    """
    days = calendar_days(calendar).select(F.col("cal_date").alias(date_col), *columns)
    return df.join(bounded_broadcast(days), date_col)
