"""Work time (K4), OEE (K5), monthly averages (K6) and today's OEE.

K5 joins per-machine hours with the calendar, line quality and work time.
Its faithful grain is one row per (machine x calendar match x work-time row)
of a line-day, which grows quadratically with machines per line.  ``oee``
(the DISTINCT the readers use) therefore dedupes both sides *before* the
joins, and ``oee_counted`` returns each distinct row with its multiplicity
instead of materialising the fan-out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linepulse.functions import month_abbr, round_half_even, round_numeric, safe_div
from linepulse.operators.calendar import join_calendar

OEE_COLUMNS = ("line_id", "txndate", "month", "quarter", "year",
               "availability", "performance", "quality", "oee")


def work_time(machine_time_snapshot: DataFrame, config: DataFrame) -> DataFrame:
    """K4: scheduled and actual hours, one row per distinct (prod, down)
    hours of a line-day (not per machine, not per line), as in the source.
    ``config`` values come from a scalar subquery (``LIMIT 1``): no row -> NULL."""
    pm = config.select("pm_time").limit(1).scalar()
    total = config.select("total_time").limit(1).scalar()
    sub = (machine_time_snapshot
           .select("line_id", F.col("txndate").cast("date").alias("txndate"),
                   "prod_time", "down_time")
           .distinct())
    sched = total - pm
    return sub.select("line_id", "txndate", sched.alias("sched_work_time"),
                      (sched - F.col("down_time")).alias("actual_work_time"))


def _metrics(rating: Column) -> list[Column]:
    a, s = F.col("actual_work_time"), F.col("sched_work_time")
    qo, qg = F.col("qty_out"), F.col("qty_good")
    avail_ratio = safe_div(a, s)
    perf_ratio = safe_div(safe_div(qo, a), rating)
    qual_ratio = safe_div(qg, qo)
    availability = (F.round(avail_ratio.try_cast("decimal(38,12)"), 2) * 100).cast("double")
    return [
        availability.alias("availability"),
        round_numeric(perf_ratio * 100, 2).alias("performance"),
        round_half_even(qual_ratio * 100).alias("quality"),
        round_numeric(avail_ratio * perf_ratio * qual_ratio * 100, 2).alias("oee"),
    ]


def _assemble(days: DataFrame, calendar: DataFrame, line_quality: DataFrame,
              work: DataFrame, config: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    rating = config.select("idea_output_rating").scalar()
    j = join_calendar(days, calendar)
    q = line_quality.select("line_id", "txndate", "qty_out", "qty_good")
    j = j.join(q, ["line_id", "txndate"], "left").join(work, ["line_id", "txndate"], "left")
    return j.select("line_id", "txndate", month_abbr("txndate").alias("month"),
                    "quarter", "year", *_metrics(rating), *extra)


def oee_rows(machine_time_df: DataFrame, calendar: DataFrame, line_quality: DataFrame,
             work: DataFrame, config: DataFrame) -> DataFrame:
    """K5 at its faithful grain (the view's multiset).  Quadratic in machines
    per line-day; prefer :func:`oee` or :func:`oee_counted`."""
    days = machine_time_df.select("line_id", "txndate")
    return _assemble(days, calendar, line_quality, work, config)


def oee_counted(machine_time_df: DataFrame, calendar: DataFrame, line_quality: DataFrame,
                work: DataFrame, config: DataFrame) -> DataFrame:
    """K5 multiset as (distinct row, ``n_rows``) without the fan-out:
    multiplicity = machines of the line-day x equal work-time rows x
    calendar matches."""
    days = machine_time_df.groupBy("line_id", "txndate").agg(F.count(F.lit(1)).alias("_nm"))
    w = (work.groupBy("line_id", "txndate", "sched_work_time", "actual_work_time")
         .agg(F.count(F.lit(1)).alias("_nw")))
    rows = _assemble(days, calendar, line_quality, w, config,
                     extra=("_nm", "_nw"))
    n = F.col("_nm") * F.coalesce(F.col("_nw"), F.lit(1))
    return rows.groupBy(*OEE_COLUMNS).agg(F.sum(n).alias("n_rows"))


def oee(machine_time_df: DataFrame, calendar: DataFrame, line_quality: DataFrame,
        work: DataFrame, config: DataFrame) -> DataFrame:
    """K5 DISTINCT, computed on deduped inputs (no per-machine fan-out)."""
    days = machine_time_df.select("line_id", "txndate").distinct()
    w = work.distinct()
    return _assemble(days, calendar, line_quality, w, config).distinct()


def positive_oee(oee_df: DataFrame) -> DataFrame:
    """The report's final filter ``oee > 0`` (NULL oee dropped)."""
    return oee_df.filter(F.col("oee") > 0)


def monthly_oee(oee_df: DataFrame, month: str | None = None) -> DataFrame:
    """K6: rounded averages of the four measures per month label."""
    if month is not None:
        oee_df = oee_df.filter(F.col("month") == month)
    return oee_df.groupBy("month").agg(*[
        round_numeric(F.avg(c), 2).alias(f"avg_{c}")
        for c in ("availability", "performance", "quality", "oee")])


def today_oee(oee_df: DataFrame, as_of: str | None = None) -> DataFrame:
    """OEE rows of one day (default: the current date)."""
    day = F.current_date() if as_of is None else F.lit(as_of).cast("date")
    return oee_df.filter(F.col("txndate") == day)
