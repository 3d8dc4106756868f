"""Machine hours per day (K1) and the downtime ranking (K7)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linepulse.functions import elapsed_micros, hours_from_micros, txn_date
from linepulse.schemas import DOWN_STATES, PROD_STATES


def machine_micros(machine_state: DataFrame, machine: DataFrame,
                   prod_states: Sequence[str] = PROD_STATES,
                   down_states: Sequence[str] = DOWN_STATES) -> DataFrame:
    """Exact production and down microseconds (``prod_us``, ``down_us``) per
    (machine_id, line_id, txndate); :func:`machine_time` converts to hours.

    Intervals count wholly on their start date and join the machine
    dimension (unknown machines are dropped).  The source's two-level
    aggregate (per state, then per machine) collapses into one group-by with
    two conditional sums of exact BIGINT microseconds, divided once at the
    end; groups with neither state give 0 and 0.
    """
    st = machine_state.select("machine_id", "state",
                              txn_date("start_time").alias("txndate"),
                              elapsed_micros("start_time", "end_time").alias("_us"))
    zero = F.lit(0).cast("bigint")
    prod = F.when(F.col("state").isin(*prod_states), F.col("_us")).otherwise(zero)
    down = F.when(F.col("state").isin(*down_states), F.col("_us")).otherwise(zero)
    # aggregate first (map-side partial sums), then attach the line: the join
    # sees one row per machine-day, and a machine listed twice in the
    # dimension still gets its full sums on each line, as in the source
    per_day = st.groupBy("machine_id", "txndate").agg(
        F.sum(prod).alias("prod_us"), F.sum(down).alias("down_us"))
    dim = machine.select("machine_id", "line_id")
    return per_day.join(dim, "machine_id").select(
        "machine_id", "line_id", "txndate", "prod_us", "down_us")


def machine_time(machine_state: DataFrame, machine: DataFrame,
                 prod_states: Sequence[str] = PROD_STATES,
                 down_states: Sequence[str] = DOWN_STATES) -> DataFrame:
    """K1: production and down hours per (machine_id, line_id, txndate)."""
    us = machine_micros(machine_state, machine, prod_states, down_states)
    return us.select("machine_id", "line_id", "txndate",
                     hours_from_micros("prod_us").alias("prod_time"),
                     hours_from_micros("down_us").alias("down_time"))


def downtime_ranking(machine_time_df: DataFrame, top: int | None = None) -> DataFrame:
    """K7: total down hours per machine, largest first (NULLs first, as the
    host database sorts them on DESC).  ``top`` keeps the first k rows (a
    top-k report).  Given :func:`machine_micros` output the sum is exact."""
    if "down_us" in machine_time_df.columns:
        total = hours_from_micros(F.sum("down_us"))
    else:
        total = F.sum("down_time")
    out = (machine_time_df.groupBy("machine_id").agg(total.alias("total_down_time"))
           .orderBy(F.col("total_down_time").desc_nulls_first(), "machine_id"))
    return out.limit(top) if top else out
