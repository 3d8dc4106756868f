"""The batch report (K12) and the views it is made of, over a ``Plant``.

As in the source's report procedure, the steps are materialised: the
machine-time view is snapshotted into a table (A6), the lot table is
refreshed (counters then write-back, K11) and stored, and OEE reads those
tables.  Each stored step also cuts the lineage, so a lost executor
recomputes from the last stored table, not from the raw samples.
"""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linepulse.functions import ntz_literal
from linepulse.operators import lots as L
from linepulse.operators import oee as O
from linepulse.operators.machine_time import machine_time
from linepulse.plans.plant import Plant
from linepulse.session import work_path
from linepulse.sources.versioned import VersionedTable, snapshot


def plant_machine_time(p: Plant, down_states=None) -> DataFrame:
    return machine_time(p.machine_state, p.machine, p.prod_states,
                        p.down_states if down_states is None else down_states)


def refreshed_lots(p: Plant) -> DataFrame:
    return L.refresh_lots(p.lot, p.sensor_events, p.policy)


@dataclass(frozen=True)
class ReportTables:
    machine_time: DataFrame      # A6 snapshot of K1
    lot: DataFrame               # K11-refreshed lot table


def store_report_tables(p: Plant, root: str | None = None) -> ReportTables:
    """Run the report's write steps; returns the stored tables.

    The machine-time snapshot (A6) and the lot refresh (K11) read disjoint
    inputs, so they are submitted as two concurrent Spark jobs.
    """
    spark = p.lot.sparkSession
    root = root or work_path(spark, "report", unique=True)
    mt_table = VersionedTable(spark, f"{root}/machine_time", partition_by=("txndate",))
    lot_table = VersionedTable(spark, f"{root}/lot")
    # Rows of a day in few files, but a day too large for one task is split.
    mt_view = plant_machine_time(p).hint("rebalance", "txndate")
    lot_view = refreshed_lots(p)
    with ThreadPoolExecutor(max_workers=2) as pool:
        mt_job = pool.submit(snapshot, mt_table, mt_view)
        lot_job = pool.submit(snapshot, lot_table, lot_view)
        return ReportTables(machine_time=mt_job.result(), lot=lot_job.result())


def live_tables(p: Plant) -> ReportTables:
    """The report tables as views (nothing written): K1 and refreshed lots."""
    return ReportTables(machine_time=plant_machine_time(p), lot=refreshed_lots(p))


def oee_inputs(p: Plant, tables: ReportTables | None = None):
    """(K1, calendar, K3, K4, config) for the OEE operators over the given
    report tables (default: the live views, nothing stored)."""
    t = tables or live_tables(p)
    return (t.machine_time, p.calendar, L.line_quality(t.lot, p.policy),
            O.work_time(t.machine_time, p.config), p.config)


def run_report(p: Plant, tables: ReportTables | None = None) -> DataFrame:
    """Snapshot machine time, refresh lots, OEE distinct, ``oee > 0``.
    Without ``tables`` the report's write steps run first."""
    return O.positive_oee(O.oee(*oee_inputs(p, tables or store_report_tables(p))))


def today_report(p: Plant, as_of: str | None = None,
                 refresh=None) -> DataFrame:
    """K13 with the inputs pruned to what one day needs.

    * state intervals starting on the day (a range on ``start_time``, pushed
      into the scan);
    * every row of the lot ids with a window starting on the day (counts
      pool over all rows of an id, whatever their day);
    * sensor events inside those windows' overall range (two scalars read
      from the small lot subset, then a range filter pushed into the scan).

    Equal to ``today_oee(oee(...), as_of)`` on the full tables.
    ``refresh(lots) -> lots`` replaces the lot refresh from sensor events
    (the streaming job refreshes from its stored counters instead).
    """
    spark = p.lot.sparkSession
    day = (spark.range(1).select(F.current_date()).first()[0] if as_of is None
           else dt.date.fromisoformat(as_of))
    lo = ntz_literal(dt.datetime.combine(day, dt.time()))
    hi = ntz_literal(dt.datetime.combine(day + dt.timedelta(days=1), dt.time()))
    in_day = (F.col("start_time") >= lo) & (F.col("start_time") < hi)
    states = p.machine_state.filter(in_day)
    ids = p.lot.filter(in_day).select("lot_id").distinct()
    lots = p.lot.join(ids, "lot_id", "left_semi")
    if refresh is None:
        fresh = L.refresh_lots(lots, _events_in_windows(p.sensor_events, lots), p.policy)
    else:
        fresh = refresh(lots)
    mt = machine_time(states, p.machine, p.prod_states, p.down_states)
    t = ReportTables(machine_time=mt, lot=fresh)
    return O.today_oee(O.oee(*oee_inputs(p, t)), day.isoformat())


def _events_in_windows(events: DataFrame, lots: DataFrame) -> DataFrame:
    """Events inside the overall range of the (few) lot windows: two scalars
    from the small lot subset become a range filter pushed into the scan."""
    first, last = lots.agg(F.min("start_time"), F.max("end_time")).first()
    if first is None or last is None:
        return events.limit(0)
    return events.filter((F.col("input_time") >= ntz_literal(first))
                         & (F.col("input_time") < ntz_literal(last)))
