"""The source's views as Spark temp views over a ``Plant``.

``register_views`` names the domain tables and the views the source
defines (``v_machine_time``, ``v_quality``, ``v_quality_lot``,
``v_work_time``, ``v_line_state``, ``v_oee``, ``t_oee``) plus the stored
``machine_time`` and ``oee`` tables, so statements over them can be written in
Spark SQL (not all of the host database's dialect: a bare ``x::numeric`` is
DECIMAL(10,0) here).  Each view is the operator's lazy DataFrame;
Catalyst inlines it into the query that reads it.

``v_oee`` and ``t_oee`` hold the distinct OEE rows, which is what every
reader of the source's view takes (``SELECT DISTINCT``): the view's own
per-machine fan-out grows quadratically with machines per line-day, so it
is exposed as ``v_oee_rows`` (each distinct row with ``n_rows``) instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from linepulse.operators import lots as L
from linepulse.operators import oee as O
from linepulse.operators.overlap import line_state_timeline
from linepulse.plans.plant import Plant
from linepulse.plans.report import ReportTables, oee_inputs, plant_machine_time


def register_views(p: Plant, tables: ReportTables | None = None,
                   as_of: str | None = None) -> dict[str, DataFrame]:
    """Create or replace the temp views; returns them by name.

    ``tables``: the stored report tables (machine-time snapshot and the
    refreshed lots); by default the lots as given and the live K1 view.
    """
    mt_view = plant_machine_time(p)
    lot = tables.lot if tables else p.lot
    snap = tables.machine_time if tables else mt_view
    inputs = oee_inputs(p, ReportTables(machine_time=snap, lot=lot))
    distinct = O.oee(*inputs)
    views = {
        "machine": p.machine, "machine_state": p.machine_state, "lot": lot,
        "calendar": p.calendar, "config": p.config, "machine_time": snap,
        "v_machine_time": mt_view,
        "v_quality": L.line_quality(lot, p.policy),
        "v_quality_lot": L.lot_quality(lot, p.policy),
        "v_work_time": O.work_time(snap, p.config),
        "v_line_state": line_state_timeline(p.machine_state, lot),
        "v_oee": distinct,
        "v_oee_rows": O.oee_counted(*inputs),
        "t_oee": O.today_oee(distinct, as_of),
        "oee": distinct,
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return views
