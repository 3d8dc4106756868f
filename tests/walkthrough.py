"""The one-day walk-through (2025-10-23) as domain tables, built by rule.

Machines M01-M13 (M07 on LINE1 in the dimension), two lot rows sharing id
A002, state intervals per machine group, and sensor rows: outputs every
minute over each line's run (08:00-12:00 LINE1, 13:00-17:00 LINE2, ends
included), 30 rejects on LINE1 inside its window, 161 good pieces on LINE2
inside [13:00, 16:00) and 61 more from 16:00 to 17:00.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from linepulse import schemas as S
from linepulse.plans.plant import Plant
from linepulse.sources.tables import literal_rows

DAY = dt.date(2025, 10, 23)


def at(hh, mm=0, day=DAY):
    return dt.datetime(day.year, day.month, day.day, hh, mm)


def minutes(start, end, step=1):
    t = start
    while t <= end:
        yield t
        t += dt.timedelta(minutes=step)


def machine_rows():
    rows = [(f"M{i:02d}", f"machine {i}", "LINE1" if i <= 7 else "LINE2") for i in range(1, 14)]
    return rows


def state_rows():
    line1 = {"M01": ("PROD", "UDOWN", "UPROD"), "M02": ("UPROD", "UDOWN", "PROD")}
    rows = []
    for i in range(1, 8):
        m = f"M{i:02d}"
        a, b, c = line1.get(m, ("PROD", "UDOWN", "PROD"))
        rows += [(m, at(8), at(10), a), (m, at(10), at(10, 15), b), (m, at(10, 15), at(12), c)]
    for i in range(8, 14):
        m = f"M{i:02d}"
        rows += [(m, at(13), at(14), "PROD"), (m, at(14), at(14, 30), "UDOWN"),
                 (m, at(14, 30), at(15, 30), "PROD"), (m, at(15, 30), at(15, 40), "UDOWN"),
                 (m, at(15, 40), at(16), "PROD")]
    return rows


def sensor_rows():
    """(line_id, input_time, event_id, is_reject, is_good, is_output)."""
    rows = []
    eid = 0

    def add(line, t, r, g, o):
        nonlocal eid
        rows.append((line, t, eid, r, g, o))
        eid += 1

    for t in minutes(at(8), at(12)):
        add("LINE1", t, 0, 0, 1)
    for t in minutes(at(13), at(17)):
        add("LINE2", t, 0, 0, 1)
    for t in list(minutes(at(8, 1), at(10, 25), 4))[:30]:
        add("LINE1", t, 1, 0, 0)
    for t in list(minutes(at(13), at(15, 59)))[:161]:
        add("LINE2", t, 0, 1, 0)
    for t in minutes(at(16), at(17)):
        add("LINE2", t, 0, 1, 0)
    return rows


CALENDAR_ROWS = [
    # Fiscal week 43 of 2025 (Q4, month 10) and its neighbours.
    ("2025", "42", 4, 10, dt.date(2025, 10, 13), dt.date(2025, 10, 20)),
    ("2025", "43", 4, 10, dt.date(2025, 10, 20), dt.date(2025, 10, 27)),
    ("2025", "44", 4, 11, dt.date(2025, 10, 27), dt.date(2025, 11, 3)),
]

SENSOR_SCHEMA = ("line_id string, input_time timestamp_ntz, event_id bigint, "
                 "is_reject bigint, is_good bigint, is_output bigint")


def plant(spark) -> Plant:
    lots = literal_rows(spark, [("A002", "LINE1", at(8), at(12), 250),
                                ("A002", "LINE2", at(13), at(16), 250)], S.LOT)
    return Plant({
        "machine": literal_rows(spark, machine_rows(), S.MACHINE),
        "machine_state": literal_rows(spark, state_rows(), S.MACHINE_STATE),
        "lot": lots,
        "sensor_events": spark.createDataFrame(sensor_rows(), SENSOR_SCHEMA),
        "calendar": literal_rows(spark, CALENDAR_ROWS, S.CALENDAR),
        "config": literal_rows(spark, [S.DEFAULT_CONFIG], S.CONFIG),
    })


def sensor_union(p: Plant):
    ev = p.sensor_events
    parts = [ev.filter(F.col(f) == 1).select("event_id", "line_id", "input_time")
             for f in ("is_output", "is_reject", "is_good")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
