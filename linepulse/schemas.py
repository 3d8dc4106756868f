"""Explicit schemas of the domain tables (the queries' schema, not the DDL's)."""

from pyspark.sql import types as T

S, TS, D, L, DBL, I = (T.StringType(), T.TimestampNTZType(), T.DateType(),
                       T.LongType(), T.DoubleType(), T.IntegerType())


def _schema(*fields):
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


MACHINE = _schema(("machine_id", S, False), ("description", S, True), ("line_id", S, True))
MACHINE_STATE = _schema(("machine_id", S, False), ("start_time", TS, False),
                        ("end_time", TS, False), ("state", S, True))
MACHINE_STATE_INPUT = _schema(("machine_id", S, False), ("state", S, True),
                              ("time_input", TS, False), ("event_id", L, True))
SENSOR = _schema(("line_id", S, False), ("input_time", TS, False), ("event_id", L, True))
LOT = _schema(("lot_id", S, False), ("line_id", S, False), ("start_time", TS, False),
              ("end_time", TS, True), ("qty_in", L, True), ("qty_out", L, True),
              ("qty_rej", L, True), ("qty_good", L, True), ("throughput", DBL, True))
CALENDAR = _schema(("year", S, True), ("ww", S, True), ("quarter", I, True),
                   ("month", I, True), ("start_date", D, False), ("end_date", D, False))
MACHINE_TIME = _schema(("machine_id", S, False), ("line_id", S, True), ("txndate", D, False),
                       ("prod_time", DBL, True), ("down_time", DBL, True))
CONFIG = _schema(("total_time", DBL, True), ("pm_time", DBL, True),
                 ("idea_output_rating", DBL, True))
OEE = _schema(("line_id", S, True), ("txndate", D, True), ("month", S, True),
              ("quarter", I, True), ("year", S, True), ("availability", DBL, True),
              ("performance", DBL, True), ("quality", DBL, True), ("oee", DBL, True))

LOT_COLUMNS = [f.name for f in LOT.fields]

# The design-rate configuration row (24 h day, 1 h planned stop,
# 1,000 pieces per hour ideal output).
DEFAULT_CONFIG = (24.0, 1.0, 1000.0)

# The states counted as production and as down time by default,
# and the wider down-state set offered as the alternative.
PROD_STATES = ("PROD",)
DOWN_STATES = ("UDOWN",)
ALL_DOWN_STATES = ("UDOWN", "SDOWN", "IDLE", "SETUP")

# Which sensor a line counts.  'reject' lines count rejects and
# derive good pieces; 'good' lines count good pieces and derive rejects.
DEFAULT_POLICY = {"LINE1": "reject", "LINE2": "good"}

# Hard-coded machine-id ranges to lines (inclusive, binary order).
DEFAULT_LINE_RANGES = (("M01", "M06", "LINE1"), ("M07", "M12", "LINE2"))
