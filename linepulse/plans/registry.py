"""Registered queries: name -> (Spark builder, DuckDB oracle SQL or None).

Each builder takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
driver's parquet tables at ``sf_dir``.  Results are not collected; queries that
store tables or run a stream do so while they are built, and range counts look
at the number of windows to choose their plan.  Column names match the oracle
SQL exactly.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linepulse.functions import MICROS_PER_DAY, parse_text_time, round_numeric
from linepulse.operators import containment as C
from linepulse.operators import islands as I
from linepulse.operators import lots as L
from linepulse.operators import oee as O
from linepulse.operators import overlap as X
from linepulse.operators.calendar import join_calendar
from linepulse.operators.machine_time import downtime_ranking, machine_micros
from linepulse.operators.window_counts import window_counts
from linepulse.plans import oracle as Q
from linepulse.plans.plant import from_testdata
from linepulse.plans.report import (live_tables, oee_inputs, plant_machine_time,
                                     refreshed_lots, run_report, today_report)
from linepulse.plans.views import register_views
from linepulse.schemas import ALL_DOWN_STATES
from linepulse.session import work_path
from linepulse.sources import adapters as A
from linepulse.sources import versioned as V
from linepulse.sources.tables import csv_rejects, read_csv_table
from linepulse.streaming import islands_job as IJ
from linepulse.streaming import sensor_job as SJ
from linepulse.streaming import stateful_islands as SI

Builder = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Builder, str | None]] = {}


def register(name: str, sql: str | None):
    def deco(fn: Builder) -> Builder:
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


# ---------------------------------------------------------------- sources ----
@register("machine_dim", Q.with_ctes("SELECT machine_id, description, line_id FROM machine"))
def q_machine_dim(spark, d):
    return A.machine(spark, d)


@register("machine_state_intervals", Q.with_ctes(
    "SELECT machine_id, start_time, end_time, state FROM machine_state"))
def q_machine_state_intervals(spark, d):
    return A.machine_state(spark, d)


# -------------------------------------------------------------- intervals ----
@register("machine_time", Q.with_ctes("SELECT * FROM v_machine_time"))
def q_machine_time(spark, d):
    return plant_machine_time(from_testdata(spark, d))


@register("machine_time_all_down", Q.with_ctes(
    "SELECT * FROM mt_all", [("mt_all", Q.machine_time_sql(ALL_DOWN_STATES))]))
def q_machine_time_all_down(spark, d):
    return plant_machine_time(from_testdata(spark, d), down_states=ALL_DOWN_STATES)


@register("downtime_ranking", Q.with_ctes("""
SELECT m.machine_id,
       CAST(SUM(CASE WHEN m.state = 'UDOWN' THEN date_diff('microsecond', m.start_time, m.end_time)
                     ELSE 0 END) AS DOUBLE) / CAST(3600000000 AS DOUBLE) AS total_down_time
FROM machine_state m JOIN machine mc ON m.machine_id = mc.machine_id
GROUP BY m.machine_id ORDER BY total_down_time DESC NULLS FIRST"""))
def q_downtime_ranking(spark, d):
    p = from_testdata(spark, d)
    return downtime_ranking(machine_micros(p.machine_state, p.machine, p.prod_states,
                                           p.down_states))


# --------------------------------------------------------------- calendar ----
def _calendar_days_query(spark, d, drift):
    p = from_testdata(spark, d, drift_calendar=drift)
    days = plant_machine_time(p).select("line_id", "txndate").distinct()
    return join_calendar(days, p.calendar, columns=("year", "ww", "quarter", "month"))


def _calendar_days_sql(cal):
    return Q.with_ctes(f"""
SELECT m.line_id, m.txndate, c.year, c.ww, c.quarter, c.month
FROM (SELECT DISTINCT line_id, txndate FROM v_machine_time) m
JOIN {cal} c ON m.txndate >= c.start_date AND m.txndate < c.end_date""")


@register("calendar_day_join", _calendar_days_sql("calendar"))
def q_calendar_day_join(spark, d):
    return _calendar_days_query(spark, d, drift=False)


@register("calendar_gap_overlap", _calendar_days_sql("calendar_drift"))
def q_calendar_gap_overlap(spark, d):
    return _calendar_days_query(spark, d, drift=True)


# ----------------------------------------------------------- range counts ----
def _lot_counts(spark, d):
    p = from_testdata(spark, d)
    return L.sensor_counts(p.lot, p.sensor_events)


def _count_query(measure):
    def build(spark, d):
        c = _lot_counts(spark, d)
        return c.filter(F.col(measure) > 0).select("lot_id", measure)
    return build


for _m, _t in (("reject_count", "reject_counts"), ("good_count", "good_counts"),
               ("output_count", "output_counts")):
    register(f"lot_{_m}", Q.with_ctes(f"""
SELECT lot_id, c AS {_m} FROM {_t}"""))(_count_query(_m))


@register("lot_count_prefix", Q.with_ctes("""
SELECT lot_id, rejects AS reject_count, goods AS good_count, outputs AS output_count
FROM lot_pieces"""))
def q_lot_count_prefix(spark, d):
    """The plan for large window sides, whatever their size here."""
    p = from_testdata(spark, d)
    c = L.sensor_counts(p.lot, p.sensor_events, strategy="prefix")
    return c.filter(F.col("output_count") > 0).select("lot_id", *L.SENSOR_MEASURES)


@register("lot_count_by_line", Q.with_ctes("""
SELECT l.lot_id, l.line_id, count(*) AS output_count
FROM ss_output s JOIN lot l ON s.line_id = l.line_id
 AND s.input_time >= l.start_time AND s.input_time < l.end_time
GROUP BY l.lot_id, l.line_id"""))
def q_lot_count_by_line(spark, d):
    p = from_testdata(spark, d)
    c = L.sensor_counts(p.lot, p.sensor_events, match_line=True)
    return c.filter(F.col("output_count") > 0).select("lot_id", "line_id", "output_count")


ORDER_WINDOW_SQL = """
SELECT o_orderkey AS lot_id, count(*) AS ship_count,
       count(*) FILTER (l_returnflag = 'R') AS return_count
FROM orders, lineitem
WHERE o_custkey % 4 = l_suppkey % 4
  AND l_shipdate >= o_orderdate AND l_shipdate < o_orderdate + INTERVAL 3 DAY
GROUP BY o_orderkey"""


def _order_windows(spark, d, strategy):
    counts = window_counts(
        A.shipments(spark, d), "t", A.order_windows(spark, d),
        {"ship_count": F.lit(1), "return_count": F.col("is_return").cast("bigint")},
        keys=["k"], group_by=["lot_id"], bucket_us=MICROS_PER_DAY, strategy=strategy)
    return counts.filter(F.col("ship_count") > 0)


@register("order_window_ship_count", ORDER_WINDOW_SQL)
def q_order_window_ship_count(spark, d):
    return _order_windows(spark, d, "auto")


@register("order_window_ship_count_prefix", ORDER_WINDOW_SQL)
def q_order_window_ship_count_prefix(spark, d):
    return _order_windows(spark, d, "prefix")


# ------------------------------------------------------------------- lots ----
LOT_SELECT = ("SELECT lot_id, line_id, start_time, end_time, qty_in, qty_out, qty_rej, "
              "qty_good, throughput FROM ")


@register("lot_update_from", Q.with_ctes(LOT_SELECT + "lot_counted"))
def q_lot_update_from(spark, d):
    p = from_testdata(spark, d)
    return L.apply_sensor_counts(p.lot, L.sensor_counts(p.lot, p.sensor_events), p.policy)


@register("lot_writeback", Q.with_ctes(LOT_SELECT + "lot_refreshed"))
def q_lot_writeback(spark, d):
    return refreshed_lots(from_testdata(spark, d))


@register("lot_quality", Q.with_ctes("SELECT * FROM v_quality_lot"))
def q_lot_quality(spark, d):
    p = from_testdata(spark, d)
    return L.lot_quality(refreshed_lots(p), p.policy)


@register("line_quality", Q.with_ctes("SELECT * FROM v_quality"))
def q_line_quality(spark, d):
    p = from_testdata(spark, d)
    return L.line_quality(refreshed_lots(p), p.policy)


LOT_SUMMARY_SQL = Q.with_ctes("""
SELECT lot_id, max(start_time) AS start_time, sum(qty_in)::BIGINT AS qty_in,
       sum(qty_out)::BIGINT AS qty_out, sum(qty_rej)::BIGINT AS qty_rej
FROM v_quality_lot GROUP BY ALL""")


@register("lot_summary", LOT_SUMMARY_SQL)
def q_lot_summary(spark, d):
    p = from_testdata(spark, d)
    return L.lot_summary(L.lot_quality(refreshed_lots(p), p.policy))


# -------------------------------------------------------------------- OEE ----
@register("work_time", Q.with_ctes("SELECT * FROM v_work_time"))
def q_work_time(spark, d):
    p = from_testdata(spark, d)
    return O.work_time(plant_machine_time(p), p.config)


@register("oee", Q.with_ctes("SELECT DISTINCT * FROM v_oee"))
def q_oee(spark, d):
    return O.oee(*oee_inputs(from_testdata(spark, d)))


@register("oee_positive", Q.with_ctes("SELECT DISTINCT * FROM v_oee WHERE oee > 0"))
def q_oee_positive(spark, d):
    return run_report(from_testdata(spark, d))


@register("oee_rows", Q.with_ctes("SELECT *, count(*) AS n_rows FROM v_oee GROUP BY ALL"))
def q_oee_rows(spark, d):
    return O.oee_counted(*oee_inputs(from_testdata(spark, d)))


@register("monthly_oee", Q.with_ctes("""
SELECT month,
       CAST(ROUND(TRY_CAST(AVG(availability) AS DECIMAL(38,12)), 2) AS DOUBLE) AS avg_availability,
       CAST(ROUND(TRY_CAST(AVG(performance) AS DECIMAL(38,12)), 2) AS DOUBLE) AS avg_performance,
       CAST(ROUND(TRY_CAST(AVG(quality) AS DECIMAL(38,12)), 2) AS DOUBLE) AS avg_quality,
       CAST(ROUND(TRY_CAST(AVG(oee) AS DECIMAL(38,12)), 2) AS DOUBLE) AS avg_oee
FROM (SELECT DISTINCT * FROM v_oee) o GROUP BY month"""))
def q_monthly_oee(spark, d):
    return O.monthly_oee(O.oee(*oee_inputs(from_testdata(spark, d))))


TODAY = "2024-01-15"


@register("today_oee", Q.with_ctes(
    f"SELECT DISTINCT * FROM v_oee WHERE txndate = DATE '{TODAY}'"))
def q_today_oee(spark, d):
    return today_report(from_testdata(spark, d), TODAY)


# ---------------------------------------------------------------- islands ----
def _islands_sql(source: str = "machine_state_input", tie: str = "event_id") -> str:
    """Runs of equal states: a run begins where the state differs from the one before."""
    return f"""
SELECT machine_id, any_value(state) AS state, min(time_input) AS start_time,
       max(time_input) AS end_time
FROM (SELECT *, sum(begins) OVER (PARTITION BY machine_id ORDER BY time_input, {tie}
                                  ROWS UNBOUNDED PRECEDING) AS run
      FROM (SELECT machine_id, state, time_input, {tie} AS tie_value, event_id,
                   CASE WHEN state IS DISTINCT FROM lag(state) OVER w
                          OR lag(time_input) OVER w IS NULL THEN 1 ELSE 0 END AS begins
            FROM {source} WINDOW w AS (PARTITION BY machine_id ORDER BY time_input, {tie})) marked) runs
GROUP BY machine_id, run"""


ISLAND_CTES = [("islands", _islands_sql())]


@register("state_islands", Q.with_ctes("SELECT * FROM islands", ISLAND_CTES))
def q_state_islands(spark, d):
    return I.state_islands(from_testdata(spark, d).machine_state_input)


@register("state_islands_no_id", Q.with_ctes(
    "SELECT * FROM no_id", [("no_id", _islands_sql(tie="state"))]))
def q_state_islands_no_id(spark, d):
    """Samples as the source stores them, without an id: the state breaks ties."""
    samples = from_testdata(spark, d).machine_state_input
    return I.state_islands(samples.withColumn("event_id", F.lit(None).cast("bigint")))


@register("state_islands_rownum", Q.with_ctes("SELECT * FROM islands", ISLAND_CTES))
def q_state_islands_rownum(spark, d):
    return I.islands_from_row_numbers(from_testdata(spark, d).machine_state_input)


@register("state_row_numbers", Q.with_ctes("""
SELECT machine_id, state, time_input, event_id,
       ROW_NUMBER() OVER (PARTITION BY machine_id ORDER BY time_input, event_id) AS rn,
       ROW_NUMBER() OVER (PARTITION BY machine_id, state ORDER BY time_input, event_id)
         AS rn_state
FROM machine_state_input"""))
def q_state_row_numbers(spark, d):
    s = from_testdata(spark, d).machine_state_input
    s = I.row_numbers(s, ["machine_id"], "time_input", "event_id", "rn")
    s = I.row_numbers(s, ["machine_id", "state"], "time_input", "event_id", "rn_state")
    return s.select("machine_id", "state", "time_input", "event_id", "rn", "rn_state")


@register("last_interval_flag", Q.with_ctes("""
SELECT g.machine_id, g.state, g.start_time, g.end_time,
       g.end_time = (SELECT MAX(time_input) FROM machine_state_input m2
                     WHERE m2.machine_id = g.machine_id) AS is_last
FROM islands g""", ISLAND_CTES))
def q_last_interval_flag(spark, d):
    return I.state_islands(from_testdata(spark, d).machine_state_input, with_last_flag=True)


# -------------------------------------------------- timeline, throughput ----
@register("line_state_timeline", Q.with_ctes("""
SELECT line_id, clipped.s AS start_time, clipped.e AS end_time, state
FROM (SELECT k.line_id, x.state, {'s': greatest(x.start_time, lot.start_time),
                                  'e': least(x.end_time, lot.end_time)} AS clipped
      FROM machine_state x JOIN machine k USING (machine_id) JOIN lot ON lot.line_id = k.line_id) spans
WHERE clipped.e > clipped.s"""))
def q_line_state_timeline(spark, d):
    p = from_testdata(spark, d)
    return X.line_state_timeline(p.machine_state, p.lot, machine=p.machine)


# The id ranges and their lines.  Machine ids inside, between and beyond them.
_SHORT_ID = "M%02d"
RANGE_CTES = [
    ("short_state", "SELECT printf('M%02d', CAST(substr(machine_id, 2) AS INTEGER) % 15) AS machine_id, "
                    "start_time, end_time, state FROM machine_state"),
    ("ranged", """
SELECT CASE WHEN machine_id >= 'M01' AND machine_id <= 'M06' THEN 'LINE1'
            WHEN machine_id >= 'M07' AND machine_id <= 'M12' THEN 'LINE2' END AS line_id,
       start_time, end_time, state FROM short_state"""),
]


@register("line_state_timeline_ranges", Q.with_ctes("""
SELECT r.line_id, greatest(r.start_time, lot.start_time) AS start_time,
       least(r.end_time, lot.end_time) AS end_time, r.state
FROM ranged r JOIN lot ON lot.line_id = r.line_id
 AND greatest(r.start_time, lot.start_time) < least(r.end_time, lot.end_time)""", RANGE_CTES))
def q_line_state_timeline_ranges(spark, d):
    p = from_testdata(spark, d)
    number = F.substring("machine_id", 2, 20).cast("int") % 15
    return X.line_state_timeline(
        p.machine_state.withColumn("machine_id", F.format_string(_SHORT_ID, number)), p.lot)


OPEN_LOTS = [("open_lots", """
SELECT line_id, start_time, CASE CAST(date_part('day', start_time) AS INTEGER) % 5
         WHEN 0 THEN TIMESTAMP '9999-12-31 00:00:00' WHEN 1 THEN start_time ELSE end_time END AS end_time
FROM lot""")]


@register("overlap_open_ended", Q.with_ctes("""
SELECT m.machine_id, m.start_time, s.line_id, o.start_time AS lot_start, o.end_time AS lot_end
FROM machine_state m JOIN machine s ON s.machine_id = m.machine_id
JOIN open_lots o ON o.line_id = s.line_id AND m.start_time < o.end_time AND m.end_time > o.start_time""", OPEN_LOTS))
def q_overlap_open_ended(spark, d):
    """Machine states against lots of which some last until the year 9999."""
    p = from_testdata(spark, d)
    day = F.dayofmonth("start_time") % 5
    lots = p.lot.select("line_id", F.col("start_time").alias("lot_start"), F.when(
        day == 0, F.to_timestamp_ntz(F.lit("9999-12-31 00:00:00"))).when(day == 1, F.col("start_time"))
        .otherwise(F.col("end_time")).alias("lot_end"))
    states = p.machine_state.select("machine_id", "start_time", "end_time").join(
        p.machine.select("machine_id", "line_id"), "machine_id")
    return X.overlap_join(states, lots, "line_id", ("start_time", "end_time"), ("lot_start", "lot_end")).select(
        "machine_id", "start_time", "line_id", "lot_start", "lot_end")


def _rounded_sql(value: str) -> str:
    """ROUND(value::numeric, 2): the 15 significant digits, half away from zero."""
    digits = f"printf('%.14e', CAST({value} AS DOUBLE))"
    return (f"CASE WHEN abs({value}) >= 1e15 THEN CAST({digits} AS DOUBLE) "
            f"ELSE CAST(round(CAST({digits} AS DECIMAL(38,22)), 2) AS DOUBLE) END")


@register("numeric_rounding", "SELECT o_orderkey, " + ", ".join(
    f"{_rounded_sql(value)} AS {name}" for name, value in
    [("huge", "o_totalprice * 1e22"), ("tiny", "o_totalprice / 1e17"), ("ties", "round(o_totalprice) / 8"),
     ("negative", "-o_totalprice / 3")]) + " FROM orders")
def q_numeric_rounding(spark, d):
    price = F.col("o_totalprice")
    return A.table(spark, d, "orders").select(
        "o_orderkey", round_numeric(price * 1e22, 2).alias("huge"), round_numeric(price / 1e17, 2).alias("tiny"),
        round_numeric(F.round(price) / 8, 2).alias("ties"), round_numeric(-price / 3, 2).alias("negative"))


LOOKUP_SQL = """
SELECT * FROM (
  SELECT s.event_id, s.line_id, s.input_time, l.lot_id, l.start_time AS lot_start,
         l.qty_out,
         row_number() OVER (PARTITION BY s.src, s.event_id
                            ORDER BY l.start_time DESC, l.lot_id DESC) AS rn
  FROM {events} s JOIN {lots} l ON l.line_id = s.line_id AND s.input_time >= l.start_time
   AND (l.end_time IS NULL OR s.input_time <= l.end_time)) x
WHERE rn = 1"""

SENSOR_UNION = """
SELECT 'output' AS src, event_id, line_id, input_time FROM ss_output
UNION ALL SELECT 'reject', event_id, line_id, input_time FROM ss_reject
UNION ALL SELECT 'good', event_id, line_id, input_time FROM ss_good"""


@register("event_lot_lookup", Q.with_ctes(
    "SELECT event_id, line_id, input_time, lot_id, lot_start FROM lookup",
    [("ev_out", "SELECT 'output' AS src, event_id, line_id, input_time FROM ss_output"),
     ("lookup", LOOKUP_SQL.format(events="ev_out", lots="lot"))]))
def q_event_lot_lookup(spark, d):
    p = from_testdata(spark, d)
    ev = p.sensor_events.select("event_id", "line_id", "input_time")
    return C.event_lot_lookup(ev, p.lot).select("event_id", "line_id", "input_time",
                                                "lot_id", "lot_start")


# Lots as they nest and stay open: each day's lots, a longer one around every
# third, one without an end from every fifth, and one that ends in 9999.
NESTED_CTES = [("nested_lot", """
SELECT lot_id, line_id, start_time, end_time, qty_out FROM lot
UNION ALL SELECT 'N' || lot_id, line_id, start_time - INTERVAL 2 DAY, end_time + INTERVAL 3 DAY, qty_out
FROM lot WHERE day(start_time) % 3 = 0
UNION ALL SELECT 'O' || lot_id, line_id, start_time + INTERVAL 1 HOUR, NULL, qty_out
FROM lot WHERE day(start_time) % 5 = 0
UNION ALL SELECT 'Z' || lot_id, line_id, start_time, TIMESTAMP '9999-12-31 00:00:00', qty_out
FROM lot WHERE day(start_time) = 7"""),
    ("ev_out", "SELECT 'output' AS src, event_id, line_id, input_time FROM ss_output"),
    ("lookup", LOOKUP_SQL.format(events="ev_out", lots="nested_lot"))]


@register("event_lot_lookup_nested", Q.with_ctes(
    "SELECT event_id, line_id, input_time, lot_id, lot_start FROM lookup", NESTED_CTES))
def q_event_lot_lookup_nested(spark, d):
    p = from_testdata(spark, d)
    lot = p.lot.select("lot_id", "line_id", "start_time", "end_time")
    day = F.dayofmonth("start_time")

    def named(prefix, df, start, end):
        return df.select(F.concat(F.lit(prefix), "lot_id").alias("lot_id"), "line_id",
                         start.alias("start_time"), end.cast("timestamp_ntz").alias("end_time"))

    start, end = F.col("start_time"), F.col("end_time")
    lots = (lot.unionByName(named("N", lot.filter(day % 3 == 0), F.timestamp_add("DAY", F.lit(-2), start),
                                  F.timestamp_add("DAY", F.lit(3), end)))
            .unionByName(named("O", lot.filter(day % 5 == 0), F.timestamp_add("HOUR", F.lit(1), start),
                               F.lit(None)))
            .unionByName(named("Z", lot.filter(day == 7), start,
                               F.to_timestamp_ntz(F.lit("9999-12-31 00:00:00")))))
    ev = p.sensor_events.select("event_id", "line_id", "input_time")
    return C.event_lot_lookup(ev, lots).select("event_id", "line_id", "input_time", "lot_id", "lot_start")


THROUGHPUT_CTES = [
    ("ev_all", SENSOR_UNION),
    ("lookup_all", LOOKUP_SQL.format(events="ev_all", lots="lot_refreshed")),
    ("last_hit", """
SELECT * FROM (
  SELECT lot_id, input_time, lot_start, qty_out,
         row_number() OVER (PARTITION BY lot_id ORDER BY input_time DESC, event_id DESC) AS rn2
  FROM lookup_all) x WHERE rn2 = 1"""),
    ("throughput", """
SELECT lot_id,
       CASE WHEN date_diff('microsecond', lot_start, input_time) > 0
            THEN CAST(COALESCE(qty_out, 0) AS DOUBLE)
                 / ((CAST(date_diff('microsecond', lot_start, input_time) AS DOUBLE)
                     / CAST(1000000 AS DOUBLE)) / CAST(60 AS DOUBLE))
            ELSE CAST(0 AS DOUBLE) END AS throughput
FROM last_hit"""),
]


def _sensor_rows(p):
    """Rows of any of the three sensor tables, read once: the lookup only
    needs distinct (line, instant) and the largest event id there, which the
    three-table union gives too."""
    ev = p.sensor_events
    any_sensor = (F.col("is_output") + F.col("is_reject") + F.col("is_good")) > 0
    return ev.filter(any_sensor).select("event_id", "line_id", "input_time")


@register("lot_throughput", Q.with_ctes("SELECT * FROM throughput", THROUGHPUT_CTES))
def q_lot_throughput(spark, d):
    p = from_testdata(spark, d)
    return C.lot_throughput(_sensor_rows(p), refreshed_lots(p))


@register("lot_with_throughput", Q.with_ctes("""
SELECT l.lot_id, l.line_id, l.start_time, l.end_time, l.qty_in, l.qty_out, l.qty_rej,
       l.qty_good, COALESCE(t.throughput, l.throughput) AS throughput
FROM lot_refreshed l LEFT JOIN throughput t ON t.lot_id = l.lot_id""", THROUGHPUT_CTES))
def q_lot_with_throughput(spark, d):
    p = from_testdata(spark, d)
    lots = refreshed_lots(p)
    return C.set_throughput(lots, C.lot_throughput(_sensor_rows(p), lots))


# ------------------------------------------------------------ text dates ----
DATE_TEXT_SQL = """
SELECT event_id,
       CASE WHEN event_type IN ('click', 'view') THEN strftime(ts, '%m/%d/%Y %H:%M:%S')
            WHEN event_type IN ('signup', 'purchase') THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
            ELSE props END AS time_text
FROM events"""
DATE_PARSED_SQL = """
SELECT event_id, time_text,
       COALESCE(try_strptime(time_text, '%m/%d/%Y %H:%M:%S'),
                try_strptime(time_text, '%Y-%m-%d %H:%M:%S')) AS parsed_time
FROM date_text"""


def _date_text(spark, d):
    ev = A.table(spark, d, "events").select("event_id", "ts", "event_type", "props")
    et = F.col("event_type")
    text = (F.when(et.isin("click", "view"), F.date_format("ts", "MM/dd/yyyy HH:mm:ss"))
            .when(et.isin("signup", "purchase"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
            .otherwise(F.col("props")))
    return ev.select("event_id", text.alias("time_text"))


@register("date_parse", Q.with_ctes("SELECT * FROM date_parsed",
                                    [("date_text", DATE_TEXT_SQL),
                                     ("date_parsed", DATE_PARSED_SQL)]))
def q_date_parse(spark, d):
    t = _date_text(spark, d)
    return t.select("event_id", "time_text", parse_text_time(F.col("time_text"))
                    .alias("parsed_time"))


@register("date_parse_rejects", Q.with_ctes("""
SELECT count(*) AS total_rows, count(*) FILTER (WHERE parsed_time IS NULL) AS rejected_rows
FROM date_parsed""", [("date_text", DATE_TEXT_SQL), ("date_parsed", DATE_PARSED_SQL)]))
def q_date_parse_rejects(spark, d):
    t = _date_text(spark, d).select(parse_text_time(F.col("time_text")).alias("p"))
    return t.agg(F.count(F.lit(1)).alias("total_rows"),
                 F.count_if(F.col("p").isNull()).alias("rejected_rows"))


@register("date_parse_fraction", """
SELECT event_id, strftime(ts + to_microseconds(event_id % 1000000), '%Y-%m-%d %H:%M:%S.%f') AS time_text,
       CAST(ts + to_microseconds(event_id % 1000000) AS TIMESTAMP) AS parsed_time
FROM events""")
def q_date_parse_fraction(spark, d):
    ev = A.table(spark, d, "events").select("event_id", F.timestamp_add(
        "MICROSECOND", F.pmod("event_id", F.lit(1_000_000)), F.col("ts")).alias("t"))
    text = F.date_format("t", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return ev.select("event_id", text.alias("time_text"), parse_text_time(text).alias("parsed_time"))


CSV_SCHEMA = "event_id bigint not null, parsed_time timestamp_ntz, machine_id string, amount int"
CSV_SQL = """
SELECT event_id, try_strptime(CASE WHEN event_type IN ('click', 'view') THEN strftime(ts, '%m/%d/%Y %H:%M:%S')
                                   WHEN event_type = 'error' THEN 'no time'
                                   ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END,
                              ['%m/%d/%Y %H:%M:%S', '%Y-%m-%d %H:%M:%S']) AS parsed_time,
       printf('M%05d', user_id) AS machine_id,
       CASE WHEN event_type = 'signup' THEN NULL ELSE CAST(event_id % 100 AS INTEGER) END AS amount
FROM events"""


def _csv_export(spark, d):
    """Events as a CSV export: columns in another order and case, an unknown
    one, both time layouts, and text that is no time or number."""
    ev = A.table(spark, d, "events")
    et = F.col("event_type")
    text = (F.when(et.isin("click", "view"), F.date_format("ts", "MM/dd/yyyy HH:mm:ss"))
            .when(et == "error", F.lit("no time"))
            .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")))
    path = work_path(spark, "exports", unique=True)
    ev.select(A.machine_id_of(F.col("user_id")).alias("MACHINE_ID"), F.lit("x").alias("unknown"),
              F.when(et == "signup", "n/a").otherwise((F.col("event_id") % 100).cast("string"))
              .alias("amount"), text.alias("parsed_time"), "event_id") \
        .write.option("header", True).csv(path)
    return path, spark.createDataFrame([], CSV_SCHEMA).schema


@register("csv_load", CSV_SQL)
def q_csv_load(spark, d):
    return read_csv_table(spark, *_csv_export(spark, d))


@register("csv_load_rejects", """
SELECT unnest(['event_id', 'parsed_time', 'machine_id', 'amount']) AS column_name,
       count(*) AS total_rows,
       unnest([0, count(*) FILTER (event_type = 'error'), 0,
               count(*) FILTER (event_type = 'signup')]) AS rejected_rows
FROM events""")
def q_csv_load_rejects(spark, d):
    return csv_rejects(spark, *_csv_export(spark, d))


# ------------------------------------------------------ table maintenance ----
@register("machine_time_snapshot", Q.with_ctes("SELECT * FROM v_machine_time"))
def q_machine_time_snapshot(spark, d):
    table = V.VersionedTable(spark, work_path(spark, "tables", "machine_time", unique=True),
                             partition_by=("txndate",))
    snap = V.snapshot(table, plant_machine_time(from_testdata(spark, d)))
    return snap.select("machine_id", "line_id", "txndate", "prod_time", "down_time")


@register("snapshot_empty_refill", Q.with_ctes("SELECT * FROM v_machine_time WHERE false"))
def q_snapshot_empty_refill(spark, d):
    """A refill from a view that has become empty empties the table."""
    table = V.VersionedTable(spark, work_path(spark, "tables", "refill", unique=True),
                             partition_by=("txndate",))
    full = plant_machine_time(from_testdata(spark, d))
    V.snapshot(table, full)
    return V.snapshot(table, full.filter(F.col("prod_time") < 0)).select(
        "machine_id", "line_id", "txndate", "prod_time", "down_time")


LAST_DAY_INPUT = """
SELECT * FROM machine_state_input
WHERE CAST(time_input AS DATE) = (SELECT MAX(CAST(time_input AS DATE)) FROM machine_state_input)"""


def _last_day_input(spark, d):
    s = from_testdata(spark, d).machine_state_input
    last_day = s.select(F.max(F.to_date("time_input"))).scalar()
    return s.filter(F.to_date("time_input") == last_day)


@register("machine_state_keyed_replace", Q.with_ctes("""
SELECT machine_id, start_time, end_time, state FROM machine_state
WHERE machine_id NOT IN (SELECT DISTINCT machine_id FROM last_day_input)
UNION ALL
SELECT machine_id, start_time, end_time, state FROM new_islands""",
    [("last_day_input", LAST_DAY_INPUT), ("new_islands", _islands_sql("last_day_input"))]))
def q_machine_state_keyed_replace(spark, d):
    table = V.VersionedTable(spark, work_path(spark, "tables", "machine_state", unique=True))
    V.snapshot(table, from_testdata(spark, d).machine_state)
    new = I.state_islands(_last_day_input(spark, d))
    replaced = V.keyed_replace(table.read(), new, "machine_id")
    return V.snapshot(table, replaced)


@register("append_result", Q.with_ctes(
    "SELECT * FROM islands UNION ALL SELECT * FROM islands", ISLAND_CTES))
def q_append_result(spark, d):
    table = V.VersionedTable(spark, work_path(spark, "tables", "islands_log", unique=True))
    islands = I.state_islands(from_testdata(spark, d).machine_state_input)
    table.append(islands)
    table.append(islands)
    return table.read()


# ------------------------------------------- the source's SQL on the views ----
def _register_views(spark, d, as_of=None):
    p = from_testdata(spark, d)
    register_views(p, live_tables(p), as_of=as_of)


@register("sql_report", Q.with_ctes("SELECT DISTINCT * FROM v_oee WHERE oee > 0"))
def q_sql_report(spark, d):
    _register_views(spark, d)
    return spark.sql("select distinct * from v_oee where oee > 0")


@register("sql_lot_summary", LOT_SUMMARY_SQL)
def q_sql_lot_summary(spark, d):
    _register_views(spark, d)
    return spark.sql("""
        SELECT lot_id, max(start_time) AS start_time, sum(qty_in) AS qty_in,
               sum(qty_out) AS qty_out, sum(qty_rej) AS qty_rej
        FROM v_quality_lot GROUP BY ALL""")


@register("sql_today_oee", Q.with_ctes(
    f"SELECT DISTINCT * FROM v_oee WHERE txndate = DATE '{TODAY}'"))
def q_sql_today_oee(spark, d):
    _register_views(spark, d, as_of=TODAY)
    return spark.sql("SELECT * FROM t_oee")


# -------------------------------------------------------------- streaming ----
def _sensor_job(spark, d, with_oee=False, with_throughput=False):
    root = work_path(spark, "streams", "sensors", unique=True)
    used = ("lot", "machine", "machine_state", "calendar", "config") if with_oee else ("lot",)
    job = SJ.SensorJob(spark, root, from_testdata(spark, d, tables=used), as_of=TODAY, with_oee=with_oee,
                       with_throughput=with_throughput)
    stream = A.sensors_of(A.replay_events(spark, d, f"{root}/_input"))
    job.run(stream, f"{root}/_checkpoint")
    return job


@register("stream_islands", Q.with_ctes("SELECT * FROM islands", ISLAND_CTES))
def q_stream_islands(spark, d):
    root = work_path(spark, "streams", "islands", unique=True)
    stream = A.samples_of(A.replay_events(spark, d, f"{root}/_input"))
    return IJ.IslandsJob(spark, root).run(stream, f"{root}/_checkpoint")


@register("stream_islands_no_id", Q.with_ctes(
    "SELECT * FROM no_id", [("no_id", _islands_sql(tie="state"))]))
def q_stream_islands_no_id(spark, d):
    """Samples as the source stores them, without an id, some of them late."""
    root = work_path(spark, "streams", "islands_no_id", unique=True)
    stream = A.samples_of(A.replay_events(spark, d, f"{root}/_input")).drop("event_id")
    return IJ.IslandsJob(spark, root).run(stream, f"{root}/_checkpoint")


LATENESS_DAYS = 3


@register("stream_islands_watermark", Q.with_ctes(
    "SELECT t.*, (SELECT count(*) FROM dealt WHERE is_late) AS n_late FROM timely_islands t", [
        ("sliced", """
SELECT s.*, (epoch_us(time_input) - lo) // ((hi - lo) // 2 + 1) + CASE WHEN event_id % 20 = 0 THEN 1 ELSE 0 END AS part
FROM machine_state_input s, (SELECT min(epoch_us(ts)) AS lo, max(epoch_us(ts)) AS hi FROM events) e"""),
        ("dealt", f"""
SELECT s.*, coalesce(s.time_input < w.newest - INTERVAL {LATENESS_DAYS} DAY, false) AS is_late
FROM sliced s JOIN (SELECT p.part, max(b.time_input) AS newest FROM (SELECT DISTINCT part FROM sliced) p
                    LEFT JOIN sliced b ON b.part < p.part GROUP BY p.part) w ON w.part = s.part"""),
        ("timely", "SELECT * FROM dealt WHERE NOT is_late"),
        ("timely_islands", _islands_sql("timely"))]))
def q_stream_islands_watermark(spark, d):
    """Islands of the rows not later than the watermark, and how many were:
    one micro-batch a time slice, the late rows of a slice with the next."""
    root = work_path(spark, "streams", "islands_watermark", unique=True)
    job = IJ.IslandsJob(spark, root, lateness=datetime.timedelta(days=LATENESS_DAYS))
    sliced = A.event_slices(spark, d)
    for k in range(3):
        sliced.filter(F.col("_part") == k).drop("_part").write.mode("append").parquet(f"{root}/_input")
        stream = spark.readStream.schema(sliced.drop("_part").schema).parquet(f"{root}/_input")
        islands = job.run(A.samples_of(stream), f"{root}/_checkpoint")
    return islands.withColumn("n_late", F.lit(job.late()).cast("bigint"))


@register("stream_islands_stateful", Q.with_ctes("SELECT * FROM islands", ISLAND_CTES))
def q_stream_islands_stateful(spark, d):
    root = work_path(spark, "streams", "islands_stateful", unique=True)
    stream = A.samples_of(A.replay_events(spark, d, f"{root}/_input", late=False))
    return SI.StatefulIslandsJob(spark, root).run(stream, f"{root}/_checkpoint")


@register("stream_lot_counts", Q.with_ctes("""
SELECT o.lot_id, COALESCE(r.c, 0) AS reject_count, COALESCE(g.c, 0) AS good_count,
       o.c AS output_count
FROM output_counts o LEFT JOIN reject_counts r ON r.lot_id = o.lot_id
LEFT JOIN good_counts g ON g.lot_id = o.lot_id"""))
def q_stream_lot_counts(spark, d):
    c = _sensor_job(spark, d, with_oee=False).counters()
    return c.filter(F.col("output_count") > 0).select("lot_id", *L.SENSOR_MEASURES)


@register("stream_throughput", Q.with_ctes("SELECT * FROM throughput", THROUGHPUT_CTES))
def q_stream_throughput(spark, d):
    return _sensor_job(spark, d, with_throughput=True).throughput()


@register("stream_today_oee", Q.with_ctes(
    f"SELECT DISTINCT * FROM v_oee WHERE txndate = DATE '{TODAY}'"))
def q_stream_today_oee(spark, d):
    return _sensor_job(spark, d, with_oee=True).today.read()


def queries() -> dict[str, Builder]:
    return {name: fn for name, (fn, _) in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in REGISTRY.items() if sql is not None}
