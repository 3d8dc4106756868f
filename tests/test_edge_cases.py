"""Edge cases of FIXTURES.md section 3, one or two rows each."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from linepulse import schemas as S
from linepulse.functions import epoch_micros, parse_text_time
from linepulse.operators import containment as C
from linepulse.operators import lots as L
from linepulse.operators import oee as O
from linepulse.operators.calendar import join_calendar
from linepulse.operators.islands import state_islands
from linepulse.operators.machine_time import machine_time
from linepulse.operators.overlap import line_by_ranges, line_state_timeline
from linepulse.sources.tables import literal_rows, text_time_rows
from tests.walkthrough import SENSOR_SCHEMA

D = dt.date(2025, 10, 23)


def at(hh, mm=0, day=D):
    return dt.datetime(day.year, day.month, day.day, hh, mm)


def sensors(spark, rows):
    return spark.createDataFrame(
        [(line, t, i, 0, 0, 1) for i, (line, t) in enumerate(rows)], SENSOR_SCHEMA)


def lots(spark, rows):
    return literal_rows(spark, rows, S.LOT)


def test_islands_small(spark):
    s = spark.createDataFrame(
        [("M1", "PROD", at(8), 1), ("M1", "PROD", at(8, 5), 2), ("M1", "DOWN", at(8, 10), 3),
         ("M1", "PROD", at(8, 15), 4)],
        "machine_id string, state string, time_input timestamp_ntz, event_id bigint")
    got = sorted(tuple(r) for r in state_islands(s).collect())
    assert got == [("M1", "DOWN", at(8, 10), at(8, 10)), ("M1", "PROD", at(8), at(8, 5)),
                   ("M1", "PROD", at(8, 15), at(8, 15))]


def test_event_at_lot_end_and_start(spark):
    lot = lots(spark, [("L", "LINE1", at(8), at(12), 1)])
    ev = sensors(spark, [("LINE1", at(12))])
    assert L.sensor_counts(lot, ev).filter("output_count > 0").count() == 0
    (tp,) = C.lot_throughput(ev, lot).collect()
    assert tp.throughput == pytest.approx(0 / 240)    # found (end inclusive), qty_out NULL -> 0
    ev2 = sensors(spark, [("LINE1", at(8))])
    assert L.sensor_counts(lot, ev2).first().output_count == 1
    assert C.lot_throughput(ev2, lot).first().throughput == 0.0      # elapsed 0


def test_open_lot(spark):
    lot = lots(spark, [("L", "LINE1", at(8), None, 1, 60)])
    ev = sensors(spark, [("LINE1", at(9))])
    assert L.sensor_counts(lot, ev).count() == 0
    (tp,) = C.lot_throughput(ev, lot).collect()
    assert tp.lot_id == "L" and tp.throughput == pytest.approx(60 / 60)


def test_nested_lots_fall_back_to_outer(spark):
    lot = lots(spark, [("A", "LINE1", at(8), at(12)), ("B", "LINE1", at(9), at(10))])
    ev = sensors(spark, [("LINE1", at(11)), ("LINE1", at(9, 30))])
    got = {r.input_time: r.lot_id for r in C.event_lot_lookup(ev, lot).collect()}
    assert got == {at(11): "A", at(9, 30): "B"}


def test_shared_id_overlapping_windows_count_twice(spark):
    lot = lots(spark, [("X", "LINE1", at(8), at(10)), ("X", "LINE2", at(9), at(11))])
    ev = sensors(spark, [("LINE1", at(9, 30))])
    assert L.sensor_counts(lot, ev).first().output_count == 2


def test_no_match_keeps_stored_value(spark):
    lot = lots(spark, [("L", "LINE1", at(8), at(12), 10, None, 7)])
    ev = spark.createDataFrame([("LINE1", at(9), 0, 0, 0, 1)], SENSOR_SCHEMA)
    (r,) = L.apply_sensor_counts(lot, L.sensor_counts(lot, ev)).collect()
    assert (r.qty_rej, r.qty_out) == (7, 1)


def test_touching_intervals_do_not_overlap(spark):
    st = literal_rows(spark, [("M01", at(10), at(12), "PROD")], S.MACHINE_STATE)
    lot = lots(spark, [("L", "LINE1", at(8), at(10))])
    assert line_state_timeline(st, lot).count() == 0


def test_interval_over_midnight_counts_on_start_date(spark):
    st = literal_rows(spark, [("M01", at(23), at(1, day=dt.date(2025, 10, 24)), "PROD")],
                      S.MACHINE_STATE)
    mc = literal_rows(spark, [("M01", "x", "LINE1")], S.MACHINE)
    (r,) = machine_time(st, mc).collect()
    assert (r.txndate, r.prod_time, r.down_time) == (D, 2.0, 0.0)


def test_calendar_gap_and_overlap(spark):
    cal = literal_rows(spark, [
        # Last 2025 week and first 2026 weeks of the source calendar.
        ("2025", "52", 4, 12, dt.date(2025, 12, 22), dt.date(2025, 12, 29)),
        ("2026", "1", 1, 1, dt.date(2025, 12, 28), dt.date(2026, 1, 3)),
        ("2026", "2", 1, 1, dt.date(2026, 1, 4), dt.date(2026, 1, 10)),
    ], S.CALENDAR)
    days = spark.createDataFrame([(dt.date(2026, 1, 3),), (dt.date(2025, 12, 28),)],
                                 "txndate date")
    got = sorted((r.txndate, r.year, r.quarter) for r in join_calendar(days, cal).collect())
    assert got == [(dt.date(2025, 12, 28), "2025", 4), (dt.date(2025, 12, 28), "2026", 1)]


def _oee_one(spark, qty_out, qty_good, config=S.DEFAULT_CONFIG):
    mt = spark.createDataFrame([("M01", "LINE1", D, 10.0, 1.0)], S.MACHINE_TIME)
    cal = literal_rows(spark, [("2025", "43", 4, 10, dt.date(2025, 10, 20),
                                dt.date(2025, 10, 27))], S.CALENDAR)
    q = spark.createDataFrame([("LINE1", D, 1, qty_out, 0, qty_good)],
                              "line_id string, txndate date, qty_in bigint, qty_out bigint, "
                              "qty_rej bigint, qty_good bigint")
    cfg = (literal_rows(spark, [config], S.CONFIG) if config
           else spark.createDataFrame([], S.CONFIG))
    return O.oee(mt, cal, q, O.work_time(mt, cfg), cfg).collect()


def test_zero_output_gives_null_quality(spark):
    (r,) = _oee_one(spark, 0, 0)
    assert r.quality is None and r.oee is None and r.availability == 96.0


def test_half_quality_rounds_to_even(spark):
    (r,) = _oee_one(spark, 200, 5)
    assert r.quality == 2.0


def test_empty_config_keeps_row(spark):
    mt = spark.createDataFrame([("M01", "LINE1", D, 10.0, 1.0)], S.MACHINE_TIME)
    (w,) = O.work_time(mt, spark.createDataFrame([], S.CONFIG)).collect()
    assert w.sched_work_time is None and w.line_id == "LINE1"


def test_string_range_is_binary_order(spark):
    df = spark.createDataFrame([("M06",), ("M055",), ("M06A",), ("Mixer",)], "machine_id string")
    got = {r.machine_id: r.l for r in
           df.select("machine_id", line_by_ranges(F.col("machine_id")).alias("l")).collect()}
    assert got == {"M06": "LINE1", "M055": "LINE1", "M06A": None, "Mixer": None}


def test_text_dates_two_layouts_and_junk(spark):
    rows = [("L1", "10/13/2025 08:00:00"), ("L2", "2025-12-28 00:00:00"), ("L3", "junk")]
    df = text_time_rows(spark, rows, S.SENSOR, ["input_time"])
    got = [r.input_time for r in df.orderBy("line_id").collect()]
    assert got == [dt.datetime(2025, 10, 13, 8), dt.datetime(2025, 12, 28), None]


def test_missing_trailing_columns_are_null(spark):
    (r,) = literal_rows(spark, [("A004", "LINE1", at(8), at(12), 20)], S.LOT).collect()
    assert (r.qty_in, r.qty_out, r.qty_good, r.throughput) == (20, None, None, None)


def test_epoch_micros_ignores_session_time_zone(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 3, 10, 2, 30),)], "t timestamp_ntz")
    base = df.select(epoch_micros("t")).first()[0]
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert df.select(epoch_micros("t")).first()[0] == base
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert base == int(dt.datetime(2024, 3, 10, 2, 30, tzinfo=dt.timezone.utc).timestamp()) * 10**6


def test_parse_text_time_function(spark):
    df = spark.createDataFrame([("01/02/2024 03:04:05",)], "s string")
    assert df.select(parse_text_time(F.col("s"))).first()[0] == dt.datetime(2024, 1, 2, 3, 4, 5)


def test_refresh_without_output_sensor_keeps_nulls(spark):
    """Older walk-through inputs (lot A004, rejects on LINE1, good pieces on
    LINE2, no output sensor): counted quantities land, qty_out stays NULL
    and the derived quantities stay NULL (NULL-propagating subtraction)."""
    day = dt.date(2025, 10, 15)
    lot = lots(spark, [("A004", "LINE1", at(8, day=day), at(12, day=day), 20),
                       ("A004", "LINE2", at(13, day=day), at(16, day=day), 20)])
    rejects = [("LINE1", at(h, m, day=day), 1, 0)
               for h, m in ((8, 30), (9, 30), (10, 0), (10, 20), (11, 15))]
    goods = [("LINE2", at(13, 0, day=day) + dt.timedelta(minutes=12 * i), 0, 1)
             for i in range(15)]                     # 13:00 ... 15:48, then 16:00
    goods[-1] = ("LINE2", at(16, day=day), 0, 1)
    ev = spark.createDataFrame([(line, t, i, r, g, 0) for i, (line, t, r, g)
                                in enumerate(rejects + goods)], SENSOR_SCHEMA)
    got = {r.line_id: (r.qty_out, r.qty_rej, r.qty_good)
           for r in L.refresh_lots(lot, ev).collect()}
    assert got == {"LINE1": (None, 5, None), "LINE2": (None, None, 14)}


def test_zero_actual_work_time(spark):
    """Down all scheduled hours: availability 0, performance and OEE NULL
    (division by zero gives NULL here; the host database would raise)."""
    mt = spark.createDataFrame([("M01", "LINE1", D, 0.0, 23.0)], S.MACHINE_TIME)
    cal = literal_rows(spark, [("2025", "43", 4, 10, dt.date(2025, 10, 20),
                                dt.date(2025, 10, 27))], S.CALENDAR)
    q = spark.createDataFrame([("LINE1", D, 1, 10, 0, 10)],
                              "line_id string, txndate date, qty_in bigint, qty_out bigint, "
                              "qty_rej bigint, qty_good bigint")
    cfg = literal_rows(spark, [S.DEFAULT_CONFIG], S.CONFIG)
    (r,) = O.oee(mt, cal, q, O.work_time(mt, cfg), cfg).collect()
    assert (r.availability, r.performance, r.quality, r.oee) == (0.0, None, 100.0, None)


def test_read_table_fills_missing_nullable_columns(spark, tmp_path):
    from linepulse.sources.tables import read_table

    old = spark.createDataFrame([("A001", "LINE2", at(8), at(10), 100, None, 1)],
                                "lot_id string, line_id string, start_time timestamp_ntz, "
                                "end_time timestamp_ntz, qty_in bigint, qty_out bigint, "
                                "qty_rej bigint")
    old.write.parquet(str(tmp_path / "lot.parquet"))
    (r,) = read_table(spark, str(tmp_path / "lot.parquet"), S.LOT).collect()
    assert (r.qty_rej, r.qty_good, r.throughput) == (1, None, None)
    with pytest.raises(ValueError):
        read_table(spark, str(tmp_path / "lot.parquet"), S.MACHINE)


def test_today_report_defaults_to_the_current_date(spark):
    from linepulse.plans.plant import from_testdata
    from linepulse.plans.report import today_report

    p = from_testdata(spark, "/root/testdata/sf0.001")
    today = spark.range(1).select(F.current_date()).first()[0]
    rows = today_report(p).collect()
    assert all(r.txndate == today for r in rows)


def test_csv_files_with_unlike_headers_fail(spark, tmp_path):
    from linepulse import schemas as S
    from linepulse.sources.tables import read_csv_table

    (tmp_path / "a.csv").write_text("machine_id,description,line_id\nM1,press,LINE1\n")
    (tmp_path / "b.csv").write_text("machine_id,description,line_id\nM2,saw,LINE2\n")
    assert read_csv_table(spark, str(tmp_path), S.MACHINE).count() == 2
    (tmp_path / "c.csv").write_text("line_id,machine_id,description\nLINE3,M3,drill\n")
    with pytest.raises(Exception, match="header"):
        read_csv_table(spark, str(tmp_path), S.MACHINE).collect()
