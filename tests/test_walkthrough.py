"""Golden values of the one-day walk-through (FIXTURES.md section 2.1)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from linepulse.operators import containment as C
from linepulse.operators import lots as L
from linepulse.operators import oee as O
from linepulse.operators.overlap import line_state_timeline
from linepulse.plans import report as R
from tests import walkthrough as W


@pytest.fixture(scope="module")
def plant(spark):
    return W.plant(spark)


@pytest.fixture(scope="module")
def tables(plant):
    return R.store_report_tables(plant)


def test_counts_pool_over_shared_lot_id(plant):
    c = L.sensor_counts(plant.lot, plant.sensor_events).collect()
    assert [(r.lot_id, r.reject_count, r.good_count, r.output_count) for r in c] == [
        ("A002", 30, 161, 420)]


def test_counts_with_line_match(plant):
    c = L.sensor_counts(plant.lot, plant.sensor_events, match_line=True)
    got = {(r.line_id): r.output_count for r in c.collect()}
    assert got == {"LINE1": 240, "LINE2": 180}


def test_machine_time(plant):
    got = {r.machine_id: (r.line_id, r.prod_time, r.down_time)
           for r in R.plant_machine_time(plant).collect()}
    assert got["M01"] == ("LINE1", 2.0, 0.25)
    assert got["M02"] == ("LINE1", 1.75, 0.25)
    for m in ("M03", "M04", "M05", "M06", "M07"):
        assert got[m] == ("LINE1", 3.75, 0.25)
    for m in ("M08", "M09", "M10", "M11", "M12", "M13"):
        line, prod, down = got[m]
        assert line == "LINE2"
        assert prod == pytest.approx(7 / 3) and down == pytest.approx(2 / 3)


def test_refreshed_lot(tables):
    got = {r.line_id: (r.qty_in, r.qty_out, r.qty_rej, r.qty_good)
           for r in tables.lot.collect()}
    assert got == {"LINE1": (250, 420, 30, 390), "LINE2": (250, 420, 259, 161)}


def test_lot_summary(tables):
    (r,) = L.lot_summary(L.lot_quality(tables.lot), "A002").collect()
    assert (r.start_time, r.qty_in, r.qty_out, r.qty_rej) == (W.at(13), 500, 840, 289)


def test_work_time(plant, tables):
    rows = O.work_time(tables.machine_time, plant.config).collect()
    line1 = [(r.sched_work_time, r.actual_work_time) for r in rows if r.line_id == "LINE1"]
    line2 = [(r.sched_work_time, r.actual_work_time) for r in rows if r.line_id == "LINE2"]
    assert sorted(line1) == [(23.0, 22.75)] * 3
    assert len(line2) == 1 and line2[0][0] == 23.0
    assert line2[0][1] == pytest.approx(22 + 1 / 3)


def test_oee_report(plant, tables):
    rows = sorted(R.run_report(plant, tables).collect(), key=lambda r: r.line_id)
    got = [tuple(r) for r in rows]
    day = dt.date(2025, 10, 23)
    assert got == [("LINE1", day, "OCT", 4, "2025", 99.0, 1.85, 93.0, 1.70),
                   ("LINE2", day, "OCT", 4, "2025", 97.0, 1.88, 38.0, 0.70)]


def test_oee_rows_multiplicity(plant, tables):
    inp = R.oee_inputs(plant, tables)
    counted = O.oee_counted(*inp)
    assert counted.agg(F.sum("n_rows")).first()[0] == 27
    assert O.oee_rows(*inp).count() == 27
    distinct = O.oee(*inp)
    assert sorted(map(tuple, O.oee_rows(*inp).distinct().collect())) == sorted(
        map(tuple, distinct.collect()))


def test_oee_identity(plant, tables):
    """oee ~= qty_good / (S * R) * 100 (A and qty_out cancel)."""
    for r in O.oee(*R.oee_inputs(plant, tables)).collect():
        good = 390 if r.line_id == "LINE1" else 161
        assert r.oee == pytest.approx(good / (23 * 1000) * 100, abs=0.006)


def test_line_state_timeline_ranges(plant):
    rows = line_state_timeline(plant.machine_state, plant.lot).collect()
    assert len(rows) == 43


def test_throughput(plant, tables):
    tp = C.lot_throughput(W.sensor_union(plant), tables.lot).collect()
    assert [(r.lot_id, round(r.throughput, 4)) for r in tp] == [("A002", 2.3333)]
    set_rows = C.set_throughput(tables.lot, C.lot_throughput(W.sensor_union(plant), tables.lot))
    assert {round(r.throughput, 4) for r in set_rows.collect()} == {2.3333}


def test_monthly_and_today(plant, tables):
    o = O.oee(*R.oee_inputs(plant, tables))
    (m,) = O.monthly_oee(o, "OCT").collect()
    assert (m.avg_availability, m.avg_performance, m.avg_quality, m.avg_oee) == (
        98.0, 1.87, 65.5, 1.2)
    assert O.today_oee(o, "2025-10-23").count() == 2
    assert O.today_oee(o, "2025-10-24").count() == 0


def test_source_sql_runs_on_views(spark, plant, tables):
    from linepulse.plans.views import register_views

    register_views(plant, tables, as_of="2025-10-23")
    worst = spark.sql("SELECT max_by(machine_id, hours) AS id FROM (SELECT machine_id, "
                      "sum(down_time) AS hours FROM v_machine_time GROUP BY ALL)").first().id
    assert worst in {f"M{i:02d}" for i in range(8, 14)}
    lot = spark.table("v_quality_lot").filter("lot_id = 'A002'").groupBy().sum().first()
    assert (lot["sum(qty_in)"], lot["sum(qty_out)"], lot["sum(qty_rej)"]) == (500, 840, 289)
    assert spark.sql("SELECT DISTINCT * FROM v_oee WHERE oee > 0").count() == 2
    assert spark.sql("SELECT * FROM t_oee").count() == 2
    assert spark.sql("SELECT SUM(n_rows) AS n FROM v_oee_rows").first().n == 27
    assert spark.sql("SELECT * FROM v_line_state").count() == 43


def test_report_from_exported_csv_tables(spark, plant, tmp_path):
    """A1-A3 end to end: the walk-through tables exported as CSV with times
    as text (US layout for lots, ISO elsewhere; lots without trailing
    columns), loaded back with the domain schemas, give the same report."""
    from pyspark.sql import functions as F

    from linepulse.plans.plant import from_folder

    def export(df, name, us_layout=()):
        types = dict(df.dtypes)

        def text(c):
            if c in us_layout:
                return F.date_format(c, "MM/dd/yyyy HH:mm:ss").alias(c)
            if types[c] == "timestamp_ntz":
                return F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)
            return F.col(c)
        cols = [text(c) for c in df.columns]
        df.select(*cols).coalesce(1).write.option("header", True).csv(str(tmp_path / f"{name}.csv"))

    export(plant.machine, "machine")
    export(plant.machine_state, "machine_state")
    export(plant.lot.select("lot_id", "line_id", "start_time", "end_time", "qty_in"), "lot",
           us_layout=("start_time", "end_time"))
    export(plant.calendar, "calendar")
    export(plant.config, "config")
    ev = plant.sensor_events
    for name, flag in (("ss_reject", "is_reject"), ("ss_good", "is_good"),
                       ("ss_output", "is_output")):
        export(ev.filter(F.col(flag) == 1).select("line_id", "input_time", "event_id"), name)
    loaded = from_folder(spark, str(tmp_path), fmt="csv")
    got = sorted(tuple(r) for r in R.run_report(loaded).collect())
    want = sorted(tuple(r) for r in R.run_report(plant).collect())
    assert got == want and len(got) == 2


def test_report_from_exported_parquet_tables(spark, plant, tmp_path):
    """The same walk-through exported as parquet (lots in the older layout
    without qty_good/throughput) gives the same report."""
    from pyspark.sql import functions as F

    from linepulse.plans.plant import from_folder

    def export(df, name):
        df.coalesce(1).write.parquet(str(tmp_path / f"{name}.parquet"))

    export(plant.machine, "machine")
    export(plant.machine_state, "machine_state")
    export(plant.lot.drop("qty_good", "throughput"), "lot")
    export(plant.calendar, "calendar")
    export(plant.config, "config")
    ev = plant.sensor_events
    for name, flag in (("ss_reject", "is_reject"), ("ss_good", "is_good"),
                       ("ss_output", "is_output")):
        export(ev.filter(F.col(flag) == 1).select("line_id", "input_time", "event_id"), name)
    loaded = from_folder(spark, str(tmp_path))
    got = sorted(tuple(r) for r in R.run_report(loaded).collect())
    want = sorted(tuple(r) for r in R.run_report(plant).collect())
    assert got == want and len(got) == 2
