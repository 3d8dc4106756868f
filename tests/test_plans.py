"""Plan-shape guards for the properties that matter at scale."""

import re

import pytest
from pyspark.sql import functions as F

from linepulse.functions import MICROS_PER_HOUR
from linepulse.operators import containment as C
from linepulse.operators.islands import row_numbers, state_islands
from linepulse.operators.sequence import next_time_within
from linepulse.operators.window_counts import window_counts
from linepulse.plans.plant import from_testdata
from linepulse.plans.registry import queries
from linepulse.plans.report import today_report

SF = "/root/testdata/sf0.001"


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plant(spark):
    return from_testdata(spark, SF)


def _assert_no_whole_key_window(plan, key):
    """A window partitioned by the key alone may only run over per-day
    summary rows (ordered by ``_day``); raw rows need a time level."""
    for line in plan.splitlines():
        if "Window [" not in line:
            continue
        m = re.search(r"\], \[([^\]]*)\], \[([^\]]*)\]\s*$", line)
        assert m is not None, line
        part = [c.split("#")[0].strip() for c in m.group(1).split(",") if c.strip()]
        order = [c.split("#")[0].strip() for c in m.group(2).split(",") if c.strip()]
        if part == [key]:
            assert order == ["_day"], f"window over the whole key: {line}"


def test_islands_windows_are_time_bounded(plant):
    for df in (state_islands(plant.machine_state_input, with_last_flag=False),
               row_numbers(plant.machine_state_input, ["machine_id"], "time_input", "event_id")):
        plan = physical(df)
        assert "Window" in plan
        # raw samples meet in units of a key; only unit summaries in whole keys
        for line in plan.splitlines():
            if m := re.search(r"Window \[.*\], \[([^\]]*)\], \[([^\]]*)\]\s*$", line):
                part = re.findall(r"(\w+)#", m.group(1))
                assert part == ["_pk", "_unit"] or (part == ["_pk"] and "_unit" in m.group(2)), line
        assert plan.count("Exchange hashpartitioning") <= 5


def test_next_sample_windows_are_time_bounded(plant):
    df = next_time_within(plant.machine_state_input, ["machine_id"], "time_input",
                          MICROS_PER_HOUR)
    _assert_no_whole_key_window(physical(df), "machine_id")


def test_prefix_counts_have_no_pairs_join(plant):
    df = window_counts(plant.sensor_events, "input_time", plant.lot, {"n": F.lit(1)},
                       strategy="prefix")
    plan = physical(df)
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    # no join between raw sensor rows and lot windows: the only inputs of
    # joins are aggregated prefix tables and the windows' boundaries
    assert plan.count("FileScan parquet") >= 2


def test_containment_has_no_window_and_no_sequence_of_buckets(plant):
    plan = physical(C.lot_throughput(plant.sensor_events, plant.lot))
    assert "Window" not in plan and "sequence(0" in plan and plan.count("sequence(") == plan.count("sequence(0")


def test_no_nested_loop_or_python_in_registered_queries(spark):
    for name, fn in queries().items():
        if name.startswith("stream_") or name in ("machine_state_keyed_replace",
                                                  "append_result", "machine_time_snapshot"):
            continue
        plan = physical(fn(spark, SF))
        for bad in ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython",
                    "ArrowEvalPython"):
            assert bad not in plan, (name, bad)


def test_today_filters_reach_the_scan(plant):
    plan = physical(today_report(plant, "2024-01-15"))
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(start_time,2024-01-15", plan)
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(input_time,", plan)


def test_scans_read_only_needed_columns(plant):
    from linepulse.operators.machine_time import downtime_ranking, machine_micros

    plan = physical(downtime_ranking(machine_micros(plant.machine_state, plant.machine)))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert any(s.startswith("machine_id:string,start_time") and "state" in s for s in schemas)
    assert not any("description" in s for s in schemas)


def test_only_the_tables_asked_for_are_stored(spark, tmp_path, monkeypatch):
    from linepulse.plans import plant as P

    monkeypatch.setattr(P, "work_path", lambda spark, *parts: "/".join([str(tmp_path), *parts]))
    names = lambda: {f.name for f in tmp_path.glob("domain/*/*")} & set(P.TABLES)
    p = P.from_testdata(spark, SF, tables=("lot",))
    assert names() == {"lot"}
    assert p.machine.count() == P.from_testdata(spark, SF, staged=False).machine.count()
    assert names() == {"lot", "machine"}
    P.from_testdata(spark, SF)
    assert names() == set(P.TABLES)
