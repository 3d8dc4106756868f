"""Streaming jobs equal the batch operators on everything received,
with input arriving as several files in shuffled time order."""

import pytest
from pyspark.sql import functions as F

from linepulse.operators import containment as C
from linepulse.operators import lots as L
from linepulse.operators.islands import state_islands
from linepulse.plans.plant import from_testdata
from linepulse.plans.report import refreshed_lots
from linepulse.sources import adapters as A
from linepulse.streaming.islands_job import IslandsJob
from linepulse.streaming.sensor_job import SensorJob

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def event_files(spark, tmp_path_factory):
    """The events split into 3 files by time; file names put the latest
    third first, so micro-batches arrive out of order."""
    folder = tmp_path_factory.mktemp("events")
    ev = A.events(spark, SF)
    lo, hi = ev.agg(F.min("ts"), F.max("ts")).first()
    step = (hi - lo) / 3
    parts = [ev.filter((F.col("ts") >= lo + step * i) & (F.col("ts") < lo + step * (i + 1)))
             if i < 2 else ev.filter(F.col("ts") >= lo + step * 2) for i in range(3)]
    for name, part in zip(["events_a", "events_c", "events_b"], [parts[2], parts[0], parts[1]]):
        part.coalesce(1).write.parquet(str(folder / f"{name}.tmp"))
        (f,) = [p for p in (folder / f"{name}.tmp").iterdir() if p.suffix == ".parquet"]
        f.rename(folder / f"{name}.parquet")
    return str(folder)


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_stream_islands_equal_batch(spark, event_files, tmp_path):
    stream = A.samples_of(A.event_stream(spark, event_files, "events_*.parquet",
                                         max_files_per_trigger=1))
    got = IslandsJob(spark, str(tmp_path / "job")).run(stream, str(tmp_path / "ckpt"))
    want = state_islands(A.machine_state_input(spark, SF))
    assert _rows(got) == _rows(want)


def test_stream_counters_and_throughput_equal_batch(spark, event_files, tmp_path):
    p = from_testdata(spark, SF, staged=False)
    job = SensorJob(spark, str(tmp_path / "job"), p, with_oee=False)
    stream = A.sensors_of(A.event_stream(spark, event_files, "events_*.parquet",
                                         max_files_per_trigger=1))
    job.run(stream, str(tmp_path / "ckpt"))
    assert job.pieces().select("batch_id").distinct().count() == 3
    batch = L.sensor_counts(p.lot, p.sensor_events)
    assert _rows(job.counters().select("lot_id", *L.SENSOR_MEASURES)) == _rows(
        batch.select("lot_id", *L.SENSOR_MEASURES))
    lots = refreshed_lots(p)
    assert _rows(job.lots()) == _rows(lots)
    ev = p.sensor_events
    union = ev.select("event_id", "line_id", "input_time").unionByName(
        ev.filter("is_reject = 1").select("event_id", "line_id", "input_time")).unionByName(
        ev.filter("is_good = 1").select("event_id", "line_id", "input_time"))
    assert _rows(job.throughput()) == _rows(C.lot_throughput(union, lots))


def test_replayed_batch_is_idempotent(spark, tmp_path):
    p = from_testdata(spark, SF, staged=False)
    job = SensorJob(spark, str(tmp_path / "job"), p, with_oee=False)
    batch = p.sensor_events
    job.handle(batch, 0)
    first = _rows(job.counters())
    job.handle(batch, 0)            # replay of the same batch id
    assert _rows(job.counters()) == first


def test_incremental_islands_cuts(spark, tmp_path):
    """Hand-made batches: runs extended across batches, a late sample that
    splits a stored island, ties at an island's first timestamp, a replay."""
    import datetime as dt

    def t(h, m=0, d=1):
        return dt.datetime(2024, 1, d, h, m)

    batches = [
        [("M1", "PROD", t(8), 1), ("M1", "PROD", t(9), 2), ("M1", "DOWN", t(10), 3),
         ("M2", "IDLE", t(8), 4)],
        [("M1", "DOWN", t(11), 5), ("M1", "PROD", t(1, 0, 2), 6)],       # next day
        [("M1", "DOWN", t(8, 30), 7)],                                   # late: splits
        [("M1", "SETUP", t(10), 0), ("M2", "IDLE", t(9), 8)],           # tie before eid 3
        [("M1", "SETUP", t(10), 0)],                                     # duplicate
    ]
    schema = "machine_id string, state string, time_input timestamp_ntz, event_id bigint"
    job = IslandsJob(spark, str(tmp_path / "job"))
    seen = []
    for i, rows in enumerate(batches):
        seen += rows
        job.handle(spark.createDataFrame(rows, schema), i)
        want = state_islands(spark.createDataFrame(seen, schema))
        assert _rows(job.read()) == _rows(want), i
    job.handle(spark.createDataFrame(batches[1], schema), 1)             # replay of batch 1
    assert _rows(job.read()) == _rows(state_islands(spark.createDataFrame(seen, schema)))


@pytest.fixture(scope="module")
def event_files_in_order(spark, tmp_path_factory):
    """The events split into 3 files by time, written (and named) in order."""
    folder = tmp_path_factory.mktemp("events_in_order")
    ev = A.events(spark, SF)
    lo, hi = ev.agg(F.min("ts"), F.max("ts")).first()
    step = (hi - lo) / 3
    for i in range(3):
        part = ev.filter(F.col("ts") >= lo + step * i)
        if i < 2:
            part = part.filter(F.col("ts") < lo + step * (i + 1))
        part.coalesce(1).write.parquet(str(folder / f"p{i}.tmp"))
        (f,) = [p for p in (folder / f"p{i}.tmp").iterdir() if p.suffix == ".parquet"]
        f.rename(folder / f"events_{i}.parquet")
    return str(folder)


def test_stateful_islands_equal_batch_in_order(spark, event_files_in_order, tmp_path):
    from linepulse.streaming.stateful_islands import StatefulIslandsJob

    stream = A.samples_of(A.event_stream(spark, event_files_in_order, "events_*.parquet",
                                         max_files_per_trigger=1))
    job = StatefulIslandsJob(spark, str(tmp_path / "job"))
    got = job.run(stream, str(tmp_path / "ckpt"))
    assert spark.read.parquet(job.path).select("batch_id").distinct().count() == 3
    want = state_islands(A.machine_state_input(spark, SF))
    assert _rows(got) == _rows(want)


def test_stateful_islands_runs_across_batches(spark, tmp_path):
    """Runs continuing across batches, NULL states and ties, fed in order."""
    import datetime as dt

    from linepulse.streaming.stateful_islands import StatefulIslandsJob

    def t(h, m=0):
        return dt.datetime(2024, 1, 1, h, m)

    batches = [
        [("M1", "PROD", t(8), 1), ("M1", "PROD", t(9), 2), ("M2", None, t(8), 3)],
        [("M1", "PROD", t(10), 4), ("M1", "DOWN", t(10), 5), ("M2", None, t(9), 6)],
        [("M1", "DOWN", t(11), 7), ("M2", "IDLE", t(12), 8), ("M3", "PROD", t(12), 9)],
    ]
    schema = "machine_id string, state string, time_input timestamp_ntz, event_id bigint"
    folder = tmp_path / "in"
    folder.mkdir()
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / f"b{i}"))
        (f,) = [p for p in (tmp_path / f"b{i}").iterdir() if p.suffix == ".parquet"]
        f.rename(folder / f"s{i}.parquet")
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
              .parquet(str(folder)))
    got = StatefulIslandsJob(spark, str(tmp_path / "job")).run(stream, str(tmp_path / "ck"))
    everything = spark.createDataFrame([r for b in batches for r in b], schema)
    assert _rows(got) == _rows(state_islands(everything))


def test_stateful_islands_without_python_on_workers(spark, tmp_path):
    """A machine's rows of a batch are no pandas frame; a replay, NULL machines,
    ties without an id and an empty batch give the same islands."""
    from linepulse.streaming import stateful_islands as SI

    batches = [[("M1", "PROD", _t(8), None), ("M1", None, _t(8), None), (None, "IDLE", _t(8), 1)],
               [], [("M1", None, _t(9), 2), (None, "IDLE", _t(9), 3), (None, "DOWN", _t(10), 4)]]
    schema = "machine_id string, state string, time_input timestamp_ntz, event_id bigint"
    job = SI.StatefulIslandsJob(spark, str(tmp_path / "job"))
    for k in (0, 1, 2, 2):
        job.handle(spark.createDataFrame(batches[k], schema), k)
    everything = spark.createDataFrame([r for b in batches for r in b], schema)
    assert _rows(job.read()) == _rows(state_islands(everything))
    plan = SI.advance(everything, job.open.read())._jdf.queryExecution().toString()
    assert "Pandas" not in plan and "Python" not in plan


def _t(h, m=0, d=1):
    import datetime as dt

    return dt.datetime(2024, 1, d, h, m)


EVENTS = "line_id string, input_time timestamp_ntz, event_id bigint, is_reject bigint, is_good bigint, is_output bigint"


def _batch(spark, times, line="LINE1"):
    return spark.createDataFrame([(line, t, i, 0, 1, 1) for i, t in enumerate(times)], EVENTS)


def _changing_plant(spark, state):
    """A plant whose lot table is read from ``state['lots']`` each time."""
    from linepulse import schemas as S
    from linepulse.plans.plant import Plant

    def lots():
        rows = [(i, line, s, e, 10, None, None, None, None) for i, line, s, e in state["lots"]]
        return spark.createDataFrame(rows, S.LOT)

    return Plant({"lot": lots})


def test_lots_that_open_close_and_move_are_recounted(spark, tmp_path):
    state = {"lots": [("A", "LINE1", _t(8), None), ("B", "LINE1", _t(12), _t(13))]}
    job = SensorJob(spark, str(tmp_path / "job"), _changing_plant(spark, state), with_oee=False)
    fed = []
    steps = [
        ([_t(8, 10), _t(8, 20)], None),                                 # A is open
        ([_t(9)], [("A", "LINE1", _t(8), _t(10)), ("B", "LINE1", _t(12), _t(13))]),    # A closed
        ([_t(12, 30), _t(8, 30)], None),                                # one late piece
        ([], [("A", "LINE1", _t(8, 15), _t(10)), ("C", "LINE1", _t(12), _t(14))]),     # A moved, B gone
        ([_t(13, 30)], None),
    ]
    for k, (times, lots) in enumerate(steps):
        if lots is not None:
            state["lots"] = lots
        fed += times
        job.handle(_batch(spark, times), k)
        everything = _batch(spark, fed)
        want = L.sensor_counts(job.plant.fresh("lot"), everything).select("lot_id", *L.SENSOR_MEASURES)
        assert _rows(job.counters()) == _rows(want), k
        assert _rows(job.throughput()) == _rows(C.lot_throughput(everything, job.lots())), k
    assert {r.lot_id: r.output_count for r in job.counters().collect()} == {"A": 3, "C": 2}
    state["lots"].append(("D", "LINE1", _t(8), _t(9)))                  # lots alone have changed
    job.refresh()
    assert {r.lot_id: r.output_count for r in job.counters().collect()}["D"] == 3


def test_throughput_state_equals_batch(spark, tmp_path):
    """Random pieces in any order, nested and open lots that come, move and go,
    a replayed batch and refreshes between batches."""
    import random

    rng = random.Random(4)

    def lot(i):
        s = _t(rng.randint(0, 23), rng.choice([0, 30]), rng.randint(1, 5))
        e = rng.choice([None, s, s + dt.timedelta(hours=rng.randint(1, 40)), dt.datetime(9999, 12, 31)])
        return f"L{i % 9}", rng.choice(["LINE1", "LINE2"]), s, e

    import datetime as dt

    state = {"lots": [lot(i) for i in range(12)]}
    job = SensorJob(spark, str(tmp_path / "job"), _changing_plant(spark, state), with_oee=False)
    fed, k = [], 0
    for step in range(4):
        if step in (1, 3):
            for i in rng.sample(range(len(state["lots"])), 4):
                state["lots"][i] = lot(i)
            state["lots"].pop()
        if step == 3:
            job.refresh()
        else:
            rows = [(rng.choice(["LINE1", "LINE2", None]), _t(rng.randint(0, 23), rng.choice([0, 15]),
                     rng.randint(1, 6)), 1000 * k + i, 0, 1, 1) for i in range(40)]
            fed += rows
            job.handle(spark.createDataFrame(rows, EVENTS), k)
            if step == 2:
                job.handle(spark.createDataFrame(rows, EVENTS), k)
            k += 1
        want = C.lot_throughput(spark.createDataFrame(fed, EVENTS), job.lots())
        assert _rows(job.throughput()) == _rows(want), step
    assert job.throughput().count() > 4


def test_a_changed_lot_reads_the_days_of_touched_windows_only(spark, tmp_path, monkeypatch):
    from linepulse.streaming import last_hits as H

    state = {"lots": [(f"L{d}", "LINE1", _t(8, d=d), _t(20, d=d)) for d in range(1, 9)]}
    job = SensorJob(spark, str(tmp_path / "job"), _changing_plant(spark, state), with_oee=False)
    job.handle(_batch(spark, [_t(9, d=d) for d in range(1, 9)]), 0)
    read = []
    monkeypatch.setattr(H, "_hits", lambda pieces, lot, of=H._hits: (
        read.append(sorted(r.day.day for r in pieces.select("day").distinct().collect())), of(pieces, lot))[1])
    job.handle(_batch(spark, [_t(10, d=2)]), 1)                 # no lot has changed
    state["lots"][4] = ("L5", "LINE1", _t(8, d=5), _t(9, d=6))  # meets L6
    job.handle(_batch(spark, [_t(11, d=1)]), 2)
    assert read == [[2], [1], [5, 6]]


def test_stream_without_any_lot(spark, tmp_path):
    job = SensorJob(spark, str(tmp_path / "job"), _changing_plant(spark, {"lots": []}), with_oee=False)
    job.handle(_batch(spark, [_t(8)]), 0)
    job.handle(_batch(spark, []), 1)
    assert job.counters().count() == 0 and job.throughput().count() == 0 and job.lots().count() == 0


def test_replay_and_expiry(spark, tmp_path):
    state = {"lots": [("A", "LINE1", _t(8), _t(10))]}
    job = SensorJob(spark, str(tmp_path / "job"), _changing_plant(spark, state), with_oee=False,
                    keep_versions=2)
    for k in range(4):
        job.handle(_batch(spark, [_t(8, k)]), k)
    job.handle(_batch(spark, [_t(8, 3)]), 3)
    assert {r.lot_id: r.output_count for r in job.counters().collect()} == {"A": 4}
    assert len(job.counts.versions()) == 2


def test_today_is_empty_after_midnight(spark, tmp_path):
    p = from_testdata(spark, SF, staged=False)
    job = SensorJob(spark, str(tmp_path / "job"), p, as_of="2024-01-15")
    job.handle(p.sensor_events, 0)
    assert job.today.read().count() > 0
    job.as_of = "2031-01-01"
    job.handle(p.sensor_events.limit(0), 1)
    assert job.today.read().count() == 0
    assert job.today.read(0).count() > 0


def test_counts_after_refreshes_between_batches(spark, tmp_path):
    """Versions of the counts follow their own numbers, whatever is called when."""
    state = {"lots": [("A", "LINE1", _t(8), _t(10))]}
    job = SensorJob(spark, str(tmp_path / "job"), _changing_plant(spark, state), with_oee=False)
    count = lambda: {r.lot_id: r.output_count for r in job.counters().collect()}
    job.refresh()                                               # before any piece
    assert count() == {"A": 0}
    job.handle(_batch(spark, [_t(8, 1)]), 0)
    job.refresh()
    job.refresh()
    job.handle(_batch(spark, [_t(8, 2)]), 1)
    assert count() == {"A": 2}
    job._store(_batch(spark, [_t(8, 3)]), 2)                    # a crash before the counts
    job.refresh()
    assert count() == {"A": 3}
    job.handle(_batch(spark, [_t(8, 3)]), 2)
    job.handle(_batch(spark, [_t(9), _t(12)]), 3)
    assert count() == {"A": 4}


SAMPLE = "machine_id string, state string, time_input timestamp_ntz"


def test_islands_without_ids_equal_batch(spark, tmp_path):
    """Random batches in any order, ties, late rows, NULL machines and states."""
    import random

    rng = random.Random(6)
    job, seen = IslandsJob(spark, str(tmp_path / "job"), buckets=3), []
    assert job.read().count() == 0
    for k in range(4):
        rows = [(rng.choice(["M1", "M2", None]), rng.choice(["A", "B", None]),
                 _t(rng.randint(0, 23), rng.choice([0, 0, 30]), rng.randint(1, 4))) for _ in range(60)]
        seen += rows
        job.handle(spark.createDataFrame(rows, SAMPLE), k)
        want = state_islands(spark.createDataFrame(seen, SAMPLE), tie=None)
        assert _rows(job.read()) == _rows(want), k
    job.handle(spark.createDataFrame(rows, SAMPLE), 3)          # replay
    assert _rows(job.read()) == _rows(want)


def test_island_days_of_many_samples_are_cut(spark, tmp_path):
    """Days beyond hot_rows go through the batch operator, the others are sorted
    whole; runs go on over days and ties order samples of an instant."""
    import random

    rng = random.Random(7)
    job, seen = IslandsJob(spark, str(tmp_path / "job"), buckets=2, hot_rows=15), []
    for k in range(2):
        rows = [(rng.choice(["M1", "M2", "M3", None]), rng.choice(["A", "A", "A", None]), t, rng.randint(1, 3))
                for t in [_t(8, m // 4, 1) for m in range(40)] + [_t(8, m, d) for m in range(2) for d in (2, 3, 5)]]
        seen += rows
        job.handle(spark.createDataFrame(rows, SAMPLE + ", event_id bigint"), k)
    pairs = job._pairs(job._samples())
    hot = job._pairs(job._samples(), job.hot_rows)
    assert any(hot.values()) and sum(map(len, hot.values())) < sum(map(len, pairs.values()))
    assert _rows(job.read()) == _rows(state_islands(spark.createDataFrame(seen, SAMPLE + ", event_id bigint")))


def test_island_days_are_made_with_one_shuffle(spark, tmp_path):
    job = IslandsJob(spark, str(tmp_path / "job"))
    job.handle(spark.createDataFrame([("M1", "A", _t(8)), ("M1", "B", _t(9))], SAMPLE), 0)
    plan = job._runs_of(job._samples())._jdf.queryExecution().sparkPlan().toString()
    made = job._runs_of(job._samples())._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window") and made.count("Exchange hashpartitioning") == 1
    assert job._runs_of(job._samples()).count() == 2


def test_islands_watermark_counts_late_rows_and_forgets_old_days(spark, tmp_path):
    import datetime as dt

    job = IslandsJob(spark, str(tmp_path / "job"), lateness=dt.timedelta(days=1))
    batches = [[("M1", "A", _t(8, 0, d)) for d in (1, 2, 3, 4)],
               [("M1", "B", _t(9, 0, 2)), ("M1", "B", _t(9, 0, 3)), ("M1", "A", _t(8, 0, 9))],
               [("M1", "B", _t(7, 0, 8)), ("M1", "B", _t(8, 0, 8))]]
    for k, rows in enumerate(batches):
        job.handle(spark.createDataFrame(rows, SAMPLE), k)
    job.handle(spark.createDataFrame(batches[2], SAMPLE), 2)
    timely = [r for k, rows in enumerate(batches) for r in rows
              if not (k == 1 and r[2] < _t(8, 0, 3)) and not (k == 2 and r[2] < _t(8, 0, 8))]
    assert job.late() == 2 and len(timely) == 7
    assert _rows(job.read()) == _rows(state_islands(spark.createDataFrame(timely, SAMPLE), tie=None))
    assert job._samples().agg(F.min("day")).first()[0] == dt.date(2024, 1, 8)


def test_stateful_stream_without_input_is_empty(spark, tmp_path):
    from linepulse.streaming.stateful_islands import StatefulIslandsJob

    assert StatefulIslandsJob(spark, str(tmp_path / "job")).read().collect() == []


def test_a_write_that_crashed_before_its_manifest_leaves_no_rows(spark, tmp_path, monkeypatch):
    from linepulse.sources.versioned import VersionedTable

    table = VersionedTable(spark, str(tmp_path / "t"))
    table.write(spark.range(2), version=0)

    def crash(*_, **__):
        raise RuntimeError("crash")

    for attempt in (lambda: table.write(spark.range(3), version=1), lambda: table.append(spark.range(5))):
        with monkeypatch.context() as m:
            m.setattr("pyspark.sql.DataFrameWriter.json", crash)
            with pytest.raises(RuntimeError):
                attempt()
        assert table.read().count() == 2
    table.write(spark.range(3), version=1)
    table.write(spark.range(3), version=1)                      # a replay
    assert table.read().count() == 3 and sorted(table.versions()) == [0, 1]
    table.append(spark.range(4))
    assert table.read().count() == 7 and table.read(0).count() == 2
    assert table.expire(1) == [0] and table.read().count() == 7


def test_day_rolls_over_without_input(spark, tmp_path):
    """The clock alone stores the new day's empty rows, once."""
    import time

    p = from_testdata(spark, SF, staged=False)
    job = SensorJob(spark, str(tmp_path / "job"), p, as_of="2024-01-15")
    job.handle(p.sensor_events, 0)
    assert job.today.read().count() > 0 and not job.tick()
    job.as_of = "2024-01-16"
    assert job.tick() and not job.tick() and len(job.today.versions()) == 2
    job.as_of = "2031-01-01"
    query = job.clock(str(tmp_path / "clock"), "1 second")
    try:
        until = time.time() + 60
        while len(job.today.versions()) < 3 and time.time() < until:
            time.sleep(0.5)
    finally:
        query.stop()
    assert job.today.read().count() == 0 and len(job.today.versions()) == 3
