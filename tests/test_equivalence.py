"""Rewritten operators against brute force on random data.

The data deliberately hits the operators' internal edges: events on
second and day boundaries, many events at one instant (a hot timestamp),
one machine/key holding most rows, ties broken by id, NULL ends, empty and
negative windows, windows sharing an id, nested and open lots.
"""

import datetime as dt
import math
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from linepulse.functions import MICROS_PER_HOUR
from linepulse.operators import containment as C
from linepulse.operators import islands as I
from linepulse.operators.overlap import overlap_join
from linepulse.operators.sequence import next_time_within
from linepulse.operators.window_counts import window_counts

BASE = dt.datetime(2024, 1, 1)


def rand_time(rng, days=3):
    kind = rng.random()
    if kind < 0.15:   # on a day boundary
        return BASE + dt.timedelta(days=rng.randrange(days))
    if kind < 0.3:    # on a whole second
        return BASE + dt.timedelta(seconds=rng.randrange(days * 86400))
    if kind < 0.4:    # the hot instant
        return BASE + dt.timedelta(days=1, hours=6, microseconds=123)
    return BASE + dt.timedelta(microseconds=rng.randrange(days * 86400 * 10**6))


@pytest.mark.parametrize("seed,keyed,strategy", [
    (1, False, "prefix"), (2, True, "prefix"), (3, False, "prefix"),
    (1, False, "broadcast"), (2, True, "broadcast"), (4, True, "auto")])
def test_window_counts_brute_force(spark, seed, keyed, strategy):
    rng = random.Random(seed)
    events = [(rng.choice("ab") if keyed else "a", rand_time(rng), rng.random() < 0.3)
              for _ in range(400)]
    wins = []
    for i in range(60):
        s = rand_time(rng) if rng.random() < 0.7 else rng.choice(events)[1]
        length = rng.choice([None, 0, -5, 1, 3600, 86400 * 1.5, 10**-6])
        e = None if length is None else s + dt.timedelta(seconds=length)
        wins.append((f"w{rng.randrange(40)}", rng.choice("ab"), s, e))
    ev = spark.createDataFrame(events, "k string, t timestamp_ntz, flag boolean")
    wn = spark.createDataFrame(wins, "lot_id string, k string, start_time timestamp_ntz, "
                                     "end_time timestamp_ntz")
    got = window_counts(ev, "t", wn, {"n": F.lit(1), "f": F.col("flag")},
                        keys=["k"] if keyed else [], strategy=strategy)
    got = {r.lot_id: (r.n, r.f) for r in got.collect()}
    want = defaultdict(lambda: [0, 0])
    for lot, k, s, e in wins:
        if e is None or e <= s:
            continue
        want[lot]
        for ek, t, flag in events:
            if (not keyed or ek == k) and s <= t < e:
                want[lot][0] += 1
                want[lot][1] += int(flag)
    assert got == {k: tuple(v) for k, v in want.items()}


def brute_islands(samples):
    out = []
    by_m = defaultdict(list)
    for m, st, t, eid in samples:
        by_m[m].append((t, eid, st))
    for m, rows in by_m.items():
        rows.sort()
        cur = None
        for t, _, st in rows:
            if cur is not None and cur[1] == st:
                cur[3] = t
            else:
                if cur:
                    out.append(tuple(cur))
                cur = [m, st, t, t]
        out.append(tuple(cur))
    return sorted(out, key=repr)


def random_samples(rng, n=600):
    rows = []
    for i in range(n):
        m = "HOT" if rng.random() < 0.6 else f"M{rng.randrange(4)}"
        st = rng.choice(["PROD", "PROD", "PROD", "DOWN", None])
        t = rand_time(rng) if rng.random() < 0.5 else BASE + dt.timedelta(
            days=1, seconds=rng.randrange(5))
        rows.append((m, st, t, i))
    return rows


@pytest.mark.parametrize("seed,hot,wide", [(5, 1 << 20, False), (7, 4, False), (8, 4, True)])
def test_islands_brute_force(spark, seed, hot, wide):
    """``hot`` 4 cuts hours into slices and the hot instants into ranges of
    ties; ``wide``: sparse 64-bit ids."""
    rows = random_samples(random.Random(seed))
    if wide:
        wild = random.Random(1)
        ids = [wild.randrange(-(1 << 62), 1 << 62) for _ in rows]
        rows = [(m, st, t, i) for (m, st, t, _), i in zip(rows, ids)]
    df = spark.createDataFrame(rows, "machine_id string, state string, "
                                     "time_input timestamp_ntz, event_id bigint")
    want = brute_islands(rows)
    got = sorted((tuple(r) for r in I.state_islands(df, hot_rows=hot).collect()), key=repr)
    assert got == want
    got_rn = sorted((tuple(r) for r in I.islands_from_row_numbers(df).collect()), key=repr)
    assert got_rn == want


@pytest.mark.parametrize("hot", [1 << 20, 4])
def test_islands_without_ids(spark, hot):
    """Samples without an id, or with some: none is lost, states break ties."""
    rng = random.Random(3)
    rows = [(m, st or "X", t, i if rng.random() < .3 else None)
            for m, st, t, i in random_samples(rng, 300)]
    fields = "machine_id string, state string, time_input timestamp_ntz, event_id bigint"
    last = 1 << 62
    want = brute_islands([(m, st, t, (last if i is None else i, st)) for m, st, t, i in rows])
    df = spark.createDataFrame(rows, fields)
    assert sorted((tuple(r) for r in I.state_islands(df, hot_rows=hot).collect()), key=repr) == want
    want = brute_islands([(m, st, t, st) for m, st, t, _ in rows])
    got = I.state_islands(df.drop("event_id"), tie=None, hot_rows=hot)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == want


def test_ids_beyond_five_digits_stay_apart(spark):
    from linepulse.sources.adapters import machine_id_of

    ids = spark.createDataFrame([(7,), (99999,), (123456,), (123457,)], "user_id long")
    assert [r[0] for r in ids.select(machine_id_of(F.col("user_id"))).collect()] == [
        "M00007", "M99999", "M123456", "M123457"]


def test_window_counts_plans_agree_on_nulls_and_long_windows(spark):
    day = dt.timedelta(days=1)
    events = [("A", BASE + day * k) for k in range(5)] + [(None, BASE)]
    windows = [("x", "A", BASE, BASE + day), ("x", None, BASE, BASE + day), (None, "A", BASE, BASE + 3 * day),
               ("n", None, BASE, BASE + day), ("z", "A", BASE, dt.datetime(9999, 12, 31)),
               ("o", "A", BASE, None)]
    ev = spark.createDataFrame(events, "line string, t timestamp_ntz")
    win = spark.createDataFrame(windows, "lot_id string, line string, start_time timestamp_ntz, "
                                         "end_time timestamp_ntz")
    want = [("n", 0), ("x", 1), ("z", 5), (None, 3)]
    for strategy, rows in (("prefix", win), ("auto", win), ("broadcast", win.filter("lot_id <> 'z' OR lot_id IS NULL"))):
        got = window_counts(ev, "t", rows, {"n": F.lit(1)}, keys=["line"], strategy=strategy)
        kept = want if strategy != "broadcast" else [w for w in want if w[0] != "z"]
        assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted(kept, key=repr), strategy


def test_islands_last_flag(spark):
    rows = random_samples(random.Random(9), 300)
    df = spark.createDataFrame(rows, "machine_id string, state string, "
                                     "time_input timestamp_ntz, event_id bigint")
    last = defaultdict(lambda: BASE)
    for m, _, t, _ in rows:
        last[m] = max(last[m], t)
    for r in I.state_islands(df, with_last_flag=True).collect():
        assert r.is_last == (r.end_time == last[r.machine_id])


@pytest.mark.parametrize("hot", [1 << 20, 4])
def test_row_numbers_brute_force(spark, hot):
    rows = random_samples(random.Random(7), 400)
    df = spark.createDataFrame(rows, "machine_id string, state string, "
                                     "time_input timestamp_ntz, event_id bigint")
    got = {r.event_id: r.rn for r in I.row_numbers(df, ["machine_id"], "time_input",
                                                      "event_id", hot_rows=hot).collect()}
    by_m = defaultdict(list)
    for m, _, t, eid in rows:
        by_m[m].append((t, eid))
    want = {}
    for lst in by_m.values():
        for i, (_, eid) in enumerate(sorted(lst), 1):
            want[eid] = i
    assert got == want


def test_next_time_within_brute_force(spark):
    rng = random.Random(11)
    rows = [(rng.choice([1, 1, 1, 2]), BASE + dt.timedelta(
        microseconds=rng.choice([0, 10**6, 3600 * 10**6, 2 * 3600 * 10**6])
        + rng.randrange(3 * 3600 * 10**6) // rng.choice([1, 10**5]))) for _ in range(300)]
    df = spark.createDataFrame(rows, "k bigint, t timestamp_ntz")
    got = {(r.k, r.t): r.next_us for r in
           next_time_within(df, ["k"], "t", MICROS_PER_HOUR).collect()}
    by_k = defaultdict(set)
    for k, t in rows:
        by_k[k].add(t)
    for (k, t), nxt in got.items():
        later = [u for u in by_k[k] if u > t]
        cand = min(later) if later else None
        if cand is not None and cand - t > dt.timedelta(hours=1):
            cand = None
        us = None if cand is None else int((cand - dt.datetime(1970, 1, 1)).total_seconds()
                                           * 10**6 + 0.5)
        assert nxt == us, (k, t)
    assert len(got) == len({(k, t) for k, t in rows})


def test_containing_lot_brute_force(spark):
    rng = random.Random(13)
    lots = []
    for i in range(40):
        s = BASE + dt.timedelta(minutes=rng.randrange(3 * 24 * 60))
        e = None if rng.random() < 0.15 else s + dt.timedelta(minutes=rng.randrange(0, 600))
        lots.append((f"L{i % 25}", rng.choice(["A", "B"]), s, e, rng.randrange(100)))
    events = [(i, rng.choice(["A", "B"]), rng.choice([l[2] for l in lots] + [l[3] for l in lots
              if l[3]] + [BASE + dt.timedelta(minutes=rng.randrange(4 * 24 * 60))]))
              for i in range(300)]
    ldf = spark.createDataFrame(lots, "lot_id string, line_id string, start_time timestamp_ntz, "
                                      "end_time timestamp_ntz, qty_out bigint")
    edf = spark.createDataFrame(events, "event_id bigint, line_id string, "
                                        "input_time timestamp_ntz")
    got = {r.event_id: r.lot_id for r in C.event_lot_lookup(edf, ldf).collect()}
    want = {}
    for eid, line, t in events:
        cands = [(s, lid) for lid, ln, s, e, _ in lots
                 if ln == line and s <= t and (e is None or t <= e)]
        if cands:
            want[eid] = max(cands)[1]
    assert got == want
    # throughput: last hit per lot id, value from the matched row
    tp = {r.lot_id: r.throughput for r in C.lot_throughput(edf, ldf).collect()}
    last = {}
    for eid, line, t in events:
        cands = [(s, lid, qo) for lid, ln, s, e, qo in lots
                 if ln == line and s <= t and (e is None or t <= e)]
        if cands:
            s, lid, _ = max(cands, key=lambda c: (c[0], c[1]))
            qos = [qo for l2, ln2, s2, _, qo in lots if (l2, ln2, s2) == (lid, line, s)]
            if lid not in last or (t, eid) > last[lid][0]:
                last[lid] = ((t, eid), s, max(qos))
    for lid, ((t, _), s, qo) in last.items():
        el = (t - s).total_seconds()
        assert tp[lid] == pytest.approx(qo / (el / 60) if el > 0 else 0.0)
    assert set(tp) == set(last)


def test_aligned_cells_cover_every_bucket_once(spark):
    rng = random.Random(19)
    spans = [(-1, 0), (0, 1), (3, 3), (5, 4), (-4, 64), (-17, 83), (1, 4 ** 6)]
    spans += [(a, a + rng.randrange(700)) for a in [rng.randrange(-500, 500) for _ in range(60)]]
    df = spark.createDataFrame([(i, *s) for i, s in enumerate(spans)], "id long, _lo long, _hi long")
    covered = {i: [] for i in range(len(spans))}
    for r in C._aligned_cells(df).collect():
        covered[r.id].append((r._level, r._cell))
    for i, (lo, hi) in enumerate(spans):
        buckets = sorted(b for level, c in covered[i] for b in range(c * 4 ** level, (c + 1) * 4 ** level))
        assert buckets == list(range(lo, hi))
        assert len(covered[i]) <= 6 * (math.log(max(hi - lo, 1), 4) + 1)


def test_containing_lot_of_any_length(spark):
    """Minute lots beside lots of months, open lots and ends in the year 9999."""
    rng = random.Random(23)
    lots = []
    for i in range(80):
        s = BASE + dt.timedelta(minutes=rng.randrange(300 * 24 * 60))
        e = rng.choice([s + dt.timedelta(minutes=rng.randrange(4)), s + dt.timedelta(days=rng.randrange(200)),
                        None, dt.datetime(9999, 12, 31, 23, 59, 59, 999999), s - dt.timedelta(minutes=1)])
        lots.append((f"L{i % 60}", rng.choice(["A", "B", None]), s, e))
    marks = [t for l in lots for t in l[2:] if t and t.year < 9999]
    events = [(i, rng.choice(["A", "B", None]),
               rng.choice(marks) + dt.timedelta(seconds=rng.choice([0, 0, 1, -1, 3000]))) for i in range(400)]
    ldf = spark.createDataFrame(lots, "lot_id string, line_id string, start_time timestamp_ntz, "
                                      "end_time timestamp_ntz")
    edf = spark.createDataFrame(events, "event_id bigint, line_id string, input_time timestamp_ntz")
    got = {r.event_id: r.lot_id for r in C.event_lot_lookup(edf, ldf).collect()}
    want = {}
    for eid, line, t in events:
        if found := [(s, lid) for lid, ln, s, e in lots
                     if line and ln == line and s <= t and (e is None or t <= e)]:
            want[eid] = max(found)[1]
    assert len(want) > 150 and got == want


@pytest.mark.parametrize("cell_us", [1_000_000, 60_000_000, 10**12])
def test_overlap_join_brute_force(spark, cell_us):
    rng = random.Random(17)

    def ivs(n, prefix):
        out = []
        for i in range(n):
            s = BASE + dt.timedelta(minutes=rng.randrange(2 * 24 * 60))
            out.append((f"{prefix}{i}", rng.choice("xy"), s,
                        s + dt.timedelta(minutes=rng.randrange(0, 300))))
        return out
    a, b = ivs(80, "a"), ivs(40, "b")
    for rows, name in ((a, "a"), (b, "b")):         # ends far off, none at all, before the start
        for k, end in enumerate([dt.datetime(9999, 12, 31), None, BASE, dt.datetime(2031, 5, 1)]):
            rows.append((f"{name}_{k}", "x", BASE + dt.timedelta(minutes=900 + k), end))
    adf = spark.createDataFrame(a, "aid string, k string, a_s timestamp_ntz, a_e timestamp_ntz")
    bdf = spark.createDataFrame(b, "bid string, k string, b_s timestamp_ntz, b_e timestamp_ntz")
    got = sorted((r.aid, r.bid) for r in overlap_join(adf, bdf, "k", ("a_s", "a_e"),
                                                      ("b_s", "b_e"), cell_us=cell_us).collect())
    want = sorted((x[0], y[0]) for x in a for y in b
                  if x[1] == y[1] and x[3] and y[3] and x[2] < y[3] and x[3] > y[2])
    assert got == want and any(i.startswith("a_") for i, _ in got)


def test_numeric_rounding_whatever_the_size(spark):
    from linepulse.functions import round_numeric

    cases = [(1e27, 1e27), (-1.23456789012345678e30, -1.23456789012346e30), (1.5e-13, 0.0), (0.125, 0.13),
             (-0.125, -0.13), (2.675, 2.68), (1.005, 1.01), (1e15, 1e15), (123456789012345.6, 123456789012346.0),
             (99999999999999.99, 100000000000000.0), (float("nan"), None), (float("inf"), None), (None, None), (0.0, 0.0)]
    df = spark.createDataFrame([(k, x) for k, (x, _) in enumerate(cases)], "k int, x double")
    got = df.select("k", round_numeric(F.col("x"), 2).alias("y")).orderBy("k").collect()
    assert [r["y"] for r in got] == [y for _, y in cases]


@pytest.mark.parametrize("ties", ["spread", "outlier", "none"])
def test_bursts_are_split_evenly(spark, ties):
    """20,000 samples of one machine within a second, or at one instant with an
    outlying tie: no unit holds much more than hot_rows of them."""
    import datetime as dt

    rng, n, hot = random.Random(1), 20_000, 100
    start = dt.datetime(2024, 1, 1, 5, 30)
    rows = []
    for i in range(n):
        at = start + dt.timedelta(microseconds=i * 40 if ties == "spread" else (i // 1000) * 7)
        tie = None if ties == "none" else (1 << 61 if i == 7 and ties == "outlier" else i)
        rows.append(("M1", str(rng.randrange(400)) if ties == "none" else rng.choice("AB"), at, tie))
    rows.append(("M1", "A", dt.datetime(2024, 1, 1, 5, 0), -(1 << 61)))
    df = spark.createDataFrame(rows, "machine_id string, state string, time_input timestamp_ntz, event_id bigint")
    order = [F.col("event_id").asc_nulls_last(), F.col("state").asc_nulls_last()]
    units = I._in_units(df, ["machine_id"], "time_input", order, hot, repeats_matter=False)
    assert units.groupBy("_pk", "_unit").count().agg(F.max("count")).first()[0] <= 4 * hot
    assert _sorted(I.state_islands(df, hot_rows=hot)) == _sorted(I.state_islands(df))
    if ties != "none":
        numbers = I.row_numbers(df, ["machine_id"], "time_input", "event_id", hot_rows=hot)
        assert [r["rn"] for r in numbers.orderBy("time_input", "event_id").collect()] == list(range(1, n + 2))


def _sorted(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
