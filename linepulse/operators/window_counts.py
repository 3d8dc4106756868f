"""Exact event counts per time window.

Two exact plans, chosen per call:

* **broadcast** -- when the windows, cut into time buckets, are proven small
  (at most ``MAX_BROADCAST_ROWS`` bucket rows and at most ``MAX_CANDIDATES``
  windows in any (key, bucket)), they are broadcast and each event probes
  its own bucket: no shuffle of events, a constant number of candidate
  windows per event, partial sums per group before the only shuffle;
* **prefix** -- otherwise (windows grow with the data, or pile up in one
  bucket), counts come from prefix sums and no (event, window) pair is
  formed at all, as described below.

Prefix plan:

``count of events in [s, e)`` equals ``C(<e) - C(<s)``, where ``C(<x)`` is the
number of events (with the same key) strictly before ``x``.  ``C`` is needed
only at window boundaries, and it is assembled from three prefix sums:

* day level:    events on earlier days            (window per key over days)
* second level: events in earlier seconds that day (window per key and day)
* exact level:  events earlier in the same second  (window per key and second)

Every window partition is bounded by the calendar, not by the data: at most
one row per day, 86,400 per day, 10^6 distinct microsecond timestamps per
second.  Events are first collapsed to distinct (key, timestamp) with
map-side partial aggregation, so a hot timestamp, key or hour costs nothing
extra, and the work is linear in events + windows no matter how many
(event, window) pairs match.  No event is dropped and no window capped.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linepulse.functions import (MICROS_PER_DAY, MICROS_PER_HOUR, MICROS_PER_SECOND,
                                 epoch_micros, floor_div)

# Bounds under which the window side may be broadcast (see window_counts).
MAX_BROADCAST_ROWS = 1_000_000
MAX_CANDIDATES = 16

def counts_before(events: DataFrame, boundaries: DataFrame, keys: Sequence[str],
                  measures: Sequence[str]) -> DataFrame:
    """For each distinct boundary (keys, ``us``): per measure, the sum over
    events of the same keys with ``us`` strictly before it.

    ``events`` has columns keys, ``us`` (BIGINT epoch micros) and the
    measures (BIGINT); ``boundaries`` has keys and ``us``.
    Returns keys, ``us`` and one ``c_<measure>`` column per measure.

    Events are aggregated once to distinct (keys, ``us``) (map-side partial
    sums).  Three window passes then run from coarse to fine, and each hands
    its result down as one carrier row per partition of the next:

    * days per key: events on earlier days, at each marked day;
    * seconds per (key, day): plus events in earlier seconds, at each marked
      second (the day's value arrives as the partition's carrier row);
    * instants per (key, second): plus events earlier in the second, at each
      boundary (the second's value arrives as the carrier row).

    Boundary marks sort before the events of their own unit, so only
    strictly earlier events count.  Coarse levels see marks collapsed to
    their unit, so every partition is bounded by the calendar; no join.
    """
    keys = list(keys)
    sums = [F.sum(m).alias(m) for m in measures]
    zero = [F.lit(0).cast("bigint").alias(m) for m in measures]
    carry = [f"_c_{m}" for m in measures]
    no_carry = [F.lit(None).cast("bigint").alias(c) for c in carry]

    def units(df: DataFrame) -> DataFrame:
        return (df.withColumn("_sec", floor_div("us", MICROS_PER_SECOND))
                .withColumn("_day", floor_div("us", MICROS_PER_DAY)))

    per_us = units(events.select(*keys, "us", *measures).groupBy(*keys, "us").agg(*sums))
    marks = units(boundaries.select(*keys, "us").distinct())

    def level(cols: list[str], part: list[str], order: str,
              carrier: DataFrame | None) -> DataFrame:
        """Running sums over ``order`` within ``part``, read at the marks."""
        totals = (per_us.select(*cols, *measures) if order == "us"
                  else per_us.groupBy(*cols).agg(*sums))
        rows = (totals.select(*cols, *measures, F.lit(1).alias("_k"), *no_carry)
                .unionByName(marks.select(*cols).distinct()
                             .select(*cols, *zero, F.lit(0).alias("_k"), *no_carry)))
        if carrier is not None:
            rows = rows.unionByName(carrier)
        spec = Window.partitionBy(*part) if part else Window.partitionBy()
        running = (Window.partitionBy(*part) if part else Window).orderBy(order, "_k") \
            .rowsBetween(Window.unboundedPreceding, -1)
        values = [(F.coalesce(F.max(c).over(spec), F.lit(0))
                   + F.coalesce(F.sum(m).over(running), F.lit(0))).alias(c)
                  for m, c in zip(measures, carry)]
        return rows.select(*cols, "_k", *values).filter(F.col("_k") == 0).drop("_k")

    def as_carrier(done: DataFrame, cols: list[str]) -> DataFrame:
        missing = [c for c in cols if c not in done.columns]
        return done.select(*[F.lit(None).cast("bigint").alias(c) if c in missing else F.col(c)
                             for c in cols], *zero, F.lit(2).alias("_k"), *carry)

    day_cols = [*keys, "_day"]
    sec_cols = [*keys, "_day", "_sec"]
    us_cols = [*keys, "_sec", "us"]
    days = level(day_cols, keys, "_day", None)                      # earlier days
    secs = level(sec_cols, [*keys, "_day"], "_sec", as_carrier(days, sec_cols))
    exact = level(us_cols, [*keys, "_sec"], "us",
                  as_carrier(secs.drop("_day"), us_cols))
    return exact.select(*keys, "us", *[F.col(c).alias(f"c_{m}")
                                       for m, c in zip(measures, carry)])


def bucketed_windows(win: DataFrame, keys: list[str], group_by: Sequence[str],
                     bucket_us: int) -> DataFrame:
    """Windows (``_s``, ``_e`` epoch micros) cut into the buckets they touch."""
    first = floor_div("_s", bucket_us)
    last = floor_div(F.col("_e") - 1, bucket_us)          # end is exclusive
    return win.select(*group_by, *[k for k in keys if k not in group_by], "_s", "_e",
                      F.explode(F.sequence(first, last)).alias("_bkt"))


def broadcast_bound_holds(win: DataFrame, keys: Sequence[str], bucket_us: int,
                          max_rows: int = MAX_BROADCAST_ROWS,
                          max_candidates: int = MAX_CANDIDATES) -> bool:
    """Whether ``win`` (keys, ``_s``, ``_e``) may be broadcast in buckets.

    The number of bucket rows is a sum over the windows, so windows of any
    length cost nothing to measure; only when it holds are the (then few) rows
    made, to find the largest number of windows sharing a (key, bucket).
    Neither job reads the events.
    """
    cut = (floor_div(F.col("_e") - 1, bucket_us) - floor_div("_s", bucket_us) + 1).cast("double")
    if (win.agg(F.sum(cut)).first()[0] or 0) > max_rows:
        return False
    peak = (bucketed_windows(win, list(keys), [], bucket_us).groupBy(*keys, "_bkt")
            .agg(F.count(F.lit(1)).alias("_c")).agg(F.max("_c")).first()[0])
    return (peak or 0) <= max_candidates


def window_counts(events: DataFrame, time_col: str, windows: DataFrame,
                  measures: Mapping[str, Column], *, keys: Sequence[str] = (),
                  start: str = "start_time", end: str = "end_time",
                  group_by: Sequence[str] = ("lot_id",), strategy: str = "auto",
                  bucket_us: int = MICROS_PER_HOUR) -> DataFrame:
    """Sum of ``measures`` over events in each window ``[start, end)``,
    summed over the window rows sharing ``group_by``.

    ``keys`` are equality keys present in both inputs (empty: any event may
    fall in any window).  Windows with a NULL or non-positive range match
    nothing.  Groups without any valid window are absent; groups whose
    windows matched no event are present with 0.  A NULL key equals no key,
    so such windows match nothing; a NULL group is a group like any other.
    ``strategy``: 'auto' (broadcast when the bound holds, else prefix),
    'broadcast' or 'prefix'; the result is the same.
    """
    keys = list(keys)
    names = list(measures)
    ev = events.select(*keys, epoch_micros(time_col).alias("us"),
                       *[F.coalesce(c.cast("bigint"), F.lit(0)).alias(n)
                         for n, c in measures.items()])
    win = (windows.filter(F.col(end).isNotNull() & (F.col(end) > F.col(start)))
           .select(*group_by, *[k for k in keys if k not in group_by],
                   epoch_micros(start).alias("_s"), epoch_micros(end).alias("_e")))
    if strategy not in ("auto", "broadcast", "prefix"):
        raise ValueError(strategy)
    if strategy != "prefix":
        if strategy == "broadcast" or broadcast_bound_holds(win, keys, bucket_us):
            bucketed = bucketed_windows(win, keys, group_by, bucket_us)
            return _broadcast_counts(ev, win, bucketed, keys, group_by, names, bucket_us)
    return _prefix_counts(ev, win, keys, group_by, names)


def _broadcast_counts(ev: DataFrame, win: DataFrame, bucketed: DataFrame, keys: list[str],
                      group_by: Sequence[str], names: list[str], bucket_us: int) -> DataFrame:
    probe = ev.withColumn("_bkt", floor_div("us", bucket_us))
    hits = (probe.join(F.broadcast(bucketed), [*keys, "_bkt"])
            .filter((F.col("us") >= F.col("_s")) & (F.col("us") < F.col("_e"))))
    zero = [F.lit(0).cast("bigint").alias(m) for m in names]
    rows = hits.select(*group_by, *names).unionByName(
        win.select(*group_by).distinct().select(*group_by, *zero))
    return rows.groupBy(*group_by).agg(*[F.sum(m).alias(m) for m in names])


def _prefix_counts(ev: DataFrame, win: DataFrame, keys: list[str], group_by: Sequence[str],
                   names: list[str]) -> DataFrame:
    # each window contributes C(<end) with sign +1 and C(<start) with -1
    signed = win.select(*group_by, *[k for k in keys if k not in group_by],
                        F.explode(F.array(
                            F.struct(F.col("_e").alias("us"), F.lit(1).alias("sign")),
                            F.struct(F.col("_s").alias("us"), F.lit(-1).alias("sign"))))
                        .alias("_bd")).select("*", "_bd.us", "_bd.sign").drop("_bd")
    bounds = signed.select(*keys, "us").distinct()
    before = counts_before(ev, bounds, keys, names)
    # A boundary under a NULL key finds no count: it adds 0 to its group.
    per_bound = signed.join(before, [*keys, "us"], "left")
    return per_bound.groupBy(*group_by).agg(*[
        F.sum(F.col("sign") * F.coalesce(F.col(f"c_{m}"), F.lit(0))).alias(m) for m in names])
