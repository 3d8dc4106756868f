"""Containment lookup (C6) and lot throughput.

For a sensor event, the lot is the latest-starting lot of the event's line
whose window contains the instant, end **inclusive**, open lots (NULL end)
never ending.  A nested lot that ended earlier falls back to the enclosing
one, so this is not a plain as-of join on start time.

Plan: the best lot depends only on (line, instant), so events are first
collapsed to distinct (line, instant) (partial aggregation absorbs hot
instants).  Time is cut into buckets (width from the lots' median length, see
``operators.buckets``).  A lot is met by itself only in the buckets where it
starts and ends.  The buckets that it covers whole are written as a few aligned
cells, each four times as long as one of the level below, and a cell keeps the
latest-starting of its lots; a lot of any length costs a number of cells that
grows with the logarithm of its length.  Buckets with events climb the levels
that occur and take the best of the cells above them.  Lots that outlast the
line's last event (open ones, or ends far in the future) cover up to the bucket
of that event.  No window and no group holds a line's history.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linepulse.functions import epoch_micros, floor_div
from linepulse.operators.buckets import auto_bucket_us


def _aligned_cells(spans: DataFrame) -> DataFrame:
    """The buckets from ``_lo`` up to ``_hi`` (exclusive) as the fewest aligned
    cells of 4 ^ ``_level`` buckets, at most six a level.  On each level the
    span is cut to whole cells; those without a place in the next level's cut
    are its rows, up to three on either side."""
    top = F.ceil(F.log2((F.col("_hi") - F.col("_lo")).cast("double")) / 2).cast("int")
    cut = (spans.filter(F.col("_lo") < F.col("_hi"))
           .withColumn("_level", F.explode(F.sequence(F.lit(0), top)))
           .withColumn("_first", F.expr("-shiftright(-_lo, 2 * _level)"))
           .withColumn("_end", F.expr("shiftright(_hi, 2 * _level)"))
           .withColumn("_left", F.least(F.expr("-shiftright(-_lo, 2 * _level + 2) * 4"), F.col("_end")))
           .withColumn("_right", F.greatest(F.expr("shiftright(_hi, 2 * _level + 2) * 4"), F.col("_left"))))
    sides = [F.when(F.col("_first") + k < F.col("_left"), F.col("_first") + k) for k in range(3)]
    sides += [F.when(F.col("_end") - k >= F.col("_right"), F.col("_end") - k) for k in range(1, 4)]
    return (cut.withColumn("_cell", F.explode(F.array(*sides))).filter(F.col("_cell").isNotNull())
            .drop("_lo", "_hi", "_first", "_end", "_left", "_right"))


def containing_lot(events: DataFrame, lots: DataFrame, t: str = "input_time",
                   line: str = "line_id", tie: str | None = "event_id",
                   bucket_us: int | Column | None = None,
                   lot_columns: tuple[str, ...] = ()) -> DataFrame:
    """Per distinct (line, instant): the containing lot with the latest
    (start_time, lot_id).  Output: line, ``us``, ``last_tie`` (largest tie
    value at that instant, if ``tie``), ``lot_id``, ``lot_start_us`` and
    ``lot_columns``; instants with no containing lot are absent.
    ``bucket_us``: bucket width (default: from the lots' median length)."""
    if bucket_us is None:
        bucket_us = auto_bucket_us(lots)
    if tie:
        pts = (events.select(line, epoch_micros(t).alias("us"), tie)
               .groupBy(line, "us").agg(F.max(tie).alias("last_tie")))
    else:
        pts = (events.select(line, epoch_micros(t).alias("us")).distinct()
               .withColumn("last_tie", F.lit(None).cast("bigint")))
    pts = pts.withColumn("_bkt", floor_div("us", bucket_us))
    last_event = pts.groupBy(line).agg(F.max("us").alias("_line_last"), F.max("_bkt").alias("_last_bkt"))
    pick = F.struct("_s", "lot_id", *lot_columns)     # greatest: latest (start, lot_id)
    lasting = F.col("_e").isNull() | (F.col("_e") >= F.col("_line_last"))
    lw = (lots.select("lot_id", line, epoch_micros("start_time").alias("_s"),
                      epoch_micros("end_time").alias("_e"), *lot_columns)
          .join(last_event, line)
          .filter((F.col("_s") <= F.col("_line_last")) & (F.col("_e").isNull() | (F.col("_e") >= F.col("_s"))))
          .withColumn("_lot", pick)
          .withColumn("_b0", floor_div("_s", bucket_us))
          .withColumn("_b1", F.when(lasting, F.col("_last_bkt") + 1).otherwise(floor_div("_e", bucket_us))))
    edges = (lw.withColumn("_bkt", F.explode(F.array_distinct(F.array("_b0", F.when(lasting, F.col("_b0"))
                                                                      .otherwise(F.col("_b1")))))))
    cells = (_aligned_cells(lw.select(line, "_lot", (F.col("_b0") + 1).alias("_lo"), F.col("_b1").alias("_hi")))
             .groupBy(line, "_level", "_cell").agg(F.max("_lot").alias("_lot")))
    levels = cells.select(F.collect_set("_level").alias("levels")).scalar()
    covered = (pts.select(line, "_bkt").distinct()
               .withColumn("_levels", levels).withColumn("_level", F.explode("_levels"))
               .withColumn("_cell", F.expr("shiftright(_bkt, 2 * _level)"))
               .join(cells, [line, "_level", "_cell"])
               .groupBy(line, "_bkt").agg(F.max("_lot").alias("_lot")))
    bound = F.lit(None).cast("bigint")
    met = (edges.select(line, "_bkt", "_lot", "_s", "_e")
           .unionByName(covered.select(line, "_bkt", "_lot", bound.alias("_s"), bound.alias("_e"))))
    cand = pts.join(met, [line, "_bkt"]).filter(
        (F.col("_s").isNull() | (F.col("us") >= F.col("_s")))
        & (F.col("_e").isNull() | (F.col("us") <= F.col("_e"))))
    best = cand.groupBy(line, "us").agg(
        F.first("last_tie").alias("last_tie"),
        F.max("_lot").alias("_lot"))
    return best.select(line, "us", "last_tie", F.col("_lot.lot_id").alias("lot_id"),
                       F.col("_lot._s").alias("lot_start_us"),
                       *[F.col(f"_lot.{c}").alias(c) for c in lot_columns])


def event_lot_lookup(events: DataFrame, lots: DataFrame, t: str = "input_time",
                     line: str = "line_id") -> DataFrame:
    """C6 per event row: the event columns plus ``lot_id`` and ``lot_start``."""
    best = containing_lot(events, lots, t, line, tie=None)
    ev = events.withColumn("us", epoch_micros(t))
    return (ev.join(best.select(line, "us", "lot_id", "lot_start_us"), [line, "us"])
            .withColumn("lot_start", F.timestamp_add(
                "MICROSECOND", F.col("lot_start_us"),
                F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")))
            .drop("us", "lot_start_us"))


def last_hits(events: DataFrame, lots: DataFrame, t: str = "input_time",
              line: str = "line_id", tie: str = "event_id") -> DataFrame:
    """Per lot id, the last event (by instant, then ``tie``) whose lookup
    found it: ``lot_id, us, last_tie, lot_start_us, line_id``."""
    best = containing_lot(events, lots, t, line, tie)
    last = best.groupBy("lot_id").agg(
        F.max(F.struct("us", "last_tie", "lot_start_us", line)).alias("_h"))
    return last.select("lot_id", "_h.us", "_h.last_tie", "_h.lot_start_us",
                       F.col(f"_h.{line}").alias(line))


def throughput_value(hits: DataFrame) -> DataFrame:
    """``coalesce(qty_out, 0) / elapsed minutes`` from (lot_id, us,
    lot_start_us, qty_out); 0 when the elapsed time is not positive."""
    elapsed_s = (F.col("us") - F.col("lot_start_us")).cast("double") / F.lit(1e6)
    qty = F.coalesce(F.col("qty_out"), F.lit(0)).cast("double")
    value = F.when(elapsed_s > 0, qty / (elapsed_s / F.lit(60.0))).otherwise(F.lit(0.0))
    return hits.select("lot_id", value.alias("throughput"))


def matched_quantity(hits: DataFrame, lots: DataFrame, line: str = "line_id") -> DataFrame:
    """Attach the matched lot row's ``qty_out`` (row = lot id, line, start)."""
    rows = (lots.select("lot_id", line, epoch_micros("start_time").alias("lot_start_us"),
                        "qty_out")
            .groupBy("lot_id", line, "lot_start_us").agg(F.max("qty_out").alias("qty_out")))
    return hits.join(rows, ["lot_id", line, "lot_start_us"], "left")


def lot_throughput(events: DataFrame, lots: DataFrame, t: str = "input_time",
                   line: str = "line_id", tie: str = "event_id") -> DataFrame:
    """Per lot id, ``coalesce(qty_out, 0) / (elapsed minutes)`` at the
    last event (by instant, then ``tie``) whose lookup found that lot id;
    0 when elapsed <= 0.  ``qty_out`` is the matched lot row's.  Lots no
    event found get no row."""
    hits = last_hits(events, lots, t, line, tie)
    return throughput_value(matched_quantity(hits, lots, line))


def set_throughput(lot: DataFrame, throughput: DataFrame) -> DataFrame:
    """Every lot row sharing the id gets the value; others keep theirs."""
    t = throughput.select("lot_id", F.col("throughput").alias("_tp"))
    return (lot.join(t, "lot_id", "left")
            .withColumn("throughput", F.coalesce("_tp", "throughput"))
            .select(*lot.columns))
